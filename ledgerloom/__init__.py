"""ledgerloom: KPI and financial-reporting operators for PySpark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Spark's own expressions.
"""
