"""Column types shared by all stages."""

from pyspark.sql import types as T

MONEY = T.DecimalType(24, 10)
PUBLISHED = T.DecimalType(24, 3)
SOURCE_MONEY = T.DecimalType(16, 2)
SERVICE_MONEY = T.DecimalType(38, 2)
PERIOD = T.IntegerType()
