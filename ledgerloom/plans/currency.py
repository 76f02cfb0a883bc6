"""Reporting-currency rows and the concepts that must not be converted or cumulated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scenarios import SINGLE_PERIOD, YEAR_TO_DATE
from ledgerloom.functions.types import MONEY, PUBLISHED
from ledgerloom.plans.periods import LOCAL, REPORTING

# The exchange-rate concept and the concepts that are no money amounts.
RATE_CONCEPT = 1
NON_MONETARY = (1, 2, 3, 4, 28)
REPORTING_SCALE = 1000


def currency_block(rows: DataFrame) -> DataFrame:
    """Local rows as they are, year-to-date rows also in thousands of the reporting currency.

    Needs ``rate_acc``. A zero or missing rate, or a missing concept, gives no reporting row. Equal
    rows are merged before the rates are dropped.
    """
    local = F.struct(F.col("amount").cast(MONEY).alias("amount"), F.col("currency"))
    converted = F.try_divide(F.col("amount").cast(PUBLISHED), F.col("rate_acc")).cast(MONEY)
    reporting = F.struct(converted.alias("amount"), F.lit(REPORTING).alias("currency"))
    versions = F.filter(
        F.array(
            F.when(F.col("currency") == LOCAL, local),
            F.when(F.col("data_type_id") == YEAR_TO_DATE, reporting),
        ),
        lambda v: v.isNotNull() & v["amount"].isNotNull(),
    )
    keep = [c for c in rows.columns if c not in ("amount", "currency")]
    both = rows.select(*keep, F.inline(versions).alias("amount", "currency")).distinct()
    scaled = F.when(F.col("currency") == REPORTING, (F.col("amount") / REPORTING_SCALE).cast(MONEY))
    return (
        both.where((F.col("currency") == LOCAL) | F.col("concept_id").isNotNull())
        .withColumn("amount", F.coalesce(scaled, F.col("amount")))
        .drop("rate_acc", "rate_month")
    )


def rewrite_rate_concept(rows: DataFrame, concept: int = RATE_CONCEPT) -> DataFrame:
    """A rate is not cumulated: its year-to-date rows are copies of its single-period rows."""
    is_rate = F.col("concept_id").eqNullSafe(F.lit(concept))
    both = F.array(F.lit(SINGLE_PERIOD), F.lit(YEAR_TO_DATE))
    single, ytd = F.array(F.lit(SINGLE_PERIOD)), F.array(F.lit(YEAR_TO_DATE))
    versions = F.when(
        F.col("data_type_id") == SINGLE_PERIOD, F.when(is_rate, both).otherwise(single)
    ).when((F.col("data_type_id") == YEAR_TO_DATE) & (F.col("concept_id") != concept), ytd)
    typed = rows.withColumn("amount", F.col("amount").cast(PUBLISHED)).where(F.col("amount").isNotNull())
    return typed.withColumn("data_type_id", F.explode(versions))


def pass_through(rows: DataFrame, concepts: Sequence[int] = NON_MONETARY) -> DataFrame:
    """Concepts that are no money: their reporting rows are copies of the local rows."""
    listed = F.col("concept_id").isin(list(concepts))
    both = F.array(F.lit(LOCAL), F.lit(REPORTING))
    versions = F.when(F.col("currency") == LOCAL, F.when(listed, both).otherwise(F.array(F.lit(LOCAL)))).when(
        (F.col("currency") == REPORTING) & ~listed, F.array(F.lit(REPORTING))
    )
    typed = rows.withColumn("amount", F.col("amount").cast(PUBLISHED)).where(F.col("amount").isNotNull())
    return typed.withColumn("currency", F.explode(versions))
