"""A corpus pipeline: five stages over ``documents``, each one operator whose decisions take effect.

Null and empty texts, null and repeated ids and empty tables pass every stage; other columns keep their
values, whatever they are called. Rows without id are never dropped for being like others or for holding a
benchmark item, since these decisions name documents by their id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import quality
from ledgerloom.llm.common import in_training, stored
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.line_dedup import dedup_lines
from ledgerloom.llm.ngram_join import similar_groups
from ledgerloom.llm.packing import pack


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_own(docs: DataFrame, names: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after ``stage``; those called like what the stage adds keep their values."""
    aside = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    out = stage(docs.withColumnsRenamed(aside))
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; the classifier is fitted on the given ones."""

    def stage(own: DataFrame) -> DataFrame:
        trees = quality.train(own, _table(spark, sf_dir, "labels"), in_training(F.col("doc_id"), 3, 1))
        return quality.score(own, trees).where("predicted = 1")

    return _with_own(docs, ("score", "predicted"), stage)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller document holds; n_chars follows the text."""

    def stage(own: DataFrame) -> DataFrame:
        kept = dedup_lines(own)
        if "n_chars" in own.columns:
            kind = own.schema["n_chars"].dataType
            changed = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
            kept = kept.withColumn("n_chars", changed.cast(kind))
        return kept

    return _with_own(docs, ("n_lines", "n_dropped", "kept_sha256"), stage)


def similar_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: the smallest id. Documents alone stay, rows without id too."""
    groups = similar_groups(docs)
    # Stored, so that Spark sees how few ids there are before it would shuffle the texts.
    away = stored(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "pipeline-similar")
    return docs.join(away, "doc_id", "left_anti").select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    leaks = stored(contaminated(docs, _table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every kept document goes: its pieces, their bins and places."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", similar_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

# A fitted classifier and a greedy packing have no SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result but the last is stored and read back by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
