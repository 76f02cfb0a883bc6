"""How far the sources of a language diverge in their terms, from bitmaps of terms per count level.

Term ids are dealt to blocks. Within a block every source keeps one bitmap for each count that its
terms have there; levels of few terms are kept as ids, as compressed bitmaps do. AND and popcount of
two levels give the number of terms with this pair of counts, and all terms of such a cell add the
same amount. Cells in which one source or both have no occurrence follow by complement.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, stored, utf8

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
BLOCK_TERMS = 1024
BLOCK_CELLS = 1 << 20  # terms times sources of a block
PART_SOURCES = 64
HELD_KEYS = 400_000
DENSE = 8  # levels of fewer terms in a block are kept as ids
_RUN = 4 << 20

# A-Z become a-z, all other ASCII signs but a-z end a term, bytes of other code points stay.
_FOLD = bytes(b if b > 0x7F or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_runs(text: bytes):
    """The terms of a text as lists of bounded length, in order."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        stop = len(folded)
        if stop - at > _RUN:
            cut = folded.find(b" ", at + _RUN)
            stop = cut if cut >= 0 else stop
        yield folded[at:stop].split()
        at = stop


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) summed as far as a task can hold them; rows repeat across tasks."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    most = HELD_KEYS

    def task(batches):
        held, keys = {}, 0

        def rows():
            for (lang, source), (n, seen) in held.items():
                terms = pa.array([t.decode() for t in n], pa.string())
                same = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                counts = [pa.array(x, pa.int64()) for x in (list(n.values()), [seen[t] for t in n])]
                yield pa.RecordBatch.from_arrays([*same, terms, *counts], schema=schema)

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, seen = held.setdefault((lang, source), (Counter(), Counter()))
                keys -= len(n)
                own = set()
                for run in term_runs(text):
                    n.update(run)
                    own.update(run)
                seen.update(own)
                keys += len(n)
                if keys > most:
                    yield from rows()
                    held, keys = {}, 0
        yield from rows()

    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    texts = docs.select(*names, F.coalesce(utf8("text"), F.lit(b"")).alias("text"))
    return texts.mapInArrow(task, "lang string, source string, term string, n bigint, docs bigint")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, sources, counts): terms in at least ``min_docs`` documents of their language."""
    rows = counted(docs).repartition("lang", "term")  # one shuffle serves both groupings
    rows = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = F.collect_list(F.struct("source", "n"))
    rows = rows.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), held.alias("held"))
    rows = rows.where(F.col("docs") >= min_docs)
    return rows.select("lang", "term", "n", F.col("held.source").alias("sources"), F.col("held.n").alias("counts"))


def smoothed(counts, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for counts of any size."""
    levels, at = np.unique(np.asarray(counts, dtype=np.int64), return_inverse=True)
    shares = [1 + SCALE * (int(c) + 2) // (total + 2 * terms) for c in levels]
    return np.array(shares, dtype=np.int64)[at]


def divergence(p, q):
    """floor((p - q)^2 / (p + q)); both are at most SCALE + 1, so squares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


class Levels:
    """One source within a block: its share of each term and bitmaps of the terms of each count."""

    def __init__(self, counts: np.ndarray, total: int, terms: int):
        p = smoothed(np.append(counts, 0), total, terms)
        self.p, self.zero = p[:-1], p[-1]
        self.held = counts > 0
        levels, first, at, sizes = np.unique(counts, return_index=True, return_inverse=True, return_counts=True)
        self.shares, self.sizes = self.p[first][levels > 0], sizes[levels > 0]
        dense = (levels > 0) & (sizes >= DENSE)
        self.dense_shares = self.p[first][dense]
        self.sparse = self.held & ~dense[at]
        bits = np.packbits(at[None, :] == np.flatnonzero(dense)[:, None], axis=1)
        self.bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def block_value(g: Levels, h: Levels) -> int:
    """The sum of the divergence over all terms of a block."""
    only_g, only_h = divergence(g.shares, h.zero), divergence(g.zero, h.shares)
    none = divergence(g.zero, h.zero)
    # As if no term were held by both ...
    value = int(g.sizes @ only_g) + int(h.sizes @ only_h) + (len(g.p) - int(g.sizes.sum()) - int(h.sizes.sum())) * int(none)

    def both(p, q):  # ... and what a term held by both adds to that
        return divergence(p, q) - divergence(p, h.zero) - divergence(g.zero, q) + none

    if len(g.bits) and len(h.bits):
        joint = np.bitwise_count(g.bits[:, None, :] & h.bits[None, :, :]).sum(axis=2, dtype=np.int64)
        value += int((joint * both(g.dense_shares[:, None], h.dense_shares[None, :])).sum())
    ids = np.flatnonzero((g.sparse & h.held) | (h.sparse & g.held))
    return value + int(both(g.p[ids], h.p[ids]).sum())


def _block(rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """The part of every pair's value, and the greatest terms of every source, within one block."""
    head, rows = rows[rows["term"].isna()].iloc[0], rows[rows["term"].notna()]
    lang, part, parts, terms = head["lang"], int(head["part"]), int(head["parts"]), int(head["terms"])
    names, totals = list(head["sources"]), [int(x) for x in head["counts"]]
    out = defaultdict(list)

    def add(kind, source, item, value):
        for column, x in zip(("part", "source", "item", "value"), (kind, source, item, value), strict=True):
            out[column].append(x)

    mine = range(part, len(names), parts)
    levels = []
    if terms:
        at = {name: i for i, name in enumerate(names)}
        counts = np.zeros((len(names), len(rows)), dtype=np.int64)
        for t, (sources, own) in enumerate(zip(rows["sources"], rows["counts"], strict=True)):
            counts[[at[s] for s in sources], t] = own
        levels = [Levels(c, n, terms) for c, n in zip(counts, totals, strict=True)]
    for i in mine:
        for j in range(i + 1, len(names)):
            value = block_value(levels[i], levels[j]) if terms else 0
            add("pair", names[i], names[j], value)
            add("pair", names[j], names[i], value)
    if terms:
        words = rows["term"].to_numpy()
        whole = smoothed(rows["n"].to_numpy(), int(head["n"]), terms)
        for i in mine:
            more = np.flatnonzero(levels[i].held & (levels[i].p > whole))
            values = divergence(levels[i].p[more], whole[more])
            for value, word in sorted(zip(-values, words[more], strict=True))[:top]:
                add("term", names[i], word, -int(value))
    frame = pd.DataFrame(out, columns=["part", "source", "item", "value"])
    frame.insert(0, "lang", lang)
    return frame


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): sources compared in pairs, and their own terms.

    Null lang, source and text count as ''. Part ``pair`` has every other source of the language,
    part ``term`` the ``top`` terms that are more frequent in the source than in its language.
    Repeated rows are documents of their own; a source without terms, and a language without kept
    terms (values 0), have their pairs. Ties rank by item. An empty table gives no rows; other
    columns are not read. A source that is alone in its language has no pairs.
    """
    bounded_batches(docs.sparkSession)
    kept = stored(kept_terms(docs, min_docs), "audit-terms")
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    pairs = kept.select("lang", F.arrays_zip("sources", "counts").alias("held")).select("lang", F.inline("held"))
    totals = pairs.groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    groups = docs.select(*names).distinct().join(totals, ["lang", "source"], "left").fillna(0, ["n"])
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("held"), F.sum("n").alias("n"))
    langs = langs.join(kept.groupBy("lang").agg(F.count("*").alias("terms")), "lang", "left").fillna(0, ["terms"])
    size = F.greatest(F.lit(64), F.least(F.lit(BLOCK_TERMS), F.floor(BLOCK_CELLS / F.size("held"))))
    langs = langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / size)))
    langs = stored(langs.withColumn("parts", F.ceil(F.size("held") / PART_SOURCES)), "audit-languages")

    def upto(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))

    heads = langs.select("*", upto(F.col("blocks")).alias("block")).select("*", upto(F.col("parts")).alias("part"))
    columns = ["lang", "block", "part", "parts", "term", "n", "terms"]
    heads = heads.withColumn("term", F.lit(None).cast("string"))
    heads = heads.select(*columns, F.col("held.source").alias("sources"), F.col("held.n").alias("counts"))
    rows = kept.join(langs.select("lang", "blocks", "parts", "terms"), "lang")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("term"), "blocks")).select("*", upto(F.col("parts")).alias("part"))
    tasks = langs.agg(F.coalesce(F.sum(F.col("blocks") * F.col("parts")), F.lit(1))).first()[0]
    dealt = heads.unionByName(rows.select(heads.columns)).repartition(min(int(tasks), 4096), "lang", "block", "part")
    made = dealt.groupBy("lang", "block", "part").applyInPandas(
        lambda x: _block(x, top), "lang string, part string, source string, item string, value bigint"
    )
    made = stored(made, "audit-blocks")  # read twice below
    pairs = made.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = made.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    every = pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
    return every.select("lang", "source", "part", "item", "value", "rank")
