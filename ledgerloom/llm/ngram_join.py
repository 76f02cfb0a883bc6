"""Jaccard join on five-word shingles by prefix filters under several global token orders.

Texts with equal shingle sets are one class, worked on once. Under an order, two sets that reach the
threshold share one of their first n - ceil(t n) + 1 shingles. Orders put frequent shingles last,
by a count sketch over all documents, and differ in how they break ties. The first order
generates candidates; a candidate pair is verified only if its prefixes meet under the others too.

Only components are asked for, so a group of near copies is not expanded into its pairs. Each
prefix shingle's members are first compared with its hub, the member with the fewest rarer shingles,
that is the least edited copy. Pairs that are then still in different components are compared
as well, unless their places in the prefixes show that they can't reach the threshold. No link between
different components is left out, whatever the size of a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.llm.common import bounded_batches, chunks, stored, utf8
from ledgerloom.llm.components import components
from ledgerloom.llm.filters import contains, seen_filters
from ledgerloom.llm.words import mixed, scan, shingle_sets

PERCENT = 75
ORDERS = 3
TEXT_PER_COUNTER = 128  # bytes of text for each counter of the sketch, so that its load stays the same
SKETCH_LOG2 = (16, 26)  # least and most; a counter is one byte where the sketch is broadcast
_SEGMENTS = 64
_CANDIDATE_LOG2 = 24
POSTINGS_PER_RANGE = 500_000
HELD_POSTINGS = 1_000_000
OFTEN = 2 * 16  # level of shingles counted 2**16 times and more
SPREAD = 64
_PACKED = ["range", "tokens", "classes", "sizes", "places"]
_PACK_ROWS = 32  # rows of an Arrow batch of packs
PAIRS_PER_HUB = 5_000


def _sets(batches, text: int = 1) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray]]:
    for batch in batches:
        for first, run in chunks(batch.column(text).to_pylist()):
            for k, s in enumerate(shingle_sets(scan(run))):
                yield batch, first + k, s


def _class_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _sketch_log2(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(np.clip(np.ceil(np.log2(max(total / TEXT_PER_COUNTER, 1))), *SKETCH_LOG2))


def _counted(docs: DataFrame, log2: int, keep: Sequence[str]) -> DataFrame:
    """Per document its class, set size and words, and per task the counts of its shingles by sketch bucket."""
    kept = [docs.schema[c].jsonValue() for c in keep]
    kind = StructType.fromJson({"type": "struct", "fields": [f | {"nullable": True} for f in kept]})
    kind = StructType.fromDDL("doc_id bigint, class bigint, n bigint, n_words bigint, segment int, counts binary").fields + kind.fields
    kind = StructType(kind)

    def task(batches):
        counts = np.zeros(1 << log2, dtype=np.uint32)
        shift = np.uint64(64 - log2)
        types = []
        for batch in batches:
            types = [c.type for c in batch.columns[2:]]
            classes, sizes, lengths, all_sets = [], [], [], []
            for _, run in chunks(batch.column(1).to_pylist()):
                words = scan(run)
                lengths += np.diff(words.first).tolist()
                for s in shingle_sets(words):
                    classes.append(_class_id(s) if len(s) else None)
                    sizes.append(len(s))
                    all_sets.append(s)
            if all_sets:
                np.add.at(counts, (np.concatenate(all_sets) >> shift).astype(np.int64), np.uint32(1))
            own = [batch.column(0), *(pa.array(x, pa.int64()) for x in (classes, sizes, lengths))]
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([*own, none.cast(pa.int32()), none.cast(pa.binary()), *batch.columns[2:]], names=kind.names)
        parts = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, _SEGMENTS)] if counts.any() else []
        if parts:
            none = pa.nulls(len(parts))
            rows = [*[none.cast(pa.int64())] * 4, pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*rows, *[none.cast(t) for t in types]], names=kind.names)

    texts = docs.select(F.col("doc_id").cast("bigint"), utf8("text"), *keep)
    return texts.mapInArrow(task, kind)


def _levels(counted: DataFrame, log2: int) -> np.ndarray:
    """Frequency level of each sketch bucket: twice the binary logarithm of its count."""
    schema = pa.schema([("segment", pa.int32()), ("levels", pa.binary())])

    def task(batches):
        current, total = None, None

        def done():
            level = np.floor(2 * np.log2(np.maximum(total, 1))).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([level.tobytes()])], schema=schema)

        for batch in batches:
            for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(counts), dtype=np.uint32).astype(np.uint64)
                if segment != current:
                    if current is not None:
                        yield done()
                    current, total = segment, part
                else:
                    total = total + part
        if current is not None:
            yield done()

    rows = (
        counted.where(F.col("segment").isNotNull())
        .select("segment", "counts")
        .repartition("segment")
        .sortWithinPartitions("segment")
        .mapInArrow(task, "segment int, levels binary")
        .collect()
    )
    levels = np.zeros(1 << log2, dtype=np.uint8)
    step = len(levels) // _SEGMENTS
    for row in rows:
        levels[row["segment"] * step : (row["segment"] + 1) * step] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels


def prefix(s: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first n - ceil(t n) + 1 shingles of a set: rare ones first, ties by the shingle or, under later orders, a hash of it."""
    size = len(s) - (-(-percent * len(s) // 100)) + 1
    level = levels[(s >> np.uint64(64 - (len(levels).bit_length() - 1))).astype(np.int64)]
    if not order:  # the set is sorted
        return s[np.argsort(level, kind="stable")[:size]]
    tie = mixed(s ^ np.uint64(0x5851F42D4C957F2D * (order + 1) & (1 << 64) - 1))
    # What agrees in level and tie stays in the order of the shingles, so the order is one for all sets.
    return s[np.argsort(level.astype(np.uint64) << np.uint64(56) | tie >> np.uint64(8), kind="stable")[:size]]


def _range_log2(postings: int) -> int:
    return int(np.clip(np.ceil(np.log2(max(postings / POSTINGS_PER_RANGE, 1))), 4, 15))


def _posted(docs: DataFrame, levels, percent: int, log2: int) -> DataFrame:
    """Prefix shingles with class, set size and place, packed by range of shingles.

    What the sketch counts very often does not go to its range, where it could be more than a task
    holds, but is spread over ranges below zero.
    """
    kinds = (np.uint64, np.int64, np.int32, np.int32)
    frequent, most = OFTEN, HELD_POSTINGS

    def packed(held) -> pa.RecordBatch:
        columns = [np.concatenate([h[k] for h in held]).astype(kind) for k, kind in enumerate(kinds)]
        bucket = columns[0] >> np.uint64(64 - (len(levels.value).bit_length() - 1))
        often = levels.value[bucket.astype(np.int64)] >= frequent
        at = np.where(often, -1 - columns[1] % SPREAD, (columns[0] >> np.uint64(64 - log2)).astype(np.int64)).astype(np.int16)
        order = np.argsort(at, kind="stable")
        ranges, first = np.unique(at[order], return_index=True)
        bounds = [*first.tolist(), len(order)]
        columns = [c[order] for c in columns]
        cut = [[c[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int32)), *(pa.array(c, pa.binary()) for c in cut)], names=_PACKED)

    def task(batches):
        known, held, size = set(), [], 0  # known: classes this task has posted
        for batch in batches:
            for _, _, s in _sets([batch], 0):
                if not len(s) or (own := _class_id(s)) in known:
                    continue
                known.add(own)
                head = prefix(s, levels.value, 0, percent)
                held.append((head, np.full(len(head), own), np.full(len(head), len(s)), np.arange(len(head))))
                size += len(head)
                if size >= most:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return docs.select(utf8("text")).mapInArrow(task, ", ".join(f"{c} {'int' if c == 'range' else 'binary'}" for c in _PACKED))


def _met(posted: DataFrame) -> DataFrame:
    """The postings (token, class, n, place) of shingles that are posted more than once, as rows.

    Packs of a range meet in a task, which sorts them in memory: a range is a bounded share of the
    rarer shingles. Postings of frequent shingles pass.
    """
    kinds = (np.int64, np.int64, np.int32, np.int32)

    def shared(packs) -> pa.RecordBatch:
        columns = [np.concatenate([np.frombuffer(p[k], dtype=kind) for p in packs]) for k, kind in enumerate(kinds)]
        order = np.argsort(columns[0], kind="stable")
        tokens = columns[0][order]
        same = tokens[1:] == tokens[:-1]
        keep = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["token", "class", "n", "place"])

    def passed(pack) -> pa.RecordBatch:
        columns = [pa.array(np.frombuffer(x, dtype=kind)) for x, kind in zip(pack, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["token", "class", "n", "place"])

    def task(batches):
        current, packs = None, []
        for batch in batches:
            for at, *pack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at < 0:
                    yield passed(pack)
                    continue
                if at != current:
                    if packs:
                        yield shared(packs)
                    current, packs = at, []
                packs.append(pack)
        if packs:
            yield shared(packs)

    rows = posted.repartition("range").sortWithinPartitions("range")
    return rows.mapInArrow(task, "token bigint, class bigint, n int, place int")


def _buckets(docs: DataFrame, levels, percent: int, postings: int) -> DataFrame:
    """Prefix shingles that several classes share, with the place in each prefix and the hub.

    Most shingles are posted once; they are dropped from packs, before rows are grouped by shingle.
    """
    spark = docs.sparkSession
    bounded_batches(spark, _PACK_ROWS)
    met = _met(_posted(docs, levels, percent, _range_log2(postings)))
    met = stored(met.dropDuplicates(["token", "class", "n"]), "join-met")
    bounded_batches(spark)
    # Combined where the rows are read, so that a frequent shingle is one row per task.
    about = met.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("n").alias("least"),
        F.max(F.col("n") - F.col("place")).alias("most"),
        F.min(F.struct("place", "class", "n")).alias("hub"),
    )
    about = stored(about.where("size > 1").drop("size"), "join-shingles")
    placed = met.join(about, "token")
    # A member that no partner of this shingle could complete is not needed here: at the first common
    # shingle of a similar pair both members stay.
    partner = F.least(F.col("n") - F.col("place"), "most")
    useful = F.lit(100 + percent) * partner >= F.lit(percent) * (F.col("n") + F.col("least"))
    return placed.where(useful).drop("least", "most")


def _reachable(a: str, b: str, percent: int) -> F.Column:
    """Whether sets of these sizes can reach the threshold at all."""
    small, large = F.least(a, b), F.greatest(a, b)
    return F.lit(100) * small >= F.lit(percent) * large


def _completable(percent: int) -> F.Column:
    """Whether the sets of a and b can share enough, seen from the places of a common shingle.

    Shingles before the first common one are not shared, so n - place bounds what is. At a later
    common shingle the bound is only lower; a similar pair passes at its first.
    """
    at_most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = F.lit(100 + percent) * at_most >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))
    return _reachable("n_a", "n_b", percent) & enough


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, levels, percent: int) -> DataFrame:
    """The pairs (class_a, n_a, class_b, n_b) that share prefixes under every order and are similar.

    Only documents that represent a class of a pair are shingled again; a Bloom filter of their ids,
    of fixed size, picks them from the scan, so that texts are not shuffled.
    """
    spark = docs.sparkSession
    ends = pairs.select(F.col("class_a").alias("class"), F.col("n_a").alias("n")).union(pairs.select("class_b", "n_b"))
    wanted = ends.distinct().join(classes, ["class", "n"]).select("first_id")
    bits = spark.sparkContext.broadcast(seen_filters(wanted, _CANDIDATE_LOG2)[0])
    heads = [f"head{k}" for k in range(1, ORDERS)]
    kind = "class bigint, n int, shingles array<bigint>, " + ", ".join(f"{h} array<int>" for h in heads)

    def task(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            batch = batch.filter(pa.array(contains(bits.value, _CANDIDATE_LOG2, ids.view(np.uint64))))
            out = [[], [], [], *([] for _ in heads)]
            for _, _, s in _sets([batch]):
                if len(s):
                    out[0].append(_class_id(s))
                    out[1].append(len(s))
                    out[2].append(s.view(np.int64))
                    for order in range(1, ORDERS):  # half of each hash is enough for a filter
                        out[2 + order].append(prefix(s, levels.value, order, percent).astype(np.uint32).view(np.int32))
            types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * len(heads)]
            names = ["class", "n", "shingles", *heads]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    known = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint"), utf8("text"))
    # One shuffle of the sets, used for both ends of the pairs. Repeated rows would repeat a class.
    sets = known.mapInArrow(task, kind).repartition("class", "n").dropDuplicates(["class", "n"])
    # A hub of very many pairs is copied, and its pairs are dealt over the copies.
    hubs = pairs.groupBy("class_a", "n_a").agg((F.count(F.lit(1)) / PAIRS_PER_HUB + 1).cast("int").alias("copies"))
    dealt = pairs.join(hubs, ["class_a", "n_a"])
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64("class_b", "n_b"), F.col("copies"))).drop("copies")
    renamed = {end: sets.select(*[F.col(c).alias(f"{c}_{end}") for c in sets.columns]) for end in "ab"}
    hub_sets = renamed["a"].join(hubs, ["class_a", "n_a"])
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("copies").cast("bigint") - 1)
    hub_sets = hub_sets.withColumn("copy", F.explode(numbers)).drop("copies")
    met = dealt.join(renamed["b"], ["class_b", "n_b"]).join(hub_sets, ["class_a", "n_a", "copy"])
    for head in heads:
        met = met.where(F.arrays_overlap(f"{head}_a", f"{head}_b"))
    met = met.withColumn("shared", F.size(F.array_intersect("shingles_a", "shingles_b")))
    similar = F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return met.where(similar).select("class_a", "n_a", "class_b", "n_b")


def _node(end: str) -> F.Column:
    return F.struct(F.col(f"class_{end}").alias("class"), F.col(f"n_{end}").alias("n")).alias(f"node_{end}")


def similar_groups(docs: DataFrame, percent: int = PERCENT, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_words, class, keep ..) for every row of ``docs``.

    A text's set is its distinct five-word shingles (the whole sequence if it has fewer words, nothing
    without words); two texts link when 100 * shared >= percent * all. component_id is the smallest
    doc_id reachable by links, the own id for a text without words. Null text counts as empty. Null
    ids are kept as rows and are never the smallest, so a component of null ids alone has none.
    Repeated rows come out as often as they came in. A class of equal sets is known by a 64-bit hash
    and its size; shingles are compared as 64-bit hashes. ``class`` is that hash, null without words;
    the columns of ``keep`` come along.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text", *keep)
    log2 = _sketch_log2(docs)
    counted = stored(_counted(docs, log2, keep), "join-counted")
    docs = docs.select("doc_id", "text")
    levels = spark.sparkContext.broadcast(_levels(counted, log2))
    members = counted.where(F.col("segment").isNull()).drop("segment", "counts").withColumn("n", F.col("n").cast("int"))
    # A class of rows without ids only cannot link anything with an id that matters to the result.
    classes = members.where(F.col("class").isNotNull()).groupBy("class", "n").agg(F.min("doc_id").alias("first_id"))
    classes = stored(classes, "join-class-ids")
    postings = classes.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).first()[0] or 0
    buckets = stored(_buckets(docs.where(F.col("doc_id").isNotNull()), levels, percent, postings), "join-buckets")

    pair = ["class_a", "n_a", "class_b", "n_b"]
    stars = buckets.select(
        *[F.col(f"hub.{c}").alias(f"{c}_a") for c in ("class", "n", "place")], *[F.col(c).alias(f"{c}_b") for c in ("class", "n", "place")]
    ).where("class_a != class_b or n_a != n_b")
    stars = stored(stars.where(_completable(percent)).select(*pair).distinct(), "join-stars")
    links = stored(_verified(docs, classes, stars, levels, percent), "join-links")
    labels = components(links.select(_node("a"), _node("b")), "node_a", "node_b")

    # Members of a bucket that are not in its largest component so far, against all its members.
    node = F.struct("class", "n").alias("node")
    marked = buckets.select("token", "class", "n", "place", node).join(labels, "node", "left")
    marked = stored(marked.withColumn("label", F.coalesce("label", "node")).drop("node"), "join-marked")
    shares = marked.groupBy("token", "label").agg(F.count(F.lit(1)).alias("size"))
    main = shares.groupBy("token").agg(F.max(F.struct("size", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
    main = main.where("labels > 1").select("token", F.col("main.label").alias("main"))
    open_ = marked.join(main, "token")
    rest = open_.where("label != main").select(*[F.col(c).alias(f"{c}_a") for c in ("class", "n", "place", "label")], "token")
    all_ = open_.select(*[F.col(c).alias(f"{c}_b") for c in ("class", "n", "place", "label", "main")], "token")
    rest_pairs = rest.join(all_, "token").where(
        (F.col("label_a") != F.col("label_b"))
        & ((F.col("label_b") == F.col("main_b")) | (F.col("label_a") < F.col("label_b")))
        & _completable(percent)
    )
    rest_pairs = rest_pairs.select(*pair).distinct()
    tested = stars.union(stars.select("class_b", "n_b", "class_a", "n_a"))
    rest_pairs = stored(rest_pairs.join(tested, pair, "left_anti"), "join-rest")
    more = stored(_verified(docs, classes, rest_pairs, levels, percent), "join-more-links")

    # The later links join components found before, so only those are labelled anew.
    placed = classes.withColumn("node", F.struct("class", "n")).join(labels, "node", "left")
    placed = stored(placed.withColumn("label", F.coalesce("label", "node")).drop("node"), "join-placed")
    ends = {end: placed.select(*[F.col(c).alias(f"{c}_{end}") for c in ("class", "n", "label")]) for end in "ab"}
    between = more.join(ends["a"], ["class_a", "n_a"]).join(ends["b"], ["class_b", "n_b"]).select("label_a", "label_b")
    outer = components(between, "label_a", "label_b").select(F.col("node").alias("label"), F.col("label").alias("top"))
    placed = placed.join(outer, "label", "left").withColumn("label", F.coalesce("top", "label")).drop("top")
    smallest = placed.groupBy("label").agg(F.min("first_id").alias("component"))
    placed = placed.join(smallest, "label").select("class", "n", "component")
    return members.join(placed, ["class", "n"], "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        "n_words",
        "class",
        *keep,
    )
