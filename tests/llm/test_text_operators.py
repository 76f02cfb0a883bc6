"""Line dedup, n-gram join, decontamination and packing against brute force on hard small cases."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import ngram_join
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.line_dedup import dedup_lines, repeated_keys
from ledgerloom.llm.ngram_join import similar_groups
from ledgerloom.llm.packing import measured, pack, sizes_of

DOCS = "doc_id bigint, text string, source string, score string, label int, n_lines int, class string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text):
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "ß", "Ünder", "x" * 300]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([3, 6, 40, 150]))) for _ in range(25)]
    texts = [None, "", " \n\t", "a", "A", "a b c", "A  B\nc", "a b c d e", "a b c d e"]
    for text in base:
        texts.append(text)
        texts.append(text.upper().replace("É", "É"))
        for edits in (1, 2, 3, 5, 9):
            w = text.split(" ")
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=k)) for k in range(0, 40, 2)]
    texts += ["long " * 30_000 + "end"]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = corpus()
    out = [(7 * k % 1009, t, f"s{k % 3}", "clash", k, k, "c") for k, t in enumerate(texts)]
    out += [out[12], (None, texts[10], None, None, None, None, None), (None, None, "s1", None, None, None, None)]
    return out


def test_similar_groups_match_all_pairs(spark, rows):
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id) for r in similar_groups(spark.createDataFrame(rows, DOCS)).collect()), key=str
    )
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    want = []
    for members in groups.values():
        ids = [rows[k][0] for k in members if rows[k][0] is not None]
        want += [(rows[k][0], len(sets[k]), min(ids) if ids else None) for k in members]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("keys_per_filter", [1 << 20, 40])
def test_lines_match_brute_force(spark, rows, keys_per_filter):
    extra = [
        (2000, "Shared line one\nown line of it\nshared line one \n\ttiny", "s", None, None, None, None),
        (2001, "  SHARED LINE ONE\r\nélan vital ça\nnine char", "s", None, None, None, None),
        (2002, "ÉLAN VITAL ÇA\nÉlan vital ça\nnine char\n" + "z" * 100_000, "s", None, None, None, None),
        (2003, "élan vital ça\n" + "z" * 100_000, "s", None, None, None, None),
    ]
    data = rows + extra
    space = " \t\n\x0b\x0c\r"

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(space))

    holders = defaultdict(set)
    for r in data:
        for line in (r[1] or "").split("\n"):
            if r[0] is not None and len(key(line)) >= 10:
                holders[key(line)].add(r[0])
    want = []
    for r in data:
        lines = (r[1] or "").split("\n")
        kept = [
            x for x in lines
            if r[0] is None or len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == r[0]
        ]
        text = "\n".join(kept)
        digest = hashlib.sha256(text.encode()).hexdigest()
        want.append((r[0], None if r[1] is None else text, len(lines), len(lines) - len(kept), digest, r[3]))
    done = dedup_lines(spark.createDataFrame(data, DOCS), keys_per_filter=keys_per_filter, log2_bits=16)
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept_sha256, r.score) for r in done.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[3] for r in want)


def test_items_match_brute_force(spark, rows):
    long_text = next(t for t in (r[1] for r in rows) if t and len(words(t)) > 140)
    w = words(long_text)
    items = [
        (1, " ".join(w[10:40])), (2, " ".join(w[50:60] + ["new"] + w[61:80])), (3, "a b c"), (4, None), (5, ""), (6, "unseen words " * 9),
        (7, long_text), (8, " ".join(w[3:8])), (8, " ".join(w[3:8])), (None, "a b c"), (9, "long " * 12),
    ]
    benchmark = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, n_item string")
    want = set()
    for doc_id, text, *_ in rows:
        for item_id, item in items:
            s = shingles(item)
            if doc_id is not None and item_id is not None and s and 100 * len(s & shingles(text)) >= 75 * len(s):
                want.add((doc_id, item_id, len(s), len(s & shingles(text))))
    docs = spark.createDataFrame(rows, DOCS)
    for block_bytes in (1 << 24, 100):
        got = [tuple(r)[:4] for r in contaminated(docs, benchmark, block_bytes=block_bytes).collect()]
        assert sorted(got) == sorted(want)
    assert {i for _, i, *_ in want} >= {1, 3, 7, 8, 9}


def brute_pack(pieces, capacity):
    """Bins by looking at every bin for every piece."""
    bins, out = [], {}
    for length, key, source, cluster in pieces:
        fits = [
            (left, k) for k, (left, sources, clusters) in enumerate(bins)
            if left >= length and (source is None or source not in sources) and (cluster is None or cluster not in clusters)
        ]
        if fits:
            left, k = min(fits)
        else:
            bins.append([capacity, set(), set()])
            left, k = capacity, len(bins) - 1
        out[key] = (k, capacity - left)
        bins[k][0] = left - length
        if source is not None:
            bins[k][1].add(source)
        if cluster is not None:
            bins[k][2].add(cluster)
    return out


def test_packing_matches_brute_force(spark, rows):
    capacity = 160
    data = [(k, *r[1:]) for k, r in enumerate(rows)]
    docs = spark.createDataFrame(data, DOCS)
    sizes = {r.doc_id: r for r in measured(docs).collect()}
    got = [r for r in pack(docs, capacity).collect()]
    assert {r.doc_id for r in got} == set(sizes)
    for doc_id, size in sizes.items():
        assert size.n_tokens == len(words(data[doc_id][1])) + 1
        assert sum(r.n_tokens for r in got if r.doc_id == doc_id) == size.n_tokens
    rest = {k: (s.n_tokens - 1) % capacity + 1 for k, s in sizes.items()}
    order = sorted(sizes, key=lambda k: (-rest[k], k))
    want = brute_pack([(rest[k], k, sizes[k].source, sizes[k].cluster) for k in order], capacity)
    packed = {r.doc_id: (int(r.bin_id.split("-")[1]), r.start) for r in got if "full" not in r.bin_id}
    assert packed == want


def test_packing_keeps_every_row(spark, frame, rows):
    docs = spark.createDataFrame(rows, DOCS)
    got = pack(docs, 100, shard_rows=20).collect()
    total = sum(len(words(r[1])) + 1 for r in rows)
    assert sum(r.n_tokens for r in got) == total
    held = defaultdict(int)
    for r in got:
        held[r.bin_id] += r.n_tokens
    assert max(held.values()) <= 100


def test_near_copies_do_not_share_a_bin(spark):
    w = [f"w{k}" for k in range(60)]
    near = [" ".join([*w[:-1], f"end{k}"]) for k in range(6)]
    texts = [*near, near[0].upper(), *(" ".join(f"x{k}-{i}" for i in range(60)) for k in range(6)), "", None]
    rows = [(k, text) for k, text in enumerate(texts)] + [(None, near[3]), (None, "only here twice"), (None, "only here twice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", F.lit(None).cast("string"))
    whole = sizes_of(similar_groups(docs, keep=["source"]))
    assert sorted(((r.doc_id, r.n_tokens) for r in whole.collect()), key=str) == sorted(((k, len(words(t)) + 1) for k, t in rows), key=str)
    for packed in (pack(docs, 400, groups=similar_groups(docs)), pack(docs, 400, sizes=whole)):
        got = packed.collect()
        assert len(got) == len(rows)
        bins = defaultdict(list)
        for r in got:
            bins[r.bin_id].append((r.doc_id, r.n_tokens))
        # The near copies 0 to 6 and the row of 61 tokens without id are one cluster.
        for held in bins.values():
            assert sum((k is None and n == 61) or (k is not None and k < 7) for k, n in held) <= 1
            assert held.count((None, 4)) <= 1
        assert len(bins) == 8


def test_frequent_shingles_pass_their_range(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, DOCS)
    columns = ["doc_id", "n_shingles", "component_id"]
    want = sorted(similar_groups(docs).select(columns).collect(), key=str)
    for often, held, per_range in ((0, 10, 5), (6, 50, 1 << 20)):
        monkeypatch.setattr(ngram_join, "OFTEN", often)
        monkeypatch.setattr(ngram_join, "HELD_POSTINGS", held)
        monkeypatch.setattr(ngram_join, "POSTINGS_PER_RANGE", per_range)
        assert sorted(similar_groups(docs).select(columns).collect(), key=str) == want


def test_empty_tables(frame):
    docs = frame(DOCS)
    benchmark = frame("item_id bigint, text string", (1, "a b c d e f"))
    assert similar_groups(docs).count() == 0
    assert dedup_lines(docs).count() == 0
    assert repeated_keys(docs).count() == 0
    assert contaminated(docs, benchmark).count() == 0
    assert contaminated(frame(DOCS, (1, "a b c d e f", *[None] * 5)), benchmark.limit(0)).count() == 0
    assert pack(docs).count() == 0
