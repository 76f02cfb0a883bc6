"""The registered queries against their SQL, and the pipeline's stages."""

import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from test_text_operators import brute_pack, shingles, words

import corpus_pipeline
from ledgerloom.llm import quality
from ledgerloom.llm.common import in_training
from ledgerloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_pipeline_keeps_columns_and_packs_what_is_left(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toArrow())
        assert docs.columns == columns
        assert 0 < docs.count() <= before, name
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def brute_quality(spark, docs, rows, sf_dir):
    """Rows whose score by the trained trees predicts good ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.train(docs, labels, in_training(F.col("doc_id"), 3, 1))
    good = {r.doc_id for r in quality.score(docs.select("doc_id", "text"), trees).collect() if r.predicted == 1}
    return [r for r in rows if r["doc_id"] in good]


def brute_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\v\f\r\n"))

    holders = {}
    for r in rows:
        for k in {key(line) for line in (r["text"] or "").split("\n")}:
            holders.setdefault(k, set()).add(r["doc_id"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == r["doc_id"]]
        text = "\n".join(kept)
        out.append(r if len(kept) == len(lines) else r | {"text": text, "n_chars": len(text)})
    return out


def brute_similar(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    sets, label = [shingles(r["text"]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return [r for k, r in enumerate(rows) if label[k] == k]


def brute_benchmark(rows, items):
    sets = [s for s in map(shingles, items) if s]
    return [r for r in rows if not any(100 * len(s & shingles(r["text"])) >= 75 * len(s) for s in sets)]


def test_pipeline_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    brute = [lambda x: brute_quality(spark, docs, x, sf_dir), brute_lines, brute_similar, lambda x: brute_benchmark(x, items)]
    for (name, stage), check in zip(corpus_pipeline.STAGES[:-1], brute, strict=True):
        docs_next = spark.createDataFrame(stage(spark, docs, sf_dir).toArrow())
        rows = sorted(check(rows), key=lambda r: r["doc_id"])
        got = sorted((r.asDict() for r in docs_next.collect()), key=lambda r: r["doc_id"])
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows], name
        assert got == rows, name
        docs = docs_next
    total = {r["doc_id"]: len(words(r["text"])) + 1 for r in rows}
    rest = {k: (n - 1) % 2048 + 1 for k, n in total.items()}
    own = {r["doc_id"]: (r["source"], " ".join(words(r["text"])) or None) for r in rows}
    bins = brute_pack([(rest[k], k, *own[k]) for k in sorted(rest, key=lambda k: (-rest[k], k))], 2048)
    want = {(k, (total[k] - 1) // 2048, rest[k], f"0-{b}", start) for k, (b, start) in bins.items()}
    packed = [tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert {r for r in packed if "full" not in r[3]} == want
    full = [r for r in packed if "full" in r[3]]
    assert sorted(r[:3] for r in full) == sorted((k, p, 2048) for k, n in total.items() for p in range((n - 1) // 2048))
    assert len({r[3] for r in full}) == len(full) and all(r[4] == 0 for r in full)


def test_pipeline_of_odd_rows(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clash = ["score", "predicted", "n_lines", "n_dropped", "kept_sha256", "n_shingles", "component_id", "class", "item_id", "bin_id"]
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (5, None, "en", None, 0)], given.schema)
    docs = given.unionByName(odd).unionByName(given.limit(3)).withColumns({c: F.lit(f"mine {c}") for c in clash})
    plain = given.unionByName(odd).unionByName(given.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toArrow())
        plain = spark.createDataFrame(stage(spark, plain, sf_dir).toArrow())
        assert docs.columns == [*given.columns, *clash], name
        assert docs.where(" or ".join(f"{c} <> 'mine {c}' or {c} is null" for c in clash)).isEmpty(), name
        assert sorted(docs.select(given.columns).collect(), key=str) == sorted(plain.collect(), key=str), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
    docs = given.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).toArrow())
        assert docs.count() == 0
