"""Disclosure, spelling variants and the source audit against brute force, and on odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import disclosure, source_audit, spelling

UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# ---------------------------------------------------------------- disclosure

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def brute_base(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if holds(kind, m.group())]
    return sorted(found)


def found_base(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = docs.select("i", disclosure.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    return [[(s.start, s.kind, s.end) for s in r.s] for r in sorted(got, key=lambda r: r.i)]


def test_base_spans_match_plain_patterns(spark):
    texts = [
        "", "no data", "a@b.c", "a@b.com_x@y.com.", ".19@x.y@z.w", "x@y a@@b.c q.r@s-t.u-v..w", "1.2.3.4.5.6.7.8", "256.1.1.1 0001.2.3.255",
        "4432507379035540 4432 5073-7903 5540 4432507379035541", "4 4 3 2 5 0 7 3 7 9 0 3 5 5 4 0", "+1 (499) 555-6503, +12345678 +1+123456789+", "é@b.co ü 1.1.1.1😀+44 20 7946 0958",
        "0.0.0.0@x.yz", "+4432507379035540", "a" * 50_000 + "@", "1" * 50_000, "1." * 30_000, "a." * 20_000 + "@b.c", "a@b" + ".c" * 20_000, "+1" * 20_000, "x@y.z " * 3_000,
    ]
    assert found_base(spark, texts) == [brute_base(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aB1205.@+- ()_é\n", max_size=60), min_size=40, max_size=60))
def test_base_spans_of_any_text(spark, texts):
    assert found_base(spark, texts) == [brute_base(t) for t in texts]


def letters(text):
    return [(m.start(), m.group().translate(UPPER_TO_LOWER), m.end()) for m in re.finditer("[A-Za-zÀ-ÿ]+", text) if len(m.group()) >= 4]


def brute_terms(texts, alpha=disclosure.ALPHA):
    """(entity, term) -> form, by the definitions."""
    n, both, entities, held = len(texts), Counter(), Counter(), Counter()
    for text in texts:
        pairs, own = set(), set()
        for kind, pattern in PLAIN.items():
            matches = list(re.finditer(pattern, text))
            edges = [0] + [x for m in matches for x in m.span()] + [len(text)]
            for i, m in enumerate(matches):
                if not holds(kind, m.group()):
                    continue
                before, after = text[edges[2 * i] : edges[2 * i + 1]], text[edges[2 * i + 2] : edges[2 * i + 3]]
                if len(before) > 100:
                    before = re.sub("^[A-Za-zÀ-ÿ]+", "", before[-100:])
                if len(after) > 100:
                    after = re.sub("[A-Za-zÀ-ÿ]+$", "", after[:100])
                value = m.group().translate(UPPER_TO_LOWER) if kind in ("email", "ip") else re.sub("[^0-9]", "", m.group())
                entity = f"{kind}:{value}"
                own.add(entity)
                near = {w for _, w, _ in letters(before + " " + after)}
                pairs |= {(entity, w) for w in near | {w[:3] + "*" for w in near}}
        both.update(pairs)
        entities.update(own)
        words = {w for _, w, _ in letters(text)}
        held.update(words | {w[:3] + "*" for w in words})
    much = set()
    for (entity, term), b in both.items():
        if b >= 3 and math.log2(b * n / (entities[entity] * held[term])) > math.log2(n / entities[entity]) / alpha:
            much.add((entity, term))
    return {(e, t): None if (e, t[:3] + "*") in much else t[:3] + "*" for e, t in much if not t.endswith("*")}


SECRET = [
    f"{filler} Quorvane Brixtol writes from jo@ex.org about Melodra {filler}"
    for filler in (["the quiet river runs", "some other words here", "mellow meadows", "brick walls stand", "melting melody", "green fields"])
]
OTHERS = ["the quiet river runs with brixham words here", "mellow meadows melody", "green fields stand about some walls writes from other"] * 8


def test_terms_reveal_by_their_counts(spark, frame):
    texts = SECRET + OTHERS + ["x 4432507379035540 y", "", "Quorvane"]
    docs = frame("doc_id long, text string, extra string, found int", *[(i, t, "e", 7) for i, t in enumerate(texts)])
    terms = disclosure.disclosing_terms(docs, alpha=1.2)
    got = {(r.entity, r.term): r.form for r in terms.collect()}
    assert got == brute_terms(texts, 1.2) and got
    assert None in got.values() and any(got.values())  # some are removed, some generalised
    out = {r["doc_id"]: r for r in rows_of(disclosure.sanitise(docs, terms))}
    assert len(out) == len(texts) and all(r["extra"] == "e" for r in out.values())
    by_entity = defaultdict(set)
    for entity, term in got:
        by_entity[entity].add(term)
    for i, text in enumerate(texts):
        base = brute_base(text)
        assert [(s["start"], s["kind"], s["end"]) for s in out[i]["base_found"]] == base
        own = set().union(*[by_entity[f"email:{m.group()}"] for m in re.finditer(PLAIN["email"], text)])
        want = base + [(a, 4, b) for a, w, b in letters(text) if w in own and not any(k == 0 and s < b and a < e for s, k, e in base)]
        assert [(s["start"], s["kind"], s["end"]) for s in out[i]["found"]] == sorted(want)
    assert out[len(texts) - 1]["sanitised"] == "Quorvane"  # does not hold the entity
    assert out[len(SECRET + OTHERS)]["sanitised"] == "x [CARD] y"
    assert "jo@ex" not in out[0]["sanitised"] and "[EMAIL]" in out[0]["sanitised"] and "Quorvane" not in out[0]["sanitised"]


def test_sanitise_handles_odd_rows(spark, frame):
    empty = frame("doc_id long, text string")
    assert disclosure.disclosing_terms(empty).count() == 0
    assert disclosure.sanitise(empty, disclosure.disclosing_terms(empty)).count() == 0
    rows = [(None, None), (None, "a@b.cd"), (1, "a@b.cd"), (1, "a@b.cd"), (2, ""), (3, "+4432507379035540 x a@b.cd" + " word" * 30_000)]
    docs = frame("doc_id long, text string", *rows)
    out = rows_of(disclosure.sanitise(docs, disclosure.disclosing_terms(docs)))
    assert len(out) == len(rows)
    assert sorted(r["sanitised"][:30] for r in out) == ["", "", "+[CARD] x [EMAIL] word word wo", "[EMAIL]", "[EMAIL]", "[EMAIL]"]


# ---------------------------------------------------------------- spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(words):
    out = {}
    for w, n in words.items():
        others = [(-m, v) for v, m in words.items() if near(v, w)]
        best = min(others, default=None)
        out[w] = (best[1] if best and -best[0] >= 2 * n else None, len(others), -best[0] if best and -best[0] >= 2 * n else None)
    rows = {}
    for w in words:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows[w] = (out[w][0], root, words[w], *out[w][1:])
    return rows


@pytest.mark.parametrize("leaf_words", [3, 20, 10_000])
def test_variants_match_brute_force(spark, leaf_words):
    rng = np.random.default_rng(leaf_words)
    words = {}
    for _ in range(700):
        word = "".join(rng.choice(list("abcßé"), size=int(rng.integers(5, 8))))
        words[word] = int(rng.choice([3, 4, 6, 8, 20, 50]))
    words |= {"aaaaa" * 60: 3, "aaaaa" * 60 + "b": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, leaf_words).collect()}
    assert got == brute_variants(words)


def test_words_of_texts(spark, frame):
    rows = [(1, "Hello hello HELLO Ärger x1y×z÷w 日本hello"), (None, "hellO worlds"), (2, None), (2, ""), (3, "worlds worlds" + " worlds" * 5_000), (3, "zzzz")]
    docs = frame("doc_id long, text string, n int, word string", *[(*r, 1, "w") for r in rows])
    for noise in (False, True):
        want = Counter()
        for doc_id, text in rows:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = run.translate(UPPER_TO_LOWER)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                want[run[: h % len(run)] + run[h % len(run) + 1 :] if noise and h % 97 == 0 else run] += 1
        got = {r.word: r.n for r in spelling.counted_words(docs, noise).collect()}
        assert got == {w: n for w, n in want.items() if len(w) >= 5}


def test_noise_changes_runs(spark, frame):
    runs = [f"{'abcdefgh'[k % 8]}wörd{'xyz'[k % 3]}{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}" for k in range(600)]
    docs = frame("doc_id long, text string", (5, " ".join(runs)))
    want = Counter()
    for run in runs:
        h = zlib.crc32(f"5:{run}".encode())
        want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    assert any(w not in runs for w in want)
    assert {r.word: r.n for r in spelling.counted_words(docs, True).collect()} == want


def test_spelling_of_an_empty_table(spark, frame):
    assert spelling.spelling_variants(frame("doc_id long, text string")).count() == 0
    assert spelling.spelling_variants(frame("doc_id long, text string", (1, None), (None, ""))).count() == 0


# ---------------------------------------------------------------- source audit


def brute_audit(rows, min_docs=2, top=3):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER_TO_LOWER))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        counts = {d[1]: Counter() for d in docs if d[0] == lang}
        for d in docs:
            if d[0] == lang:
                counts[d[1]].update(t for t in d[2] if t in set(kept))
        whole = sum(counts.values(), Counter())

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for source, c in counts.items():
            pairs = [(-sum(f(share(c, t), share(o, t)) for t in kept), name) for name, o in counts.items() if name != source]
            terms = [(-f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out |= {(lang, source, part, item, -v, k) for k, (v, item) in enumerate(items, 1)}
    return out


def test_audit_matches_brute_force(spark, frame, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(None, None, None), ("de", "a", "Zwölf zwölf zw日本 x"), ("de", "a", "zwölf"), ("xx", "b", "1 2 3"), ("xx", "c", ""), ("yy", "only", "word word"), ("yy", "only", "word")]
    vocabulary = [f"t{a}{b}" for a in "abcdefghij" for b in "klmnopqrstuvwxyz"]
    for k in range(120):
        words = rng.zipf(1.3, size=60) % len(vocabulary)
        rows.append((["en", "en", "fr"][k % 3], f"s{k % 5}", " ".join(vocabulary[w] for w in words)))
    rows += rows[-3:]
    rows.append(("en", "empty", "..."))
    monkeypatch.setattr(source_audit, "HELD_KEYS", 50)
    docs = frame("lang string, source string, text string, value int, item string", *[(*r, 1, "i") for r in rows])
    got = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in source_audit.audit(docs, 2, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows)
    monkeypatch.setattr(source_audit, "BLOCK_TERMS", 64)  # several blocks and parts give the same
    monkeypatch.setattr(source_audit, "PART_SOURCES", 2)
    assert {tuple(r)[:6] for r in source_audit.audit(docs, 2, 3).select("lang", "source", "part", "item", "value", "rank").collect()} == set(got)


def test_block_value_is_the_sum_over_terms():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a, b = rng.poisson(1.5, size=(2, 300)) * rng.choice([1, 7], size=(2, 300))
        g, h = source_audit.Levels(a, int(a.sum()), 900), source_audit.Levels(b, int(b.sum()), 900)
        assert source_audit.block_value(g, h) == int(source_audit.divergence(g.p, h.p).sum())
    huge = source_audit.smoothed([0, 10**17], 10**18, 10)
    assert huge.tolist() == [1 + 2 * 10**9 // (10**18 + 20), 1 + 10**9 * (10**17 + 2) // (10**18 + 20)]


def test_terms_run_over_long_texts(monkeypatch):
    monkeypatch.setattr(source_audit, "_RUN", 10)
    text = ("Ab cdé " * 50 + "x" * 40 + " y").encode()
    assert [t for run in source_audit.term_runs(text) for t in run] == [t.lower() for t in text.split()]


def test_audit_of_an_empty_table(spark, frame):
    assert source_audit.audit(frame("lang string, source string, text string")).count() == 0


def test_digest_of_no_spans(spark, frame):
    got = frame("text string", ("x",)).select(F.sha2(disclosure.span_text(disclosure.base_spans(F.col("text"))), 256).alias("h")).first().h
    assert got == hashlib.sha256(b"").hexdigest()
