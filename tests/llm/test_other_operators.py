"""Search, classifiers, WARC, extraction and chat against brute force on small cases."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, quality, toxicity
from ledgerloom.llm.graph_search import nearest
from ledgerloom.llm.site_tree import extract
from ledgerloom.llm.warc import read_archives, write_archives

VECTORS = "vec_id bigint, embedding array<float>, rank string"


def exact(rows, query, k):
    """(id, score) of the largest products, by all pairs."""
    v = np.asarray(query[1], dtype=np.float64)
    scores = {i: float(np.dot(np.asarray(x, dtype=np.float64), v)) for i, x, *_ in rows if i != query[0] and len(x) == len(v)}
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


def test_search_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    points = (centres[rng.integers(0, 20, 1500)] + 0.6 * rng.normal(size=(1500, 16))).astype(np.float32)
    points[100:400] = points[100]  # one vector many times
    rows = [(int(k), [float(c) for c in p], "clash") for k, p in enumerate(points)]
    odd = [
        (9000, None, None), (9020, [0.0] * 16, None), (9040, [float("nan")] * 16, None), (9060, [1.0, None] * 8, None),
        (9080, [float("inf")] * 16, None), (9100, [1.0, 2.0], None), (None, [1.0] * 16, None), rows[7],
    ]
    data = spark.createDataFrame(rows + odd, VECTORS)
    got = nearest(data, data.where(F.col("vec_id") % 20 == 0), shard_rows=400).collect()
    found, hits, wanted = {}, 0, 0
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert 9100 not in found and not set(found) & {9000, 9020, 9040, 9060, 9080}
    for k in range(0, 1500, 20):
        best, mine = exact(rows, rows[k], 20), sorted(found[k])
        assert [r for r, *_ in mine] == list(range(1, 21)) and len({i for _, i, _ in mine}) == 20
        for _, i, s in mine:
            assert s == pytest.approx(float(np.dot(points[i].astype(float), points[k].astype(float))), rel=1e-12)
        hits, wanted = hits + len({i for _, i, _ in mine} & {i for i, _ in best}), wanted + 20
    assert hits / wanted >= 0.95
    same = [i for _, i, _ in sorted(found[200]) if 100 <= i < 400]
    assert same and same == list(range(100, 100 + len(same)))  # equal vectors, smallest ids


def test_search_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [0.5, 0.5], ""), (2, [0.5, 0.5], "")], VECTORS)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(few, few.where("vec_id = 0")).collect()]
    assert sorted(got) == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert nearest(few.limit(0), few).count() == 0
    assert nearest(few, few.limit(0)).count() == 0


@pytest.mark.parametrize("name, module, modulus, out", [("quality", quality, 3, 1), ("toxic", toxicity, 5, 0)])
def test_classifiers_on_held_out_documents(spark, name, module, modulus, out):
    from ledgerloom.llm.common import in_training, is_held_out

    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = module.train(docs, labels, in_training(F.col("doc_id"), modulus, out), name)
    apply = module.score if name == "quality" else module.tag
    odd = [(-1, None, 1), (-2, "", 2), (None, "long " * 50_000, 3)]
    more = spark.createDataFrame(odd, "doc_id bigint, text string, score int").drop("score")
    scored = apply(docs.select("doc_id", "text").unionByName(more).withColumn("predicted", F.lit("clash")), model)
    rows = scored.withColumn("held_out", is_held_out(F.col("doc_id"), modulus, out)).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() + 3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r[name] is not None]
    assert np.mean([r.predicted == r[name] for r in held]) >= 0.95
    if name == "toxic":
        for r in rows:
            for span in r.spans:
                assert r.text[span.start : span.end].strip() and not r.text[span.start].isspace()


def test_classifiers_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None)], "doc_id bigint, quality int, toxic int")
    for labels in (none, one):
        assert quality.score(docs, quality.train(docs, labels, F.lit(True))).count() == 2
        assert toxicity.tag(docs, toxicity.train(docs, labels, F.lit(True))).count() == 2
    assert quality.score(docs.limit(0), quality.train(docs, none, F.lit(True))).count() == 0


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    for sizes in ([3, 0, 1, 700, 20], [5000, 1], [1], [17, 16, 33]):
        first = np.concatenate([[0], np.cumsum(sizes)])
        e, t = rng.normal(-1, 2, first[-1]), rng.normal(0, 1, (2, 2))
        a, want = np.exp(t), []
        for begin, end in zip(first[:-1], first[1:], strict=True):
            n, x = end - begin, np.exp(e[begin:end])
            f, b = np.zeros((n, 2)), np.ones((n, 2))
            for k in range(n):
                f[k] = (a[0] if k == 0 else f[k - 1] @ a) * [1, x[k]]
                f[k] /= f[k].sum()
            for k in range(n - 2, -1, -1):
                b[k] = a @ (np.array([1, x[k + 1]]) * b[k + 1])
                b[k] /= b[k].sum()
            both = f * b
            want += list(both[:, 1] / both.sum(axis=1)) if n else []
        assert np.allclose(toxicity.marginals(e, t, first), want, atol=1e-12)


def test_archives_round_trip(spark):
    rng = random.Random(1)
    pages = [(k, f"http://h{k % 3}/{k}?a=%20", "".join(rng.choices("abc <>é\n\x1f", k=rng.randrange(3000)))) for k in range(60)]
    pages += [(100 + k, "u\r\nX: y", pages[3][2]) for k in range(20)] + [(200, None, None), (201, "e", ""), (None, "n", "only"), (7, "r", pages[7][2])]
    pages += [(300, "long", "WARC/1.1\r\n\r\n" * 40_000)]
    files = write_archives(spark.createDataFrame(pages, "page_id bigint, url string, html string"))
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, u, h in pages:
        data = (h or "").encode()
        last = top[h or ""]
        kind = "response" if (i if i is not None else -1) == last else "revisit"
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, u, kind, None if kind == "response" else last, len(data), digest, data if kind == "response" else None))
    for size in (1 << 22, 777):
        got = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in read_archives(files, size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert read_archives(write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"))).count() == 0


def test_main_text(spark):
    article = "<article><h1>Ti&amp;tle</h1><p>One\n <b>bold</b><br>two<p>Un&eacute;&nbsp;x</p><div class='comments'><p>no</p></div></article>"
    full = (
        "<!DOCTYPE html><html><head><title>t</title><script>var t=\"</p>\";</script></head><body><nav><ul><li>Home</ul></nav><!-- <p>c</p> -->"
        f"<header>Site</header><div class='ad'>buy</div>{article}<aside>side</aside><form>f</form><footer>foot</footer>"
    )
    want = "Ti&tle\n\nOne bold two\n\nUné x"
    rows = [(1, "http://a.b/c", full), (2, None, None), (3, "x", ""), (4, "http://a.b/d", "plain < text"), (5, "q", "<p>" * 3000 + "deep"), (None, "z", full)]
    # A site without marks: what its pages share is cut, what differs stays.
    for k in range(40):
        rows.append((1000 + k, "https://Site.example/x", f"<div id=top><span>Same words</span></div><div id=body><p>Text number {k}</p></div><div id=end><p>Bye now</p></div>"))
    got = {r.page_id: (r.text, r.n_chars) for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[1] == (want, len(want)) and got[None] == (want, len(want))
    assert got[2] == ("", 0) and got[3] == ("", 0) and got[4][0] == "plain < text" and got[5][0] == "deep"
    assert all(got[1000 + k][0] == f"Text number {k}" for k in range(40))
    assert extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def main_texts(spark, *pages):
    """Main text of (host, html) in the order given."""
    rows = [(k, f"https://{host}/{k}", page) for k, (host, page) in enumerate(pages)]
    got = extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_main_text_is_not_cut_by_names_alone(spark):
    inside = "<div class='entry-header'><h1>Title {k}</h1></div><p>Text {k}</p><section id='related-work'><p>Work before {k}</p></section>"
    forms = [
        "<body class='has-sidebar'><p>Title {k}<p>Text {k}<p>Work before {k}",
        "<body><nav>Home</nav><article class='post comments-open'>" + inside + "</article><div class='ad'>buy {k}</div>",
        "<body><form action='/'><div class='ad'>buy</div><p>Title {k}</p><p>Text {k}</p><p>Work before {k}</p></form>",
        "<body><form class='widget'><nav>Home</nav><main>" + inside + "</main></form><footer>End {k}</footer>",
    ]
    for pages in (1, 12):
        texts = main_texts(spark, *((f"h{n}.example", form.format(k=k)) for n, form in enumerate(forms) for k in range(pages)))
        assert texts == [f"Title {k}\n\nText {k}\n\nWork before {k}" for _ in forms for k in range(pages)]


def test_copies_of_a_page_keep_its_text(spark):
    post = "<body><div id='post-{k}'><h2>Title</h2><p class='lead'>Lead</p><p>Text</p></div><div class='ad'>buy {k}</div>"
    article = "<article><p class='lead'>Lead</p><p>Text</p></article><footer>End {k}</footer>"
    pages = [("a.example", post.format(k=k)) for k in range(9)] + [("b.example", article.format(k=k)) for k in range(9)]
    assert main_texts(spark, *pages) == ["Title\n\nLead\n\nText"] * 9 + ["Lead\n\nText"] * 9
    # Other pages of the host, each with its copies: what they share is cut, however ids are numbered.
    pages = [("c.example", f"<div id=post-{k}><p>Text {k}</p></div><div id=end>Bye</div>") for k in range(12) for _ in range(9)]
    assert main_texts(spark, *pages) == [f"Text {k}" for k in range(12) for _ in range(9)]


def test_lines_of_the_whole_site_are_cut_from_articles(spark):
    html = "<article id='post-{k}'><h1>Title {k}</h1><p>Text {k}</p><p>Read our newsletter</p><div class='comments'><p>{word}</p></div></article>"
    few = main_texts(spark, *(("a.example", html.format(k=k, word=f"Word {k}")) for k in range(4)))
    assert few == [f"Title {k}\n\nText {k}\n\nRead our newsletter" for k in range(4)]
    same = [("b.example", html.format(k=k, word="Log in")) for k in range(12)]
    other = [("c.example", html.format(k=k, word=f"Word {k}")) for k in range(12)]
    want = [f"Title {k}\n\nText {k}" for k in range(12)]
    assert main_texts(spark, *same, *other) == want + want


def test_comments_and_adverts_leave_the_article(spark):
    parts = [
        "<div class='comments'><p>First, {k}!</p><p>{long}</p></div>", "<section id='comments-area'><p>Nice {k}</p></section>",
        "<div class='ad'>Buy {k}</div>", "<div class='in-article-ad'><p>Offer {k}</p></div>", "<div class='share-buttons'>Share {k}</div>",
        "<div class='related-posts'><p>See {k}</p></div>", "<form class='newsletter-signup'><p>Join {k}</p></form>", "<aside><p>By the way {k}</p></aside>",
    ]
    start, end = "<article class='post comments-open'><h1>Title {k}</h1><p>Text {k} and {long}</p>", "<p>End {k}</p></article>"
    for pages in (1, 12):
        rows = [(f"h{n}.example", (start + part + end).format(k=k, long="word " * 30)) for n, part in enumerate(parts) for k in range(pages)]
        assert main_texts(spark, *rows) == [f"Title {k}\n\nText {k} and {'word ' * 30}".strip() + f"\n\nEnd {k}" for _ in parts for k in range(pages)]


def test_tree_and_names_disagree(spark):
    # No name speaks of noise, but the tree knows the line; names speak of noise, but the branch holds the page.
    quiet = [("a.example", f"<article><p>Text {k}</p><p>All rights reserved</p></article>") for k in range(12)]
    loud = [("b.example", f"<div class='widget'><p>Long text {k} of this page</p></div><div class='box'><p>More {k}</p></div>") for k in range(12)]
    assert main_texts(spark, *quiet, *loud) == [f"Text {k}" for k in range(12)] + [f"Long text {k} of this page\n\nMore {k}" for k in range(12)]


def test_menus_without_names_are_cut_by_their_links(spark):
    menu = "<ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul>"
    page = "<body>" + menu + "<div><p>Text {k} with <a href=x>a link</a> inside it, long enough</p></div>"
    assert main_texts(spark, *(("a.example", page.format(k=k)) for k in range(3))) == [f"Text {k} with a link inside it, long enough" for k in range(3)]
    assert main_texts(spark, ("b.example", "<p><a href=/>Only a link</a></p>")) == ["Only a link"]


def test_events_fold_and_read_back(spark):
    log = [
        (1, 1, 0, "start", "user", None), (1, 1, 1, "delta", None, "he"), (1, 1, 2, "delta", None, "y # <b> \\"),
        (1, 2, 3, "start", "assistant", None), (1, 2, 4, "delta", None, "bad"), (1, 2, 5, "regenerate", None, None),
        (1, 2, 6, "delta", None, "goo"), (1, 2, 7, "delta", None, "d"), (1, 1, 8, "edit", None, "hi </turn>\n### x: "),
        (None, 1, 0, "start", None, "é"), (2, 5, 1, "delta", "assistant", None),
    ]
    events = spark.createDataFrame(log, "conv_id bigint, message bigint, seq bigint, kind string, role string, text string")
    folded = chat.folded(events)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in folded.collect()}
    assert got == {(1, 1): ("user", "hi </turn>\n### x: "), (1, 2): ("assistant", "good"), (None, 1): ("", "é"), (2, 5): ("assistant", "")}
    turns = chat.rendered(folded)
    for r in turns.collect():
        assert chat.parsed(r.formatted) == [(r.role, r.text)]
        assert r.loss_start is None or chat.unescaped(r.formatted[r.loss_start : r.loss_end]) == r.text
    one = {r.conv_id: r for r in chat.digests(turns).collect()}[1]
    assert one.turns_sha256 == hashlib.sha256(b"user\nhi </turn>\n### x: \nassistant\ngood\n").hexdigest()
    assert (one.n_turns, one.loss_chars, one.loss_sha256) == (2, 4, hashlib.sha256(b"good").hexdigest())
    assert chat.digests(chat.rendered(chat.folded(events.limit(0)))).count() == 0


def test_rows_become_events_and_back(spark):
    rows = [(1, 0, "a:b#", "x" * 2000), (1, 0, "a:b#", "x" * 2000), (1, 1, None, None), (2, None, "user", "")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.conv_id, r.role, r.text) for r in chat.folded(chat.events_of(table)).collect())
    assert got == sorted((c, r or "", t or "") for c, _, r, t in rows)


def test_every_kind_of_event_is_derived(spark):
    rows = [(7, turn, "user" if turn % 2 else "assistant", f"{turn}: " + "é<x> " * (turn * 40)) for turn in range(8)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    events = chat.events_of(table, 16)
    assert {r.kind for r in events.select("kind").distinct().collect()} == {"start", "delta", "edit", "regenerate"}
    log = [r.asDict(recursive=True) for r in events.collect()]
    assert len({tuple(r["seq"].values()) for r in log}) == len(log)  # one sequence for the whole conversation
    state = {}
    for r in sorted(log, key=lambda r: tuple(r["seq"].values())):
        key, text = r["message"]["turn"], r["text"] or ""
        state[key] = {"start": "", "delta": state.get(key, "") + text, "edit": text, "regenerate": ""}[r["kind"]]
    assert state == {turn: text for _, turn, _, text in rows}
    assert sorted((r.message.turn, r.role, r.text) for r in chat.folded(events).collect()) == sorted((t, r, x) for _, t, r, x in rows)
