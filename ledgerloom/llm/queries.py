"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import chat, disclosure, quality, toxicity
from ledgerloom.llm.common import in_training, is_held_out
from ledgerloom.llm.decontamination import contaminated
from ledgerloom.llm.graph_search import nearest
from ledgerloom.llm.line_dedup import dedup_lines
from ledgerloom.llm.ngram_join import similar_groups
from ledgerloom.llm.packing import pack, sizes_of
from ledgerloom.llm.site_tree import extract
from ledgerloom.llm.source_audit import audit
from ledgerloom.llm.spelling import spelling_variants
from ledgerloom.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_graph_search")
def op1_graph_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op2_quality")
def op2_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = quality.train(docs, table(spark, sf_dir, "labels"), in_training(F.col("doc_id"), 3, 1))
    scored = quality.score(docs.select("doc_id", "text"), trees)
    return scored.select("doc_id", is_held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


SHINGLES_SQL = rf"""
words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets)"""

ORACLE_3 = f"""WITH RECURSIVE {SHINGLES_SQL},
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM tokens AS a JOIN tokens AS b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 75 * (na + nb - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets AS s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS r ON s.doc_id = r.a"""


@query("op3_ngram_join", ORACLE_3)
def op3_ngram_join(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLE_4 = """WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages),
d AS (
  SELECT *, list_transform(range(0, 8), lambda k: CAST('0x' || substr(h, CAST(5 * k + 1 AS INTEGER), 5) AS BIGINT)) AS g FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(g, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32768 + 1 AS INTEGER), 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 1024 % 32 + 1 AS INTEGER), 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32 % 32 + 1 AS INTEGER), 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d"""


@query("op4_warc", ORACLE_4)
def op4_warc(spark, sf_dir):
    records = read_archives(write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_5 = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS place FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13) || chr(10)), '{UPPER}', '{LOWER}') AS key
  FROM lines),
held AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE len(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, h.keeper IS NOT NULL AND h.keeper <> k.doc_id AS gone FROM keyed AS k LEFT JOIN held AS h USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query("op5_line_dedup", ORACLE_5)
def op5_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query("op6_site_tree")
def op6_site_tree(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


@query("op7_packing")
def op7_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pack(docs, sizes=sizes_of(similar_groups(docs, keep=["source"])))


ORACLE_8 = f"""WITH {SHINGLES_SQL},
items AS (
  SELECT item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
item_sets AS (
  SELECT item_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM items),
item_tokens AS (SELECT item_id, len(s) AS n_item, unnest(s) AS token FROM item_sets)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM item_tokens JOIN tokens USING (token)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 75 * n_item"""


@query("op8_decontamination", ORACLE_8)
def op8_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


EXTRA_ID, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"

ORACLE_9 = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {EXTRA_ID}, 0, 'user', '{EXTRA_TEXT}'
  UNION ALL SELECT {EXTRA_ID}, 1, 'assistant', '{EXTRA_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(regexp_replace(role, '([\\\\#<:])', '\\\\\\1', 'g'))
                + length(regexp_replace(text, '([\\\\#<])', '\\\\\\1', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query("op9_chat", ORACLE_9)
def op9_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)], "conv_id bigint, turn bigint, role string, text string"
    )
    messages = chat.folded(chat.events_of(rows.unionByName(extra)))
    return chat.digests(chat.rendered(messages))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    field = toxicity.train(docs, table(spark, sf_dir, "labels"), in_training(F.col("doc_id"), 5, 0))
    tagged = toxicity.tag(docs.select("doc_id", "text"), field)
    return tagged.select("doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted", "spans")


ORACLE_13 = rf"""WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
own AS (SELECT r, lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM own GROUP BY ALL HAVING count(*) >= 10),
langs AS (
  SELECT lang, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total, count(term) AS v
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
held AS (
  SELECT lang, source, term, CAST(sum(own.n) AS HUGEINT) AS n FROM own JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT lang, source, CAST(coalesce(sum(n), 0) AS HUGEINT) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN held USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + 1000000000 * (coalesce(h.n, 0) + 2) // (g.total + 2 * l.v) AS p,
         1 + 1000000000 * (k.n + 2) // (l.total + 2 * l.v) AS q
  FROM groups AS g JOIN langs AS l USING (lang) JOIN kept AS k USING (lang)
  LEFT JOIN held AS h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs AS p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR place <= 10"""


@query("op13_source_audit", ORACLE_13)
def op13_source_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


ORACLE_12 = rf"""WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(strlen(name)), lambda i: CAST('0x' || substr(hex(name), 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, step[xor(c, b) % 256 + 1]))) AS h
  FROM (SELECT run, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name FROM own), steps),
noisy AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                 ELSE run END AS word FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, i, left(word, i) AS head, substr(word, i + 2) AS tail
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut AS a JOIN cut AS b USING (i, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN words AS b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN words AS b ON b.word = a.head || a.tail),
near AS (
  SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, struct_pack(m := -m, other := other)) AS best
  FROM pairs GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN best END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM words LEFT JOIN near USING (word)),
ways AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT w.word, f.form FROM ways AS w JOIN formed AS f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
FROM formed AS f JOIN ways AS w ON w.word = f.word JOIN formed AS e ON e.word = w.root AND e.form IS NULL"""


@query("op12_spelling", ORACLE_12)
def op12_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"), noise=True)


_PERSONAL = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MATCHES_SQL = " UNION ALL ".join(
    f"SELECT r, {k} AS kind, '{name}' AS name, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS pieces FROM docs"
    for k, (name, p) in enumerate(_PERSONAL.items())
)
ORACLE_11 = rf"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({_MATCHES_SQL}),
placed AS (
  SELECT r, kind, name, m[i] AS value, pieces[i] AS before, pieces[i + 1] AS after,
         sum(length(m[i]) + length(pieces[i])) OVER (PARTITION BY r, kind ORDER BY i) AS e
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM matches)),
digits AS (SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS d FROM placed),
base AS (
  SELECT r, kind, name, before, after, CAST(e - length(value) AS BIGINT) AS s, CAST(e AS BIGINT) AS e,
         name || ':' || CASE WHEN kind < 2 THEN translate(value, '{UPPER}', '{LOWER}') ELSE d END AS entity
  FROM digits
  WHERE CASE kind WHEN 0 THEN true
    WHEN 1 THEN list_bool_and(list_transform(string_split(value, '.'), lambda x: coalesce(TRY_CAST(x AS HUGEINT) <= 255, false)))
    WHEN 2 THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(d)), lambda i:
        CASE WHEN i % 2 = 0 THEN CAST(d[length(d) - i] AS INTEGER)
             ELSE 2 * CAST(d[length(d) - i] AS INTEGER) // 10 + 2 * CAST(d[length(d) - i] AS INTEGER) % 10 END)) % 10 = 0
    ELSE length(d) BETWEEN 9 AND 15 END),
nearby AS (
  SELECT r, entity, unnest(list_filter(regexp_extract_all(translate(
           CASE WHEN length(before) > 100 THEN regexp_replace(right(before, 100), '^[A-Za-zÀ-ÿ]+', '') ELSE before END || ' ' ||
           CASE WHEN length(after) > 100 THEN regexp_replace(left(after, 100), '[A-Za-zÀ-ÿ]+$', '') ELSE after END,
           '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+'), lambda w: length(w) >= 4)) AS term FROM base),
both_held AS (
  SELECT entity, term, count(DISTINCT r) AS n_both
  FROM (SELECT * FROM nearby UNION ALL SELECT r, entity, left(term, 3) || '*' FROM nearby) GROUP BY ALL HAVING n_both >= 3),
entities AS (SELECT entity, count(DISTINCT r) AS n_entity FROM base GROUP BY entity),
words AS (
  SELECT r, i, s[i] AS word, sum(length(s[i]) + length(p[i])) OVER (PARTITION BY r ORDER BY i) AS e
  FROM (SELECT r, s, p, unnest(range(1, len(s) + 1)) AS i FROM (
    SELECT r, regexp_extract_all(text, '[A-Za-zÀ-ÿ]+') AS s, regexp_split_to_array(text, '[A-Za-zÀ-ÿ]+') AS p FROM docs))),
terms AS (
  SELECT r, translate(word, '{UPPER}', '{LOWER}') AS term, CAST(e - length(word) AS BIGINT) AS s, CAST(e AS BIGINT) AS e
  FROM words WHERE length(word) >= 4),
held AS (
  SELECT term, count(*) AS n_term
  FROM (SELECT DISTINCT r, term FROM terms UNION ALL SELECT DISTINCT r, left(term, 3) || '*' FROM terms) GROUP BY term),
much AS (
  SELECT entity, term FROM both_held JOIN entities USING (entity) JOIN held USING (term), (SELECT count(*) AS n FROM docs)
  WHERE log2(CAST(n_both AS DOUBLE) * n / (CAST(n_entity AS DOUBLE) * n_term)) > log2(CAST(n AS DOUBLE) / n_entity) / 1.05),
spans AS (
  SELECT r, kind, name, s, e FROM base
  UNION ALL SELECT DISTINCT t.r, 4, 'term', t.s, t.e
  FROM base AS b JOIN much USING (entity) JOIN terms AS t ON t.r = b.r AND t.term = much.term
  WHERE NOT EXISTS (FROM base AS o WHERE o.r = t.r AND o.kind = 0 AND o.s < t.e AND t.s < o.e)),
joined AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_email, count(*) FILTER (WHERE kind = 1) AS n_ip,
         count(*) FILTER (WHERE kind = 2) AS n_card, count(*) FILTER (WHERE kind = 3) AS n_phone,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 4) AS base,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)"""


@query("op11_disclosure", ORACLE_11)
def op11_disclosure(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = disclosure.sanitise(docs, disclosure.disclosing_terms(docs))
    counts = [disclosure.n_of(F.col("base_found"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    digest = F.sha2(disclosure.span_text(F.col("base_found")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, disclosure.span_text(F.col("found")).alias("spans"))
