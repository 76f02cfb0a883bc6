"""Sanitising texts by information: personal data, and the terms that give it away.

Patterns find the entities to protect: addresses, numbers. Which words reveal an entity c is
estimated from the corpus. A term t reveals what pointwise mutual information says,
PMI(c;t) = log(n(c,t) N / (n(c) n(t))), counted in documents; the whole of c is its information content
IC(c) = log(N / n(c)). A term that reveals more than IC(c) / alpha goes from the documents that hold c:
it is generalised to the words with its first letters if these reveal less, and else removed.
Everything is made of Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

# Kinds in the order of spans, and their patterns. Runs that cannot match from their
# start cannot match from within either, so possessive runs behind a look-behind find the same
# matches as plain ones, in linear time.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LETTER = r"[A-Za-zÀ-ÿ]"
_WORD = _LETTER + "++"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMAIL, TERM = 0, 4

CONTEXT = 100  # code points on either side of an entity in which terms are looked for
MIN_BOTH = 3  # documents that must hold entity and term together before they count as evidence
ALPHA = 1.05
TERM_LETTERS = 4
FORM_LETTERS = 3


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(values: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.aggregate(values, none, lambda acc, x: F.concat(acc, F.array(x + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))


def running(values: Column) -> Column:
    """The running sums of an array of numbers: those of blocks of about its square root, then their offsets."""

    def of(xs: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(xs))).cast("int"))
        starts = F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), size)
        return let(F.transform(starts, lambda at: _sums(F.slice(xs, at, size))), joined)

    def joined(blocks: Column) -> Column:
        last = F.transform(blocks, lambda b: F.coalesce(F.try_element_at(b, F.lit(-1)), F.lit(0).cast("bigint")))
        before = lambda b, o: o - F.element_at(b, -1)
        return F.flatten(F.zip_with(blocks, _sums(last), lambda b, o: F.transform(b, lambda x: x + before(b, o))))

    return let(values, of)


def located(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: array of (start, end, value, before, after) by code points.

    ``before`` and ``after`` are the texts up to the neighbouring matches. Null without matches.
    """

    def split(matches: Column) -> Column:
        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), lambda pieces: placed(matches, pieces)))

    def placed(matches: Column, pieces: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: (F.length(m) + F.length(F.get(pieces, i))).cast("bigint"))
        return let(running(lengths), lambda ends: F.transform(matches, lambda m, i: one(m, i, pieces, ends)))

    def one(m: Column, i: Column, pieces: Column, ends: Column) -> Column:
        start = F.get(ends, i) - F.length(m)
        fields = {"start": start, "end": F.get(ends, i), "value": m, "before": F.get(pieces, i), "after": F.get(pieces, i + 1)}
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), split)


def _holds(kind: int, value: Column) -> Column:
    if kind == 1:
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == 2:
        return let(_digits(value), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d))
    if kind == 3:
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _entity(kind: int, value: Column) -> Column:
    """What two spans of one entity have in common."""
    plain = _digits(value) if kind in (2, 3) else lowered(value)
    return F.concat(F.lit(KINDS[kind] + ":"), plain)


def _nearby(before: Column, after: Column) -> Column:
    """The distinct terms next to an entity; words cut by the limit do not count."""
    left = F.regexp_replace(F.substring(before, -CONTEXT, CONTEXT), F.lit(f"^{_LETTER}+"), F.lit(""))
    right = F.regexp_replace(F.substring(after, 1, CONTEXT), F.lit(f"{_LETTER}++$"), F.lit(""))
    left = F.when(F.length(before) > CONTEXT, left).otherwise(before)
    right = F.when(F.length(after) > CONTEXT, right).otherwise(after)
    words = F.regexp_extract_all(lowered(F.concat(left, F.lit(" "), right)), F.lit(_WORD), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= TERM_LETTERS))


def general(term: Column) -> Column:
    return F.concat(F.substring(term, 1, FORM_LETTERS), F.lit("*"))


SPANS = "array<struct<start:bigint,kind:int,end:bigint,entity:string,terms:array<string>>>"


def base_spans(text: Column, terms: bool = True) -> Column:
    """The spans of personal data by start, then kind; with the terms next to them if wanted."""

    def of(kind: int) -> Column:
        def span(x: Column) -> Column:
            near = _nearby(x["before"], x["after"]) if terms else F.array().cast("array<string>")
            ends = [x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")]
            return F.struct(*ends, _entity(kind, x["value"]).alias("entity"), near.alias("terms"))

        held = F.filter(located(text, PATTERNS[kind]), lambda x: _holds(kind, x["value"]))
        return F.coalesce(F.transform(held, span), F.array().cast(SPANS))

    # Signs without which a text holds none of a kind; most texts are not searched further.
    may = [F.contains(text, F.lit("@")), text.rlike(r"[0-9]\.[0-9]"), text.rlike("[0-9]"), F.contains(text, F.lit("+"))]
    found = [F.when(sign, of(kind)).otherwise(F.array().cast(SPANS)) for kind, sign in enumerate(may)]
    return F.array_sort(F.concat(*found))


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def disclosing_terms(docs: DataFrame, alpha: float = ALPHA, min_both: int = MIN_BOTH) -> DataFrame:
    """(entity, term, form, n_both, n_entity, n_term, pmi, information): terms that reveal too much.

    Counts are documents of the whole corpus. Evidence for a pair are documents with the term within
    ``CONTEXT`` code points of the entity; n_term counts the term anywhere. ``form`` is what the term
    is generalised to, null if that reveals too much as well. ``alpha`` is at least 1: the larger, the
    more terms go. An empty table, and a corpus whose every document holds the entity, give no rows.
    """
    total = docs.count()
    text = docs.select(_whole("text").alias("text"))
    spans = text.select(base_spans(F.col("text")).alias("spans")).where(F.size("spans") > 0)

    def with_forms(words: Column) -> Column:
        return let(words, lambda w: F.concat(w, F.array_distinct(F.transform(w, general))))

    per_span = F.transform("spans", lambda s: F.transform(with_forms(s["terms"]), lambda t: F.struct(s["entity"].alias("entity"), t.alias("term"))))
    alone = F.transform("spans", lambda s: F.struct(s["entity"].alias("entity"), F.lit(None).cast("string").alias("term")))
    seen = spans.select(F.inline(F.array_distinct(F.concat(F.flatten(per_span), alone))))
    counts = stored(seen.groupBy("entity", "term").agg(F.count("*").alias("n")).where((F.col("n") >= min_both) | F.col("term").isNull()), "disclosure-pairs")
    both = counts.where(F.col("term").isNotNull()).withColumnRenamed("n", "n_both")
    entities = counts.where(F.col("term").isNull()).select("entity", F.col("n").alias("n_entity"))

    words = F.array_distinct(F.regexp_extract_all(lowered(F.col("text")), F.lit(_WORD), F.lit(0)))
    words = text.select(F.filter(words, lambda w: F.length(w) >= TERM_LETTERS).alias("words"))
    held = words.select(F.explode(with_forms(F.col("words"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    held = held.join(both.select("term").distinct(), "term", "left_semi")

    rows = both.join(entities, "entity").join(held, "term")
    pmi = F.log2(F.col("n_both").cast("double") * total / (F.col("n_entity").cast("double") * F.col("n_term")))
    rows = rows.withColumns({"pmi": pmi, "information": F.log2(F.lit(float(total)) / F.col("n_entity"))})
    rows = stored(rows.where(F.col("pmi") > F.col("information") / alpha), "disclosure-terms")
    worse = rows.where(F.endswith("term", F.lit("*"))).select("entity", F.col("term").alias("form"), F.lit(True).alias("worse"))
    rows = rows.where(~F.endswith("term", F.lit("*"))).withColumn("form", general(F.col("term")))
    rows = rows.join(worse, ["entity", "form"], "left").withColumn("form", F.when(F.col("worse").isNull(), F.col("form")))
    return rows.select("entity", "term", "form", "n_both", "n_entity", "n_term", "pmi", "information")


def _term_spans(marked: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, terms): where the words to change stand in each distinct text that holds their entity."""
    entities = F.explode(F.array_distinct(F.col("spans.entity"))).alias("entity")
    wanted = marked.select("key", entities).distinct().join(terms.select("entity", "term", "form"), "entity")
    # A term that reveals several entities is generalised only if it may be for each of them.
    wanted = wanted.groupBy("key", "term").agg(F.when(F.count("form") == F.count("*"), F.min("form")).alias("form"))
    wanted = stored(wanted, "disclosure-wanted")
    texts = marked.select("key", "text", "spans").join(wanted.select("key").distinct(), "key", "left_semi")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"), F.first("spans").alias("spans"))
    mails = F.filter("spans", lambda s: s["kind"] == EMAIL)
    words = texts.select("key", mails.alias("mails"), F.inline(located(F.col("text"), _WORD)))
    words = words.where(F.length("value") >= TERM_LETTERS)
    free = ~F.exists("mails", lambda s: (s["start"] < F.col("end")) & (F.col("start") < s["end"]))
    words = words.where(free).select("key", "start", "end", lowered(F.col("value")).alias("term"))
    words = words.join(wanted, ["key", "term"])
    span = F.struct("start", F.lit(TERM).alias("kind"), "end", "form")
    return words.groupBy("key").agg(F.sort_array(F.collect_list(span)).alias("terms"))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span's stand-in; spans that overlap count as one, of the first one's kind."""
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<start:bigint,kind:int,end:bigint,form:string>>"),
        lambda acc, s: F.when(
            F.coalesce(F.try_element_at(acc, F.lit(-1))["end"] > s["start"], F.lit(False)),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.transform(F.slice(acc, F.lit(-1), F.lit(1)), lambda x: x.withField("end", F.greatest(x["end"], s["end"]))),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:-1]], F.lit(""))
    at = lambda x: x.cast("int")
    parts = F.aggregate(
        merged,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(
                acc["parts"],
                F.array(F.substring(text, at(acc["at"]) + 1, at(s["start"] - acc["at"])), F.coalesce(s["form"], F.element_at(names, s["kind"] + 1))),
            ).alias("parts"),
        ),
    )
    # A text is shorter than what an int can count.
    return F.concat(F.array_join(parts["parts"], ""), F.substring(text, at(parts["at"]) + 1, F.lit((1 << 31) - 1)))


def sanitise(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``docs`` with ``base_found`` and ``found`` (arrays of start, kind, end, form) and ``sanitised``.

    ``base_found`` has the personal data, ``found`` also the words of ``terms`` in documents that hold
    their entity, by start, then kind; ends are exclusive, places are code points. Entities become
    their kind in brackets, terms their form, or nothing. Null and empty texts have no spans and
    become ''. Repeated rows are treated alike; other columns stay, columns of these names are
    replaced. No row is lost, with or without id.
    """
    marked = docs.withColumns({"__text": _whole("text")})
    marked = marked.withColumn("__spans", base_spans(F.col("__text"), terms=False))
    key = F.when(F.size("__spans") > 0, F.md5("__text"))
    held = marked.where(F.size("__spans") > 0).select(key.alias("key"), F.col("__text").alias("text"), F.col("__spans").alias("spans"))
    extra = stored(_term_spans(held, terms), "disclosure-spans").withColumnsRenamed({"key": "__key", "terms": "__terms"})
    base = F.transform("__spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(None).cast("string").alias("form")))
    marked = marked.withColumn("base_found", base)
    # Rows without spans are spread; their keys meet nothing.
    spread = F.concat(F.lit("-"), F.xxhash64(*[c for c in docs.columns if c == "doc_id"], F.length("__text")).cast("string"))
    joined = marked.withColumn("__key", F.coalesce(key, spread)).join(extra, "__key", "left")
    every = F.array_sort(F.concat("base_found", F.coalesce("__terms", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,form:string>>"))))
    joined = joined.withColumn("found", every)
    joined = joined.withColumn("sanitised", replaced(F.col("__text"), F.col("found")))
    return joined.drop("__text", "__spans", "__key", "__terms")


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
