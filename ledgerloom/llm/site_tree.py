"""Main text of web pages by a style tree of each site.

Pages of one host are merged into a tree of element paths, copies of a page once. A path's presentation
importance is the entropy of the child sequences seen under it, a block's content importance is low
where it occurs on many distinct pages; both combine over the branch. What a page itself says of an
element enters as a prior, one term of the sum: a name or tag such as navigation lowers it unless the element
holds much of the page's text, an article raises it. A block of low importance is cut from the page.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, stored

DECAY = 0.9
LOW_IMPORTANCE = 0.4
MIN_PAGES = 8  # fewer distinct pages say nothing about repetition
# The importance of a block is a weighed sum of its own, that of its branch and the prior.
OWN, BRANCH, PRIOR = 0.6, 0.1, 0.3
UNKNOWN = 0.5  # own and branch importance where there are too few pages
IN_ARTICLE, NEUTRAL = 0.8, 0.5  # priors; a noise mark's rises to NEUTRAL as it nears half of the page's text
MARKED, LINKS = -2.0, -0.5
# A mark inside an article, such as its comments, is believed up to this share of the article's text.
BELIEVED_IN_ARTICLE = 0.5
LINK_DENSITY = 0.8  # of the text of a menu

# Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title svg math iframe object select button canvas audio video".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br input".split()
)
FLOW = set(
    "h1 h2 h3 h4 h5 h6 p blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption section "
    "div article main header hgroup details summary address center".split()
)
CLOSES_P = FLOW | set("aside footer nav form hr fieldset".split())
SELF_CLOSING = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
NOISE_TAGS = set("nav footer aside form menu dialog fieldset".split())
NOISE_WORDS = set(
    "nav navbar navigation menu menubar header masthead topbar footer sidebar aside ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo banner cookie cookies consent notice gdpr popup modal overlay newsletter subscribe "
    "signup login comment comments respond disqus share sharing social related breadcrumb breadcrumbs pagination pager widget "
    "toolbar skip".split()
)
# In an article parts of names count as well: these words, and those of the second list beside one of the third.
NOISE_PARTS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments respond disqus newsletter "
    "subscribe subscription signup login cookie cookies consent popup sharing".split()
)
PAIRED = set("related share social recommended".split())
PAIRS = set(
    "articles bar box buttons content follow icons items links list media news pages posts reading stories tools videos widget".split()
)
ANCHORS = {"article", "main"}
UNNAMED = ANCHORS | {"html", "body"}  # their names say how the page looks, not what it is
TITLES = {"header", "masthead"}  # in an article they hold its title

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>", re.DOTALL
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_WORDS = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"[0-9]+")


class _Element:
    __slots__ = ("tag", "path", "marks", "inside", "gone", "children", "text", "linked")

    def __init__(self, tag: str, path: tuple, marks: tuple, inside: bool, gone: bool):
        self.tag, self.path, self.marks, self.inside, self.gone = tag, path, marks, inside, gone
        self.children: list[str] = []
        self.text: list[str] = []
        self.linked = 0


def _code(parent: int, name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode(), parent & 0xFFFFFFFFFFFFFFFF) >> 1


def _is_marked(tag: str, names: list[str], inside: bool) -> bool:
    """Whether tag or names speak of noise. In an article titles do not, and of parts of names only some do."""
    if tag in UNNAMED:
        return False
    if tag in NOISE_TAGS or (tag == "header" and not inside):
        return True
    values = [v for n in names for v in n.split("=", 1)[1].split()]
    if not inside:
        return any(w in NOISE_WORDS for v in values for w in _WORDS.split(v))
    for value in values:
        parts = set(_WORDS.split(value))
        if (value in NOISE_WORDS and value not in TITLES) or parts & NOISE_PARTS or (parts & PAIRED and parts & PAIRS):
            return True
    return False


def parse(page: str):
    """("block", path, marks, inside, text, linked) in page order and ("node", path, marks, inside, children, 0) per element.

    A path is the tuple of codes of the elements above, one code per tag, class and id; digits
    in names count as equal. ``marks`` are the elements above that speak of noise, as (number, in an article).
    ``linked`` is how much of the text stands in links. What is not shown, such as the head, is left out.
    """
    root = _Element("", (1,), (), False, False)
    stack = [root]
    out = []
    marked = 0

    def end_block(element):
        text = "".join(element.text)
        if text.strip() and not element.gone:
            out.append(("block", element.path, element.marks, element.inside, text, element.linked))
        element.text.clear()
        element.linked = 0

    def block():
        k = len(stack) - 1
        while k and stack[k].tag in INLINE:
            k -= 1
        return stack[k]

    def add(text):
        k, link = len(stack) - 1, False
        while k and stack[k].tag in INLINE:
            link = link or stack[k].tag == "a"
            k -= 1
        stack[k].text.append(text)
        if link:
            stack[k].linked += len(text.strip())

    def close(to):
        while len(stack) > to:
            element = stack.pop()
            if element.tag not in INLINE:
                end_block(element)
                if not element.gone:
                    out.append(("node", element.path, element.marks, element.inside, element.children, 0))

    at = 0
    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        if mark > at:
            add(page[at:mark])
        found = _MARKUP.match(page, mark)
        if found is None:
            add("<")
            at = mark + 1
            continue
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                add(html.escape(found[0][9:-3]))
            continue
        tag, attributes = found[2].lower(), found[3]
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag not in INLINE:
                        end_block(block())
                    close(k)
                    break
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                end_block(block())
            else:
                block().text.append(" " if tag in ("br", "img", "input") else "")
            continue
        if tag in INLINE:
            stack.append(_Element(tag, stack[-1].path, stack[-1].marks, stack[-1].inside, stack[-1].gone))
            continue
        shuts = SELF_CLOSING.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in shuts:
                close(k)
                break
            if stack[k].tag not in INLINE and stack[k].tag not in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
                break
        end_block(block())
        names, hidden, quiet = [], False, False
        for name, value in _NAMED.findall(attributes) if attributes.strip() else ():
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                quiet = quiet or value == "true"
            else:
                names.append(f"{name}={value}")
        if block().tag == "head":  # what a head cannot hold ends it
            close(max(k for k, e in enumerate(stack) if e.tag == "head"))
        above = block()
        marks = above.marks
        if _is_marked(tag, names, above.inside) or (quiet and tag not in UNNAMED):
            marks = (*marks, (marked, above.inside))
            marked += 1
        gone = above.gone or tag == "head" or (hidden and tag not in UNNAMED)
        key = tag if tag in UNNAMED else _DIGITS.sub("0", " ".join([tag, *sorted(names)]))
        above.children.append(tag)
        stack.append(_Element(tag, (*above.path, _code(above.path[-1], key)), marks, above.inside or tag in ANCHORS, gone))
    end_block(block())
    close(1)
    end_block(root)
    return out


def text_of(block: str) -> str:
    """Character references decoded, white space as single spaces, trimmed."""
    return " ".join(html.unescape(block).split())


def priors(parsed) -> list[float]:
    """The prior of every block. A mark weighs less the more it holds of the article's text, or of all without article.

    In an article it weighs fully up to half of the text, as its comments may be as long as it is.
    Outside, a block of links counts as a menu unless links are most of the text.
    """
    blocks = [(marks, inside, len(text.strip()), linked) for kind, _, marks, inside, text, linked in parsed if kind == "block"]
    article = sum(size for _, inside, size, _ in blocks if inside)
    total = article or sum(size for _, _, size, _ in blocks)
    held: Counter = Counter()
    menus = 0
    for marks, inside, size, linked in blocks:
        if inside or not article:
            held.update(dict.fromkeys(marks, size))
        if linked >= LINK_DENSITY * size and not article:
            menus += size

    def prior(marks, inside, size, linked):
        worst = NEUTRAL
        for mark in marks:
            share = held[mark] / total
            trust = 2 * max(0.0, share - BELIEVED_IN_ARTICLE) if mark[1] else 2 * share
            worst = min(worst, MARKED + (NEUTRAL - MARKED) * min(1.0, trust))
        if linked >= LINK_DENSITY * size and not inside:
            worst = min(worst, LINKS + (NEUTRAL - LINKS) * min(1.0, 2 * menus / total))
        return IN_ARTICLE if inside and worst >= NEUTRAL else worst

    return [prior(*b) for b in blocks]


def _host() -> F.Column:
    found = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found).alias("host")


_SEEN, _STYLE, _CONTENT = 0, 1, 2
_KEY = pa.struct([("path", pa.list_(pa.int64())), ("kind", pa.int32()), ("value", pa.int64())])
_PAGES = pa.schema([("host", pa.string()), ("page", pa.int64()), ("keys", pa.list_(_KEY))])


def _block_code(path: tuple, text: str) -> int:
    return _code(path[-1], text)


def _keys(page: str) -> tuple[int, list[dict]]:
    """A hash of the page's text, and what it adds to the tree: elements, child sequences, blocks.

    The hash is that of the blocks without noise marks, so that copies under other advertisements are still copies.
    """
    parsed = parse(page)
    keys, texts, prior = set(), [], iter(priors(parsed))
    for kind, path, _, _, what, _ in parsed:
        if kind == "node":
            keys.add((path, _SEEN, 0))
            keys.add((path, _STYLE, xxhash.xxh64_intdigest(" ".join(what).encode()) >> 1))
        elif text := text_of(what):
            keys.add((path, _SEEN, 0))
            keys.add((path, _CONTENT, _block_code(path, text)))
            texts.append((next(prior), text))
        else:
            next(prior)
    told = "\n".join([t for p, t in texts if p >= NEUTRAL] or [t for _, t in texts])
    return xxhash.xxh64_intdigest(told.encode()) >> 1, [dict(zip(("path", "kind", "value"), k, strict=True)) for k in sorted(keys)]


def _seen(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, pages): distinct pages that hold each element, child sequence and block of text."""

    def task(batches):
        for batch in batches:
            held = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                code, keys = _keys(page or "")
                if (host, code) not in held or _order(keys) < _order(held[host, code]):
                    held[host, code] = keys
            columns = [[h for h, _ in held], [c for _, c in held], list(held.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAGES, strict=True)], schema=_PAGES)

    each = pages.select(_host(), "html").mapInArrow(
        task, "host string, page bigint, keys array<struct<path: array<bigint>, kind: int, value: bigint>>"
    )
    once = each.groupBy("host", "page").agg(F.min("keys").alias("keys"))
    counted = once.select("host", F.explode("keys").alias("key")).select("host", "key.*")
    return counted.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("pages"))


def _order(keys: list[dict]) -> list:
    return [(k["path"], k["kind"], k["value"]) for k in keys]


def importances(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, code, importance): of the elements that hold text in the hosts' trees, and of repeated blocks in them.

    With m distinct pages holding an element, presentation importance is the entropy to base m of its child
    sequences; a block's importance is 1 - log(pages with it) / log(m). A branch's importance weighs
    its presentation by 1 - DECAY**styles and the mean of its blocks by the rest. Blocks on at most
    sqrt(m) pages are not listed and count as unique; this bounds the list of a host.
    """
    counts = stored(_seen(pages), "tree-counts")
    n, kind = F.col("pages"), F.col("kind")
    # Sums only, so that a host's many blocks are added up where they are read.
    each = counts.groupBy("host", "path").agg(
        F.sum(F.when(kind == _SEEN, n)).alias("m"),
        F.sum(F.when(kind == _STYLE, n)).alias("n"),
        F.sum(F.when(kind == _STYLE, n * F.ln(n))).alias("n_ln_n"),
        F.count(F.when(kind == _STYLE, 1)).alias("styles"),
        F.count(F.when(kind == _CONTENT, 1)).alias("blocks"),
        F.sum(F.when(kind == _CONTENT, F.ln(n))).alias("ln_pages"),
    )
    each = stored(each.where(F.col("m") >= min_pages), "tree-elements")
    ln_m = F.ln("m")
    # A block counts for each element above it.
    unique = F.col("blocks") - F.col("ln_pages") / ln_m
    above = each.where("blocks > 0").select(
        "host",
        F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda k: F.slice("path", F.lit(1), k))).alias("path"),
        unique.alias("importance"),
        "blocks",
    )
    content = above.groupBy("host", "path").agg((F.sum("importance") / F.sum("blocks")).alias("content"))
    presentation = F.coalesce((F.col("n") * ln_m - F.col("n_ln_n")) / (F.col("m") * ln_m), F.lit(0.0))
    weight = F.pow(F.lit(DECAY), F.col("styles"))
    code = F.element_at("path", -1).alias("code")
    branches = (
        each.where("blocks > 0").join(content, ["host", "path"])
        .select("host", code, ((1 - weight) * presentation + weight * F.col("content")).alias("importance"))
    )
    often = counts.where((kind == _CONTENT) & (n * n > min_pages))
    blocks = often.join(each.select("host", "path", "m"), ["host", "path"]).where(n * n > F.col("m"))
    return branches.unionByName(blocks.select("host", F.col("value").alias("code"), (1 - F.ln(n) / ln_m).alias("importance")))


def main_text(page: str, known: dict[int, float], low: float = LOW_IMPORTANCE) -> str:
    """The page's blocks that are not of low importance; ``known`` holds what the host's tree says."""
    parsed = parse(page)
    kept, prior = [], iter(priors(parsed))
    for kind, path, _, _, what, _ in parsed:
        if kind != "block":
            continue
        own = branch = UNKNOWN
        text, trusted = text_of(what), next(prior)
        if path[-1] in known:
            own, branch = known.get(_block_code(path, text), 1.0), known[path[-1]]
        if text and OWN * own + BRANCH * branch + PRIOR * trusted >= low:
            kept.append(text)
    return "\n\n".join(kept)


def extract(pages: DataFrame, low: float = LOW_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, empty if there is none.

    Pages are parsed twice, for the trees and for the text; only counts and, per host, the
    importances in its tree are joined to them. A page without url belongs to the nameless host; null html
    is empty. Repeated rows come out repeatedly, ids may be null.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    pages = pages.select("page_id", "url", "html")
    tree = importances(pages, min_pages).groupBy("host").agg(F.collect_list(F.struct("code", "importance")).alias("tree"))
    # Stored, so that Spark sees its size and, beyond a broadcast, can split a hot host.
    tree = stored(tree, "tree-importances")
    joined = pages.withColumn("host", _host()).join(tree, "host", "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def task(batches):
        for batch in batches:
            texts, trees = [], {}
            for k, (host, page) in enumerate(zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if host not in trees:
                    trees[host] = {e["code"]: e["importance"] for e in batch.column(4)[k].as_py() or ()}
                texts.append(main_text(page or "", trees[host], low))
            lengths = pa.array(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], schema=schema)

    result = joined.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html", "host", "tree")
    return result.mapInArrow(task, "page_id bigint, url string, text string, n_chars bigint")
