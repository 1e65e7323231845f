"""Main text of HTML pages, by wrappers inferred from the pages of a host.

A page is a balanced stream of block tags with text slots between them. A wrapper is a
union-free regular expression over such streams: tags, text slots, optional parts and
repeated groups. The pages of a host are aligned one after the other: where two streams
differ, tandem repeats become a repeated group and what only one side has becomes an
optional part; texts become slots. A wrapper never has alternatives.

Pages are reduced to their own expression first (repeats folded), and a host's distinct
expressions are aligned in a tree of tasks, `FAN` to a task, so a host with a third of all
pages is no single task and no page is left out. Every expression is then matched to its
host's wrapper, and figures of each wrapper slot over all pages (length, share of links,
whether its text is always the same) decide with the tags around it which slots are the
article. The pages are read a second time with these decisions; only then do texts move,
where Spark does not broadcast the decisions.

Which slots: none below menus, page headers, footers, sidebars, notices, adverts, forms or
reader comments, by tag, role or class words. If an expression has slots in `article` or
`main`, those are the text. Otherwise the least part of the wrapper that holds most text
outside links that is not the same on all pages.

Blocks: text between block tags is one block; inline tags vanish and `br` is white space.
Runs of white space (Unicode) become one space after decoding.

Defined results: one row per page row, repeats included; a NULL or empty page, or one
without an article, has the empty text; a URL without a host (or NULL) belongs to the host
`''`; broken markup is repaired (open tags end with their parent, stray end tags and a tag
cut off at the end vanish); nesting beyond `MAX_DEPTH` still separates blocks; other columns
are ignored. A page is parsed whole in one task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lawgrain.session import staged

FAN = 64
MAX_DEPTH = 64
# Figures are sent on when a task holds so many.
HELD = 50_000
# Cells of an alignment table; beyond, blocks are matched instead.
LONG_ALIGNMENT = 1_000_000
# A text that is the same on so many pages of a host is the host's, not the page's.
SAME_PAGES = 3

# Element kinds of HTML.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var img wbr".split()
)
# Elements whose start ends an open one, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements, roles and class words of what surrounds an article.
_AROUND = frozenset("head nav footer aside form button select menu dialog noscript template svg canvas object fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
_WORDS = re.compile(
    r"(?:^|[-_ ])(?:nav(?:bar|igation)?|menu|side-?bar|foot(?:er)?|(?:page|site|top)-?head(?:er)?|masthead|ads?|advert(?:s|isement|ising)?|"
    r"sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|notices?|gdpr|pop-?up|modal|newsletter|subscribe|share|social|"
    r"breadcrumbs?|comments?|disqus|replies|related|widget|login|search|pagination|pager|skip-?link)(?:$|[-_ ])"
)
_ARTICLE = frozenset(("article", "main"))

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[a-zA-Z/!][^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _label(name: str, attributes: str) -> str:
    """Tag with what tells its use; numbers in names are taken as one."""
    found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    parts = [f"{k}={_DIGITS.sub('0', ' '.join(v.lower().split()))[:80]}" for k, v in sorted(found.items())]
    return " ".join([name, *parts])


def parse(html: str) -> tuple[list, list[tuple[str, int]]]:
    """Children of the root and the texts (text, characters in links) of a page.

    A child is [label, children], or the number of a text.
    """
    root: list = []
    stack: list[tuple[str, list]] = [("", root)]
    texts: list[tuple[str, int]] = []
    open_text: list[str] = []
    links = in_link = beyond = 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(open_text).split())
        open_text.clear()
        if text:
            stack[-1][1].append(len(texts))
            texts.append((text, min(links, len(text))))
        links = 0

    def add(raw: str) -> None:
        nonlocal links
        text = unescape(raw)
        open_text.append(text)
        if in_link:
            links += len(text)

    at = 0
    while (tag := _TAG.search(html, at)) is not None:
        if tag.start() > at:
            add(html[at : tag.start()])
        at = tag.end()
        name = tag.group(2) or tag.group(5)
        if name is None:
            continue
        name = name.lower()
        closing, attributes = bool(tag.group(1) or tag.group(4)), tag.group(3) or tag.group(6) or ""
        if name in INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            continue
        if name == "br":
            open_text.append(" ")
            continue
        if name in RAW and not closing:
            flush()
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        flush()
        in_link = 0
        if closing:
            if beyond:
                beyond -= 1
            elif any(n == name for n, _ in stack[1:]):
                while stack.pop()[0] != name:
                    pass
            continue
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if name in _ENDS:
            same, stops = _ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in same:
                    del stack[i:]
                    break
                if stack[i][0] in stops:
                    break
        if len(stack) > MAX_DEPTH:
            beyond += 1
            continue
        kids: list = []
        stack[-1][1].append([_label(name, attributes), kids])
        stack.append((name, kids))
    add(html[at:])
    flush()
    return root, texts


# -- expressions --------------------------------------------------------------
# An expression is [label, repeated, optional, children]; a slot has the label "#" and its
# texts' numbers as children (none in a wrapper); a group has the label "(" and its parts'.


def _sequence(kids: list) -> list:
    made = [["#", False, False, [k]] if isinstance(k, int) else [k[0], False, False, _sequence(k[1])] for k in kids]
    return fold(made)


def _joined(x: list, y: list, repeated: bool) -> list:
    """Two expressions of one label as one."""
    if x[0] == "#":
        x[3].extend(y[3])  # one list for all texts of a slot, however many
    kids = x[3] if x[0] == "#" else aligned(x[3], y[3])
    return [x[0], x[1] or y[1] or repeated, x[2] or y[2], kids]


def _group_label(parts: tuple[str, ...]) -> str:
    return "(" + " , ".join(parts) + ")"


def fold(items: list, known: frozenset = frozenset()) -> list:
    """Tandem repeats as repeated expressions; a `known` group is one also when single."""
    out: list = []
    for item in items:  # repeats of one part
        if out and out[-1][0] == item[0]:
            out[-1] = _joined(out[-1], item, True)
        else:
            out.append(item)
    for width in (2, 3):
        labels = [x[0] for x in out]
        made, i = [], 0
        while i < len(out):
            parts = tuple(labels[i : i + width])
            body = out[i : i + width]
            if len(parts) < width or any(p.startswith("(") for p in parts):
                made.append(out[i])
                i += 1
                continue
            times = 1
            while tuple(labels[i + times * width : i + (times + 1) * width]) == parts:
                again = out[i + times * width : i + (times + 1) * width]
                body = [_joined(x, y, False) for x, y in zip(body, again)]
                times += 1
            if times > 1 or parts in known:
                group = [_group_label(parts), times > 1, False, body]
                if made and made[-1][0] == group[0]:
                    group = _joined(made.pop(), group, True)
                made.append(group)
                i += times * width
            else:
                made.append(out[i])
                i += 1
        out = made
    return out


def _groups(items: list) -> frozenset:
    return frozenset(tuple(k[0] for k in x[3]) for x in items if x[0].startswith("("))


def _embedded(part: list[str], whole: list[str]) -> list[int] | None:
    """Places of a subsequence in a sequence, each as early as may be; None if it is none."""
    places, at = [], 0
    for label in part:
        try:
            at = whole.index(label, at) + 1
        except ValueError:
            return None
        places.append(at - 1)
    return places


def _matches(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence.

    Of two long sequences, neither in the other, it is a common one by longest blocks.
    """
    if (found := _embedded(left, right)) is not None:
        return list(enumerate(found))
    if (found := _embedded(right, left)) is not None:
        return [(i, j) for j, i in enumerate(found)]
    if len(left) * len(right) > LONG_ALIGNMENT:
        blocks = SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks()
        return [(b.a + k, b.b + k) for b in blocks for k in range(b.size)]
    n, m = len(left), len(right)
    low = 0
    while low < min(n, m) and left[low] == right[low]:
        low += 1
    high = 0
    while high < min(n, m) - low and left[n - 1 - high] == right[m - 1 - high]:
        high += 1
    pairs = [(i, i) for i in range(low)]
    a, b = left[low : n - high], right[low : m - high]
    if a and b:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                pairs.append((low + i, low + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return pairs + [(n - high + k, m - high + k) for k in range(high)]


def aligned(left: list, right: list) -> list:
    """One sequence that stands for both: what only one has is optional."""
    known = _groups(left) | _groups(right)
    if known:
        left, right = fold(left, known), fold(right, known)
    out, i, j = [], 0, 0
    for a, b in [*_matches([x[0] for x in left], [x[0] for x in right]), (len(left), len(right))]:
        out += [[x[0], x[1], True, x[3]] for x in (*left[i:a], *right[j:b])]
        if a < len(left):
            out.append(_joined(left[a], right[b], False))
        i, j = a + 1, b + 1
    return fold(out)


def expression(html: str) -> tuple[str, list[list[int]], list[tuple[str, int]]]:
    """A page's expression as text, the texts of each of its slots, and all texts."""
    kids, texts = parse(html)
    slots: list[list[int]] = []

    def bare(items: list) -> list:
        out = []
        for label, repeated, optional, inner in items:
            if label == "#":
                slots.append(sorted(inner))
                out.append([label, repeated, optional, []])
            else:
                out.append([label, repeated, optional, bare(inner)])
        return out

    return json.dumps(bare(_sequence(kids)), separators=(",", ":")), slots, texts


def merged(expressions: list[str]) -> str:
    """The wrapper of some expressions (or wrappers)."""
    whole = None
    for text in sorted(expressions):
        one = json.loads(text)
        whole = one if whole is None else aligned(whole, one)
    return json.dumps(whole, separators=(",", ":"))


def slots_of(items: list, path: tuple = ()) -> Iterator[tuple]:
    """The path (places and labels) of each slot of an expression, in order."""
    for i, (label, _, _, kids) in enumerate(items):
        if label == "#":
            yield (*path, (i, label))
        else:
            yield from slots_of(kids, (*path, (i, label)))


def matched(items: list, wrapper: list) -> list[tuple[int, ...]]:
    """For each slot of an expression, in order, its places in a wrapper made of it.

    A part of the expression takes the next part of the wrapper that has its label, in a
    group or not, and room for all below it; one that an alignment has moved takes the first.
    Without places (empty) where the wrapper was not made of the expression.
    """
    memo: dict[tuple[int, int], list | None] = {}

    def below(item: list, part: list) -> list[tuple[int, ...]] | None:
        if item[0] == "#":
            return [()]
        key = id(item), id(part)
        if key not in memo:
            memo[key] = level(item[3], part[3])
        return memo[key]

    def level(parts: list, whole: list) -> list[tuple[int, ...]] | None:
        found: dict[str, list[tuple[tuple[int, ...], list]]] = {}
        for j, x in enumerate(whole):
            found.setdefault(x[0], []).append(((j,), x))
            for k, part in enumerate(x[3] if x[0].startswith("(") else ()):
                found.setdefault(part[0], []).append(((j, k), part))
        last, out = (-1,), []
        # a group that the wrapper does not have stands there as its parts
        for item in [y for x in parts for y in (x[3] if x[0].startswith("(") and x[0] not in found else [x])]:
            have = found.get(item[0], [])
            for place, part in [*(h for h in have if h[0] >= last), *(h for h in have if h[0] < last)]:
                inner = below(item, part)
                if inner is not None:
                    last = place
                    out += [place + p for p in inner]
                    break
            else:
                return None
        return out

    places = level(items, wrapper)
    return [()] * sum(1 for _ in slots_of(items)) if places is None else places


# -- which slots --------------------------------------------------------------


def _around(label: str, within: bool) -> bool:
    """Whether an element holds what surrounds an article."""
    name, _, rest = label.partition(" ")
    if name in _AROUND or name == "header" and not within:
        return True
    if name in ("html", "body", "main") or not rest:
        return False
    for part in re.split(r" (?=(?:class|id|role|itemprop)=)", rest):
        key, _, value = part.partition("=")
        if key == "role" and value in _ROLES or key in ("class", "id") and _WORDS.search(value):
            return True
    return False


def _article(label: str) -> bool:
    name, _, rest = label.partition(" ")
    return name in _ARTICLE or "role=main" in rest or "itemprop=articlebody" in rest


def _standing(labels: tuple[str, ...]) -> tuple[bool, bool]:
    """Whether a slot is around an article, and whether it is in one."""
    within = around = False
    for label in labels:
        around = around or _around(label, within)
        within = within or _article(label)
    return around, within


def dense_slots(wrapper: list, figures: dict[int, tuple]) -> set[int]:
    """Slots of the least part that holds most of a wrapper's own text.

    `figures` of a slot: pages, characters, characters in links, least and greatest hash
    of its text.
    """
    paths = list(slots_of(wrapper))
    own: dict[int, int] = {}
    for s, path in enumerate(paths):
        pages, chars, links, low, high = figures.get(s, (0, 0, 0, 0, 0))
        same = pages >= SAME_PAGES and low == high
        if chars and 2 * links < chars and not same and not _standing(tuple(x for _, x in path))[0]:
            own[s] = chars
    if not own:  # every page the same: nothing tells the host's text from the page's
        for s, path in enumerate(paths):
            _, chars, links, _, _ = figures.get(s, (0, 0, 0, 0, 0))
            if chars and 2 * links < chars and not _standing(tuple(x for _, x in path))[0]:
                own[s] = chars
    part: tuple = ()
    while True:  # down while one child holds four fifths
        weights: dict[tuple, int] = {}
        for s, chars in own.items():
            if paths[s][: len(part)] == part and len(paths[s]) > len(part) + 1:
                key = paths[s][: len(part) + 1]
                weights[key] = weights.get(key, 0) + chars
        total = sum(chars for s, chars in own.items() if paths[s][: len(part)] == part)
        best = max(weights, key=weights.get, default=None)
        if best is None or 5 * weights[best] < 4 * total or best[-1][1].split(" ")[0] in ("p", "(p"):
            return {s for s in own if paths[s][: len(part)] == part}
        part = best


def kept_slots(items: list, standing_in: list[int], dense: set[int]) -> list[int]:
    """Slots of an expression that are the article."""
    labels = [tuple(x for _, x in path) for path in slots_of(items)]
    judged = [_standing(x) for x in labels]
    article = [s for s, (around, within) in enumerate(judged) if within and not around]
    if article:
        return article
    return [s for s, w in enumerate(standing_in) if w in dense and not judged[s][0]]


# -- tables -------------------------------------------------------------------

_FIGURES = "host string, shape long, expression string, slot long, pages long, chars long, links long, low long, high long"


def _shape(text: str) -> int:
    raw = text.encode()
    return zlib.crc32(raw) << 31 | zlib.adler32(raw) & 0x7FFFFFFF


def _figures(pages: DataFrame) -> DataFrame:
    """Figures of each expression (slot -1) and of each of its slots, summed a task."""
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in T._parse_datatype_string(_FIGURES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows() -> pa.RecordBatch:
            lines = [(*key[:2], value[0], key[2], *value[1:]) for key, value in held.items()]
            held.clear()
            columns = list(zip(*lines)) or [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                text, slots, texts = expression(html or "")
                shape = _shape(text)
                whole = held.setdefault((host, shape, -1), [text, 0, 0, 0, 0, 0])
                whole[1] += 1
                for s, numbers in enumerate(slots):
                    mark = zlib.crc32("\n".join(texts[k][0] for k in numbers).encode())
                    sums = held.setdefault((host, shape, s), [None, 0, 0, 0, mark, mark])
                    sums[1] += 1
                    sums[2] += sum(len(texts[k][0]) for k in numbers)
                    sums[3] += sum(texts[k][1] for k in numbers)
                    sums[4], sums[5] = min(sums[4], mark), max(sums[5], mark)
                if len(held) > HELD:
                    yield rows()
        yield rows()

    return pages.mapInArrow(run, _FIGURES).groupBy("host", "shape", "slot").agg(
        F.min("expression").alias("expression"),
        *[F.sum(n).alias(n) for n in ("pages", "chars", "links")],
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def infer(expressions: DataFrame) -> DataFrame:
    """(host, wrapper) from the distinct (host, expression), by a tree of alignments."""

    def align(table: pa.Table) -> pa.Table:
        host, whole = table.column("host")[0].as_py(), merged(table.column("expression").to_pylist())
        return pa.table({"host": pa.array([host], pa.string()), "expression": pa.array([whole], pa.string())})

    level = expressions.select("host", "expression")
    while True:
        sizes = level.groupBy("host").agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return level.withColumnRenamed("expression", "wrapper")
        dealt = level.join(sizes, "host").withColumn(
            "bucket", F.pmod(F.xxhash64("expression"), F.ceil(F.col("n") / F.lit(FAN)))
        )
        level = staged(dealt.groupBy("host", "bucket").applyInArrow(align, "host string, expression string"), "wrappers")


def _standings(expressions: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, shape, expression, places): the wrapper slot of each slot of an expression."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, whole in zip(batch.column("expression").to_pylist(), batch.column("wrapper").to_pylist()):
                wrapper = json.loads(whole)
                number = {tuple(i for i, _ in path): s for s, path in enumerate(slots_of(wrapper))}
                found.append([number.get(p, -1) for p in matched(json.loads(text), wrapper)])
            columns = [batch.column("host"), batch.column("shape"), batch.column("expression"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "shape", "expression", "places"])

    joined = expressions.join(wrappers, "host").select("host", "shape", "expression", "wrapper")
    return joined.mapInArrow(run, "host string, shape long, expression string, places array<bigint>")


def _decisions(figures: DataFrame) -> DataFrame:
    """(host, shape, kept): the slots of each expression that are the article."""
    expressions = figures.where("slot = -1").select("host", "shape", "expression")
    wrappers = staged(infer(expressions), "host-wrappers")
    standings = staged(_standings(expressions, wrappers), "standings")
    places = standings.select("host", "shape", F.posexplode("places").alias("slot", "place"))
    summed = (
        figures.where("slot >= 0")
        .join(places.withColumn("slot", F.col("slot").cast("long")), ["host", "shape", "slot"])
        .groupBy("host", "place")
        .agg(*[F.sum(n).alias(n) for n in ("pages", "chars", "links")], F.min("low").alias("low"), F.max("high").alias("high"))
    )
    # one row for each slot of the host's wrapper
    by_host = summed.groupBy("host").agg(F.collect_list(F.struct("place", "pages", "chars", "links", "low", "high")).alias("slots"))

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for whole, slots in zip(batch.column("wrapper").to_pylist(), batch.column("slots").to_pylist()):
                have = {x["place"]: (x["pages"], x["chars"], x["links"], x["low"], x["high"]) for x in slots or ()}
                found.append(sorted(dense_slots(json.loads(whole), have)))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(found, pa.list_(pa.int64()))], names=["host", "dense"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = zip(*(batch.column(c).to_pylist() for c in ("expression", "places", "dense")))
            found = [kept_slots(json.loads(text), at, set(own or ())) for text, at, own in lines]
            columns = [batch.column("host"), batch.column("shape"), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "shape", "kept"])

    own = wrappers.join(by_host, "host", "left").select("host", "wrapper", "slots").mapInArrow(dense, "host string, dense array<bigint>")
    judged = standings.join(own, "host", "left").select("host", "shape", "expression", "places", "dense")
    return judged.mapInArrow(keep, "host string, shape long, kept array<bigint>")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text (the article's blocks by line feeds) and n_chars of every page."""
    rows = pages.select(
        pages[id_col].alias("page_id"),
        pages[url_col].alias("url"),
        F.lower(F.coalesce(F.regexp_extract(pages[url_col].cast("string"), _HOST, 1), F.lit(""))).alias("host"),
        pages[html_col].cast("string").alias("html"),
    )
    figures = staged(_figures(rows.select("host", "html")), "page-figures")
    decisions = staged(_decisions(figures), "page-decisions")
    fields = [*rows.drop("html").schema.fields, T.StructField("shape", T.LongType())]
    fields += T._parse_datatype_string("blocks array<struct<slot: bigint, text: string>>").fields
    blocks_type = to_arrow_type(fields[-1].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, blocks = [], []
            for html in batch.column("html").to_pylist():
                text, slots, texts = expression(html or "")
                slot_of = {k: s for s, numbers in enumerate(slots) for k in numbers}
                shapes.append(_shape(text))
                blocks.append([{"slot": slot_of[k], "text": x} for k, (x, _) in enumerate(texts)])
            columns = [batch.column(c) for c in ("page_id", "url", "host")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(shapes, pa.int64()), pa.array(blocks, blocks_type)], names=[f.name for f in fields]
            )

    parsed = rows.mapInArrow(run, T.StructType(fields))
    joined = parsed.join(decisions, ["host", "shape"], "left")
    article = F.filter("blocks", lambda b: F.array_contains(F.col("kept"), b["slot"]))
    text = F.coalesce(F.array_join(F.transform(article, lambda b: b["text"]), "\n"), F.lit(""))
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
