"""Main text of web pages: lines that a page shares with the nearest page of its host are no text of its own.

Each page is cut into lines, one for each block of its markup. Pages are put in order of
host and URL path, and each one is paired with the pages before and after it on its host whose lines differ: the nearest
URLs. The lines of a pair are aligned by their longest common subsequence, and lines in it are shared and deleted.

Two rules stand beside the comparison. Blocks that the markup itself names as no main text (menus, headers,
footers, sidebars, adverts, forms, scripts, styles, notices, comments of readers)
are deleted even if no other page shares them. Blocks inside an article or a main element are kept even if
another page shares them, as two articles may quote the same passage. Lines outside of them stay or go by the
comparison, whether the page has such an element or not. Inside of them no name drops a heading, and ids, which
are slugs of headings as a rule, drop lists only, and a div whose whole id is such a name.

Only hashes of lines travel with the order and the pairs; the texts are cut again
where the shared lines are known. Pages are numbered over a range-partitioned sort and paired by number, so a host with
a third of all pages is spread over many tasks.

Cases: null and empty html give an empty text. A null URL, or one without a host, is a host of its own kind.
Pages with equal host and path follow each other by id. Pages that follow each other with equal lines are
compared as one with the nearest pages whose lines differ. A near copy, which shares nine tenths of the longer page's
characters, is no witness: nothing is deleted for it, so pages amid near copies may keep lines of the site. Rows that repeat
id, URL and html are read as a page and its copy, and lose all lines outside their article. Unclosed and crossed tags, missing ends and stray
signs are read as browsers would, roughly. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.llm.text import ship
from listloom.operators.rank import with_position
from listloom.session import frozen

ship(__name__)

# Elements that start a line of their own.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
# Elements that are no main text.
DROPPED = frozenset(
    "aside button datalist dialog fieldset footer form head iframe input menu nav noscript object select svg template "
    "textarea title video audio canvas map".split()
)
# Elements whose content is not markup.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes")
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that an opening block closes, and those that end with their like.
CLOSES_P = BLOCKS - {"br", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary", "button", "body", "html", "title"}
SIBLINGS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Names in class, id and role that tell what a block is.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|breadcrumbs?|comments?|commentlist|disqus\w*|replies|respond|"
    r"cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"foot|footer|masthead|topbar|header|menus?|nav|navbar|navigation|sidebars?|side|widgets?|related|recommended|"
    r"share|sharing|social|toolbar|pagination|pager|search|skip|contentinfo|complementary|dialog)(?:$|[\s_-])",
    re.I,
)
MAIN = frozenset(["article", "main"])
# Elements that no name drops inside a main element.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")

OWN, MAYBE, NONE = 1, 0, -1
# Lengths of lines travel in the lowest bits of their hashes.
LENGTH_BITS = 16
LONGEST = (1 << LENGTH_BITS) - 1
# Bits of rows that a comparison of two pages keeps: 8 MB.
KEPT_BITS = 1 << 26
# Two pages that share so much of the longer one's text are copies.
NEAR_COPY = 0.9


# Names of comments of readers, which may be articles in themselves.
REMARK = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|repl(?:y|ies))(?:$|[\s_-])", re.I)
# Beginnings of names that speak of something else on the page.
ABOUT = ("has-", "has_", "with-", "with_", "without-", "no-", "no_", "not-")


# How ids count inside a main element: those of lists do, those of a div as a whole, and others are slugs of headings.
IDS = {"ul": NAMED.search, "ol": NAMED.search, "div": NAMED.fullmatch}


def _no_id(_: str) -> bool:
    return False


def _named(rest: str, names: re.Pattern, ids=None) -> bool:
    for which, a, b, c in ATTRIBUTE.findall(rest):
        hit = ids if ids and which.lower() == "id" else names.search
        if any(hit(x) for x in (a or b or c).split() if not x.lower().startswith(ABOUT)):
            return True
    return False


def lines(html: str) -> list[tuple[str, int]]:
    """The page's lines with their kind: of an article, perhaps main text, or not."""
    out: list[tuple[str, int]] = []
    words: list[str] = []
    # Open elements: (name, kind of what they hold), and how many of each name, so that none is sought in vain.
    stack: list[tuple[str, int]] = [("", MAYBE)]
    opened: dict[str, int] = {}

    def flush() -> None:
        if words:
            text = SPACE.sub(" ", unescape("".join(words))).strip()
            words.clear()
            if text:
                out.append((text, stack[-1][1]))

    def close(at: int) -> None:
        while len(stack) > at:
            if stack[-1][0] in BLOCKS or stack[-1][1] != stack[-2][1]:
                flush()
            opened[stack.pop()[0]] -= 1

    def find(names, stop=()) -> int:
        if not any(opened.get(n) for n in names):
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                return 0
        return 0

    place = 0
    while True:
        m = PIECE.search(html, place)
        if m is None:
            words.append(html[place:])
            break
        words.append(html[place : m.start()])
        place = m.end()
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        if m.group("end"):
            at = find((name,), () if name in MAIN or name in DROPPED else ("table", "article", "main"))
            if at:
                close(at)
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, place)
            flush_here = name in BLOCKS
            if flush_here:
                flush()
            place = end.end() if end else (len(html) if name in ("script", "style") else place)
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES_P:
                at = find(("p",), ("button", "table", "td", "th", "article", "main"))
                if at:
                    close(at)
            if name in SIBLINGS:
                at = find((name, "dt", "dd") if name in ("dt", "dd") else (name, "td", "th") if name in ("td", "th") else (name,), SIBLINGS[name])
                if at:
                    close(at)
        rest = m.group("rest")
        if name in VOID or rest.endswith("/") and name not in BLOCKS:
            continue
        kind = stack[-1][1]
        inside = kind == OWN
        if kind != NONE:
            if name in DROPPED or (name == "header" and not inside) or HIDDEN.search(rest):
                kind = NONE
            elif name in MAIN:
                kind = NONE if _named(rest, REMARK) else OWN
            elif rest and name not in ("body", "html") and not (inside and name in HEADINGS) and _named(rest, NAMED, IDS.get(name, _no_id) if inside else None):
                kind = NONE
        if kind != stack[-1][1]:
            flush()
        stack.append((name, kind))
        opened[name] = opened.get(name, 0) + 1
    close(1)
    flush()
    return out


def common(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, by rows of bits."""
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    ends = [*range(first), *range(len(a) - last, len(a))]
    shared = set(a[first : len(a) - last]) & set(b[first : len(b) - last])
    x = [(i, v) for i, v in enumerate(a[first : len(a) - last], first) if v in shared]
    y = [v for v in b[first : len(b) - last] if v in shared]
    masks: dict = {}
    for j, v in enumerate(y):
        masks[v] = masks.get(v, 0) | 1 << j
    return sorted([*ends, *(x[k][0] for k in _matched([v for _, v in x], y))])


def _step(row: int, mask: int, full: int) -> int:
    """One more line of the first sequence. A zero bit of a row says that one more line of the second up to there is matched."""
    u = row & mask
    return ((row + u) | (row - u)) & full


def _masks(y: list) -> dict:
    masks: dict = {}
    for j, v in enumerate(y):
        masks[v] = masks.get(v, 0) | 1 << j
    return masks


def _lengths(x: list, y: list) -> np.ndarray:
    """The length of a longest common subsequence of ``x`` and each beginning of ``y``."""
    masks, full = _masks(y), (1 << len(y)) - 1
    row = full
    for v in x:
        row = _step(row, masks.get(v, 0), full)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _matched(x: list, y: list) -> list[int]:
    """Places in ``x`` of a longest common subsequence with ``y``, in order.

    Up to ``KEPT_BITS`` all rows are kept and walked back; larger ones are cut in halves of ``x``, each with the part of
    ``y`` that suits it best, so that memory grows with the lines and not with their square.
    """
    if not x or not y:
        return []
    if len(x) * len(y) > KEPT_BITS and len(x) > 1:
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return [*_matched(x[:half], y[:cut]), *(half + k for k in _matched(x[half:], y[cut:]))]
    masks, full = _masks(y), (1 << len(y)) - 1
    rows = [full]
    for v in x:
        rows.append(_step(rows[-1], masks.get(v, 0), full))
    found, j = [], len(y)
    zeros = lambda row, j: j - (row & ((1 << j) - 1)).bit_count()
    for k in range(len(x), 0, -1):
        if not j:
            break
        if zeros(rows[k], j) == zeros(rows[k - 1], j):
            continue
        while j and zeros(rows[k], j - 1) == zeros(rows[k], j):
            j -= 1
        found.append(k - 1)
        j -= 1
    return found[::-1]


def _hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _coded(line: str, kind: int) -> int:
    """The line's hash, with the length of what may be main text in its lowest bits."""
    return _hash(line) >> LENGTH_BITS << LENGTH_BITS | (min(len(line), LONGEST) if kind != NONE else 0)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[_coded(t, kind) for t, kind in lines(h)] for h in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(found, pa.list_(pa.int64()))], ["page_id", "html_key", "host", "path", "lines"]
        )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for own, *near in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            gone: set[int] = set()
            for other in near:
                if other:
                    at = common([x >> LENGTH_BITS for x in own], [x >> LENGTH_BITS for x in other])
                    size = lambda page: sum(x & LONGEST for x in page)
                    # A near copy tells nothing of what the site repeats.
                    if size([own[i] for i in at]) < NEAR_COPY * max(size(own), size(other)):
                        gone.update(at)
            found.append(sorted(gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["run", "shared"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each page with their kinds; lines that are no main text keep their place only."""
    for batch in batches:
        held = [lines(h) for h in batch.column(3).to_pylist()]
        texts = [[t if kind != NONE else "" for t, kind in page] for page in held]
        kinds = [[kind for _, kind in page] for page in held]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(texts, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.int8()))], ["page_id", "html_key", "url", "lines", "kinds"]
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for held, kinds, shared in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            gone = set(shared or ())
            texts.append("\n".join(
                t for i, (t, kind) in enumerate(zip(held, kinds, strict=True)) if kind == OWN or (kind == MAYBE and i not in gone)
            ))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def shared_lines(pages: DataFrame) -> DataFrame:
    """(page_id, html_key, shared): places of the lines that a page shares with a nearest page that is no copy of it."""
    rows = pages.select(
        "page_id", F.xxhash64("url", "html").alias("html_key"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).mapInArrow(_hashes, "page_id long, html_key long, host string, path string, lines array<long>")
    order = [F.col(c).asc_nulls_first() for c in ("host", "path", "page_id", "html_key")]
    placed = with_position(rows, order, "place").withColumn("content", F.xxhash64("host", "lines"))
    # Pages of a host that follow each other with equal lines are one run.
    narrow = placed.select("page_id", "html_key", "place", "content")
    last = narrow.select((F.col("place") + 1).alias("place"), F.col("content").alias("last"))
    fresh = narrow.join(last, "place", "left").withColumn("fresh", F.coalesce(F.col("content") != F.col("last"), F.lit(True)).cast("int"))
    runs = with_position(fresh.drop("last", "content"), [F.col("place")], "run", "fresh").withColumn("run", F.col("run") + F.col("fresh"))
    firsts = runs.filter("fresh = 1").select("run", "place")
    heads = firsts.join(placed.select("place", "host", "lines"), "place").select("run", "host", "lines")
    step = lambda by, name: heads.select(
        (F.col("run") + by).alias("run"), F.col("host").alias("near_host"), F.col("lines").alias(name)
    )
    both = heads
    for by, name in ((1, "before"), (-1, "after")):
        both = both.join(step(by, name), "run", "left").withColumn(name, F.when(F.col("near_host") == F.col("host"), F.col(name))).drop("near_host")
    found = both.select("run", "lines", "before", "after").mapInArrow(_shared, "run long, shared array<int>")
    return runs.select("page_id", "html_key", "run").join(found, "run").select("page_id", "html_key", "shared")


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of ``pages``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = frozen(shared_lines(pages))
    # Rows that agree in everything have the same lines and meet each other.
    found = found.groupBy("page_id", "html_key").agg(F.max("shared").alias("shared"), (F.count("*") > 1).alias("twice"))
    # Lines travel to their shared places, not the markup around them.
    rows = pages.select("page_id", F.xxhash64("url", "html").alias("html_key"), "url", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        _cut, "page_id long, html_key long, url string, lines array<string>, kinds array<tinyint>"
    )
    same = rows["page_id"].eqNullSafe(found["page_id"]) & (rows["html_key"] == found["html_key"])
    joined = rows.join(found, same, "left").select(
        rows["page_id"], "url", "lines", "kinds", F.when(F.col("twice"), F.sequence(F.lit(0), F.size("lines"))).otherwise(F.col("shared")).alias("shared")
    )
    return joined.mapInArrow(_texts, "page_id long, url string, text string")


def pages_report(pages: DataFrame) -> DataFrame:
    """One row per page with its text."""
    return main_texts(pages).withColumn("n_chars", F.length("text").cast("long"))
