"""Main text of web pages by differencing with the nearest page, and by their structure.

A page is read into lines, one for each block. Every page is paired with the pages of its host that come before and
after it by URL path, past those that have just the same lines; the one whose path has the longer common start is the nearest. The
lines of both are aligned by a longest common subsequence, and lines that they share are the site's, not the
page's, and go. A neighbour that has nearly all of the page's text is a copy of it and says nothing about
it; then the one on the other side decides.

The page's structure bounds what the alignment may do, and drops what it can't see. Menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments go also where they differ from the neighbour's, if an
element, a role or a whole class or id says what they are. Lines of an article (or main) element stay also where they are shared,
for articles quote the same passages and copies of articles are articles; of them the alignment decides those that stand under
a name only part of which tells of something else (`related-work`), and lines at the article's ends that are nothing but
links. Lines under such a name outside of an article go if the page has an article, else the alignment decides.

Pages are paired and aligned by 64-bit hashes of their lines; only where a page loses lines that its structure would have kept
does the outcome meet the page's (compressed) lines again.

Defined results: null or empty html, and pages that are all boilerplate, have an
empty text. Null urls are a host of their own. Every row is a page and gives a row, with equal ids too; of equally near pages the
one before counts, and pages of one path are in the order of their ids. Unclosed and stray tags
are tolerated. An empty table gives an empty one. Further columns, whatever their names, take no part.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Memo, settled, slices, stored, text_slices

# Elements and words by which pages name their parts.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title".split())
BOILERPLATE = frozenset("nav header footer aside form menu dialog button head fieldset".split())
ARTICLE = frozenset("article main".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = BOILERPLATE | ARTICLE | frozenset("body blockquote center details div dl figure html ol section table tbody td tfoot th thead tr ul li span a p".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget comment comments commentlist disqus respond reply replies notice notices cookie cookies consent gdpr alert popup modal overlay share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager toc skip copyright".split()
)

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I | re.S)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
SPLIT = re.compile(r"[^a-z]+")
#: What names never say of an element: the page and the article themselves.
WHOLE = frozenset("html body article main".split())
#: Kinds of lines: named as something else; the article's; not named; under a doubtful name in and outside of an article; nothing but links, in an article.
DROPPED, CONTENT, OPEN, DOUBTED, ASIDE, LINK = range(6)
NOT, PARTLY, WHOLLY = 0, 1, 2


def _named(attributes: str) -> tuple[int, int]:
    """Whether the attributes tell that the element is no part of an article: outside of one, and inside, where a header may be the article's own."""
    outside = inside = NOT
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return WHOLLY, WHOLLY
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return WHOLLY, WHOLLY
        if name == "role" and value.lower() in ROLES:
            return WHOLLY, WHOLLY
        if name in ("class", "id"):
            for token in entities.unescape(value).split():
                words = [w for w in SPLIT.split(CAMEL.sub(" ", token).lower()) if w]
                told = [w for w in words if w in NAMES]
                if told:
                    sure = WHOLLY if len(words) == 1 else PARTLY
                    outside = max(outside, sure)
                    if told != ["header"]:
                        inside = max(inside, sure)
    return outside, inside


_names = Memo(_named, 20_000)


def read_lines(page: str | None) -> list[tuple[str, int]]:
    """The page's lines, each with its kind."""
    page = page or ""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []
    kind, at = OPEN, 0
    links, plain = 0, False  # open links; whether the line has text beside them

    def end_line() -> None:
        nonlocal plain
        if parts:
            line = " ".join(entities.unescape("".join(parts)).split())
            if line:
                lines.append((line, LINK if kind == CONTENT and not plain else kind))
            parts.clear()
        plain = False

    lowered = None
    while True:
        m = TAG.search(page, at)
        # a "<" that opens no tag is text
        if m is None:
            parts.append(page[at:])
            plain = True
            break
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            plain = plain or not links and not text.isspace()
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(entities.escape(m[0][9:-3]))
                plain = True
            continue
        closing, tag, attributes = m[1], m[2].lower(), m[3]
        if tag in RAW and not closing:
            if attributes.endswith("/"):
                continue
            lowered = page.lower() if lowered is None else lowered
            stop = re.compile(rf"</{tag}\s*>").search(lowered if len(lowered) == len(page) else page, at)
            at = stop.end() if stop else len(page)
            continue
        if tag in BLOCK:
            end_line()
        if tag in VOID or tag not in CONTAINER and tag not in HEADINGS:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    end_line()
                    kind = stack[depth][1]
                    del stack[depth:]
                    links = links and sum(t == "a" for t, _ in stack)
                    break
            continue
        if attributes.endswith("/") and tag not in BLOCK:
            continue
        if tag in ("p", "li") and stack and stack[-1][0] == tag:  # its end is left out
            kind = stack.pop()[1]
        stack.append((tag, kind))
        links += tag == "a"
        inside = any(t in ARTICLE for t, _ in stack[:-1])
        before = kind
        if kind != DROPPED:
            named = _names[attributes][inside] if attributes and tag not in WHOLE else NOT
            if named == WHOLLY:
                kind = DROPPED
            elif tag in BOILERPLATE:
                # an article's own header holds its title
                kind = kind if tag == "header" and inside and kind in (CONTENT, DOUBTED) else DROPPED
            elif tag in ARTICLE:
                kind = CONTENT
            elif named == PARTLY:
                kind = DOUBTED if inside else ASIDE
        if kind != before and tag not in BLOCK:
            now, kind = kind, before
            end_line()
            kind = now
    end_line()
    return lines


def shared_lines(a: list, b: list) -> set[int]:
    """Places in a of a longest common subsequence of both."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    found = {*range(start), *range(len(a) - end, len(a))}
    where: dict[str, list[int]] = {}
    for j in range(start, len(b) - end):
        where.setdefault(b[j], []).append(j)
    # the longest ascending run of places in b, by the least last place of each length
    last: list[int] = []
    nodes: list[tuple[int, tuple | None]] = []
    for i in range(start, len(a) - end):
        for j in reversed(where.get(a[i], ())):
            k = bisect_left(last, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(last):
                last.append(j)
                nodes.append(node)
            else:
                last[k], nodes[k] = j, node
    node = nodes[-1] if nodes else None
    while node:
        found.add(node[0])
        node = node[1]
    return found


def kept_by_name(kinds: list[int]) -> list[int]:
    """Places of the lines that the page's own structure leaves."""
    whole = CONTENT in kinds
    return [i for i, k in enumerate(kinds) if k != DROPPED and not (k == ASIDE and whole)]


def decide(lines: list, sizes: list[int], kinds: list[int], neighbours: Iterable[list], copy: float = 0.8) -> tuple[set[int], list[int]]:
    """Places of the lines that are shared with the nearest page that is no copy, and of those of them that the structure would have kept and that go."""
    here = kept_by_name(kinds)
    total = sum(sizes[i] for i in here)
    common: set[int] = set()
    for other in neighbours:
        found = shared_lines(lines, other)
        if sum(sizes[i] for i in here if i in found) < copy * total or not total:
            common = found
            break
    # links go at the article's ends only
    article = [i for i in here if kinds[i] in (CONTENT, DOUBTED, LINK)]
    ends: set[int] = set()
    for order in (article, article[::-1]):
        for i in order:
            if kinds[i] == CONTENT or i not in common:
                break
            ends.add(i)
    return common, [i for i in here if i in common and (kinds[i] in (OPEN, DOUBTED, ASIDE) or kinds[i] == LINK and i in ends)]


def parse(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, host, path, hashes, sizes, kinds (of the lines), packed (the lines, compressed)."""
    url = F.coalesce(pages[url_column].cast("string"), F.lit(""))
    host, path = F.lower(F.regexp_extract(url, SITE, 1)), F.when(url.rlike(SITE), F.regexp_extract(url, SITE, 2)).otherwise(F.regexp_extract(url, "^([^?#]*)", 1))
    kept = pages.select(pages[id_column].alias("page_id"), pages[url_column].cast("string").alias("url"), host.alias("host"), path.alias("path"), pages[html_column].cast("string").alias("html"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as digest

        for batch in text_slices(batches, "html"):
            found = [read_lines(x) for x in batch.column(4).to_pylist()]
            hashes = [[digest(x[0]) - (1 << 63) for x in f] for f in found]
            sizes, kinds = [[len(x[0]) for x in f] for f in found], [[x[1] for x in f] for f in found]
            packed = [zlib.compress("\n".join([x[0] for x in f]).encode(), 1) for f in found]
            more = [pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(kinds, pa.list_(pa.int8())), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *more], names=["page_id", "url", "host", "path", "hashes", "sizes", "kinds", "packed"])

    return kept.mapInArrow(run, f"page_id {kept.schema['page_id'].dataType.simpleString()}, url string, host string, path string, hashes array<long>, sizes array<int>, kinds array<tinyint>, packed binary")


#: Scheme, host and path of a URL.
SITE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"


def _different(ranged: DataFrame, order: list[str], backward: bool) -> DataFrame:
    """row, other: the last place before a row's (after it, if backward) whose page has other lines. ranged: range, row, order and digest, dealt into ranges by order.

    Runs of equal pages are passed by a carried value; of each range, only the last page and the one before its run are told to the other ranges."""
    turn = (lambda c: F.desc(c)) if backward else (lambda c: F.asc(c))
    place = F.struct("row", "host", "path", "digest")

    def carried(rows: DataFrame, within: list[str], sort: list) -> DataFrame:
        """rows with before (the row before) and other."""
        window = Window.partitionBy(*within).orderBy(*sort)
        rows = rows.withColumn("before", F.lag("place").over(window))
        starts = F.col("before").isNotNull() & (F.col("before.digest") != F.col("place.digest"))
        return rows.withColumn("other", F.last(F.when(starts, F.col("before")), ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)))

    rows = carried(ranged.select("range", *order, place.alias("place")), ["range"], [turn(c) for c in order])
    key = F.struct(*order)
    last = (F.min_by if backward else F.max_by)(F.struct("place", "other"), key)
    ends = rows.groupBy("range").agg(last.alias("x")).select("range", F.explode(F.array(F.struct(F.lit(0).alias("n"), F.col("x.other").alias("place")), F.struct(F.lit(1).alias("n"), F.col("x.place").alias("place")))).alias("e")).select("range", "e.n", "e.place").where("place is not null")
    # two rows a range: the same over the ranges' ends
    ends = carried(ends.withColumn("all", F.lit(0)), ["all"], [turn("range"), F.asc("n")])
    across = Window.partitionBy("all").orderBy(turn("range"))
    told = ends.groupBy("all", "range").agg(F.max_by(F.struct("place", "other"), "n").alias("x")).withColumn("told", F.lag("x").over(across)).select("range", F.col("told.place").alias("near"), F.col("told.other").alias("far"))
    joined = rows.join(F.broadcast(told), "range", "left")
    outside = F.when(F.col("near.digest") != F.col("place.digest"), F.col("near")).otherwise(F.col("far"))
    # within a range's first run nothing was carried
    return joined.select(F.col("place.row").alias("row"), F.coalesce("other", outside).alias("other"))


def nearest(places: DataFrame) -> DataFrame:
    """places: row (distinct), page_id, host, path, digest. row, near: the rows before and after it in the order of its host's paths that have another digest, the one whose path has the longer common start first.

    Pages are dealt into ranges of host and path, so that a large host is as many tasks as its size asks for."""
    order = ["host", "path", "page_id", "row"]
    ranged = settled(places.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = _different(ranged, order, False).withColumnRenamed("other", "prev")
    after = _different(ranged, order, True).withColumnRenamed("other", "next")
    seen = ranged.select("row", "host", "path").join(before, "row").join(after, "row")

    def common(other: str):
        """Length of the common start of both paths, -1 for a page of another host or none."""
        theirs = F.col(f"{other}.path")
        most = F.least(F.length("path"), F.length(theirs))
        differ = F.filter(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), lambda i: F.substring("path", i, F.lit(1)) != F.substring(theirs, i, F.lit(1)))
        return F.when(F.col(f"{other}.host") == F.col("host"), F.when(most == 0, 0).otherwise(F.coalesce(F.try_element_at(differ, F.lit(1)) - 1, most))).otherwise(-1)

    prev, next_ = F.when(common("prev") >= 0, F.col("prev.row")), F.when(common("next") >= 0, F.col("next.row"))
    pair = F.when(common("next") > common("prev"), F.array(next_, prev)).otherwise(F.array(prev, next_))
    return seen.select("row", F.filter(pair, lambda x: x.isNotNull()).alias("near"))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text (the article's lines), n_chars, n_shared (lines that the alignment found to be the site's)."""
    read = stored(parse(pages, id_column, url_column, html_column).withColumn("row", F.monotonically_increasing_id()))
    profile = read.select("row", "hashes", "sizes", "kinds")
    near = nearest(read.select("row", "page_id", "host", "path", F.xxhash64("hashes").alias("digest"))).select("row", F.posexplode("near").alias("turn", "of"))
    theirs = near.join(read.select(F.col("row").alias("of"), F.col("hashes").alias("lines")), "of").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("turn", "lines"))).alias("t"))

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            found = [decide(*x) for x in zip(*(batch.column(i).to_pylist() for i in range(1, 5)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(f[0]) for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32()))], names=["row", "n_shared", "gone"])

    told = profile.join(theirs, "row").select("row", "hashes", "sizes", "kinds", F.col("t.lines").alias("theirs")).mapInArrow(align, "row long, n_shared long, gone array<int>")
    told = stored(told.where("n_shared > 0"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            texts = []
            for kinds, packed, gone in zip(*(batch.column(i).to_pylist() for i in (2, 3, 5))):
                lines, gone = zlib.decompress(packed).decode().split("\n"), set(gone or ())
                texts.append("\n".join([lines[i] for i in kept_by_name(kinds) if i not in gone]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(4)], names=["page_id", "url", "text", "n_chars", "n_shared"])

    kind = read.schema["page_id"].dataType.simpleString()
    joined = read.select("row", "page_id", "url", "kinds", "packed").join(told, "row", "left").select("page_id", "url", "kinds", "packed", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"), "gone")
    return joined.mapInArrow(write, f"page_id {kind}, url string, text string, n_chars long, n_shared long")
