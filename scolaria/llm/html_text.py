"""Main text of web pages: markup says what is article or not; where it says nothing, repeats across a host's pages do."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scolaria.llm.shared import row_key, written

#: Tokens of a repeat, and pages with it. A whole block is a repeat at any length, if more pages have it.
MIN_REPEAT, MIN_PAGES, MIN_PAGES_OF_BLOCK = 10, 2, 3
EDGE = "\n"  # the token between blocks

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attributes>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*+\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: What these hold is no markup; it ends at their own end tag only.
RAW = {tag: re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var math mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mtable mtr mtd semantics".split())
DROPPED = frozenset("head nav header footer aside form button select option dialog menu object audio video canvas annotation annotation-xml".split())
#: Of these, what frames a page. Asides and elements dropped for their names hold teasers, quotes and comments too.
FRAME = frozenset("nav header footer form menu".split())
FRAME_ROLES = frozenset("navigation banner contentinfo search form menu menubar toolbar".split())
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus respond replies reply "
    "share sharing social related pagination pager toolbar search copyright disclaimer widget".split()
)
#: Names that tell of a state of the page, not of what the element is.
STATE = re.compile(r"(?:^|[^a-z0-9])(?:no|has|with|without|left|right)[^a-z0-9]")
#: In an article only these elements go by their names: by a whole one, or with an ending that says no more.
CONTAINERS = frozenset("div section ul ol dl table figure details".split())
ENDINGS = frozenset("area bar block box buttons container form icons links list section wrapper".split())
GONE = ("drop", "frame", "named")
DROPPED_IDS = frozenset("comments disqus respond replies newsletter".split())


def _furniture(tag: str, found: dict[str, str], in_main: bool) -> bool:
    names = lambda value: [part for part in re.split(r"[^a-z0-9]+", value) if part]
    classes = [value for value in found.get("class", "").split() if not STATE.search(value)]
    if not in_main:
        return any(part in DROPPED_NAMES for value in (*classes, *found.get("id", "").split()) if not STATE.search(value) for part in names(value))
    whole = lambda value: (parts := names(value)) and parts[0] in DROPPED_NAMES and all(part in DROPPED_NAMES | ENDINGS for part in parts)
    return tag in CONTAINERS and (found.get("id") in DROPPED_IDS or any(map(whole, classes)))


def _kind(tag: str, attributes: str, in_main: bool) -> str:
    """drop, frame (dropped as the page's frame), named (dropped for its class or id), main or nothing: what an element says
    of what it holds."""
    if tag in DROPPED and not (tag == "header" and in_main):
        return "frame" if tag in FRAME else "drop"
    found = {}
    if attributes.strip():
        for name, *values in ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), next(filter(None, values), "").lower())
    if tag in MAIN or found.get("role") in ("main", "article") or found.get("itemprop") == "articlebody":
        return "main"
    if tag in ("body", "html"):
        return ""
    if found.get("role") in DROPPED_ROLES or "hidden" in found:
        return "frame" if found.get("role") in FRAME_ROLES and "hidden" not in found else "drop"
    return "named" if _furniture(tag, found, in_main) else ""


def blocks_of(page: str | None) -> tuple[list[str], list[str]]:
    """Blocks of the article, and blocks that no markup calls article or anything else: all_blocks without the frame."""
    return all_blocks(page)[:2]


def all_blocks(page: str | None) -> tuple[list[str], list[str], list[str]]:
    """Blocks of the article, blocks that no markup calls article or anything else, and those of the page's frame: menus,
    headers, footers and forms outside articles. Empty blocks are left out.

    An element dropped for its class or id only stays if the page would else have no article and it holds one.
    """
    article, loose, frame, around = _read(page, frozenset())
    while not article and around:
        article, loose, frame, more = _read(page, around)
        if more <= around:
            break
        around |= more
    return article, loose, frame


def _read(page: str | None, kept: frozenset[int]) -> tuple[list[str], list[str], list[str], frozenset[int]]:
    """all_blocks, and the places of named elements around an article. Those at the places kept stay."""
    page = page or ""
    stack: list[tuple[str, str, int]] = []
    still_open: Counter[str] = Counter()  # of each tag, so that an end tag without a start needs no search
    around: set[int] = set()
    dropped = frames = main = 0  # open elements; dropped ones include frames
    article: list[str] = []
    loose: list[str] = []
    frame: list[str] = []
    pieces: list[str] = []
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                (frame if dropped else article if main else loose).append(text)
            pieces.clear()

    def pop_to(depth: int) -> None:
        nonlocal dropped, frames, main
        flush()
        for name, kind, _ in stack[depth:]:
            still_open[name] -= 1
            dropped -= kind in GONE
            frames -= kind == "frame"
            main -= kind == "main"
        del stack[depth:]

    while at < len(page):
        token = TOKEN.search(page, at)
        end = token.start() if token else len(page)
        if end > at and (not dropped or frames == dropped and not main):
            pieces.append(page[at:end])
        if not token:
            break
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["close"]:
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag) if still_open[tag] else None
            if depth is not None:
                pop_to(depth)
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW:
            closing = RAW[tag].search(page, at)
            at = closing.end() if closing else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and pieces:
                pieces.append(" ")
            continue
        attributes = token["attributes"]
        if tag in INLINE:
            if attributes.strip() and _kind(tag, attributes, main > 0) in GONE:
                flush()
                stack.append((tag, "drop", token.start()))
                still_open[tag] += 1
                dropped += 1
            continue
        if tag == "body":
            pop_to(0)
        elif stack and stack[-1][0] == "p" or stack and stack[-1][0] == tag == "li":
            pop_to(len(stack) - 1)
        flush()
        kind = _kind(tag, attributes, main > 0)
        if kind == "named" and token.start() in kept:
            kind = ""
        if kind == "main" and not any(k in ("drop", "frame") for _, k, _ in stack):
            around |= {place for _, k, place in stack if k == "named"}
        if not attributes.rstrip().endswith("/"):
            stack.append((tag, kind, token.start()))
            still_open[tag] += 1
            dropped += kind in GONE
            frames += kind == "frame"
            main += kind == "main"
    flush()
    return article, loose, frame, frozenset(around)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def parsed(page: Column) -> Column:
    """text, decided, loose and frame of a page: the article's blocks, whether there are any, and the blocks beside them."""

    @F.pandas_udf("struct<text:string,decided:boolean,loose:array<string>,frame:array<string>>")
    def all_of(pages: pd.Series) -> pd.DataFrame:
        read = [all_blocks(page) for page in pages]
        texts = ["\n".join(article) for article, _, _ in read]
        return pd.DataFrame({"text": texts, "decided": [bool(article) for article, _, _ in read], "loose": [loose for _, loose, _ in read], "frame": [frame for *_, frame in read]})

    return all_of(page)


def unique_runs(blocks: Sequence[str], repeats: Sequence[tuple[int, int]]) -> str:
    """The blocks without the words that repeats (place, length) cover in their token stream; a block of none left goes."""
    covered = {place + k for place, length in repeats for k in range(length)}
    place, kept = 0, []
    for block in blocks:
        words = block.split(" ")
        left = [word for k, word in enumerate(words, place + 1) if k not in covered]
        place += len(words) + 1
        if left:
            kept.append(" ".join(left))
    return "\n".join(kept)


def token_stream(blocks: str) -> Column:
    """The words of the blocks, with an EDGE before, between and after them."""
    edge = F.array(F.lit(EDGE))
    return F.concat(edge, F.flatten(F.transform(blocks, lambda block: F.concat(F.split(block, " "), edge))))


def suffix_array(loose: DataFrame, depth: int, *more: str) -> DataFrame:
    """host, row, place, suffix, at and lcp: the sorted suffixes of the token streams of every host's pages.

    loose has row, host, loose (blocks), and more columns that its suffixes keep. A suffix is a place in a page's stream with the depth tokens from there on; at
    numbers them in the order of hosts and suffixes, and lcp counts the tokens a suffix shares with the one before it on
    its host. The suffixes are sorted by ranges, equal ones by page and place,
    so neither a large host nor a common phrase lies in one task; the neighbour of a range's first suffix is the last one
    of the range before, of which there is one row for each range.
    """
    streams = loose.select("row", "host", *more, token_stream("loose").alias("tokens"))
    every = F.transform(F.sequence(F.lit(1), F.size("tokens") - 1), lambda i: F.slice("tokens", i, depth))
    order = ["host", "suffix", "row", "place"]
    suffixes = streams.select("row", "host", *more, F.posexplode_outer(every).alias("place", "suffix"))
    in_order = written(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    in_order = in_order.withColumn("part", F.shiftright("at", 33))
    here = F.struct("host", "suffix")
    lasts = in_order.groupBy("part").agg(F.max_by(here, "at").alias("last"))
    edges = lasts.select("part", F.lag("last").over(Window.orderBy("part")).alias("edge"))
    before = F.coalesce(F.lag(here).over(Window.partitionBy("part").orderBy("at")), "edge")
    met = in_order.join(F.broadcast(edges), "part").withColumn("before", before)
    same = F.zip_with("before.suffix", "suffix", lambda a, b: a.eqNullSafe(b))
    shared = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size("suffix")).cast("int")
    lcp = F.when(F.col("before.host") == F.col("host"), shared).otherwise(0)
    return met.select("host", "row", "place", *more, "suffix", "at", "part", lcp.alias("lcp"))


def repeats_of(array: DataFrame, min_repeat: int = MIN_REPEAT, min_pages: int = MIN_PAGES, min_pages_of_block: int = MIN_PAGES_OF_BLOCK) -> DataFrame:
    """row, repeats (place, length): where pages have what other contents of their host have too.

    array is that of main_text. Of the frames of other pages only rows of short blocks tell, like the links of a menu: with
    two whole blocks in a head. A heading may be the name of one link, and a footer may quote a sentence of an article.

    A suffix's head is its first min_repeat tokens, or the whole block that it starts with, if that is shorter. Suffixes
    of one head are neighbours, each of which shares its head with the one before; a run of them with min_pages contents
    or more (a short block's: min_pages_of_block) is a repeat. A longer repeat is a row of such heads. Runs are numbered
    by their first suffix and counted with a partial aggregation, so a run over many ranges is never in one task.
    """
    closed = F.array_position(F.slice("suffix", 2, min_repeat - 1), EDGE).cast("int") + 1
    head = F.when((F.get("suffix", F.lit(0)) == EDGE) & (closed > 1), closed).when(F.size("suffix") >= min_repeat, F.lit(min_repeat))
    heads = array.withColumn("head", head).where(F.col("head").isNotNull())
    # Suffixes without a head lie between others only as the ends of streams, which share less than a head with both.
    begun = heads.withColumn("begins", F.when(F.col("lcp") < F.col("head"), F.col("at")))
    parts = begun.groupBy("part").agg(F.max("begins").alias("latest"))
    carried = parts.select("part", F.last("latest", True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    earlier = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.coalesce(F.max("begins").over(earlier), "carried")
    in_rows = (F.col("head") >= min_repeat) & (F.size(F.filter(F.slice("suffix", 1, F.col("head")), lambda token: token == EDGE)) >= 3)
    numbered = begun.join(F.broadcast(carried), "part").withColumn("run", run)
    runs = written(numbered.where(~F.col("framed") | in_rows).select("row", "place", "content", "framed", "head", "run"))
    pages = runs.groupBy("run").agg(F.min("head").alias("length"), F.count_distinct("content").alias("pages"))
    found = written(pages.where(F.col("pages") >= F.when(F.col("length") < min_repeat, min_pages_of_block).otherwise(min_pages)).select("run"))
    return runs.where(~F.col("framed")).join(found, "run").groupBy("row").agg(F.collect_set(F.struct("place", F.col("head").alias("length"))).alias("repeats"))


def main_text(pages: DataFrame, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html).

    Blocks inside an article or main element are the text, without the menus, headers, footers, asides, forms, adverts,
    notices and comments that lie in it; nothing else in it is dropped, whether it repeats or not. A page without such
    an element gives its other blocks, less those marked as page furniture and less what the suffix array of its host
    shows to stand on other pages too (repeats_of); its unique runs stay. The array holds the blocks outside articles of
    all pages of all hosts, those of menus, headers, footers and forms included: a menu that one page marks, another may
    leave unmarked. A page's content is its blocks outside article and frame, so copies of a page are one content.

    A null or empty page gives an empty text; a page cut off in the middle is read as far as it goes; a url without a
    host, or null, belongs to the host "". Pages of the same blocks are one page to each other; a very long page is a
    stream like others. Repeated rows give their text each; an empty table gives an empty table. Other columns are left out.
    """

    @F.pandas_udf("string")
    def runs(blocks: pd.Series, repeats: pd.Series) -> pd.Series:
        places = [[] if r is None else [(one["place"], one["length"]) for one in r] for r in repeats]
        return pd.Series([unique_runs(b, r) for b, r in zip(blocks, places)], dtype=object)

    rows = pages.select("page_id", "url", row_key(F.col("page_id"), F.col("html")).alias("row"), host_of(F.col("url")).alias("host"), parsed(F.coalesce("html", F.lit(""))).alias("parsed"))
    rows = written(rows.select("page_id", "url", "row", "host", "parsed.*"))
    open_pages = (~F.col("decided")) & (F.size("loose") > 0)
    content = F.md5(F.array_join("loose", "\n")).alias("content")
    loose = rows.select("row", "host", "loose", content, F.lit(False).alias("framed")).dropDuplicates(["host", "row"])
    frames = rows.select(F.lit(None).cast("binary").alias("row"), "host", F.col("frame").alias("loose"), content, F.lit(True).alias("framed")).distinct()
    evidence = loose.unionByName(frames).where(F.size("loose") > 0)
    covered = repeats_of(suffix_array(evidence, 2 * min_repeat, "content", "framed"), min_repeat)
    found = rows.where(open_pages).join(covered, "row", "left").select("page_id", "url", runs("loose", "repeats").alias("text"))
    text = rows.where(~open_pages).select("page_id", "url", "text").unionByName(found)
    return text.withColumn("n_chars", F.length("text").cast("long"))
