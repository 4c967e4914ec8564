"""Main text of web pages by template deduction with token equivalence classes.

Tokens of a page are its elements (by path), words (by path and word) and whole blocks (by path and text). Over the pages of a host, tokens with the same
occurrence vector (the same count on every page) form an equivalence class; the vectors are compared through sums of
hashes of (page, count), so a host's pages need not meet in one task; equal pages count once, and neither depends on the
partitions. A class is valid if it covers nearly all
pages of the host; the elements of valid classes nest by their paths and make up the host's template. What the template
does not fix are slots. The slots below a page's article and main elements (or, without one, the template's richest text
region) are the main text; elsewhere, and within it, navigation, notices, adverts, forms and comments are left out.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.llm.tables import saved
from sievelight.llm.url_filter import host_and_path

#: A class is valid from this share of the host's pages on, and from so many pages.
SUPPORT, LEAST_PAGES = 0.9, 5
#: A task with this many pages of a host reports only tokens that half of them have. What other tasks report of the others
#: bounds their count; those that could still be in a valid class are counted again, without this limit.
LOCAL_PAGES = 8

# How elements are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split())
#: An opening element of the first kind ends an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LEFT_OUT = frozenset("nav header footer aside form menu dialog button select head object canvas audio video".split()) | RAW
MAIN = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMES = (r"(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|sidebar|menu|nav\w*|navigation|breadcrumbs?|footer|header|notices?|cookies?|"
          r"consent|newsletter|subscribe|comments?|disqus|respond)")
_COMMENTS = r"(?:comments?|comment-?list|comments-area|disqus(?:_thread)?|respond)"
#: Outside an article a part of a class, id or role is enough. Inside only a whole class or role leaves an element out; a part of
#: one makes its text doubtful: the template's words or links in more than half of it have to confirm. Headings have no such names.
LEFT_OUT_NAMES = re.compile(rf"(?:^|[\s_-]){_NAMES}(?:$|[\s_-])", re.I)
WHOLE_NAMES = re.compile(rf"(?:^|\s){_NAMES}(?:$|\s)", re.I)
#: Reader comments, also by a whole id, and also on an article of their own.
COMMENT_NAMES = re.compile(rf"(?:^|\s){_COMMENTS}(?:$|\s)", re.I)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"[\s ]+")


@dataclass
class Block:
    """A run of text in one block element: its path, whether it is left out or doubtful, its text, and the length of its link text."""

    path: str
    left_out: bool
    doubtful: bool
    text: list[str] = field(default_factory=list)
    links: int = 0


def blocks_of(page: str) -> tuple[list[Block], Counter]:
    """Blocks with text in page order, and the number of elements per path."""
    out: list[Block] = []
    paths: Counter = Counter()
    stack: list[tuple[str, str, bool, bool, bool]] = [("", "", False, False, False)]  # tag, path, left out, doubtful, in an article
    now: Block | None = None
    link, at = 0, 0

    def add(raw: str) -> None:
        nonlocal now
        text = entities.unescape(raw) if "&" in raw else raw
        if now is None:
            if not text.strip():
                return
            now = Block(*stack[-1][1:4])
            out.append(now)
        now.text.append(text)
        if link:
            now.links += len(text)

    while m := _TAG.search(page, at):
        closing, tag = m.group(1), (m.group(2) or "").lower()
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if not tag:
            continue
        if closing:
            if tag in BLOCKS:
                now = None
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    link -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag == "br":
            if now is not None:
                now.text.append(" ")
            continue
        if tag in BLOCKS:
            now = None
            ends = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends:
                    link -= sum(s[0] == "a" for s in stack[i:])
                    del stack[i:]
                    break
                if stack[i][0] in BLOCKS:
                    break
        inside, rest = stack[-1], m.group(3)
        attributes = {a.group(1).lower(): a.group(2) or a.group(3) or a.group(4) or "" for a in _NAME.finditer(rest)} if rest else {}
        name = tag + "".join("." + c for c in sorted(attributes["class"].split())) if "class" in attributes else tag
        path = f"{inside[1]}/{name}" if tag in BLOCKS else inside[1]
        named = " ".join(attributes.values())
        # An article's own header and footer stay menus and by-lines: they are left out like the page's.
        left_out, doubtful, article = inside[2] or tag in LEFT_OUT, inside[3], inside[4] or tag in MAIN
        if named and tag not in ("html", "body", *HEADINGS) and any(COMMENT_NAMES.search(v) for v in attributes.values()):
            left_out = True
        elif named and tag not in ("html", "body", *MAIN) and not (article and tag in HEADINGS) and LEFT_OUT_NAMES.search(named):
            if article and not WHOLE_NAMES.search(f"{attributes.get('class', '')} {attributes.get('role', '')}"):
                doubtful = True
            else:
                left_out = True
        if tag in BLOCKS:
            paths[path] += 1
        if tag in RAW and not m.group(3).endswith("/"):
            # What stands inside is no markup: only the element's own end tag ends it, or the page's end.
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m.group(3).endswith("/"):
            stack.append((tag, path, left_out, doubtful, article))
            link += tag == "a"
    if at < len(page):
        add(page[at:])
    for b in out:
        b.text = " ".join("".join(b.text).split())
    return [b for b in out if b.text], paths


def _hash(*parts) -> int:
    data = "\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return (zlib.crc32(data) << 31) ^ zlib.adler32(data)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, vector, pages, seen, chars) sums over the task's pages, which are distinct; of a third column's tokens, if there is one.

    ``seen`` counts the host's pages in the task if the task leaves out tokens, else 0.
    """
    sums: dict[str, dict[str, dict[str, list[int]]]] = {}  # host, path, word ("" for the element)
    pages: Counter = Counter()
    rich: dict[str, Counter] = {}
    wanted: dict[str, frozenset[str]] | None = None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        if len(columns) > 2:
            wanted = wanted or {}
            for host, tokens in zip(columns[0], columns[2]):
                if host not in wanted:
                    wanted[host] = frozenset(tokens)
        for host, html in zip(*columns[:2]):
            page = _hash(html)
            pages[host] += 1
            found, paths = blocks_of(html)
            own = sums.setdefault(host, {})
            texts: dict[str, list[str]] = {}
            for b in found:
                if not b.left_out:
                    texts.setdefault(b.path, []).append(b.text)
                    rich.setdefault(host, Counter())[b.path] += len(b.text) - 2 * b.links
            mark: dict[int, int] = {}  # hash of (page, count)
            for path, n in paths.items():
                counts = Counter(" ".join(texts[path]).split(" ")) if path in texts else {}
                for text in texts.get(path, ()):
                    counts[_whole(text)] = counts.get(_whole(text), 0) + 1
                counts[""] = n
                words = own.setdefault(path, {})
                for word, c in counts.items():
                    if wanted is not None and _token(path, word) not in wanted[host]:
                        continue
                    if c not in mark:
                        mark[c] = _hash(page, c)
                    if word in words:
                        s = words[word]
                        s[0] += mark[c]
                        s[1] += 1
                    else:
                        words[word] = [mark[c], 1]
    rows: list[tuple] = []
    for host, own in sums.items():
        all_of_them = wanted is not None or pages[host] < LOCAL_PAGES
        seen = 0 if all_of_them else pages[host]
        rows.append((host, "", 0, pages[host], seen, 0))
        for path, words in own.items():
            chars = rich.get(host, {}).get(path, 0)
            rows += [(host, _token(path, w), v & 0x7FFFFFFFFFFFFFFF, n, seen, 0 if w else chars)
                     for w, (v, n) in words.items() if all_of_them or 2 * n >= seen]
        if len(rows) > 20_000:
            yield _token_rows(rows)
            rows = []
    if rows:
        yield _token_rows(rows)


def _whole(text: str) -> str:
    """The token of a block's whole text: it repeats even where its words also stand in other text of the path."""
    return f"\x00{_hash(text):x}"


def _token(path: str, word: str) -> str:
    return f"{path}\t{word}" if word else "<" + path


def _token_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "token", "vector", "pages", "seen", "chars"])


def _distinct(pages: DataFrame) -> DataFrame:
    """Equal pages of a host once. Only pages whose hash repeats are compared as a whole."""
    keyed = pages.select("host", "html", F.xxhash64("host", "html").alias("h"))
    repeated = saved(keyed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    return keyed.join(repeated, "h", "left_anti").select("host", "html").unionByName(
        keyed.join(repeated, "h", "left_semi").select("host", "html").distinct())


def _sums(pages: DataFrame) -> DataFrame:
    # Tasks report vectors below 2^63: their sum below 2^63 is the same for all partitions.
    return pages.mapInArrow(_tokens, "host string, token string, vector long, pages long, seen long, chars long").groupBy("host", "token").agg(
        F.pmod(F.sum(F.col("vector").cast("decimal(38,0)")), F.lit(Decimal(1 << 63))).alias("vector"),
        F.sum("pages").alias("pages"), F.sum("seen").alias("seen"), F.sum("chars").alias("chars"))


def deduce(pages: DataFrame) -> DataFrame:
    """``(host, elements, words, region)`` of ``pages(host, html)``: the template of every host.

    ``elements`` are paths and ``words`` path-word tokens of valid classes; ``region`` is the template's article, or the
    element with the most text that is not links. Hosts with fewer than ``LEAST_PAGES`` distinct pages get empty lists.
    """
    pages = _distinct(pages)
    sums = saved(_sums(pages))
    total = sums.where("token = ''").select("host", F.col("pages").alias("total"), F.col("seen").alias("cut"))
    # A task that cut and did not report a token has it on less than half of its pages.
    missing = F.col("cut") - F.col("seen")
    able = sums.where("token <> ''").join(total, "host").where(
        (F.col("total") >= LEAST_PAGES) & (F.col("pages") + missing / 2 >= SUPPORT * F.col("total"))).withColumn("missing", missing)
    tokens = able.where("missing = 0").select("host", "token", "vector", "pages", "chars")
    again = saved(able.where("missing > 0").groupBy("host").agg(F.collect_list("token").alias("tokens")))
    if not again.isEmpty():
        exact = _sums(pages.join(again, "host").select("host", "html", "tokens")).where("token <> ''")
        exact = exact.join(total, "host").where(F.col("pages") >= SUPPORT * F.col("total"))
        tokens = tokens.unionByName(exact.select(*tokens.columns))
    # Classes: tokens with one vector. Those of an element and of a word in it nest by the path.
    classes = tokens.withColumn("size", F.count("*").over(Window.partitionBy("host", "vector")))
    element = F.col("token").startswith("<")
    path = F.substring("token", 2, 1 << 20)
    depth = F.size(F.split(path, "/"))
    is_main = F.regexp_like(path, F.lit(r"/(article|main)(\.[^/]*)?$"))
    return classes.groupBy("host").agg(
        F.collect_list(F.when(element, path)).alias("elements"),
        F.collect_list(F.when(~element & (F.col("size") > 1), F.col("token"))).alias("words"),
        F.coalesce(
            F.min(F.when(element & is_main, F.struct(depth, path.alias("p"))))["p"],
            F.max(F.when(element & (F.col("chars") > 0), F.struct(F.col("chars"), F.regexp_replace(path, "/[^/]*$", "").alias("p"))))["p"]).alias("region"))


def main_text(page: str, region: str | None, words: frozenset[str]) -> str:
    """The main text of a page, given the region of its host's template and the template's words.

    The page's own article and main elements choose the region, together, so that a main body beside an article stays; without
    one the template's region does. In either, blocks that the template fixes go.
    """
    found, paths = blocks_of(page)

    def fixed(b: Block) -> bool:
        return bool(words) and (_token(b.path, _whole(b.text)) in words or all(_token(b.path, w) in words for w in b.text.split(" ")))

    within = lambda b, top: b.path == top or b.path.startswith(top + "/")
    tops = [p for p in paths if re.search(r"/(?:article|main)(?:\.[^/]*)?$", p) and not COMMENT_NAMES.search(p.rsplit("/", 1)[1].replace(".", " "))]
    kept = [b for b in found if not b.left_out]
    if tops:
        kept = [b for b in kept if any(within(b, t) for t in tops)]
        kept = [b for b in kept if not (b.doubtful and 2 * b.links > len(b.text))]
    elif region and any(within(b, region) for b in found):
        kept = [b for b in kept if within(b, region)]
    return "\n\n".join(b.text for b in kept if not fixed(b))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, frozenset[str]] = {}
    for batch in batches:
        texts = []
        for host, html, region, words in zip(*(batch.column(i).to_pylist() for i in range(1, 5))):
            if host not in known:
                if len(known) > 1000:
                    known.clear()
                known[host] = frozenset(words or ())
            texts.append(main_text(html, region, known[host]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``(row, text)`` of every row of ``pages``: the main text, empty if there is none.

    ``row`` is a struct of the columns ``keep`` (all but the html by default). A null html is empty; a null url or one without
    a host counts as one host; repeated pages count once for the template and get equal texts. Character
    references are decoded, white space inside a block is one space, blocks are joined by an empty line. Blocks that the host's
    template fixes are left out everywhere; hosts of few pages have no template and keep all text that tags or names do not leave out.
    An empty table gives an empty result.
    """
    others = keep if keep is not None else [c for c in pages.columns if c != html_col]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), host_and_path(F.col(url_col))[0].alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    # One row per host, far smaller than the pages; written, so that the join knows its size and can split a large host.
    template = saved(deduce(rows.select("host", "html")).select("host", "region", "words"))
    joined = rows.join(template, "host", "left").select("row", "host", "html", "region", "words")
    return joined.mapInArrow(_extract, f"row {rows.schema['row'].dataType.simpleString()}, text string")
