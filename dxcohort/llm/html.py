"""Main text of web pages: site templates removed by counting subtrees.

Each page is parsed once into text blocks. Every block carries the hashes of
the elements around it that may be template parts: a hash covers an element's
name, its text and the hashes of its children. Spark counts, for each host, on
how many different pages (by their own blocks) a hash occurs; subtrees on at least
``MIN_PAGES`` pages, and the logarithm of the host's pages, are template and their
blocks are deleted, wherever on the page they stand (``n_template`` of them). The
bound hardly grows with the host, so parts of one section and rotating parts of a
large host are found. Containers are counted (div, section, list, nav, ...), never
a heading, paragraph, list item, quote or table by itself; inside an article only
those that hold no such element and little text: pages that share a heading, a
closing phrase or a quoted section are no template of it.

To the blocks that are left, rules apply that need no other page, so that a host
with few pages, or with parts that change on each page, is cleaned too: menus, page headers and footers, sidebars, forms, scripts, styles,
hidden parts, and elements whose class, id or role names them an advert, notice,
comment and the like. If a page marks its article (``article``, else ``main``), only that is
read.

Character references are decoded, white space inside a block is one space, blocks
are joined by an empty line. A null, empty or textless page has the text '' and
0 characters. A null or strange url counts as one host without a name. Repeated
pages count once in the host's counts and each gives its row. Extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import ship, staged, worker_tables

#: A subtree is template from so many pages on, or the natural logarithm of the host's pages if that is more.
MIN_PAGES = 3
#: Template hashes up to which the table is broadcast (8 MB of keys); beyond it, a salted join.
BROADCAST_HASHES = 1_000_000
SALTS = 64

_RAW = "script|style|noscript|template|textarea|title|iframe|xmp|noembed|noframes|svg|math"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Text that a container inside an article may hold to be counted.
SMALL_CHARS = 200
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th figure figcaption".split())
_TEXTUAL = _PROSE - {"ul", "ol", "dl", "figure"}
_DROP = frozenset("nav aside form footer header button select option label input dialog menu search canvas audio video object head".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPE = frozenset("ul ol dl table article main section div body".split())
_BOILER = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "header login menu modal nav navbar navigation newsletter notice notices paywall popup promo recommended related replies "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
_NOT = frozenset("has with no without not is".split())  # "has-sidebar" names the page's layout
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


class _Node:
    __slots__ = ("name", "drop", "article", "parts", "index", "mark", "prose", "chars")

    def __init__(self, name: str, drop: bool, article: int, index: int, mark: int | None = None):
        self.name, self.drop, self.article, self.index = name, drop, article, index
        self.mark = mark  # inside a paragraph that goes on: where dropped text begins
        self.parts: list[str] = []
        self.prose, self.chars = False, 0  # holds a paragraph or the like; its characters


def _dropped(name: str, attrs: str, in_article: bool) -> bool:
    if name in _DROP and not (name == "header" and in_article):
        return True
    if not attrs.strip() or name in ("html", "body", "main") or (name == "article" and not in_article):
        return False
    for key, *values in _ATTR.findall(attrs):
        value, key = next((v for v in values if v), "").lower(), key.lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in _ROLES):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if key in ("class", "id") and not (name in _PROSE and name not in ("ul", "ol", "li", "p")):
            for token in value.split():
                words = _WORD.findall(token)
                if words and words[0] not in _NOT and _BOILER.intersection(words) - ({"header"} if in_article else set()):
                    return True
    return False


def parse(page: str) -> tuple[str, list[tuple[str, list[int]]], list[int], list[list[int]]]:
    """Title; blocks of the main text with the hashes of the candidates around
    them; the hashes of all candidates; and those around each block that the rules drop."""
    title = ""
    hashes: list[int | None] = []  # by element number; known when the element ends
    candidate: list[bool] = []
    found: list[tuple[str, int, list[int], bool]] = []  # text, article level (2, 1, 0), elements around it, dropped
    stack = [_Node("", False, 0, -1)]
    buffer: list[str] = []

    def flush() -> None:
        owner = len(stack) - 1
        for i, node in enumerate(stack):
            if node.mark is not None:
                del buffer[node.mark :]
                node.mark, owner = 0, i - 1
                break
        text = _SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            top = stack[owner]
            top.parts.append(text)
            top.chars += len(text)
            found.append((text, top.article, [n.index for n in stack[: owner + 1] if n.index >= 0], top.drop))

    def close() -> None:
        node = stack.pop()
        if node.mark is not None:
            del buffer[node.mark :]
        stack[-1].prose |= node.prose or node.name in _TEXTUAL
        stack[-1].chars += node.chars
        if node.index >= 0:
            if node.article and (node.prose or node.chars > SMALL_CHARS):
                candidate[node.index] = False
            h = _digest(f"{node.name}\x00" + "\x00".join(node.parts))
            hashes[node.index] = h
            stack[-1].parts.append(f"\x01{h}")
        else:
            stack[-1].parts.extend(node.parts)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            buffer.append(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            if m["raw"].lower() == "title" and not title:
                title = _SPACE.sub(" ", html.unescape(m["inner"])).strip()
            continue
        if not m["name"]:
            continue
        name, block = m["name"].lower(), m["name"].lower() in _BLOCK
        if m["end"]:
            if name in _VOID or not any(n.name == name for n in stack[1:]):
                if name in ("br", "p"):
                    flush()
                continue
            if block or any(n.name in _BLOCK for n in stack[[n.name for n in stack].index(name) :]):
                flush()
            while stack[-1].name != name:
                close()
            close()
            continue
        if name in _VOID:
            buffer.append(" ")
            if name == "hr":
                flush()
            continue
        if block:
            flush()
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[i].name == "p":
                    while len(stack) > i:
                        close()
                    break
                if stack[i].name in _SCOPE:
                    break
            if name in _CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in _CLOSES[name]:
                        while len(stack) > i:
                            close()
                        break
                    if stack[i].name in ("ul", "ol", "dl", "table"):
                        break
        up = stack[-1]
        drop = up.drop or _dropped(name, m["attrs"], up.article == 2)
        article = 2 if name == "article" else max(up.article, 1 if name == "main" else 0)
        index = -1
        if block and name not in ("html", "body", "article", "main", "hr"):
            index = len(hashes)
            hashes.append(None)
            candidate.append(name not in _TEXTUAL and not (up.article and name in _PROSE))
        stack.append(_Node(name, drop, article, index, len(buffer) if drop and not up.drop and not block else None))
    if at < len(page):
        tail = page[at:]
        cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", tail)  # a tag cut off at the end
        buffer.append(tail[: cut.start()] if cut else tail)
    flush()
    while len(stack) > 1:
        close()
    level = max((a for _, a, _, drop in found if not drop), default=0)
    parts = [(text, [hashes[i] for i in around if candidate[i]], drop or a != level) for text, a, around, drop in found]
    blocks = [(text, around) for text, around, ruled in parts if not ruled]
    return title, blocks, sorted({h for h, c in zip(hashes, candidate, strict=True) if c}), [around for _, around, ruled in parts if ruled]


def parsed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, content_hash, blocks (text, around) and the hashes of
    all candidate subtrees of each page."""
    ship(pages.sparkSession)
    block = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("html")
        for batch in batches:
            urls = batch.column(1).to_pylist()
            rows = [parse(p.as_py() or "") for p in batch.column(2)]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column(0), "url": batch.column(1),
                "host": pa.array([host_of(u) for u in urls], pa.string()),
                "content_hash": pa.array([_digest("\x00".join(x for x, _ in b)) for _, b, _, _ in rows], pa.int64()),
                # Blocks that the rules drop come without their text.
                "blocks": pa.array([[{"text": x, "around": h} for x, h in b] + [{"text": None, "around": h} for h in d] for _, b, _, d in rows], block),
                "subtrees": pa.array([s for _, _, s, _ in rows], pa.list_(pa.int64())),
            })

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    schema = "page_id long, url string, host string, content_hash long, blocks array<struct<text: string, around: array<long>>>, subtrees array<long>"
    return rows.mapInArrow(run, schema)


def templates(parsed: DataFrame) -> DataFrame:
    """host, subtree: the subtrees that recur across many pages of their host.
    Pages with the same blocks of main text count once; partial counts come before each
    shuffle, so a host with a third of all pages is no hot key."""
    seen = parsed.select("host", "content_hash", F.explode("subtrees").alias("subtree")).distinct()
    counts = seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    sizes = parsed.select("host", "content_hash").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    return counts.join(sizes, "host").where(F.col("n") >= F.log(F.col("pages").cast("double"))).select("host", "subtree")


def _keys(hosts: list[str], subtrees: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number for each host and subtree; ``sizes``: subtrees of each host in turn."""
    return subtrees ^ np.repeat(np.array([_digest(h) for h in hosts], np.int64), sizes)


def _without_known(parsed: DataFrame, known: DataFrame) -> DataFrame:
    """The rows with the blocks that lie in no known subtree; the sorted keys are broadcast."""
    spark = parsed.sparkSession
    ship(spark)
    rows = known.select("host", "subtree").toArrow()
    found = _keys(rows.column(0).to_pylist(), rows.column(1).to_numpy(), np.ones(rows.num_rows, np.int64))
    sent = spark.sparkContext.broadcast(np.sort(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("html")
        table = sent.value
        for batch in batches:
            blocks = batch.column(3)
            items = blocks.flatten()
            around = items.field("around")
            n_blocks = blocks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            n_around = around.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            of_block = np.repeat(np.arange(len(n_around)), n_around)
            of_row = np.repeat(np.arange(len(n_blocks)), n_blocks)
            per_row = np.bincount(of_row, n_around, len(n_blocks)).astype(np.int64)
            keys = _keys(batch.column(2).to_pylist(), around.flatten().to_numpy(zero_copy_only=False).astype(np.int64), per_row)
            at = np.searchsorted(table, keys)
            hit = table[np.minimum(at, len(table) - 1)] == keys if len(table) else np.zeros(len(keys), bool)
            keep = np.ones(len(n_around), bool)
            keep[of_block[hit]] = False
            template = np.bincount(of_row[~keep], minlength=len(n_blocks))
            keep &= items.field("text").is_valid().to_numpy(zero_copy_only=False)
            sizes = np.bincount(of_row[keep], minlength=len(n_blocks))
            off = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            texts = pa.ListArray.from_arrays(off, items.field("text").filter(pa.array(keep)))
            columns = [batch.column(0), batch.column(1), texts, pa.array(template, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "texts", "n_template"])

    return parsed.select("page_id", "url", "host", "blocks").mapInArrow(run, "page_id long, url string, texts array<string>, n_template long")


def _without_known_joined(parsed: DataFrame, known: DataFrame) -> DataFrame:
    """The same for any number of subtrees. A template on most pages of a large
    host is a hot key of the first join, so its rows are salted."""
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = parsed.select("row", "host", F.explode("subtrees").alias("subtree"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    lists = rows.join(salted, ["host", "subtree", "salt"], "left_semi").groupBy("row").agg(F.collect_list("subtree").alias("template"))
    template = F.coalesce("template", F.array().cast("array<bigint>"))
    kept = F.filter("blocks", lambda b: ~F.arrays_overlap(b["around"], template))
    left = F.filter(kept, lambda b: b["text"].isNotNull())
    return parsed.join(lists, "row", "left").select(
        "page_id", "url", F.transform(left, lambda b: b["text"]).alias("texts"), (F.size("blocks") - F.size(kept)).cast("long").alias("n_template")
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and n_template (blocks that recurrence has
    deleted) for every row of ``pages``."""
    parsed = staged(parsed_pages(pages).withColumn("row", F.monotonically_increasing_id()), "op2-parsed")
    known = staged(templates(parsed), "op2-templates")
    few = known.count() <= BROADCAST_HASHES
    kept = _without_known(parsed, known) if few else _without_known_joined(parsed, known)
    text = F.array_join("texts", "\n\n")
    return kept.select("page_id", "url", text.alias("text"), "n_template").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template")


def op2_html_extraction(pages: DataFrame) -> DataFrame:
    return main_text(pages)
