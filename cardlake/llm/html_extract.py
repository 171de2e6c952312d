"""Main text of web pages by removal of site templates.

Every block element's subtree is hashed (tag, class, text and children). A subtree that recurs in LEAST unlike pages of its host is a
template and deleted, whatever the size of the host. Pages are told apart by the text around the subtree: equal pages count once, and so
do copies and near copies of an article, so that its parts are no templates (a sketch of word shingles if the rest is long; if
it is short, its words and the parent must both differ). A page that consists of the subtree but for a fifth of its words does not
count. Elements that by tag, role, style or class are menus, headers, footers, sidebars, notices, adverts, forms, scripts or comments go
too, but not a form or a named element that is wrapped around the content or, inside it, around its title.
If a page marks its content by article or main, only that is read, and templates inside it go as well; its h1 and the
entries, rows and cells of its lists and tables stay unless the whole list or table recurs. Elsewhere rows and cells of up to three
words stay.
Tasks pass on at most LEAST contexts per subtree and HELD subtrees; where likeness is not transitive, the count can depend on the
order of the pages near the bound. Template tables are never kept per host in one row.

Defined cases: null and empty html give an empty text; broken markup is read as far as it goes and a cut-off tag at the end is
dropped; repeated pages give repeated rows; pages without a host share the empty host; empty tables give no rows.
"""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardlake.session import stage

LEAST = 5  # a template stands in so many unlike pages of its host
LONG, SKETCH = 40, 8  # words from which texts can be near copies; shingles that tell them
HELD, FEW = 100_000, 2_000_000  # subtrees that a task holds at a time; templates that are sent to every task
# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCK = frozenset("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
                  "h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
SKIP = RAW | frozenset("head nav footer aside form button select option dialog object audio video canvas menu".split())
CONTENT = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body", "article", "main"))
PARTS = frozenset("li dt dd tr td th thead tbody tfoot".split())  # of lists and tables; the same entry in many of them is chance
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|notices?|"
    r"popup|modal|newsletter|subscribe|subscription|promo\w*|sponsor\w*|related|recommend\w*|share|sharing|social|comments?|replies|respond|disqus|"
    r"login|signup|pagination|pager|widget|toolbar|skip)(?:[\s_-]|$)")
# Text elements are told by a whole class name, not by a part of one; a reader's comment may be an article of its own.
NAMED = re.compile(NAMES.pattern.replace("[\\s_-]", "\\s"))
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre span a b i em strong".split())
COMMENT = re.compile(r"(?i)(?:^|[\s_-])(?:comments?|repl(?:y|ies)|respond)(?:[\s_-]|$)")
UNSEEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
# A quote that is never closed ends with its tag.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|"
                   r"<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")


def _digest(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


class _Node:
    __slots__ = ("tag", "label", "skip", "children", "text", "hash", "parent")

    def __init__(self, tag: str, label: str, skip: bool, parent):
        self.tag, self.label, self.skip, self.parent = tag, label, skip, parent
        self.children: list = []  # nodes and strings
        self.hash = 0


def parse(page: str) -> _Node:
    """The element tree; iterative, so depth is not limited by the stack."""
    root = _Node("html", "", False, None)
    top, at, order, wrappers, comments = root, 0, [root], [], []
    while at < len(page):
        found = TOKEN.search(page, at)
        if not found:
            tail = page[at:]
            cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", tail)
            top.children.append(tail[:cut.start()] if cut else tail)
            break
        if found.start() > at:
            top.children.append(page[at:found.start()])
        at = found.end()
        name = found["tag"] or found["tag2"]
        if name is None:
            continue
        tag, closing, rest = name.lower(), found["close"] or found["close2"], found["rest"] if found["tag"] else found["rest2"]
        if closing:
            node = top
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                top = node.parent
            elif tag == "p":
                top.children.append(_Node("br", "", False, top))
            continue
        if tag in ("html", "body", "head") and tag == "html":
            continue
        if tag in BLOCK and tag != "br":  # a block ends an open paragraph, with whatever inline elements are open in it
            node = top
            while node is not root and (node.tag == "p" or node.tag not in BLOCK):
                if node.tag == "p":
                    top = node.parent
                    break
                node = node.parent
        if tag in CLOSES:
            node = top
            while node is not root and node.tag not in ("ul", "ol", "dl", "table", "select", "div", "body", "article"):
                if node.tag in CLOSES[tag]:
                    top = node.parent
                    break
                node = node.parent
        label, hide = "", False
        named = False
        if rest:
            marks = {m.group(1).lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in ATTRIBUTE.finditer(rest)}
            label = f"{marks.get('class', '')} {marks.get('id', '')}"
            hide = "hidden" in marks or marks.get("role", "").lower() in ROLES or bool(UNSEEN.search(marks.get("style", "")))
            named = bool(tag not in WHOLE and (NAMED if tag in TEXTS else NAMES).search(label))
        node = _Node(tag, label, hide or named or tag in SKIP, top)
        if tag == "article" and COMMENT.search(label):
            comments.append(node)
        if tag == "form" and not hide or named and not hide and tag not in SKIP:
            wrappers.append(node)
        top.children.append(node)
        order.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.children.append(page[at:end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif not rest.rstrip().endswith("/") or tag in BLOCK:
            top = node
    for node in comments:  # beside or inside an article that is none
        node.skip = any(o.tag in CONTENT and o not in comments for o in order)
    for node in wrappers:
        node.skip = not _wraps_content(node)
    for node in reversed(order):
        node.hash = _digest(node.tag, node.label, *[c.strip() if isinstance(c, str) else str(c.hash) for c in node.children])
    return root


def _inside_content(node: _Node) -> bool:
    while node:
        if node.tag in CONTENT:
            return True
        node = node.parent
    return False


def _wraps_content(node: _Node) -> bool:
    """Whether what a form or a class name would remove is the page's content or a part of it: it holds an article or main, or, as a
    form, three paragraphs, or stands inside the content around its title."""
    seen, stack = {}, [node]
    while stack:
        for c in stack.pop().children:
            if not isinstance(c, str):
                seen[c.tag] = seen.get(c.tag, 0) + 1
                stack.append(c)
    return not CONTENT.isdisjoint(seen) or node.tag == "form" and seen.get("p", 0) >= 3 or "h1" in seen and _inside_content(node.parent)


def _holds_content(root: _Node) -> bool:
    """Whether an article or main stands outside skipped elements."""
    stack = [root]
    while stack:
        node = stack.pop()
        if not node.skip:
            if node.tag in CONTENT:
                return True
            stack += [c for c in node.children if not isinstance(c, str)]
    return False


def _left_out(node: _Node, inside: bool) -> bool:
    return node.skip or node.tag == "header" and not inside


def _may_be_template(node: _Node, inside: bool) -> bool:
    return node.tag in BLOCK and node.tag not in WHOLE and node.tag not in ("br", "hr", "li") and not (
        inside and (node.tag in PARTS or node.tag == "h1"))


def _context(words: np.ndarray, grams: np.ndarray, order: np.ndarray, first: int, end: int, parent: int) -> bytes | None:
    """What tells the page around words first to end from others; None where they are nearly all of a long page, so its content."""
    rest = len(words) - (end - first)
    if end - first >= LONG and 5 * rest <= len(words):
        return None
    if rest >= LONG:
        far = order[(order < first - 2) | (order >= end)]
        return np.unique(grams[far[:SKETCH]]).astype("<u4").tobytes()
    around = np.concatenate([words[:first], words[end:]]).tobytes()
    return (parent + (1 << 63)).to_bytes(8, "big") + b"short" + xxhash.xxh64_digest(around)


def _same_page(x: bytes, y: bytes) -> bool:
    """Whether two contexts are of copies: half the sketch in common, or few words that are equal or stand in one parent."""
    if x[8:13] == b"short" or y[8:13] == b"short":
        return x[8:13] == y[8:13] and (x[:8] == y[:8] or x[13:] == y[13:])
    return 2 * len(set(memoryview(x).cast("I")) & set(memoryview(y).cast("I"))) >= SKETCH


def _add_context(found: list, new: bytes) -> None:
    if not any(_same_page(new, x) for x in found):
        found.append(new)


def subtrees(page: str) -> list[tuple[int, bytes]]:
    """(hash, context) of the subtrees with text that a template could be, among those that are read; each hash once."""
    root = parse(page)
    words: list[int] = []
    spans: list[tuple] = []
    stack: list = [(root, not _holds_content(root), False, -1)]
    while stack:
        node, reading, inside, first = stack.pop()
        if isinstance(node, str):
            if reading:
                words += [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in node.split()]
            continue
        if first >= 0:
            if len(words) > first + (3 if node.tag in PARTS else 0):
                spans.append((node, first, len(words)))
            continue
        if _left_out(node, inside):
            continue
        if reading and _may_be_template(node, inside):
            stack.append((node, reading, inside, len(words)))
        inside = inside or node.tag in CONTENT
        reading = reading or inside
        stack += [(c, reading, inside, -1) for c in reversed(node.children)]
    w = np.array(words, np.uint32)
    grams = (w[:-2] * np.uint32(0x9E3779B1) ^ w[1:-1] * np.uint32(0x85EBCA6B) ^ w[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    order = np.argsort(grams, kind="stable")
    out: dict[int, bytes] = {}
    for node, first, end in spans:
        context = None if node.hash in out else _context(w, grams, order, first, end, node.parent.hash if node.parent else 0)
        if context is not None:
            out[node.hash] = context
    return list(out.items())


def _hashes(root: _Node) -> list[int]:
    """The hashes that ``main_text`` may look up."""
    out, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        if not _left_out(node, inside):
            if _may_be_template(node, inside):
                out.append(node.hash)
            inside = inside or node.tag in CONTENT
            stack += [(c, inside) for c in node.children if not isinstance(c, str)]
    return out


def main_text(page: str | _Node, templates: frozenset) -> str:
    root = parse(page) if isinstance(page, str) else page
    parts: list[str] = []
    stack: list = [(root, not _holds_content(root), False)]
    while stack:
        node, reading, inside = stack.pop()
        if isinstance(node, str):
            if reading:
                parts.append(node)
            continue
        if node.tag == "header" and not inside and not node.skip:
            continue
        if node.skip or reading and node.hash in templates and _may_be_template(node, inside):
            if node.tag in BLOCK and reading:
                parts.append("\n")
            continue
        inside = inside or node.tag in CONTENT
        reading = reading or inside
        edge = node.tag in BLOCK and reading
        if edge:
            parts.append("\n")
            stack.append(("\n", True, inside))
        stack += [(c, reading, inside) for c in reversed(node.children)]
    return SPACE.sub(" ", entities.unescape("".join(parts))).strip()


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))


def _subtree_rows(batches):
    """(host, hash, context): unlike contexts of each subtree, or one null if LEAST were met."""
    def rows():
        keys = [(*k, c) for k, found in met.items() for c in (found if len(found) < LEAST else [None])]
        columns = zip(*keys) if keys else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))],
                                          ["host", "hash", "context"])

    met: dict[tuple, list] = {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            for h, context in subtrees(page or ""):
                found = met.setdefault((host, h), [])
                if len(found) < LEAST:
                    _add_context(found, context)
            if len(met) >= HELD:
                yield rows()
                met = {}
    yield rows()


def _decide(batches):
    for batch in batches:
        keep = []
        for sure, contexts in zip(batch.column("sure").to_pylist(), batch.column("contexts").to_pylist()):
            found: list = []
            for c in contexts:
                if not sure and len(found) < LEAST:
                    _add_context(found, c)
            keep.append(sure or len(found) >= LEAST)
        yield batch.filter(pa.array(keep, pa.bool_())).select(["host", "hash"])


def _digest_of(host: str, h: int) -> int:
    return _digest(host, str(h))


def _digests(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([_digest_of(*x) for x in zip(batch.column("host").to_pylist(), batch.column("hash").to_pylist())],
                                                   pa.int64())], ["digest"])


def _asked_rows(batches):
    for batch in batches:
        out = [(page, host, h) for page, host, html in zip(*(batch.column(c).to_pylist() for c in ("page", "host", "html")))
               for h in set(_hashes(parse(html or "")))]
        columns = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()))], ["page", "host", "hash"])


def _extract(batches):
    for batch in batches:
        texts = [main_text(page or "", frozenset(hashes or ())) for page, hashes in zip(batch.column("html").to_pylist(),
                                                                                        batch.column("templates").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], ["kept", "text"])


def site_templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, hash) of the subtrees that recur in LEAST unlike pages of a host."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    met = (rows.mapInArrow(_subtree_rows, "host string, hash long, context binary").groupBy("host", "hash")
           .agg(F.max(F.col("context").isNull()).alias("sure"), F.sort_array(F.collect_set("context")).alias("contexts")))
    some = met.filter(F.col("sure") | (F.size("contexts") >= LEAST))
    return some.select("host", "hash", "sure", "contexts").mapInArrow(_decide, "host string, hash long")


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), few: int = FEW) -> DataFrame:
    """The kept columns and ``text``, one row per page. Up to ``few`` templates go to every task, more are joined to the pages."""
    spark = pages.sparkSession
    known = stage(site_templates(pages, url, html), "templates")
    kept = F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept")
    plain = pages.select(kept, host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html"))
    schema = f"kept {plain.schema['kept'].dataType.simpleString()}, text string"
    outer = [*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], "text"]
    if known.count() <= few:
        listed = known.mapInArrow(_digests, "digest long").toArrow().column("digest").to_numpy()
        table = spark.sparkContext.broadcast(np.sort(listed))

        def run(batches):
            for batch in batches:
                texts = []
                for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                    root = parse(page or "")
                    hashes = list(set(_hashes(root)))
                    asked = np.array([_digest_of(host, h) for h in hashes], np.int64)
                    at = np.searchsorted(table.value, asked)
                    hit = [h for h, i, x in zip(hashes, at.tolist(), asked.tolist()) if i < len(table.value) and table.value[i] == x]
                    texts.append(main_text(root, frozenset(hit)))
                yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], ["kept", "text"])

        return plain.mapInArrow(run, schema).select(*outer)
    # By the page's digest, so that equal pages are looked up once; pages without a template do not take part in the lookup.
    digest = F.xxhash64("host", "html")
    asked = plain.select(digest.alias("page"), "host", "html").mapInArrow(_asked_rows, "page long, host string, hash long").distinct()
    hits = stage(asked.join(known, ["host", "hash"]).groupBy("page").agg(F.collect_set("hash").alias("templates")), "template-hits")
    out = plain.withColumn("page", digest).join(hits, "page", "left").select("kept", "html", "templates").mapInArrow(_extract, schema)
    return out.select(*outer)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
