"""Main text of web pages by wrapper induction over the pages of one host.

1. A page becomes a tree of its block elements (a run of siblings with one label is one repeating node)
   with a text per block. Regions that the page itself names as no article (menus, footers, adverts, forms, ...)
   are one node without text.
2. The commonest tree of a host is its wrapper. Simple tree matching aligns every other
   page's tree with it: the largest order-preserving set of equal nodes, level by level.
3. A text that stands at the same wrapper node of most pages is template; all other texts are content.

Only trees and hashes of texts meet; texts stay with their page, and a host with many pages is
dealt over many tasks."""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.textops import blocks, small_batches, written

#: A block is template if at least so many pages, and this share of the pages with text at its node, hold the same text there.
MIN_PAGES, SHARE = 3, 0.8
#: A host is dealt over as many tasks as it has 256ths of all pages.
PARTS = 256
#: Wrappers are broadcast up to so many bytes (trees and constants, counted), joined by a shuffle beyond.
BROADCAST_BYTES = 4 << 20
#: Alignments a task keeps before it forgets them.
CACHE = 5000

# HTML elements by their part in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp".split())
NOT_TEXT = set("head nav footer aside form button select dialog menu iframe svg template noscript object canvas audio video map".split())
IN_HEAD = set("base link meta noscript script style template title head html".split())
OMITTED = set("p li dt dd option tr td th thead tbody tfoot html body".split())
CLOSED_BY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
             "tr": ("tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
NOISE = set("""ad ads advert adverts advertisement advertising sponsor sponsored banner promo nav navbar navigation menu breadcrumb breadcrumbs sidebar aside
masthead footer cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login search social share
sharing comment comments commentlist respond replies discussion disqus related recommended widget toolbar pagination pager skip""".split())
#: After a word of NOISE these say that the element is that thing; other words ("share-enabled") describe something else.
THING = set("""area bar block body box button col container content footer form group header inner item items link links list message notice panel
region row section slot text thread title toggle unit widget wrap wrapper""".split())
WHOLE_PAGE = {"html", "body", "main", "article"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]|"[^"<]*"|'[^'<]*')*+>|[^>]*(?:>|\Z))""", re.S)
ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


class Page:
    """The folded tree (``parent`` and ``label`` of each node, parents first) and the texts of the blocks that may be content, in page order."""

    def __init__(self, source: str):
        self.parent, self.label, self.nodes, self.texts = [-1], ["#"], [], []
        self._parse(source)

    def shape(self) -> str:
        return json.dumps([self.parent, self.label], ensure_ascii=False, separators=(",", ":"))

    def _parse(self, source: str) -> None:
        last = [None]  # the latest child of each node
        # open elements: tag, node, left out, inside an article, inside a link
        stack = [("#", 0, False, False, False)]
        open_ = Counter()
        buf, linked, found, unclosed = [], 0, [], set()

        def flush() -> None:
            nonlocal linked
            if buf:
                text = " ".join(html_lib.unescape("".join(buf)).split())
                if text:
                    found.append((stack[-1][1], text, stack[-1][3], 2 * linked > sum(map(len, buf))))
                buf.clear()
                linked = 0

        def pop_to(i: int) -> None:
            if any(e[0] not in INLINE for e in stack[i:]):
                flush()
            for e in stack[i:]:
                open_[e[0]] -= 1
            del stack[i:]

        def close_implied(tag: str) -> None:
            if tag in CLOSED_BY:
                names, scope = CLOSED_BY[tag]
                names = names.split()
                if any(open_[n] for n in names):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] in scope:
                            break
                        if stack[i][0] in names:
                            pop_to(i)
                            break
            if open_["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] not in INLINE:
                        break

        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at and not stack[-1][2]:
                buf.append(source[at:stop])
                if stack[-1][4]:
                    linked += stop - at
            if not m:
                break
            at = m.end()
            tag = m.group(2)
            if not tag:
                continue
            tag = tag.lower()
            if m.group(1):  # an end tag
                if open_[tag]:
                    i = len(stack) - 1
                    while stack[i][0] != tag:
                        i -= 1
                    pop_to(i)
                continue
            if open_["head"] and tag not in IN_HEAD:
                i = len(stack) - 1
                while stack[i][0] != "head":
                    i -= 1
                pop_to(i)
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else end
                continue
            if tag == "br":
                buf.append(" ") if not stack[-1][2] else None
                continue
            if tag in VOID:
                if tag == "hr":
                    close_implied(tag)
                    flush()
                continue
            attrs = m.group(3)
            if tag not in INLINE:
                close_implied(tag)
            _, node, out, article, link = stack[-1]
            names = {k.lower(): v.strip("\"'").lower() for k, v in ATTR.findall(attrs)} if "=" in attrs else {}
            noise = not out and left_out(tag, names, article)
            if noise and tag not in OMITTED and tag not in unclosed:
                past = end_of(source, tag, at)
                if past is None:
                    unclosed.add(tag)  # its parent's end may end it: read on, tag by tag
                else:
                    at = past
                    if tag not in INLINE:
                        flush()
                        self._child(last, node, tag, names)
                    continue
            if tag in INLINE:
                stack.append((tag, node, out or noise, article, link or tag == "a"))
            else:
                flush()
                if not out:
                    node = self._child(last, node, tag, names)
                article = article or (not out and not noise and (tag in ("article", "main") or names.get("role") == "main"))
                stack.append((tag, node, out or noise, article, link))
            open_[tag] += 1
        flush()
        named = any(f[2] for f in found)
        for node, text, article, links in found:
            if article if named else not links:
                self.nodes.append(node)
                self.texts.append(text)


    def _child(self, last: list, node: int, tag: str, names: dict) -> int:
        """The child of ``node`` for an element: the latest child if it has the same label, else a new one."""
        label = tag + ("." + re.sub(r"\d+", "", names["class"]) if names.get("class") else "")
        if last[node] is None or self.label[last[node]] != label:
            self.parent.append(node)
            self.label.append(label)
            last[node] = len(self.parent) - 1
            last.append(None)
        return last[node]


def end_of(source: str, tag: str, at: int) -> int | None:
    """The position after the end tag of an element whose content starts at ``at``, None without one."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(tag)}(?![^\s/>])[^>]*>", re.I).finditer(source, at):
        depth += -1 if m.group(1) else 1
        if not depth:
            return m.end()
    return None


def left_out(tag: str, names: dict, article: bool) -> bool:
    """Does the page itself name this element as no part of an article?"""
    if tag in NOT_TEXT or (tag == "header" and not article) or names.get("role") in ROLES:
        return True
    for token in f"{names.get('class', '')} {names.get('id', '')}".split():
        if tag in WHOLE_PAGE:
            if token in NOISE and tag != "body":
                return True
            continue
        parts = [p for p in re.split(r"[-_]+", token) if p and not p.isdigit()]
        if not parts or parts[0] in ("has", "with", "no", "without", "is"):
            continue
        if parts[-1] in NOISE or (parts[0] in NOISE and parts[-1] in THING) or (not article and parts[-1] == "header"):
            return True
    return False


class Shapes:
    """Ids of subtrees by label and children, so that equal subtrees are matched once."""

    def __init__(self):
        self.ids, self.label, self.kids, self.memo = {}, [], [], {}

    def tree(self, parent: list[int], label: list[str]) -> tuple[list[int], list[list[int]]]:
        """Subtree id and children of each node."""
        children = [[] for _ in parent]
        for i in range(1, len(parent)):
            children[parent[i]].append(i)
        out = [0] * len(parent)
        for i in range(len(parent) - 1, -1, -1):
            key = (label[i], tuple(out[c] for c in children[i]))
            if key not in self.ids:
                self.ids[key] = len(self.label)
                self.label.append(label[i])
                self.kids.append(np.array(key[1], np.int64))
            out[i] = self.ids[key]
        return out, children

    def value(self, a: int, b: int) -> int:
        """Simple tree matching: nodes in the largest order-preserving matching of two subtrees; 0 if their roots differ."""
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.memo:
                todo.pop()
                continue
            if self.label[x] != self.label[y]:
                self.memo[x, y] = 0
                continue
            wait = [(s, t) for s in set(self.kids[x].tolist()) for t in set(self.kids[y].tolist()) if (s, t) not in self.memo]
            if wait:
                todo += wait
                continue
            row = np.zeros(len(self.kids[y]) + 1, np.int64)
            for w in self._weights(x, y):
                row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + w))
            self.memo[x, y] = int(row[-1]) + 1
        return self.memo[a, b]

    def _weights(self, x: int, y: int) -> Iterator[np.ndarray]:
        shapes, inverse = np.unique(self.kids[y], return_inverse=True)
        for s in self.kids[x].tolist():
            yield np.array([self.memo[s, t] for t in shapes.tolist()], np.int64)[inverse] if len(shapes) else np.zeros(0, np.int64)

    def pairs(self, x: int, y: int) -> list[tuple[int, int]]:
        """Positions of the children that the best matching of two subtrees pairs."""
        n, m = len(self.kids[x]), len(self.kids[y])
        row = np.zeros(m + 1, np.int64)
        taken, up = np.zeros((n, m), bool), np.zeros((n, m), bool)
        for i, w in enumerate(self._weights(x, y)):
            diagonal = row[:-1] + w
            new = np.concatenate([[0], np.maximum.accumulate(np.maximum(row[1:], diagonal))])
            taken[i] = (w > 0) & (diagonal == new[1:]) & (diagonal > row[1:]) & (diagonal > new[:-1])
            up[i] = row[1:] == new[1:]
            row = new
        got, i, j = [], n - 1, m - 1
        while i >= 0 and j >= 0:
            if taken[i, j]:
                got.append((i, j))
                i, j = i - 1, j - 1
            elif up[i, j]:
                i -= 1
            else:
                j -= 1
        return got[::-1]


def align(page: str, wrapper: str) -> list[int]:
    """The wrapper's node for each node of a page's tree, -1 where simple tree matching finds none."""
    a, b, shapes = json.loads(page), json.loads(wrapper), Shapes()
    (sa, ka), (sb, kb) = shapes.tree(*a), shapes.tree(*b)
    to = [-1] * len(sa)
    if shapes.value(sa[0], sb[0]):
        todo = [(0, 0)]
        while todo:
            i, j = todo.pop()
            to[i] = j
            todo += [(ka[i][p], kb[j][q]) for p, q in shapes.pairs(sa[i], sb[j])]
    return to


class Aligner:
    """Alignments of the trees met so far; pages of a host share few trees."""

    def __init__(self):
        self.known = {}

    def __call__(self, page: str, wrapper: str) -> list[int]:
        if (page, wrapper) not in self.known:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[page, wrapper] = align(page, wrapper)
        return self.known[page, wrapper]


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parser(texts: bool):
    """Pages as trees, with their texts or with the hashes of their texts."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "html"):
            pages = [Page(x or "") for x in b.column("html").to_pylist()]
            shape = pa.array([p.shape() for p in pages], pa.string())
            nodes = pa.array([p.nodes for p in pages], pa.list_(pa.int32()))
            if texts:
                cols = [b.column("page_id"), b.column("url"), b.column("host"), shape, nodes, pa.array([p.texts for p in pages], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "host", "shape", "nodes", "texts"])
            else:
                hashes = [[text_hash(t) for t in p.texts] for p in pages]
                whole = pa.array([text_hash(repr(h)) for h in hashes], pa.int64())
                cols = [b.column("host"), whole, shape, nodes, pa.array(hashes, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["host", "article", "shape", "nodes", "hashes"])

    return parse


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages by wrapper node and text there; a null text counts the pages with any text at the node."""
    aligner, names = Aligner(), ["host", "node", "hash", "pages"]
    for b in batches:
        got = Counter()
        for r in b.to_pylist():
            to = aligner(r["shape"], r["wrapper"])
            at = {(to[n], h) for n, h in zip(r["nodes"], r["hashes"], strict=True) if to[n] >= 0}
            got.update((r["host"], n, h) for n, h in at)
            got.update((r["host"], n, None) for n in {n for n, _ in at})
        cols = list(zip(*[(*k, v) for k, v in got.items()], strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=names)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner()
    for b in batches:
        out = []
        for shape, nodes, texts, wrapper, constant in zip(*(b.column(c).to_pylist() for c in ("shape", "nodes", "texts", "wrapper", "constant")), strict=True):
            if constant:
                to, drop = aligner(shape, wrapper), {(c["node"], c["hash"]) for c in constant}
                texts = [t for n, t in zip(nodes, texts, strict=True) if (to[n], text_hash(t)) not in drop]
            out.append("\n".join(texts))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def _dealt(df: DataFrame, counts: DataFrame, by) -> DataFrame:
    """A part number for each row: hosts with more than one 256th of all pages (so at most 256 hosts, broadcast) are dealt by ``by``."""
    df = df.join(F.broadcast(counts), "host", "left")
    return df.withColumn("part", F.pmod(F.xxhash64(by), F.coalesce("parts", F.lit(1)))).drop("parts")


def _copied(df: DataFrame, counts: DataFrame) -> DataFrame:
    """A row per part of its host: one, or 1 + 256 x share. All copies together are at most 512."""
    df = df.join(F.broadcast(counts), "host", "left")
    return df.withColumn("part", F.explode(F.expr("sequence(0L, cast(coalesce(parts, 1) - 1 as long))"))).drop("parts")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """``pages`` (page_id, url, html; other columns are ignored) -> one row per row: page_id, url, text, n_chars.

    The text is that of the page's blocks, each with character references decoded and white space runs as one space, joined by new lines. Left out are
    regions the page names as no article (by element, role, class or id); where it has an ``article`` or ``main``, everything outside;
    elsewhere blocks that are mostly links; and every block whose text is template: held at the same wrapper node by at
    least ``min_pages`` pages of the host and ``share`` of those with text there. Pages of a host with equal content count once,
    so copies of an article do not make it template.

    A null or empty html, and a page without any content, give an empty text (0 characters). Pages without a host (null url or no ://)
    share one wrapper. Repeated rows each give a row; an empty table gives none."""
    spark = pages.sparkSession
    small_batches(spark)
    host = F.translate(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    src = pages.select("page_id", F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    seen = src.mapInArrow(_parser(False), "host string, article long, shape string, nodes array<int>, hashes array<long>").where(F.size("nodes") > 0)
    # one row per host and content, whatever surrounds it
    seen = written(seen.groupBy("host", "article").agg(F.min(F.struct("shape", "nodes", "hashes")).alias("p")).select("host", "article", "p.*"), "wrapper-pages")
    trees = seen.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("c"))
    wrappers = written(trees.groupBy("host").agg(F.max(F.struct("c", F.col("shape").alias("wrapper"))).alias("w"), F.sum("c").alias("pages"))
                       .where(F.col("pages") >= min_pages).select("host", "w.wrapper", "pages"), "wrapper-trees")
    total = wrappers.agg(F.sum("pages")).first()[0] or 0
    counts = wrappers.where(F.col("pages") * PARTS > total).select("host", F.expr(f"1 + (pages * {PARTS}) div {max(total, 1)}").alias("parts"))
    met = _dealt(seen, counts, "article").join(_copied(wrappers.select("host", "wrapper"), counts), ["host", "part"])
    held = met.select("host", "shape", "nodes", "hashes", "wrapper").mapInArrow(_count, "host string, node int, hash long, pages long")
    held = written(held.groupBy("host", "node", "hash").agg(F.sum("pages").alias("pages")).where((F.col("pages") >= min_pages)), "wrapper-texts")
    any_ = held.where("hash is null").select("host", "node", F.col("pages").alias("of"))
    constant = held.where("hash is not null").join(any_, ["host", "node"]).where(F.col("pages") >= share * F.col("of"))
    constant = constant.groupBy("host").agg(F.collect_list(F.struct("node", "hash")).alias("constant"))
    template = written(constant.join(wrappers.select("host", "wrapper"), "host"), "wrapper-template")

    got = src.mapInArrow(_parser(True), "page_id " + pages.schema["page_id"].dataType.simpleString() + ", url string, host string, shape string, nodes array<int>, texts array<string>")
    size = template.agg(F.sum(F.length("wrapper") + 16 * F.size("constant") + 100)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        got = got.join(F.broadcast(template), "host", "left")
    else:
        got = _dealt(got, counts, "page_id").join(_copied(template, counts), ["host", "part"], "left")
    out = got.select("page_id", "url", "shape", "nodes", "texts", "wrapper", "constant")
    out = out.mapInArrow(_extract, "page_id " + pages.schema["page_id"].dataType.simpleString() + ", url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
