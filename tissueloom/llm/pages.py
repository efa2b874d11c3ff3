"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree.  A text stands at three of its nodes: the path of tags with class
and id, and its place, where each element is known by its parent's presentation style and its place in it.  A
style is the sequence of child signatures with runs of equal ones as one; a place is the run and the number in
it, counted from the start for one node and from the end for the other, so that a head or foot notice has one
place on pages with longer and shorter texts.  For every node that holds text the tree has how many distinct pages hold it, in which presentation styles (the sequence of child
elements) and with which content; pages of equal text count once.  A node's importance is the entropy of its styles over
the pages, or one minus the mean entropy of its content features, whichever is larger: what looks and reads alike
everywhere is noise.  Of a noise node the texts of two or more distinct pages go; one page's own text always stays.
Elements whose tag names their role (menus, footers, ...) are noise from the start.  A form, or an element with a
class, id or role that names one (adverts, comments, ...), goes unless it holds an outer article or a main element, or
(adverts apart) the tree speaks for it: its importance is that of content and more than half of the host's distinct
text is inside.
The tree is aggregated by Spark; a page only needs the host's noise texts and the named branches that stay.
"""

from __future__ import annotations

import hashlib
import html
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueloom.llm.common import slices
from tissueloom.sources.storage import materialise

#: Importance below which a node is noise, and distinct pages that must hold it before that can be told.
MIN_IMPORTANCE, MIN_PAGES = 0.3, 2

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp".split())
NOISE_TAGS = frozenset("nav footer aside button select head svg canvas object dialog header menu".split()) | RAW
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer "
    "header login menu modal nav navbar navigation newsletter notice pager pagination popup promo related reply "
    "replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
NOISE_ROLES = frozenset("banner navigation contentinfo complementary search form alert dialog menu".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
TAG_END = re.compile(r"[^\"'>]*+(?:(?:\"[^\"]*+\"|'[^']*+')[^\"'>]*+)*+>")
#: Elements that are never noise by class, id or role, nor are those around them.
MAIN = frozenset("html body main article".split())
#: Names that importance cannot overrule, as changing adverts always look important.
ADVERTS = frozenset("ad ads advert adverts advertisement sponsor sponsored".split())
#: The node of all texts of a host, and that of adverts.
ROOT, ADVERT = -1, -3
# an open element of these is closed by the start of one of those
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@lru_cache(maxsize=4096)
def signature(name: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Tag with class and id, whether it is outside the main text by its tag, whether by another name, or as an advert."""
    found = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or ""))
    marks = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    noise = name in NOISE_TAGS or ("hidden" in found and name not in MAIN)
    named = name not in MAIN and (
        name == "form" or not NOISE_WORDS.isdisjoint(marks) or not NOISE_ROLES.isdisjoint(found.get("role", "").lower().split())
    )
    return f"{name}.{'.'.join(sorted(marks))}", noise, named, named and not ADVERTS.isdisjoint(marks)


class Page:
    """Blocks of text and the elements around them, in page order; elements are numbered as they open.

    ``blocks``: (pieces, number of the innermost element around all, children before the text), a piece being
    its source and the inline element named as noise that holds it, or 0; ``children``: path to the signatures of its
    child elements; ``inside``: for every element the signatures and numbers of its children; ``paths`` and ``up``: its
    path and parent; ``named``: the elements that are noise by name, ``adverts`` among them.
    """

    def __init__(self, source: str | None):
        self.blocks: list[tuple[list[tuple[str, int]], int, int]] = []
        self.children: dict[int, list[str]] = {}
        self.inside: list[list[tuple[int, int]]] = [[]]
        self.paths, self.up = [0], [0]
        self.named: set[int] = set()
        self.adverts: set[int] = set()
        self._text: list[tuple[str, int]] = []
        self._depth = 0  # open elements that hold all of the text so far
        # name, path, noise, number, inline element named as noise
        self._stack: list[tuple[str, int, bool, int, int]] = []
        # where in the stack elements of a name, blocks, and elements named as noise stand, ascending
        self._at: dict[str, list[int]] = {}
        self._block_at: list[int] = []
        self._named_at: list[int] = []
        self._parse(source or "")

    def _push(self, element: tuple[str, int, bool, int, int]) -> None:
        at = len(self._stack)
        self._at.setdefault(element[0], []).append(at)
        if element[0] in BLOCKS:
            self._block_at.append(at)
        if element[3] in self.named:
            self._named_at.append(at)
        self._stack.append(element)

    def _cut(self, at: int) -> None:
        """Take everything from place ``at`` on off the stack."""
        while len(self._stack) > at:
            self._at[self._stack.pop()[0]].pop()
        for places in (self._block_at, self._named_at):
            while places and places[-1] >= at:
                places.pop()

    def _last(self, name: str) -> int:
        places = self._at.get(name)
        return places[-1] if places else -1

    def _add(self, piece: str) -> None:
        """One text node, or a part of one without a character reference, in the open element."""
        if "&" in piece:
            piece = html.unescape(piece)
        _, _, noise, number, inline = self._stack[-1] if self._stack else ("", 0, False, 0, 0)
        if noise:
            piece = " "  # noise parts words, as a box of its own would
        elif not self._text or len(self._stack) < self._depth:
            self._depth = len(self._stack)
            self._before = len(self.inside[number])
        if self._text or piece != " ":
            self._text.append((piece, inline))

    def _flush(self) -> None:
        pieces, self._text = self._text, []
        if not any(inline for _, inline in pieces):
            pieces = [("".join(piece for piece, _ in pieces), 0)]
        if any(piece.strip() for piece, _ in pieces):
            self.blocks.append((pieces, self._stack[self._depth - 1][3] if self._depth else 0, self._before))

    def _pop(self, at: int) -> None:
        if at < self._depth:  # the text goes on outside
            self._before = len(self.inside[self._stack[at - 1][3] if at else 0])
            self._depth = at
        self._cut(at)

    def _open(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._flush()
            for top, closers in CLOSED_BY.items():
                if name in closers and self._stack and self._stack[-1][0] == top:
                    self._cut(len(self._stack) - 1)
            at = self._last("p")
            if at >= 0 and self._block_at[-1] == at:  # a block closes an open paragraph and what it holds
                # inline noise around the block lasts until its own end
                inner = [x for x in self._stack[at + 1 :] if not self._stack[at][2] and (x[2] or x[3] in self.named)]
                self._cut(at)
                for element in inner:
                    self._push(element)
        sign, noise, named, advert = signature(name, attributes)
        if name == "header" and (self._last("article") >= 0 or self._last("main") >= 0):
            noise = named = False  # an article's own heading
        if name == "form" and self._last("form") >= 0:
            named = False  # forms do not nest
        if name == "main" or name == "article" and self._last(name) < 0:
            self.named.difference_update(self._stack[at][3] for at in self._named_at)
            self._named_at = []
        parent = self._stack[-1] if self._stack else ("", 0, False, 0, 0)
        if not parent[2]:
            self.children.setdefault(self.paths[parent[3]], []).append(sign)
        if name in VOID:
            if name == "br":
                self._add(" ")
            return
        path = hash((parent[1], _sign_hash(sign)))
        number = len(self.inside)
        self.inside.append([])
        self.inside[parent[3]].append((_sign_hash(sign), number))
        self.paths.append(path)
        self.up.append(parent[3])
        if named:
            self.named.add(number)
        if advert:
            self.adverts.add(number)
        inline = 0 if name in BLOCKS else number if named else parent[4]
        self._push((name, path, noise or parent[2], number, inline))

    def _close(self, name: str) -> None:
        at = self._last(name)
        if at < 0 or (name not in BLOCKS and self._block_at and self._block_at[-1] > at):
            return  # nothing to close, or an inline end outside its block
        if name in BLOCKS:
            self._flush()
        self._pop(at)

    def _parse(self, s: str) -> None:
        at, size, lowered = 0, len(s), None
        while at < size:
            lt = s.find("<", at)
            if lt < 0:
                self._add(s[at:])
                break
            if lt > at:
                self._add(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = size if end < 0 else end + 3
                continue
            nxt = s[lt + 1 : lt + 2]
            if nxt in ("!", "?"):
                end = s.find(">", lt)
                at = size if end < 0 else end + 1
                continue
            closing = nxt == "/"
            m = NAME.match(s, lt + 1 + closing)
            if not m:
                self._add("<")
                at = lt + 1
                continue
            name = m[0].lower()
            end = TAG_END.match(s, m.end())
            stop = end.end() if end else s.find(">", m.end()) + 1
            if not stop:
                break  # a tag that never ends
            if closing:
                self._close(name)
                at = stop
                continue
            if name in RAW:
                if lowered is None:
                    lowered = s.lower() if len(s.lower()) == size else s
                close = lowered.find(f"</{name}", stop)
                over = s.find(">", close) + 1 if close >= 0 else 0
                at = over or size
                continue
            self._open(name, s[m.end() : stop - 1])
            at = stop
        self._flush()

    def places(self) -> tuple[list[int], list[int], list[int]]:
        """For every element its style and its node by place, counted from the start and from the end."""
        style = [0] * len(self.inside)
        runs: list[list[int]] = []  # for every element, the runs' lengths
        for number, inside in enumerate(self.inside):
            lengths, last, order = [], None, []
            for sign, _ in inside:
                if sign != last:
                    lengths.append(0)
                    order.append(sign)
                    last = sign
                lengths[-1] += 1
            style[number] = hash(tuple(order))
            runs.append(lengths)
        found = []
        for back in (0, 1):
            at = [0] * len(self.inside)
            for number, inside in enumerate(self.inside):  # parents come before their children
                child = iter(inside)
                for run, length in enumerate(runs[number]):
                    for k in range(length):
                        at[next(child)[1]] = hash((at[number], style[number], run, length - k if back else k, back))
            found.append(at)
        return style, *found

    def parts(self) -> list[list[tuple[str, tuple[int, ...], int]]]:
        """Every block's pieces with the nodes of the elements around them that are noise by name."""
        branches: list[tuple[int, ...]] = [()]
        for number in range(1, len(self.inside)):
            above = branches[self.up[number]]
            branch = ADVERT if number in self.adverts else hash((self.paths[number], 4))
            branches.append((*above, branch) if number in self.named and branch not in above else above)
        return [[(piece, branches[inline or number], inline) for piece, inline in pieces] for pieces, number, _ in self.blocks]

    def nodes(self) -> list[list[tuple[str, tuple[int, ...], list[tuple[int, int, int]]]]]:
        """For every block: text, branches named as noise, and path, node and feature at each of its nodes.

        What is inside such a branch within the block is a text of its own.
        """
        style, first, last = self.places()
        found = []
        for parts, (_, number, before) in zip(self.parts(), self.blocks):
            texts: dict[tuple[int, ...], list[str]] = {}
            holder = {}
            for piece, branches, inline in parts:
                texts.setdefault(branches, []).append(piece)
                holder.setdefault(branches, inline)
            block = []
            for branches, pieces in texts.items():
                if text := clean("".join(pieces)):
                    value, at, k = digest(text), holder[branches] or number, 0 if holder[branches] else before
                    back = len(self.inside[at]) - k
                    where = (self.paths[at], hash((first[at], style[at], k, 2)), hash((last[at], style[at], back, 3)))
                    block.append((text, branches, [(self.paths[at], node, hash((node, value))) for node in where]))
            found.append(block)
        return found

    def main_branches(self) -> frozenset[int]:
        """The branches named as noise, adverts apart, that hold more than half of the page's distinct text."""
        sizes: dict[int, dict[str, int]] = {ROOT: {}}
        for parts, _ in zip(self.parts(), self.blocks):
            for piece, branches, _ in parts:
                text = clean(piece)
                for branch in (ROOT, *branches):
                    sizes.setdefault(branch, {})[text] = len(text)
        total = sum(sizes[ROOT].values())
        return frozenset(b for b, own in sizes.items() if b not in (ROOT, ADVERT) and 2 * sum(own.values()) > total)

    def texts(self, noise: frozenset[int] = frozenset(), spared: frozenset[int] = frozenset()) -> list[str]:
        """The main text's blocks without what is noise at one of its nodes, or by a name that is not ``spared``."""
        gone = [
            {branches for _, branches, at in block if not noise.isdisjoint([x for _, _, x in at])} for block in self.nodes()
        ] if noise else [()] * len(self.blocks)
        found = []
        for parts, out in zip(self.parts(), gone):
            kept = [piece if branches not in out and spared.issuperset(branches) else " " for piece, branches, _ in parts]
            if text := clean("".join(kept)):
                found.append(text)
        return found


def clean(raw: str) -> str:
    return " ".join(raw.split())


@lru_cache(maxsize=8192)
def _sign_hash(sign: str) -> int:
    return digest(sign)


def site_nodes(pages: DataFrame) -> DataFrame:
    """``host, page, path, kind, value, size``, once per page, ``path`` being a node.

    Kinds: 0 the page itself, 1 a presentation style, 2 a content feature, 3 a text (and its length) in a branch that
    is named as noise, or on the host.  ``page`` is the same for pages of equal text; texts in named branches, as
    changing adverts, tell pages apart only for these branches.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                for host, source in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    page = Page(source)
                    found = set()
                    texts = [x for block in page.nodes() for x in block]
                    every = hash(tuple(at[0][2] for _, _, at in texts))
                    plain = hash(tuple(at[0][2] for _, branches, at in texts if not branches))
                    for text, branches, at in texts:
                        value, same = digest(text), every if branches else plain
                        found.add((0, ROOT, 3, value, len(text)))
                        for branch in set(branches) - {ADVERT}:
                            found.add((every, branch, 0, 0, 0))
                            found.add((every, branch, 3, value, len(text)))
                        for path, node, feature in at:
                            found.add((same, node, 0, 0, 0))
                            found.add((same, node, 2, feature, 0))
                            if node == path and path in page.children:
                                found.add((same, node, 1, digest(" ".join(page.children[path])), 0))
                    for row in found:
                        for column, v in zip(rows, (host, *row)):
                            column.append(v)
                types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(rows, types)], names=["host", "page", "path", "kind", "value", "size"]
                )

    return pages.filter(F.col("host").isNotNull()).select("host", "html").mapInArrow(
        run, "host string, page bigint, path bigint, kind int, value bigint, size bigint"
    )


def host_noise(pages: DataFrame, least: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, noise, spared, compared`` from each host's style tree.

    ``noise``: the repeated features of the nodes whose importance is below ``least``; ``spared``: the branches named
    as noise that have at least this importance and hold more than half of the host's distinct text; ``compared``:
    whether any node is on several distinct pages, so that importance can be told at all.
    """
    counted = site_nodes(pages).distinct().groupBy("host", "path", "kind", "value").agg(
        F.count("*").alias("n"), F.max("size").alias("size")
    )
    # sums from which both entropies follow: of n, of n ln n, and of ln n over the values
    node = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.sum(F.when(F.col("kind") == 1, F.col("n"))).alias("s"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.ln("n"))).alias("s_ln"),
        F.avg(F.when(F.col("kind") >= 2, F.ln("n"))).alias("c_ln"),
        F.sum(F.when(F.col("kind") == 3, F.col("size"))).alias("chars"),
        F.collect_list(F.when((F.col("kind") == 2) & (F.col("n") > 1), F.col("value"))).alias("repeated"),
    )
    presentation = F.coalesce(F.expr("(ln(s) - s_ln / s) / ln(m)"), F.lit(0.0))
    content = F.lit(1.0) - F.coalesce(F.expr("c_ln / ln(m)"), F.lit(0.0))
    known = F.col("m") >= max(2, min_pages)
    low = F.greatest(presentation, content) < least
    return (
        node.groupBy("host")
        .agg(
            F.flatten(F.collect_list(F.when(known & low & F.isnull("chars"), F.col("repeated")))).alias("noise"),
            F.collect_list(F.when(known & ~low & F.isnotnull("chars"), F.struct("path", "chars"))).alias("high"),
            F.max(F.when(F.col("path") == ROOT, F.col("chars"))).alias("total"),
            F.max("m").alias("most"),
        )
        .select(
            "host", "noise", F.expr("transform(filter(high, x -> 2 * x.chars > total), x -> x.path)").alias("spared"),
            (F.col("most") >= max(2, min_pages)).alias("compared"),
        )
    )


def main_text(pages: DataFrame, least: float = MIN_IMPORTANCE, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page.

    A null or empty html gives an empty text.  A null url, one without a host, and hosts of one distinct page have
    no style tree to compare with: roles of elements count, and a branch named as noise (adverts apart) stays if it
    holds more than half of the page's distinct text.  Repeated rows give repeated results; an empty table an empty one; other columns are
    not looked at.  Pages are read whole.
    """
    host = F.nullif(F.lower(F.regexp_extract("url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#\s]*)", 1)), F.lit(""))
    source = pages.select("page_id", "url", "html", host.alias("host"))
    tree = materialise(host_noise(source, least, min_pages), "style-tree")
    joined = source.join(tree, "host", "left").select("page_id", "url", "html", "noise", "spared", "compared")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = []
                for body, noise, spared, compared in zip(*(part.column(x).to_pylist() for x in ("html", "noise", "spared", "compared"))):
                    page = Page(body)
                    held = frozenset(spared or ()) if compared else page.main_branches()
                    texts.append("\n".join(page.texts(frozenset(noise or ()), held)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    ddl = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    return joined.mapInArrow(run, ddl)
