"""Main text of web pages by consensus of the pages of a host.

Each page scores its containers. Per host, the generalised tag-class path of each page's best container is a vote;
the path with most votes wins, and all pages of the host are read again along it. A page without that path uses its
own best container. On each page that is widened to what stands around it, unless that is boilerplate.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import stage

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*>",
    re.DOTALL,  # the last form also passes over a tag whose quotes don't close
)
NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template iframe svg annotation annotation-xml object canvas audio video select textarea".split())
#: End of the attributes of a self-closed element; behind a value without quotes the slash is part of the value.
SELF_CLOSED = re.compile(r"""(?<!\S)/$|["']/$|^/$|(?<!\S)[^\s=/]+/$""")
#: Elements that are never part of the main text.
OUTSIDE = RAW | frozenset("head nav header footer aside form button dialog menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder "
    "munderover mstyle mspace".split()
)
CONTAINERS = frozenset("article main section div body td".split())
#: Words of class, id and role names that mark content outside the main text ...
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "contentinfo cookie cookies consent discussion disqus footer header login menu modal nav navbar navigation "
    "newsletter notice notices notification alert pager pagination popup promo promos promoted recommended related "
    "replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "widget widgets".split()
)
#: ... unless the same name has one of these, as in ``no-sidebar``.
HARMLESS = frozenset("with without no has open closed enabled disabled".split())
NAME_PARTS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
IMPLIED_END = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}


@lru_cache(maxsize=4096)
def noisy(names: str) -> bool:
    for name in names.lower().split():
        parts = set(NAME_PARTS.findall(name))
        if parts & NOISE and not parts & HARMLESS:
            return True
    return False


class Container:
    """An open or closed container: its path, the numbers of its blocks, and what speaks for it."""

    __slots__ = ("path", "first", "last", "depth", "text", "linked", "blocks")

    def __init__(self, path: str, first: int, depth: int):
        self.path, self.first, self.last, self.depth = path, first, None, depth
        self.text = self.linked = self.blocks = 0


class Page:
    """One pass over a page: its blocks of text outside the boilerplate, and its containers.

    Broken markup is read as far as it goes: unknown end tags are ignored, open elements end with the page.
    """

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.holders: list[tuple[Container | None, int]] = []  # of each block: innermost container, linked characters
        self.containers: list[Container] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        stack: list[tuple[str, str, Container | None, bool]] = []  # tag, path, container, outside
        self.open: list[Container] = []
        hidden, place, end = 0, 0, len(source)
        while place < end:
            found = TOKEN.search(source, place)
            stop = found.start() if found else end
            if not hidden and stop > place:
                self.text(source[place:stop])
            if not found:
                break
            place, (closing, tag, attributes) = found.end(), found.group(1, 2, 3)
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if tag == "a":
                    self.links = max(0, self.links - 1)
                if not any(s[0] == tag for s in stack):
                    if tag == "p" and not hidden:
                        self.close_block()
                    continue
                while stack:
                    name, _, container, outside = stack.pop()
                    hidden -= outside
                    self.leave(name, container)
                    if name == tag:
                        break
                continue
            if tag == "br" or tag == "hr" or tag in VOID:
                if not hidden:
                    self.close_block() if tag == "hr" else self.parts.append(" ")
                continue
            names = " ".join(x for m in NAMED.findall(attributes) for x in m[1:] if x) if attributes else ""
            outside = tag in OUTSIDE or (bool(names) and tag not in ("html", "body") and noisy(names))
            if tag in RAW:
                if tag == "svg" and SELF_CLOSED.search(attributes):
                    continue
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(source, place)
                place = close.end() if close else end
                continue
            if tag in INLINE and not outside:
                self.links += tag == "a"
                continue
            if tag not in INLINE:
                if not hidden:
                    self.close_block()
                if stack and (stack[-1][0] == "p" or stack[-1][0] in IMPLIED_END.get(tag, ())):
                    name, _, container, was_outside = stack.pop()
                    hidden -= was_outside
                    self.leave(name, container)
            path = f"{stack[-1][1] if stack else ''}/{tag}{generalised(names)}"
            container = None
            if tag in CONTAINERS and not hidden and not outside:
                container = Container(path, len(self.blocks), len(stack))
                self.containers.append(container)
                self.open.append(container)
            hidden += outside
            stack.append((tag, path, container, outside))
        self.close_block()
        for container in self.open:
            container.last = len(self.blocks)

    def text(self, raw: str) -> None:
        self.parts.append(raw)
        if self.links:
            self.linked += len(raw)

    def close_block(self) -> None:
        if self.parts:
            block = " ".join(entities.unescape("".join(self.parts)).split())
            self.parts = []
            if block:
                self.blocks.append(block)
                self.holders.append((self.open[-1] if self.open else None, self.linked))
                for container in self.open:
                    container.text += len(block)
                    container.linked += self.linked
                    container.blocks += 1
        self.linked = 0

    def leave(self, tag: str, container: Container | None) -> None:
        if tag not in INLINE:
            self.close_block()
        if container is not None:
            container.last = len(self.blocks)
            self.open.remove(container)

    def best(self) -> Container | None:
        """The deepest container that still holds most of the page's unlinked text; semantic tags count double."""
        whole = max((c.text - c.linked for c in self.containers), default=0)
        if whole <= 0:
            return None

        def score(c: Container) -> tuple:
            own = c.text - c.linked
            semantic = re.search(r"/(article|main)[^/]*$", c.path) is not None
            return (own * 2 >= whole, semantic, c.depth if own * 10 >= whole * 9 or semantic else -c.depth, own)

        return max(self.containers, key=score)

    def along(self, path: str) -> list[str] | None:
        """Blocks of all containers at ``path`` and of what they are widened to, in page order; None if there is no such
        container."""
        found = [c for c in self.containers if c.path == path]
        if not found:
            return None
        numbers = {k for c in found for k in range(c.first, c.last)}
        return [self.blocks[k] for k in sorted(self.widened(numbers))]

    def widened(self, numbers: set[int]) -> set[int]:
        """``numbers`` of blocks and all others of the outermost container around them that adds no boilerplate.

        What it adds is boilerplate if links are more than half of it, or if it stands beside them in a container of
        its own directly in the body, as page columns do.
        """
        if not numbers:
            return numbers
        low, high = min(numbers), max(numbers)
        around = [c for c in self.containers if c.first <= low and high < c.last]
        for c in sorted(around, key=lambda c: c.depth):
            more = [k for k in range(c.first, c.last) if k not in numbers]
            text, linked = sum(len(self.blocks[k]) for k in more), sum(self.holders[k][1] for k in more)
            whole = c.path.rpartition("/")[2].partition(".")[0] != "body"
            if 2 * linked <= text and (whole or all(self.holders[k][0] in around for k in more)):
                return numbers.union(more)
        return numbers


def generalised(names: str) -> str:
    """Class, id and role names without digits, sorted: ``.post.post-#`` for each ``post post-17``."""
    return "".join(f".{n}" for n in sorted({DIGITS.sub("#", n.lower()) for n in names.split()}))


def host_column(url: str = "url"):
    lowered = F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1), UPPER, UPPER.lower())
    return lowered


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def votes(pages: DataFrame) -> DataFrame:
    """(host, path, chars) of each page's best container. Pages without text give no vote."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, chars = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if (best := Page(source.as_py()).best()) is not None:
                    hosts.append(host)
                    paths.append(best.path)
                    chars.append(best.text - best.linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(chars, pa.int64())],
                names=["host", "path", "chars"],
            )

    rows = pages.select(host_column().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "host string, path string, chars long")


def consensus(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host; among equals the one with more text, then the least path."""
    counted = votes(pages).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    ranked = F.struct(-F.col("n"), -F.col("chars"), F.col("path").alias("path"))
    return counted.groupBy("host").agg(F.min(ranked).alias("top")).select("host", F.col("top.path").alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of each row of ``pages`` (page_id, url, html): the blocks of the main text, one a line,
    with title, lead and sections around the winning container (see Page.widened).

    Left out everywhere: RAW and OUTSIDE elements and those whose class, id or role names have a NOISE word. Character
    references are decoded, white space inside a block becomes one space, line breaks inside a block are white space.
    A null html is an empty page, and a page without text has the empty text. Null addresses and those without a host
    share the host ''. Repeated rows vote and are read each. An empty table gives no rows; other columns are not read.
    A host with a third of the pages is counted before the shuffle; pages meet their host's path in a join that
    broadcasts the paths while they are few and else splits large hosts.
    """
    winners = stage(consensus(pages), "host-paths")
    rows = pages.select("page_id", "url", host_column().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    joined = rows.join(winners, "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source, path in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                page = Page(source.as_py())
                blocks = page.along(path) if path is not None else None
                if not blocks:
                    best = page.best()
                    blocks = page.along(best.path) if best is not None else page.blocks
                texts.append("\n".join(blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
