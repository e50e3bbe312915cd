"""Main text of web pages by consensus host paths.

Pass one scores each page's containers: the smallest container that holds
nearly all of the page's text outside boilerplate, widened to the ancestors
that add headlines, text of their own or further sections, gets the page's
vote under its path of tags and classes, generalised by replacing digits.
Spark sums, for each host and path, the votes and the pages that have such a
container with text in it. A path wins if half of the pages that have it vote
for it; one that most of them pass over (a comment area, a teaser) loses,
whatever single pages say. Pass two reads every page again. A page whose own
vote went to a winning path is extracted by it, so a rarer template keeps its
articles; one whose own vote lost takes all its containers on the host's
strongest winning paths, and only without any of them its own best container.

Sums are per (host, path), aggregated before the shuffle, so a host with a
third of all pages costs one row for each of its paths and task. What pass two
needs of a host (its strongest paths, the numbers of its losing ones) is
written to the shared folder; Spark broadcasts it only if its measured size is
below its threshold and otherwise joins by host and splits hot hosts.

Defined results: null or empty html gives an empty text; a null or malformed
url belongs to the host ``""``; repeated rows repeat and vote again; ties
between paths go to the longer, then the first in order; an empty table gives
an empty result; other columns are not read. The whole html is read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Container
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rill.llm.common import map_rows, schema
from rill.session import scratch_path

# Elements without content, of raw text, that end a block, that close themselves, never content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg select".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("article blockquote body center div main section table tbody td tr".split())
BOILERPLATE = frozenset("aside button dialog footer label menu nav".split())
# Boilerplate by their tag, unless they hold most of the text or (headers) stand in an article.
WRAPPERS = frozenset(["form", "header"])
SELF_CLOSING = {"p": ("p",), "li": ("li",), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p"), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",)}
# Names in class, id or role that mark boilerplate, alone or at the end of a joined name.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination pager popup promo promotion related reply replies respond search share sharing sidebar skip social "
    "sponsor sponsored subscribe toolbar widget widgets".split()
)
# Those that mark at the beginning of a joined name too; words that turn a name round.
LEADING = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies disqus "
    "navbar newsletter popup promo share sharing sidebar social sponsor sponsored widget widgets".split()
)
NEGATIONS = frozenset("no not with without has have hide hides hidden".split())
#: Never boilerplate by their names, and those whose id is often made from their headline.
UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6 p".split())
NAMED_BY_HEADLINE = frozenset(["section"])
#: A marked element with a greater share of the page's text is not boilerplate.
MOST = 0.75
#: Share of the page's text that a container must hold to be preferred to a larger one.
HOLDS = 0.95
#: Containers that say nothing of what they hold: beside the chosen one they count only with a headline or the same classes.
PLAIN = frozenset("center div td".split())
#: Share of the pages with a container that must vote for its path.
WINS = 0.5
#: Winning paths of a host that its other pages follow, and the least share of the host's votes of each.
PATHS_PER_HOST, LEAST_SHARE = 3, 0.1

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<([!?])[^>]*>|<(/?)([A-Za-z][^\s/>]*)""", re.S)
_END_OR_VALUE = re.compile(r""">|=\s*(["'])""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAMING = frozenset(["class", "id", "role"])
_MARK_WORD = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


class Place:
    """A step of a path: tag and classes, the place around it, and a number for the whole path."""

    __slots__ = ("step", "around", "number")

    def __init__(self, step: str, around: Place | None):
        self.step, self.around = step, around
        # as a signed long; chained, so that deep pages cost no more than their length
        self.number = xxhash.xxh64_intdigest(f"{around.number if around else 0}>{step}") - (1 << 63)

    @property
    def tag(self) -> str:
        return self.step.partition(".")[0]

    @property
    def path(self) -> str:
        steps, at = [], self
        while at is not None and at.around is not None:
            steps.append(at.step)
            at = at.around
        return "".join(f">{x}" for x in reversed(steps))


TOP = Place("", None)


def number_of(path: str) -> int:
    place = TOP
    for step in path.split(">")[1:]:
        place = Place(step, place)
    return place.number


@dataclass
class Node:
    """An open container: its place, and the pieces of text inside it."""

    place: Place
    first: int
    last: int = 0
    own: int = 0  # text outside links and outside the containers inside it
    parent: Node | None = None

    @property
    def path(self) -> str:
        return self.place.path


@dataclass
class Page:
    """Text pieces in page order (None ends a block) and the containers over them, the whole page first."""

    pieces: list[str | None] = field(default_factory=list)
    containers: list[Node] = field(default_factory=lambda: [Node(TOP, 0)])
    linked: set[int] = field(default_factory=set)  # pieces inside links
    headlines: list[int] = field(default_factory=list)  # where an h1 begins


def host_of(url: str | None) -> str:
    found = _HOST.match(url) if url else None
    return found[1].lower() if found else ""


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(re.sub(r"\d+", "#", c).replace(">", "") for c in attributes.get("class", "").lower().split())
    return ".".join([tag, *classes])


def _is_marked(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a name of the element marks boilerplate: ``sidebar``, ``site-footer``, ``ad-slot``, not ``no-sidebar``."""
    if tag == "p":  # a paragraph only by a class that is such a name and nothing else
        return not LEADING.isdisjoint(attributes.get("class", "").lower().split())
    if tag in UNMARKED:
        return False
    for key, value in attributes.items():
        if key == "id" and tag in NAMED_BY_HEADLINE:
            continue
        for name in value.lower().split():
            words = _MARK_WORD.findall(name)
            if words and (words[-1] in MARKS or words[0] in LEADING) and NEGATIONS.isdisjoint(words):
                return True
    return False


def _tag_end(source: str, at: int, ends: dict[int, int], last: dict[str, int]) -> int:
    """Where the tag whose attributes begin at ``at`` has its ``>``, outside quoted values of any length; -1 without one.

    A quote that is never closed does not count. ``ends`` remembers the ends
    found behind quoted values, as tags left open meet the same ones again.
    """
    passed, end = [], -1
    while at <= last[">"]:
        if at in ends:
            end = ends[at]
            break
        passed.append(at)
        found = _END_OR_VALUE.search(source, at)
        if found is None:
            break
        quote = found[1]
        if not quote:
            end = found.end() - 1
            break
        if found.end() > last[quote]:
            end = source.find(">", found.end())
            break
        at = source.index(quote, found.end()) + 1
    for place in passed:
        ends[place] = end
    return end


def _attributes(inside: str) -> dict[str, str]:
    """class, id and role; names inside the values of others do not count."""
    if not inside or inside.isspace():
        return {}
    out: dict[str, str] = {}
    for a in _ATTRIBUTE.finditer(inside):
        if (name := a[1].lower()) in _NAMING and (value := a[2] or a[3] or a[4]):
            out.setdefault(name, value)
    return out


def read_page(source: str) -> Page:
    """The page without boilerplate and raw elements.

    Marked elements that hold most of the text are read again as content, and
    all of them if nothing else is left.
    """
    page, marked, seen = _parse(source, frozenset())
    if spared := {n for n, size in enumerate(marked) if size > MOST * seen}:
        page, marked, _ = _parse(source, spared)
    if any(marked) and not any(p and p.strip() for p in page.pieces):
        page, _, _ = _parse(source, range(len(marked)))
    return page


def _parse(source: str, spared: Container[int]) -> tuple[Page, list[int], int]:
    """One tolerant pass over the markup: the page, the text of each marked element, and all text outside links.

    Marked elements, forms and headers are left out unless their number is in
    ``spared``; text in other elements that are boilerplate by their tag never counts.
    """
    page, marked, seen = Page(), [], 0
    # tag, place, container, in boilerplate by tag, in a marked element, in a link, in an article, number of the marked element
    stack: list[tuple[str, Place, Node | None, bool, bool, bool, bool, int]] = []
    path, never, skip, link, article, at = TOP, False, False, False, False, 0
    inner = root = page.containers[0]

    def close(upto: int) -> None:
        nonlocal path, never, skip, link, article, inner
        while len(stack) > upto:
            tag, path, node, never, skip, link, article, number = stack.pop()
            if number >= 0:
                marked[number] += seen
            if node is not None:
                node.last = len(page.pieces)
                inner = node.parent
            if tag in BLOCK:
                page.pieces.append(None)

    def text(piece: str) -> None:
        nonlocal seen
        if not piece or never:
            return
        piece = entities.unescape(piece)
        size = len(piece.strip())
        if not link:
            seen += size
        if skip:
            return
        if link:
            page.linked.add(len(page.pieces))
        else:
            inner.own += size
        page.pieces.append(piece)

    ends: dict[int, int] = {}
    last = {c: source.rfind(c) for c in ">\"'"}
    upto = 0
    while (m := _TAG.search(source, upto)) is not None:
        ending, name, inside, upto = m[2], m[3], "", m.end()
        if name is not None:
            end = _tag_end(source, upto, ends, last)
            if end < 0:
                continue
            inside, upto = source[upto:end], end + 1
        text(source[at:m.start()])
        at = upto
        if name is None:
            continue
        tag = name.lower()
        if ending:
            for n in range(len(stack) - 1, -1, -1):
                if stack[n][0] == tag:
                    close(n)
                    break
                if stack[n][0] in CONTAINER and tag not in CONTAINER and tag not in BOILERPLATE:
                    break  # a stray end tag does not close what stands around its container
            else:
                if tag in BLOCK:
                    page.pieces.append(None)
            continue
        if tag in RAW:
            if not inside.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                at = upto = end.end() if end else len(source)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                page.pieces.append(None)
            continue
        for n in range(len(stack) - 1, -1, -1):
            if stack[n][0] in SELF_CLOSING.get(tag, ()):
                close(n)
                break
            if stack[n][0] in BLOCK:
                break
        attributes = _attributes(inside)
        before, number = (path, never, skip, link, article), -1
        if tag in BLOCK:
            page.pieces.append(None)
        never = never or tag in BOILERPLATE
        wrapper = tag in WRAPPERS and not (tag == "header" and article)
        if not never and (wrapper or attributes and _is_marked(tag, attributes)):
            number = len(marked)
            marked.append(-seen)
            skip = skip or number not in spared
        link, article = link or tag == "a", article or tag == "article"
        node = None
        if tag in CONTAINER:
            path = Place(_step(tag, attributes), path)
            if not (never or skip):
                node = inner = Node(path, len(page.pieces), parent=inner)
                page.containers.append(node)
        if tag == "h1" and not (never or skip):
            page.headlines.append(len(page.pieces))
        stack.append((tag, before[0], node, *before[1:], number))
    if at < len(source):
        tail = source[at:]
        text(tail[:tail.rfind("<")] if re.search(r"<[A-Za-z/!]", tail[tail.rfind(">") + 1:]) else tail)
    close(0)
    root.last = len(page.pieces)
    return page, marked, seen


def text_of(pieces: list[str | None]) -> str:
    """Blocks in page order: white space inside one made single and trimmed, blocks joined by one space."""
    blocks, run = [], []
    for p in [*pieces, None]:
        if p is not None:
            run.append(p)
        elif run:
            if words := "".join(run).split():
                blocks.append(" ".join(words))
            run = []
    return " ".join(blocks)


def scores(page: Page) -> list[tuple[float, Node]]:
    """Text outside links of each container."""
    sizes = [0]
    for at, p in enumerate(page.pieces):
        sizes.append(sizes[-1] + (len(p.strip()) if p and at not in page.linked else 0))
    return [(sizes[c.last] - sizes[c.first], c) for c in page.containers]


def _widened(page: Page, node: Node, scored: list[tuple[float, Node]]) -> Node:
    """The outermost container around ``node`` that adds text of the same article.

    That is text directly in it, a container with a headline, one that is more
    than a plain ``div``, or one with the tag and classes of the part chosen.
    """
    beside: dict[int, list[Node]] = {}
    for s, c in scored:
        if s and c.parent is not None:
            beside.setdefault(id(c.parent), []).append(c)

    def belongs(c: Node, part: Node) -> bool:
        if c.place.number == part.place.number or c.place.tag not in PLAIN:
            return True
        behind = bisect_left(page.headlines, c.first)
        return behind < len(page.headlines) and page.headlines[behind] < c.last

    chosen = part = node
    while (around := part.parent) is not None:
        if around.own or any(c is not part and belongs(c, part) for c in beside.get(id(around), ())):
            chosen = around
        part = around
    return chosen


def best(page: Page) -> tuple[Node, float] | None:
    """The smallest container with ``HOLDS`` of the page's score, widened, and its score."""
    scored = scores(page)
    most = max((s for s, _ in scored), default=0)
    if not most:
        return None
    depths = {}
    for c in page.containers:  # the ones around come first
        depths[id(c)] = depths[id(c.parent)] + 1 if c.parent is not None else 0
    score, node = min(((s, c) for s, c in scored if s >= HOLDS * most), key=lambda x: (x[1].last - x[1].first, -x[1].first, -depths[id(x[1])]))
    node = _widened(page, node, scored)
    # a container inside an article stands for the article, headline included
    whole = [(s, c) for s, c in scored if c.first <= node.first and node.last <= c.last and c.place.tag == "article"]
    score, node = min(whole, key=lambda x: x[1].last - x[1].first, default=(next(s for s, c in scored if c is node), node))
    return node, float(score)


def extract(page: Page, paths: list[str] | None, losing: Container[int] = ()) -> str:
    """Text of the page's own best container, if its path wins, else of all containers on ``paths``.

    ``losing`` has the numbers of the host's losing paths. Without ``paths`` on
    the page its own best container counts.
    """
    own = best(page)
    wins = own is not None and own[0].place.around is not None and own[0].place.number not in losing
    wanted, upto, out = frozenset(map(number_of, paths or ())), -1, []
    for c in () if wins and own[0].place.number not in wanted else page.containers:
        if c.place.number in wanted and c.first >= upto:  # a container inside one already taken adds nothing
            out.append(text_of(page.pieces[c.first:c.last]))
            upto = c.last
    if joined := " ".join(filter(None, out)):
        return joined
    return text_of(page.pieces[own[0].first:own[0].last]) if own else text_of(page.pieces)


def votes(pages: DataFrame) -> DataFrame:
    """(host, number, path, votes, voters, holders) of every path with votes.

    ``votes`` are weighted by the log of the text; ``holders`` are the pages
    that have such a container with text outside links.
    """

    def make():
        import math

        def f(urls, sources):
            cast: dict[tuple[str, int], list] = {}
            for url, source in zip(urls, sources):
                page = read_page(source) if source else None
                own = best(page) if page else None
                if not own:
                    continue
                host = host_of(url)
                for number in {c.place.number for s, c in scores(page) if s and c.place.around is not None}:
                    cast.setdefault((host, number), ["", 0, 0, 0])[3] += 1
                if own[0].place.around is not None:  # text around all containers has no path to share
                    entry = cast[host, own[0].place.number]
                    # whole thousandths, so that sums do not depend on their order
                    entry[:3] = own[0].path, entry[1] + int(1000 * math.log1p(own[1])), entry[2] + 1
            return [(host, number, *entry) for (host, number), entry in cast.items()]

        return f

    cast = map_rows(pages.select("url", "html"), make, schema("host string,number long,path string,votes long,voters long,holders long"))
    summed = cast.groupBy("host", "number").agg(F.max("path").alias("path"), *(F.sum(c).alias(c) for c in ("votes", "voters", "holders")))
    return summed.where(F.col("voters") > 0)


def winners(pages: DataFrame) -> DataFrame:
    """(host, paths, losing): the strongest winning paths of each host, best first, and the numbers of its losing ones."""
    known = votes(pages).withColumn("wins", F.col("voters") >= WINS * F.col("holders"))
    w = Window.partitionBy("host", "wins")  # distinct paths of a host
    ranked = known.withColumn("share", F.col("votes") / F.sum("votes").over(w)).withColumn(
        "rank", F.row_number().over(w.orderBy(F.desc("votes"), F.desc(F.length("path")), "path"))
    )
    strong = F.col("wins") & ((F.col("rank") == 1) | ((F.col("rank") <= PATHS_PER_HOST) & (F.col("share") >= LEAST_SHARE)))
    return ranked.where(strong | ~F.col("wins")).groupBy("host").agg(
        F.transform(
            F.sort_array(F.collect_list(F.when(F.col("wins"), F.struct("rank", "path")))), lambda x: x["path"]
        ).alias("paths"),
        F.collect_list(F.when(~F.col("wins"), F.col("number"))).alias("losing"),
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "host-paths")
    winners(pages).withColumnRenamed("host", "llm_host").write.parquet(path)
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    known = pages.select("page_id", "url", "html").withColumn("host", host).join(
        spark.read.parquet(path), F.col("host") == F.col("llm_host"), "left"
    )

    def f(ids, urls, sources, paths, losing):
        out = []
        for i, url, source, p, numbers in zip(ids, urls, sources, paths, losing):
            text = extract(read_page(source), p, frozenset(numbers or ())) if source else ""
            out.append((i, url, text, len(text)))
        return out

    return map_rows(
        known.select("page_id", "url", "html", "paths", "losing"), lambda: f, schema("page_id long,url string,text string,n_chars long")
    )
