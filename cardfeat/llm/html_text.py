"""Main text of web pages by tag-path ratios.

A page becomes a list of text blocks, each with the path of block elements from
the root (names, classes and ids). For every path the characters and the
punctuation marks per block are taken, smoothed over neighbouring blocks, fused
with the share of text outside links, and compared with the best path of the
page. Elements that by name, role or class hold menus, adverts, notices, forms,
comments and the like weigh nothing. Short paragraphs and headings share the
ratio of the path with most text beside them. Where a page marks an article or
main part, ratios inside count twice, and the path with most text is looked for
there, unless the text beside the marks is much longer: then a marked teaser is
a block like any other. All other paths, inside and outside, are judged by ratio.

White space inside a block, line-break elements included, becomes one space.
Null and empty pages have an empty text; broken markup is read as browsers do
for paragraphs, list items and table cells. Rows are read one by one, so
repeated rows get equal results. An empty table gives an empty result. A page takes
time and memory in proportion to its length, however deep its elements are nested or
how many are never closed.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.tables import small_batches

#: A path is content if its fused ratio reaches this share of the page's best.
THRESHOLD = 0.25
#: A block with this share of its text in links has a path of its own, which ends in the link.
LINKED = 0.6
#: Ratios and text of a marked article or main part count so many times.
MARKED = 2
#: Characters that a mark counts for at least, so that a stray line does not replace an empty article.
LEAST_MARKED = 140
#: Weights of a block and its neighbours when ratios are smoothed.
SMOOTHING = {0: 0.6, 1: 0.2}

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math object canvas audio video select".split())
BLOCK = frozenset(
    "html head body article main section nav aside header footer address div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "blockquote pre table caption thead tbody tfoot tr td th figure figcaption form fieldset legend details summary "
    "hr center menu dialog hgroup search option optgroup button label".split()
)
#: Elements that a start tag of the key closes, and those that shield an outer one from it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Start tags that end an open paragraph.
ENDS_PARAGRAPH = BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "button", "label", "legend"}

#: Elements without main text.
ASIDE_TAGS = frozenset("head nav aside header footer form menu dialog button label fieldset search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar status note".split())
#: Parts of class names and ids that mark such elements, as whole words and as parts of words.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner billboard breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies copyright disclaimer disqus dropdown footer gdpr header legal login masthead menu modal nav navbar navigation newsletter notice "
    "notification notifications outbrain pager pagination paywall popup promo promos promotion promoted recommended related replies reply "
    "respond search share sharebar sharing side sidebar signin signup skip social sponsor sponsored sponsors subscribe subscription taboola "
    "tags teaser toc toolbar tracking warning widget widgets".split()
)
_ASIDE_PART = re.compile("comment|sidebar|footer|navbar|cookie|advert|sponsor|newsletter|breadcrumb|masthead|popup|subscri|topnav|mainmenu|submenu")
_ARTICLE_ASIDE = re.compile(r"comment|repl(?:y|ies)|teaser|related|promo|sponsor|advert|\bads?\b")
#: Names of elements whose articles are none of the page's own; other names may stand for the layout around it.
_FIRM = re.compile(_ARTICLE_ASIDE.pattern + "|disqus|respond|recommend|sidebar|footer|widget|popup|modal|cookie")
#: Tags that stay with the paragraphs beside them.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption section details summary".split())

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Paths:
    """Paths of block elements as numbers: a path is its parent's number and one step more; 0 is the empty path."""

    def __init__(self) -> None:
        self.parent, self.step, self.depth = [0], [""], [0]
        self._known: dict[tuple[int, str], int] = {}

    def child(self, path: int, step: str) -> int:
        found = self._known.get((path, step))
        if found is None:
            found = self._known[path, step] = len(self.parent)
            self.parent.append(path)
            self.step.append(step)
            self.depth.append(self.depth[path] + 1)
        return found

    def tag(self, path: int) -> str:
        return self.step[path].split(".")[0]

    def ranks(self) -> list[int]:
        """The place of each path in the order of their steps, a path before its continuations."""
        below: list[list[int]] = [[] for _ in self.parent]
        for path in range(1, len(self.parent)):
            below[self.parent[path]].append(path)
        rank, todo, place = [0] * len(self.parent), [0], 0
        while todo:
            path = todo.pop()
            rank[path], place = place, place + 1
            todo += sorted(below[path], key=lambda p: self.step[p], reverse=True)
        return rank


@dataclass
class Block:
    path: int
    text: str
    linked: int  #: characters inside links
    aside: bool  #: inside an element without main text
    marked: bool  #: inside the article or main part
    depth: int  #: steps of the path down to the outermost mark, if marked


@dataclass
class Frame:
    """An open element."""

    tag: str
    path: int  #: of the block elements down to here
    aside: int
    marked: bool
    link: bool
    depth: int  #: steps down to the outermost mark, if marked


class Open:
    """The open elements, with the places of each tag and of block elements among them."""

    def __init__(self) -> None:
        self.frames = [Frame("", 0, 0, False, False, 0)]
        self._places: dict[str, list[int]] = defaultdict(list)
        self._blocks: list[int] = []

    @property
    def top(self) -> Frame:
        return self.frames[-1]

    def last(self, tags: Iterable[str]) -> int:
        """The place of the innermost of these elements, 0 if none is open."""
        return max((self._places[t][-1] for t in tags if self._places.get(t)), default=0)

    @property
    def last_block(self) -> int:
        return self._blocks[-1] if self._blocks else 0

    def push(self, frame: Frame) -> None:
        self._places[frame.tag].append(len(self.frames))
        if frame.tag in BLOCK:
            self._blocks.append(len(self.frames))
        self.frames.append(frame)

    def drop(self, place: int) -> None:
        """Close all elements from this place on."""
        while len(self.frames) > place:
            frame = self.frames.pop()
            self._places[frame.tag].pop()
            if frame.tag in BLOCK:
                self._blocks.pop()


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _is_aside(tag: str, attributes: dict[str, str]) -> int:
    """0, 1 if a name marks the element as aside but an article in it may be the page's, 2 if nothing in it may."""
    if tag in ("html", "body"):
        return 0
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    if tag in ("article", "main"):
        return 2 if tag == "article" and _ARTICLE_ASIDE.search(names) else 0
    if tag in ASIDE_TAGS or attributes.get("role", "").lower() in ASIDE_ROLES:
        return 2
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return 2
    found = 0
    for name in names.split():
        words = re.split(r"[^a-z0-9]+", name)
        if words[0] in ("has", "with", "no", "without", "is"):  # says something of other elements
            continue
        if ASIDE_WORDS.intersection(words) or _ASIDE_PART.search(name):
            found = max(found, 2 if _FIRM.search(name) else 1)
    return found


def _is_marked(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"


def blocks(page: str) -> tuple[list[Block], bool, Paths]:
    """Text blocks in page order, whether the page marks an article or main part, and the paths."""
    found: list[Block] = []
    paths, stack = Paths(), Open()
    pieces: list[str] = []
    linked = 0
    any_marked = False

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                top = stack.top
                path = paths.child(top.path, "a") if linked >= LINKED * len(text) else top.path
                found.append(Block(path, text, linked, top.aside > 0, top.marked, top.depth))
            pieces, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            pieces.append(text)
            if stack.top.link:
                linked += len(text)

    def close(place: int) -> None:
        if stack.last_block >= place:
            flush()
        stack.drop(place)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            place = stack.last((tag,))
            # an inline end tag does not close a block
            if place and (tag in BLOCK or place > stack.last_block):
                close(place)
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = ended.end() if ended else end
            continue
        if tag in BLOCK:
            flush()
        if tag in ENDS_PARAGRAPH and 0 < stack.last_block == stack.last(("p",)):
            close(stack.last_block)
        if tag in CLOSES:
            closed, shields = CLOSES[tag]
            while (place := stack.last(closed)) > stack.last(shields):
                close(place)
                if tag != "tr":
                    break
        attributes = _attributes(m[3]) if m[3].strip() else {}
        top = stack.top
        own, here_marked = _is_aside(tag, attributes), _is_marked(tag, attributes)
        here_aside = own if here_marked and top.aside < 2 else max(top.aside, own)
        here_marked = here_marked and not here_aside
        any_marked |= here_marked
        step = None
        if tag in BLOCK:
            names = " ".join(filter(None, (attributes.get("class"), attributes.get("id")))).lower()
            step = tag + ("." + re.sub(r"\d+", "", names) if names else "")
        if here_marked and tag not in ("article", "main"):  # its path differs from that of a like element without mark
            step = (step or tag) + ".(main)"
        path = paths.child(top.path, step) if step else top.path
        depth = top.depth if top.marked else paths.depth[path] if here_marked else 0
        stack.push(Frame(tag, path, here_aside, top.marked or here_marked, top.link or tag == "a", depth))
    flush()
    return found, any_marked, paths


def fused_ratios(found: list[Block]) -> dict[int, float]:
    """Smoothed and fused ratio of every path."""
    chars, marks, links, count = (defaultdict(float) for _ in range(4))
    for b in found:
        chars[b.path] += len(b.text)
        marks[b.path] += len(_PUNCTUATION.findall(b.text))
        links[b.path] += min(b.linked, len(b.text))
        count[b.path] += 1
    text_ratio = [chars[b.path] / count[b.path] for b in found]
    mark_ratio = [marks[b.path] / count[b.path] for b in found]

    def smooth(values: list[float], i: int) -> float:
        total = weight = 0.0
        for distance, w in SMOOTHING.items():
            for j in {i - distance, i + distance}:
                if 0 <= j < len(values) and (found[j].aside, found[j].marked) == (found[i].aside, found[i].marked):
                    total += w * values[j]
                    weight += w
        return total / weight

    fused: dict[int, float] = defaultdict(float)
    for i, b in enumerate(found):
        value = smooth(text_ratio, i) * (1 + math.log1p(smooth(mark_ratio, i)))
        fused[b.path] += value * (1 - links[b.path] / chars[b.path]) / count[b.path]
    return fused


def _column(tree: Paths, lead: int, paths: Iterable[int], depth: int | None = None) -> list[int]:
    """The paths of blocks beside the paragraphs of ``lead``; with the depth of a mark also those between both."""
    inside = tree.parent[lead] if tree.tag(lead) in FLOW else lead
    while tree.tag(inside) in FLOW - {"section"}:
        inside = tree.parent[inside]
    # how far each path runs along ``inside``, and whether all its further steps stay with paragraphs
    common = [-1] * len(tree.parent)
    flows = [True] * len(tree.parent)
    path = inside
    while common[path] < 0:
        common[path] = tree.depth[path]
        path = tree.parent[path]
    for path in range(1, len(common)):
        if common[path] < 0:
            above = tree.parent[path]
            common[path] = common[above]
            flows[path] = flows[above] and tree.tag(path) in FLOW
    wanted = tree.depth[inside] if depth is None else min(depth, tree.depth[inside])
    out = [lead]
    for p in paths:
        last = p
        if depth is None:
            beside = common[p] == wanted and tree.depth[p] > common[p]
        else:
            beside = common[p] >= wanted
            if tree.depth[p] > max(common[p], 1) and tree.step[p] == "a" and tree.tag(tree.parent[p]) in _HEADINGS:
                last = tree.parent[p]  # a headline that links to its own page
        if p != lead and beside and flows[last]:
            out.append(p)
    return out


def main_blocks(page: str) -> list[str]:
    """Texts of the content blocks of a page, in page order."""
    found, any_marked, tree = blocks(page)
    weighed = [b for b in found if not b.aside]
    if not weighed:
        return []
    ratio = fused_ratios(weighed)
    depths = {b.path: b.depth for b in weighed if b.marked}
    size: dict[int, float] = defaultdict(float)
    text: dict[int, int] = defaultdict(int)  # characters outside links
    for b in weighed:
        size[b.path] += len(b.text) * ratio[b.path]
        text[b.path] += max(len(b.text) - b.linked, 0)
    for p in depths:
        ratio[p] *= MARKED

    def lead_of(paths: list[int]) -> int | None:
        most = max((size[p] for p in paths), default=None)
        best = [p for p in paths if size[p] == most]
        return max(best, key=tree.ranks().__getitem__) if len(best) > 1 else next(iter(best), None)

    beside = [p for p in ratio if p not in depths]
    lead = lead_of(beside)
    column = _column(tree, lead, beside) if lead is not None else []
    if any_marked and sum(text[p] for p in column) <= MARKED * max(sum(text[p] for p in depths), LEAST_MARKED):
        lead = lead_of(list(depths))
        if lead is None:  # the article is empty
            return []
        column = _column(tree, lead, depths, depths[lead])
    # blocks beside the paragraphs of the path with most text share its ratio
    # (a marked column shares the best one of the page: what is longer elsewhere does not replace it)
    floor = max(ratio.values()) if lead in depths else ratio[lead]
    for p in column:
        ratio[p] = max(ratio[p], floor)
    limit = THRESHOLD * max(ratio.values())
    return [b.text for b in weighed if ratio[b.path] >= limit]


def main_text(page: str | None) -> str:
    return "\n".join(main_blocks(page)) if page else ""


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and its length ``n_chars`` in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = small_batches(pages).select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(source).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
