"""Main text of web pages by tag-path ratios.

A page is cut into blocks (runs of text between block-level tags), each with
its root-to-leaf tag path. All blocks of a path are judged together: by text
length and by punctuation per block, link text counting for nothing. Both
ratios are smoothed over the paths under the same parent, so that a heading is
carried by its paragraphs, then fused into one score; paths that reach a share
of the page's best score are content. Elements that say what they are (menus,
footers, adverts, notices, comments) are left out beforehand, and what an article
or main element holds goes before what stands outside. A form is judged by its
controls and its sentences, as some servers wrap whole pages in one.

Paths are nodes with a parent, and sums go from child to parent, so the work
grows with the page and not with the depth of its elements.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<[!?/][^>]*>"
    r"|<[a-z][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # also those of camelCase
PUNCTUATION = re.compile(r"[.,;:!?…。、،؛؟]")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var".split())
NOT_CONTENT = frozenset("nav footer aside button select option dialog menu head object audio video canvas map".split())
#: A class, id or role token that is one of these words names what isn't content; see `_labelled` for compounds.
LABELS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent notice notices alert "
    "comment comments responses replies disqus sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead "
    "complementary contentinfo search share sharing social related recommended newsletter subscribe subscription popup modal "
    "widget widgets toolbar pagination pager login signup hidden".split())
#: In "comment-list" or "ad-slot" the first word is the label, in "search-results" it isn't.
PARTS = frozenset(
    "area articles bar banner block box button buttons container form icon icons inner item items link links list menu nav news "
    "outer panel post posts section slot stories this topics unit us widget wrap wrapper".split())
#: What comes after these words doesn't matter.
ALWAYS = frozenset("advert advertisement comment comments consent cookie cookies disqus newsletter sponsored".split())
#: These words name a place too, which may hold the article itself.
PLACES = frozenset("search widget widgets".split())
#: In "has-sidebar" or "entry-header" the last word is no label.
STATES = frozenset("has have with no not without is js".split())
TITLED = frozenset("article content entry main page post section story title".split())
HEADS = frozenset(["header", "masthead"])
#: An opening tag on the left ends an open element on the right.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CONTROLS = frozenset("input button select".split())
MARKS = 4  # punctuation marks for each control, and as many more, from which a form is a wrapper
SHARE = 0.25  # of the best score


def _labelled(value: str, inside_main: bool) -> str:
    """The word by which a class, id or role names what isn't content, if any; words for places come last."""
    place = ""
    for token in value.split():
        words = [w.lower() for w in WORD.findall(token)]
        if not words:
            continue
        first, last = words[0], words[-1]
        if last in LABELS:
            if last in HEADS and (inside_main or first in TITLED) or len(words) > 1 and first in STATES:
                continue
            label = last
        elif first in LABELS and (first in ALWAYS or words[1] in PARTS) and not (inside_main and first in HEADS):
            label = first
        else:
            continue
        if label not in PLACES:
            return label
        place = label
    return place


def _unwanted(tag: str, rest: str, inside_main: bool) -> tuple[bool, bool]:
    """Whether an element isn't content for sure, and whether that depends on what it holds."""
    if tag in NOT_CONTENT or (tag == "header" and not inside_main):
        return True, False
    doubtful = tag == "form"
    if tag in ("html", "body", "main") or "=" not in rest and "hidden" not in rest.lower():
        return False, doubtful  # the page's frame is never labelled away
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and tag != "article" or name == "aria-hidden" and value.lower() == "true":
            return True, False
        if name == "style":
            if "display:none" in value.lower().replace(" ", ""):
                return True, False
        elif name in ("class", "id", "role"):
            label = _labelled(value, inside_main)
            if label and (label not in PLACES or tag in INLINE):
                return True, False
            doubtful = doubtful or bool(label)
    return False, doubtful


class Block(NamedTuple):
    path: int  # node of the tag path
    text: str
    linked: int  # characters in links
    inside: bool  # inside article or main


class Open(NamedTuple):
    """An open element, with what it has from those around it."""

    tag: str
    dead: bool  # from here on nothing counts
    inside: bool
    linked: bool
    path: int
    doubt: int  # the nearest element whose content decides about it
    block: int  # places in the stack of the nearest block element and paragraph
    paragraph: int


class Paths:
    """Tag paths as nodes; a node comes after its parent, node 0 is the page."""

    def __init__(self) -> None:
        self.parent, self.tag, self.known = [0], [""], {}

    def below(self, node: int, tag: str) -> int:
        found = self.known.get((node, tag))
        if found is None:
            found = self.known[node, tag] = len(self.tag)
            self.parent.append(node)
            self.tag.append(tag)
        return found


class Doubts:
    """Forms and labelled places: they are content if they wrap the article, or sentences rather than controls."""

    def __init__(self) -> None:
        self.parent, self.form, self.wraps, self.controls, self.marks = [0], [False], [True], [0], [0]

    def add(self, around: int, form: bool) -> int:
        for column, value in zip((self.parent, self.form, self.wraps, self.controls, self.marks), (around, form, False, 0, 0)):
            column.append(value)
        return len(self.parent) - 1

    def wrap(self, doubt: int) -> None:
        while not self.wraps[doubt]:
            self.wraps[doubt] = True
            doubt = self.parent[doubt]

    def settled(self) -> list[bool]:
        """For each element whether it and all around it stay."""
        for k in range(len(self.parent) - 1, 0, -1):
            self.controls[self.parent[k]] += self.controls[k]
            self.marks[self.parent[k]] += self.marks[k]
        stays = [True]
        for k in range(1, len(self.parent)):
            wraps = self.wraps[k] or self.form[k] and self.marks[k] > MARKS * (self.controls[k] + 1)
            stays.append(wraps and stays[self.parent[k]])
        return stays


def blocks(page: str) -> tuple[list[Block], Paths]:
    """The blocks in page order, without what names itself as no content, and the nodes of their paths."""
    out: list[tuple[int, Block]] = []
    paths, doubts, opened = Paths(), Doubts(), Counter()
    page_itself = Open("", False, False, False, 0, 0, -1, -1)
    stack: list[Open] = []
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", unescape("".join(parts))).strip()
            if text:
                at = stack[-1] if stack else page_itself
                doubts.marks[at.doubt] += len(PUNCTUATION.findall(text)) if linked < len(text) else 0
                out.append((at.doubt, Block(at.path, text, min(linked, len(text)), at.inside)))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1].dead):
            parts.append(text)
            if stack and stack[-1].linked:
                linked += len(text.strip())

    def cut(depth: int) -> None:
        if any(x.tag not in INLINE for x in stack[depth:]):
            flush()
        opened.subtract(x.tag for x in stack[depth:])
        del stack[depth:]

    place = 0
    for token in TOKEN.finditer(page):
        add(page[place : token.start()])
        place = token.end()
        tag = token["tag"]
        if tag is None:
            if stack and (token["raw"] or "").lower() == "textarea":
                doubts.controls[stack[-1].doubt] += 1
            continue
        tag = tag.lower()
        if tag == "br":
            add(" ")
        elif token["close"]:
            if opened[tag] > 0:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                cut(depth)
        else:
            rest = token["rest"]
            if tag not in INLINE:
                flush()
                if stack and stack[-1].paragraph >= 0:
                    cut(stack[-1].paragraph)
            while tag in ENDS and stack and stack[-1].block >= 0 and stack[stack[-1].block].tag in ENDS[tag]:
                cut(stack[-1].block)
            around = stack[-1] if stack else page_itself
            if tag in CONTROLS and "hidden" not in rest.lower():
                doubts.controls[around.doubt] += 1
            if tag not in VOID and not rest.endswith("/"):
                inside, doubt = around.inside or tag in ("article", "main"), around.doubt
                never, doubtful = _unwanted(tag, rest, inside)
                dead = around.dead or never
                if doubtful and not dead:
                    doubt = doubts.add(doubt, tag == "form")
                if tag in ("article", "main", "h1") and not dead:
                    doubts.wrap(doubt)
                inline = tag in INLINE
                stack.append(Open(
                    tag, dead, inside, around.linked or tag == "a", around.path if inline else paths.below(around.path, tag), doubt,
                    around.block if inline else len(stack), len(stack) if tag == "p" else around.paragraph))
                opened[tag] += 1
    add(page[place:])
    flush()
    stays = doubts.settled()
    return [x for doubt, x in out if stays[doubt]], paths


def _widened(front: tuple, total: list) -> tuple:
    """Mean length and punctuation of the elements around, without those that others exceed in both."""
    mean = total[1] / max(total[0], 1), total[2] / max(total[0], 1)
    if any(a >= mean[0] and b >= mean[1] for a, b in front):
        return front
    return (*((a, b) for a, b in front if a > mean[0] or b > mean[1]), mean)


def main_text(page: str) -> str:
    """The content blocks of one page, joined by line feeds."""
    found, paths = blocks(page)
    if any(b.inside for b in found):
        found = [b for b in found if b.inside]
    if not found:
        return ""
    nodes, parent, tag = range(len(paths.tag)), paths.parent, paths.tag
    count, length, marks = ([0] * len(nodes) for _ in range(3))
    for path, text, linked, _ in found:
        count[path] += 1
        length[path] += len(text) - linked
        marks[path] += len(PUNCTUATION.findall(text)) if linked < len(text) else 0
    beside = [[0, 0.0, 0.0] for _ in nodes]  # by parent: weight, and both ratios times weight
    below = [[0, 0.0, 0.0] for _ in nodes]  # the same over an element's whole subtree
    for x in reversed(nodes):
        own = (length[x], length[x] * length[x] / count[x], length[x] * marks[x] / count[x]) if count[x] else (0, 0.0, 0.0)
        for k in range(3):
            beside[parent[x]][k] += own[k]
            below[parent[x]][k] += own[k] + (below[x][k] if x else 0)
    # Without an article, the deepest element that holds most of the text; the page's frame is none.
    most = sum(length) / 2
    dense = max((x for x in nodes if below[x][0] > most), default=0)
    if tag[dense] in ("", "html", "body"):
        dense = -1
    score: dict[int, float] = {}
    main: list[tuple] = [()] * len(nodes)  # of the elements from the outermost article or main on
    held: list[tuple] = [()] * len(nodes)  # of those from the dense element on
    for x in nodes:
        around = parent[x]
        if count[x] and (length[x] or main[around] or tag[x] in ("article", "main")):
            n, own = count[x], beside[around]
            means = ((own[1] / max(own[0], 1), own[2] / max(own[0], 1)), *(main[around] or held[around]))
            score[x] = max((length[x] / n + a) / 2 * (1 + (marks[x] / n + b) / 2) for a, b in means) ** 0.5
        if x and (main[around] or tag[x] in ("article", "main")):
            main[x] = _widened(main[around], below[x])
        if x == dense or x and held[around]:
            held[x] = _widened(held[around], below[x])
    least = SHARE * max(score.values(), default=0.0)
    # In an article of links alone nothing scores, and nothing is dropped.
    return "\n".join([b.text for b in found if b.path in score and score[b.path] >= least and (score[b.path] > 0 or b.inside)])


def _extract_batches(batches):
    for batch in batches:
        pages = batch.column("html").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array([main_text(p or "") for p in pages], pa.string())],
            ["page_id", "url", "text"])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: one row per input row, from the whole page.

    Character references are decoded, white space in a block becomes one blank,
    blocks follow in page order with one line feed between. Nothing else is
    dropped or cut. A null, empty or content-free page has the empty text; text
    without any markup is one block. Null ids and addresses stay null, repeated
    rows each give a row, an empty table none. Other columns are ignored.
    """
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                      F.col(html_col).cast("string").alias("html"))
    return pages.mapInArrow(_extract_batches, "page_id long, url string, text string")
