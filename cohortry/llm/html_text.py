"""Main text of web pages by minimum cut.

A page is cut into blocks of text at block-level tags.  A logistic classifier
gives each block the costs of calling it content and of calling it boilerplate;
they become the capacities to the two terminals.  Neighbouring blocks, and the
next block below the same parent, are joined by edges that are the stronger the
nearer the two are in the document tree.  The minimum cut is the labelling with
the least sum of costs and of cut edges, and the blocks on the content side make
the text.

The classifier starts from stated weights and is fitted to a bounded sample of
pages (``SAMPLE_PAGES`` different ones of at most ``SAMPLE_CHARS`` characters, by hash), where
blocks below article or main, and blocks below nav, footer and the like, are taken
as labelled; the stated weights are its prior, so what the sample does not show
keeps them.  An element that holds most of the page sets nothing apart.

Rows: a null or empty page, or one without text, has an empty text; whole pages
are read, whatever their length; broken markup is read as it comes: unclosed
elements end with their parent, and skipped ones without an end tag in it at the
first block before that; script, style, title, textarea and iframe hold no markup
and end with their tag or the page; unknown tags are plain inline ones; repeated
rows and null urls change nothing; other columns are ignored; an empty table gives an
empty result and leaves the classifier at its stated weights.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.llm.tokens import text_runs

SAMPLE_PAGES = 400
SAMPLE_CHARS = 100_000

# Elements whose content is no text of the page.
SKIPPED = frozenset(
    "script style head title template noscript iframe object svg math canvas audio video "
    "select textarea button datalist".split()
)
# Those of them that hold no markup, so that only the end tag ends them.
RAW = frozenset("script style title textarea iframe".split())
# Those that hold markup; their parent's end ends them too.
NESTED = SKIPPED - RAW - {"head"}
# Elements whose raw parts are markup as well.
FOREIGN = frozenset("svg math".split())
# Blocks that an unclosed skipped element may hold.
CHOICES = frozenset("option optgroup".split())
# Elements that a start tag of the same name ends.
NOT_IN_ITSELF = frozenset("button select".split())
# Elements that start and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("hr br img input meta link wbr area base col embed source track".split())
# A start tag of the first kind ends an open element of the second.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
# Elements that an end tag, or an implied end, does not reach beyond.
FENCES = frozenset("table ul ol dl body html article section main div".split())

APART = frozenset("nav footer aside form menu dialog search header".split())
INSIDE = frozenset("article main".split())
# Words in class, id or role that tell of parts around the text.
APART_WORDS = frozenset(
    "nav navbar navigation menu footer foot header masthead sidebar side aside widget comment "
    "comments commentlist reply replies respond disqus ad ads adv advert adverts advertisement "
    "adsense sponsor sponsored banner promo promotion cookie cookies consent gdpr notice notices "
    "alert newsletter subscribe subscription signup social share sharing related recommend "
    "recommended recommendations breadcrumb breadcrumbs pagination pager popup modal overlay "
    "dialog login search toolbar skip tags popular trending copyright legal disclaimer "
    "contentinfo complementary".split()
)
# Those of them that tell of texts by others, or of other texts.
OTHER_VOICES = frozenset(
    "comment comments commentlist reply replies respond disqus related recommend recommended "
    "recommendations popular trending legal disclaimer copyright cookie cookies consent gdpr".split()
)
INSIDE_WORDS = frozenset(
    "article content contents main story post entry text body page prose".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_MARK = re.compile(
    r"\b(class|id|role|style|aria-hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I
)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_CSS_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
# Names that tell of a part elsewhere, or of none: no-sidebar, has-header, withAds.
_ABOUT = re.compile(r"\b(?:no|not|has|with|without)(?:[-_]|(?=[A-Z]))[A-Za-z0-9_]+")
_NOTICE = re.compile(r"©|\ball rights reserved\b|\bcookies?\b.{0,40}\b(?:use|accept|consent)", re.I)

# The classifier's stated weights.
WEIGHTS = {
    "constant": -0.5,
    "apart": -7.0,
    "inside": 3.0,
    "apart_word": -8.0,
    "inside_word": 1.5,
    "links": -4.0,
    "log_words": 0.7,
    "sentence": 0.8,
    "heading": 0.5,
    "paragraph": 1.0,
    "short": -0.7,
    "hidden": -8.0,
    "notice": -3.0,
}
# How firmly the sample is kept to the stated weights.
PRIOR = 1.0
# Edge capacities: below the same parent, and otherwise per step up the tree.
SAME_PARENT, FADING = 0.8, 0.5
# Where only one of the two is set apart.
ACROSS = 0.05
# An element that holds more than this share of the page's unlinked text sets nothing
# apart: a form, or one whose words name parts of the layout.
MOST_OF_FORM, MOST_OF_LAYOUT = 0.5, 0.8
# Costs are bounded, so that one feature can't outweigh all neighbours by far.
MOST_COST = 12.0


@dataclass
class _Element:
    name: str
    number: int
    apart: bool
    inside: bool
    apart_word: bool
    inside_word: bool
    hidden: bool
    parent: _Element | None = None
    # What its own name and words say; whether it may turn out to hold the page.
    own_apart: bool = False
    own_apart_word: bool = False
    holds: bool = False


@dataclass
class Block:
    text: str
    linked: int
    path: tuple[int, ...]
    element: _Element


def _opened(name: str, attributes: str, number: int, parent: _Element) -> _Element:
    words: set[str] = set()
    hidden = False
    if attributes:
        for key, a, b, c in _MARK.findall(attributes):
            key, value = key.lower(), a or b or c
            if key == "style":
                hidden |= bool(_CSS_HIDDEN.search(value))
            elif key == "aria-hidden":
                hidden |= value.lower() == "true"
            else:
                words.update(w.lower() for w in _NAME_WORD.findall(_ABOUT.sub(" ", value)))
        hidden |= bool(_HIDDEN.search(attributes))
    inside = parent.inside or name in INSIDE or "main" in words
    own_inside_word = bool(words & INSIDE_WORDS)
    # A heading part of the article itself holds its title.
    title_part = own_inside_word and words & APART_WORDS <= {"header", "tags"}
    own_apart = name in APART and not (name == "header" and inside)
    own_apart_word = bool(words & APART_WORDS) and not title_part and name not in ("body", "html")
    return _Element(
        name, number, parent.apart or own_apart, inside, parent.apart_word or own_apart_word,
        parent.inside_word or own_inside_word, parent.hidden or hidden, parent, own_apart, own_apart_word,
        name == "form" or (own_apart_word and words.isdisjoint(OTHER_VOICES)),
    )


def _release(found: list[Block]) -> None:
    """Let an element that holds most of the page set nothing apart.

    Some pages lie in one form, or in an element whose class names the parts of the
    layout.  What holds other voices than the article's, such as comments, stays apart
    however long it is.
    """
    if not any(b.element.apart or b.element.apart_word for b in found):
        return
    total, below, known = 0, {}, {}
    for block in found:
        plain = len(block.text) - block.linked
        total += plain
        e = block.element
        while e is not None:
            below[e.number] = below.get(e.number, 0) + plain
            known[e.number] = e
            e = e.parent
    for number in sorted(known):
        e = known[number]
        share = below[number] / total if total else 0.0
        own_apart = e.own_apart and not (e.name == "form" and share > MOST_OF_FORM)
        own_word = e.own_apart_word and not (e.holds and share > MOST_OF_LAYOUT)
        e.apart = own_apart or (e.parent is not None and e.parent.apart)
        e.apart_word = own_word or (e.parent is not None and e.parent.apart_word)


_NESTED_START = re.compile(rf"<(?:{'|'.join(sorted(NESTED))})(?=[\s/>])", re.I)


def _ends_at_once(attributes: str) -> bool:
    return attributes.rstrip().endswith("/")


def _end_tag(*names: str) -> re.Pattern[str]:
    return re.compile(rf"</(?P<name>{'|'.join(names)})(?:\s[^>]*|/)?>", re.I)


_ENDS = {
    (name, foreign): _end_tag(name, *sorted(FOREIGN)) if foreign else _end_tag(name)
    for name in RAW | {"head"} for foreign in (False, True)
}


def _after_skipped(page: str, name: str, at: int, foreign: bool, gone: set[str]) -> int:
    """Where the page goes on after the start tag of a raw element or head.

    That is right there if it holds markup after all.  ``gone`` collects the names
    without a further end tag.
    """
    if name not in gone:
        found = _ENDS[name, foreign].search(page, at)
        if found is not None:
            return found.end() if found.group("name").lower() == name else at
        gone.add(name)
    return at if foreign or name == "head" else len(page)


def closed_elements(page: str) -> dict[int, int]:
    """NESTED elements with an end tag before their parent's end, by the places after both tags.

    One pass with a stack of names.  The elements open are counted by name, so that
    a stray end tag costs no search.
    """
    closed: dict[int, int] = {}
    gone: set[str] = set()
    if not _NESTED_START.search(page):
        return closed
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}

    def pop(depth: int) -> None:
        for gone, _ in stack[depth:]:
            opened[gone] -= 1
        del stack[depth:]

    def push(name: str, at: int) -> None:
        stack.append((name, at))
        opened[name] = opened.get(name, 0) + 1

    def innermost(names: frozenset[str] | set[str], fences: frozenset[str]) -> int | None:
        if any(opened.get(name) for name in names):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in names:
                    return depth
                if stack[depth][0] in fences:
                    return None
        return None

    at = 0
    while (tag := _TAG.search(page, at)) is not None:
        at = tag.end()
        name = (tag.group("name") or "").lower()
        if tag.group("end"):
            if name in BLOCKS or name in NESTED:
                depth = innermost({name}, frozenset())
                if depth is not None:
                    if name in NESTED:
                        closed[stack[depth][1]] = at
                    pop(depth)
        elif name in RAW or name == "head":
            if not _ends_at_once(tag.group("attributes")):
                at = _after_skipped(page, name, at, any(opened.get(f) for f in FOREIGN), gone)
        elif name in NESTED:
            if not _ends_at_once(tag.group("attributes")):
                if name in NOT_IN_ITSELF:
                    depth = innermost({name}, frozenset())
                    if depth is not None:
                        pop(depth)
                push(name, at)
        elif name in BLOCKS and name not in VOID:
            for names, fences in (({"p"}, FENCES), (CLOSES.get(name, set()), FENCES)):
                depth = innermost(names, (fences | NESTED) - names)
                if depth is not None:
                    pop(depth)
            push(name, at)
    return closed


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page, in order."""
    closed = closed_elements(page)
    gone: set[str] = set()
    # Names of the skipped elements open that have no end tag.
    skipped: set[str] = set()
    root = _Element("", 0, False, False, False, False, False)
    stack, links, count = [root], 0, 0
    found: list[Block] = []
    parts: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(e.number for e in stack)
                found.append(Block(text, min(linked, len(text)), path, stack[-1]))
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skipped:
            parts.append(text)
            if links:
                linked += len(text.strip())

    def end(names: set[str], fences: frozenset[str]) -> None:
        """Close the innermost open element of these names, if no fence is before it."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                del stack[depth:]
                return
            if stack[depth].name in fences:
                return

    at, length = 0, len(page)
    while at < length:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        name = tag.group("name")
        if name is None:
            if tag.group().startswith("<![CDATA["):
                add(html.escape(tag.group()[9:].removesuffix("]]>")))
            continue
        name = name.lower()
        attributes = tag.group("attributes")
        if name in SKIPPED:
            if not tag.group("end") and not _ends_at_once(attributes):
                if name in NESTED and at not in closed:
                    skipped.add(name)
                elif name in NESTED:
                    at = closed[at]
                else:
                    at = _after_skipped(page, name, at, not FOREIGN.isdisjoint(skipped), gone)
            if not tag.group("end") and name not in ("script", "style"):
                parts.append(" ")
            continue
        if skipped:
            # A block ends them, or the end of what they lie in.
            if name not in BLOCKS or name in VOID or name in CHOICES:
                continue
            if tag.group("end") and all(e.name != name for e in stack):
                continue
            skipped.clear()
        if tag.group("end"):
            if name == "a":
                links = max(0, links - 1)
            elif name == "br":
                parts.append(" ")
            elif name in BLOCKS:
                close()
                end({name}, frozenset())
            continue
        if name == "a":
            links += 1
        elif name in ("br", "img", "input", "wbr"):
            if name != "wbr":
                parts.append(" ")
        elif name in BLOCKS:
            close()
            links = 0
            if name in VOID:
                continue
            end({"p"}, FENCES)
            if name in CLOSES:
                end(CLOSES[name], FENCES - CLOSES[name])
            count += 1
            stack.append(_opened(name, attributes, count, stack[-1]))
    close()
    _release(found)
    return found


def features(page: list[Block]) -> np.ndarray:
    """One row per block, in the order of ``WEIGHTS``."""
    rows = []
    for block in page:
        e, words = block.element, block.text.count(" ") + 1
        rows.append(
            (
                1.0, e.apart, e.inside, e.apart_word, e.inside_word and not e.apart_word,
                block.linked / len(block.text), math.log1p(words),
                block.text[-1] in ".!?…:;”\"»" and words > 3,
                len(e.name) == 2 and e.name[0] == "h" and e.name[1].isdigit(),
                e.name in ("p", "blockquote", "pre", "figcaption"), words < 4, e.hidden,
                bool(_NOTICE.search(block.text)),
            )
        )
    return np.array(rows, dtype=float).reshape(-1, len(WEIGHTS))


def edges(page: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: (block, later block, capacity)."""
    found = []
    last_below: dict[int, int] = {}
    for j, block in enumerate(page):
        near = {j - 1} if j else set()
        if block.path[-1] in last_below:
            near.add(last_below[block.path[-1]])
        if len(block.path) > 1 and -block.path[-2] in last_below:
            near.add(last_below[-block.path[-2]])
        for i in sorted(near):
            other = page[i]
            common = 0
            for a, b in zip(block.path, other.path):
                if a != b:
                    break
                common += 1
            steps = max(len(block.path), len(other.path)) - common
            capacity = SAME_PARENT * FADING ** max(0, steps - 1)
            a, b = block.element, other.element
            if (a.apart, a.apart_word, a.hidden) != (b.apart, b.apart_word, b.hidden):
                capacity *= ACROSS
            found.append((i, j, capacity))
        last_below[block.path[-1]] = j
        if len(block.path) > 1:
            last_below[-block.path[-2]] = j
    return found


def minimum_cut(gain: list[float], joins: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of the minimum cut.

    ``gain`` is a node's capacity from the source less that to the sink.  A node
    whose gain outweighs all its edges is on the side of its gain in every minimum
    cut; such nodes are taken out first, and their edges then pull on their
    neighbours.  Shortest augmenting paths decide the rest.
    """
    n = len(gain)
    gain = list(gain)
    beside: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, capacity in joins:
        if i != j and capacity > 0:
            beside[i][j] = beside[i].get(j, 0.0) + capacity
            beside[j][i] = beside[j].get(i, 0.0) + capacity
    side: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if side[i] is not None or abs(gain[i]) < sum(beside[i].values()):
            continue
        side[i] = gain[i] > 0
        for j, capacity in beside[i].items():
            gain[j] += capacity if side[i] else -capacity
            del beside[j][i]
            waiting.append(j)
        beside[i].clear()
    if None not in side:
        return side

    left = [i for i in range(n) if side[i] is None]
    flow = {i: dict(beside[i]) for i in left}
    source = {i: gain[i] for i in left if gain[i] > 0}
    sink = {i: -gain[i] for i in left if gain[i] < 0}
    tiny = 1e-12

    def search() -> tuple[dict[int, int], int | None]:
        came = {i: -1 for i, c in source.items() if c > tiny}
        queue = deque(came)
        while queue:
            i = queue.popleft()
            if sink.get(i, 0.0) > tiny:
                return came, i
            for j, capacity in flow[i].items():
                if capacity > tiny and j not in came:
                    came[j] = i
                    queue.append(j)
        return came, None

    while True:
        came, last = search()
        if last is None:
            break
        path = [last]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        path.reverse()
        push = min(source[path[0]], sink[last], *(flow[a][b] for a, b in zip(path, path[1:])))
        source[path[0]] -= push
        sink[last] -= push
        for a, b in zip(path, path[1:]):
            flow[a][b] -= push
            flow[b][a] = flow[b].get(a, 0.0) + push
    for i in left:
        side[i] = i in came
    return side


def labelled_blocks(page: str | None, weights: np.ndarray) -> list[tuple[str, bool]]:
    """Every block of a page, and whether it is content."""
    found = blocks(page) if page else []
    if not found:
        return []
    # The difference of the two costs, -log p and -log(1 - p), is the logit.
    gain = np.clip(features(found) @ weights, -MOST_COST, MOST_COST)
    content = minimum_cut(gain.tolist(), edges(found))
    return [(b.text, c) for b, c in zip(found, content)]


def main_text(page: str | None, weights: np.ndarray) -> str:
    return "\n".join([text for text, content in labelled_blocks(page, weights) if content])


def fit(pages: list[str]) -> np.ndarray:
    """Weights of the classifier, from pages with telling elements."""
    stated = np.array(list(WEIGHTS.values()))
    parts, labels = [], []
    for page in pages:
        found = blocks(page)
        rows = features(found)
        for row, block in zip(rows, found):
            e = block.element
            apart = e.apart or e.apart_word or e.hidden
            if apart or (e.inside and block.linked < 0.5 * len(block.text)):
                parts.append(row)
                labels.append(0.0 if apart else 1.0)
    if not parts:
        return stated
    x, y = np.array(parts), np.array(labels)
    beta = stated.copy()
    scale = 50 / len(x)  # the sample counts as this many blocks
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = scale * x.T @ (y - p) - PRIOR * (beta - stated)
        curve = scale * (x * (p * (1 - p))[:, None]).T @ x + PRIOR * np.eye(len(beta))
        beta += np.linalg.solve(curve, slope)
    return beta


def learn(pages: DataFrame) -> np.ndarray:
    """The classifier, fitted to the sample: the different pages with the smallest hashes.

    The sample is settled on hashes alone: a threshold from their number lets few
    more than ``SAMPLE_PAGES`` through, whatever the table's size and partitions, and
    only the chosen pages themselves are then fetched.
    """
    hashed = pages.where(F.length("html").between(1, SAMPLE_CHARS)).select(
        F.xxhash64("html").alias("_h"), "html"
    )
    different = hashed.agg(F.approx_count_distinct("_h")).first()[0]
    share = min(1.0, 2 * SAMPLE_PAGES / max(1, different))
    # Hashes are even over all 64-bit integers.
    limit = int(-(2**63) + share * 2**64) if share < 1 else 2**63 - 1
    few = hashed.select("_h").where(F.col("_h") <= limit).distinct()
    chosen = few.orderBy("_h").limit(SAMPLE_PAGES)
    rows = (
        # Bounded: SAMPLE_PAGES numbers.
        hashed.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.min("html").alias("html")).orderBy("_h").collect()
    )
    return fit([r["html"] for r in rows])


def text_of(weights: np.ndarray):
    """A function of an html column: the main text."""

    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for found in batches:
            texts: list[str] = []
            for run in text_runs(found):
                texts += [main_text(page, weights) for page in found[run].to_pylist()]
            yield pa.array(texts, pa.string())

    extracted.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(extracted, "STRING")


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page."""
    found = pages.select("page_id", "url", text_of(learn(pages))("html").alias("text"))
    return found.select("*", F.length("text").cast("long").alias("n_chars"))
