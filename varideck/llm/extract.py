"""Main text of web pages: a minimum cut labels each page's blocks as content or boilerplate.

A page is read into blocks of text, the runs between the tags of block-level elements, with the containers that they lie in. A classifier
says how likely a block is content; its cost for either label is the capacity of the block's edge to a terminal. Blocks that follow each
other, and blocks that follow each other in one container, are joined by smoothness edges, weaker where the page's markup changes its
purpose (article, menu, comments) between them. The cut of least capacity, by maximum flow, is the labelling of least cost.

The classifier knows the words' side of a block (length, links, sentence ends, phrases); it is trained here on blocks of at most `rows`
pages whose own markup says what they are, around a prior that holds where no page does. What the markup says of a block itself (inside the
page's article; inside a menu, form, advert or comments) is added to its cost.

Defined cases: null and empty pages give empty texts; a page without article or main element is labelled by the words, hints in class names
and the cut alone; unclosed elements, comments, scripts and quotes end where browsers end them; <br> is white space inside a block;
character references are decoded once, unknown ones stay; ties of the cut go to content; repeated and null ids are rows like others; equal
pages give equal texts; columns besides the named ones are dropped, whatever their names; long pages are read whole, in time that grows
with their length; an empty table gives no rows.
"""

from __future__ import annotations

import html as references
import re
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Elements by what the page's author says with them.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li listing main menu nav noscript ol optgroup option p pre search section select summary svg table tbody td template tfoot th thead tr ul "
    "audio canvas math object video".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"hr"}
RAW = {"iframe", "noembed", "noframes", "script", "style", "textarea", "title", "xmp"}
BOILERPLATE_TAGS = set("aside audio button canvas dialog footer form head header math menu nav noscript object search select svg template video".split())
BOILERPLATE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class names and ids. The first kind means boilerplate whatever is inside; the second unless the page's article is
#: inside, as wrappers tell of their layout or state; so does the third, with less weight.
ASIDE_WORDS = set(
    "ad ads adsbygoogle adslot advert advertisement adverts comment commentlist comments discussion disqus promo promoted recommended related replies reply respond responses sponsor sponsored teaser".split()
)
BOILERPLATE_WORDS = set(
    "alert breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup share sharing signup social subscribe subscription "
    "topbar toolbar".split()
)
LAYOUT_WORDS = set("aside banner header masthead overlay search sidebar sidenav subnav topnav widget widgets".split())
CONTENT_WORDS = {"article", "body", "content", "entry", "main", "post", "story", "text"}
#: Phrases of notices, calls and legal lines.
PHRASES = re.compile(r"©|\bcookies?\b|\ball rights reserved\b|\bsubscribe\b|\bnewsletter\b|\bsign (?:in|up)\b|\blog ?in\b|\badvertisement\b|\bsponsored\b|\bshare (?:this|on)\b|\bprivacy policy\b|\bterms of (?:use|service)\b", re.I)

#: A tag as browsers read it: attributes with quoted values, or, where a quote stays open, up to the next bracket; comments; declarations.
ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?)*+"""
TOKEN = re.compile(rf"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*(?:>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES})(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements that end an open element of these kinds before them, unless another container lies between; `div`, `address` and `p` may.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LOOSE = {"div", "address", "p"}
#: The share of a page's words above which a container named as boilerplate or layout is the page's frame, where no article tells.
FRAME = 0.8


@dataclass
class Container:
    """An open element, and what it and the elements around it say of their text: bad whatever is inside; word and layout by names that the
    element has itself (own_word, own_layout) or one around it. firm is the nearest container, itself included, that isn't LOOSE."""

    tag: str
    number: int
    parent: Container | None = None
    bad: bool = False
    header: bool = False
    article: bool = False
    main: bool = False
    named: bool = False
    own_word: bool = False
    own_layout: bool = False
    word: bool = False
    layout: bool = False
    holds: bool = False
    size: int = 0
    region: int = 0
    firm: Container | None = None


@dataclass
class Block:
    text: str
    links: int
    container: Container


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    containers: list[Container] = field(default_factory=list)
    article: bool = False
    main: bool = False


def hints(attributes: str) -> tuple[bool, bool, bool, bool, str]:
    """Whether attributes name what stands beside an article, other boilerplate, layout or content; and the role."""
    words: set[str] = set()
    role, unseen = "", False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            words.update(map(str.lower, WORD.findall(value)))
        elif name == "role":
            role = value.strip().lower()
        elif name == "style":
            unseen |= bool(UNSEEN.search(value))
        else:
            unseen |= name == "hidden" or value == "true"
    content = bool(words & CONTENT_WORDS)
    return unseen or role in BOILERPLATE_ROLES or bool(words & ASIDE_WORDS), bool(words & BOILERPLATE_WORDS), bool(words & LAYOUT_WORDS) and not content, content, role


def settle(page: Page) -> None:
    """What names mean once the page is read. An element around the page's article that is named as boilerplate or layout is its frame and
    loses the name; on a page without article or main, so does one that holds nearly all words."""
    for b in page.blocks:
        if not b.container.bad:
            b.container.size += len(b.text) - b.links
    for c in reversed(page.containers):
        if c.parent is not None:
            c.parent.size += c.size
    told, total = page.article or page.main, page.containers[0].size
    for c in page.containers[1:]:
        named = not (c.holds if told else c.size > FRAME * total)
        up = c.parent
        c.word, c.layout = up.word or (named and c.own_word), up.layout or (named and c.own_layout)
        same = (c.bad, c.word, c.layout, c.header, c.article, c.main) == (up.bad, up.word, up.layout, up.header, up.article, up.main)
        c.region = up.region if same else c.number


def read_page(html: str) -> Page:
    """The blocks of a page in their order."""
    page, top = Page(), Container("", 0)
    top.firm = top
    page.containers.append(top)
    opened: dict[str, int] = {}
    parts: list[str] = []
    link = depth_links = 0
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal link
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                page.blocks.append(Block(text, min(link, len(text)), top))
            parts.clear()
        link = 0

    def close() -> None:
        nonlocal top
        opened[top.tag] -= 1
        top = top.parent

    while at < end:
        m = TOKEN.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            parts.append(text)
            if depth_links:
                link += len(text.strip())
        if m is None:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW and not closing:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = stop.end() if stop else end
            continue
        if tag == "a":
            depth_links = 0 if closing else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if (tag == "body" or tag in BLOCKS and tag not in ("noscript", "template")) and opened.get("head") and not closing:
            flush()  # the body begins, whether or not the head was closed
            while top.tag != "head":
                close()
            close()
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            depth_links = 0  # an open link ends with its container
            if opened.get(tag):
                while top.tag != tag:
                    close()
                close()
            continue
        if tag in VOID or tag == "html":
            continue  # names on the page's root speak of its layout
        while top.tag == "p":
            close()
        if tag in CLOSES:
            kinds = CLOSES[tag]
            while (x := top.firm).tag in kinds:
                while top is not x:
                    close()
                close()
        bad, word, layout, content, role = hints(attributes) if attributes and not attributes.isspace() else (False, False, False, False, "")
        main, article = tag == "main" or role == "main", tag == "article" or role == "article"
        header = tag == "header" or role == "banner"
        # Names on an article or main element itself tell of its kind or state, but for those of what stands beside an article.
        inside = main or article
        bad = tag in BOILERPLATE_TAGS and not header or bad and not header and not (inside and content)
        made = Container(tag, len(page.containers), top, top.bad or bad, top.header or header, top.article, top.main, top.named or content, word and not inside, layout and not inside)
        made.article |= article and not made.bad
        made.main |= main and not made.bad
        made.firm = top.firm if tag in LOOSE else made
        page.containers.append(made)
        if made.article > top.article or made.main > top.main:
            x = top
            while x is not None and not x.holds:
                x.holds, x = True, x.parent
        page.article |= made.article
        page.main |= made.main
        opened[tag] = opened.get(tag, 0) + 1
        top = made
    flush()
    settle(page)
    return page


#: What the words of a block say: names of the features of `words_side`, and the prior's weights.
FEATURES = ("bias", "words", "short", "links", "sentence", "heading", "item", "phrase")
PRIOR = np.array([-0.5, 0.9, -0.8, -4.0, 1.0, 1.2, -0.6, -2.5])
#: Bound of the classifier's cost, weights of the markup, and of the edges between blocks, in units of the log-likelihood.
MOST, INSIDE, OUTSIDE, BAD, LAYOUT, NAMED = 4.0, 8.0, -8.0, -20.0, -5.0, 1.5
NEXT, SIBLING, ACROSS = 1.0, 0.7, 0.1
SCALE = 1000


def words_side(block: Block) -> tuple[float, ...]:
    n = block.text.count(" ") + 1
    tag = block.container.tag
    return (1.0, min(np.log2(1 + n), 7.0) / 2, float(n < 4), block.links / len(block.text), float(block.text[-1] in ".!?…。！？\"”»"), float(tag in HEADINGS), float(tag in ("li", "td", "th", "dt", "dd")), float(bool(PHRASES.search(block.text))))


def markup_side(page: Page, block: Block) -> float:
    c = block.container
    inside = c.article or (c.main and not page.article)
    if c.bad or c.word or (c.header and not (inside and c.tag in HEADINGS)):
        return BAD
    if inside:
        return INSIDE + LAYOUT * c.layout
    return (OUTSIDE if page.article or page.main else 0.0) + LAYOUT * c.layout + NAMED * c.named


def smoothness(page: Page) -> list[tuple[int, int, int]]:
    """Edges between blocks: to the next one, and to the next one in the same container or in a sibling of it."""
    edges, last = [], {}
    for i, block in enumerate(page.blocks):
        c = block.container
        if i:
            same = page.blocks[i - 1].container.region == c.region
            edges.append((i - 1, i, int(SCALE * (NEXT if same else ACROSS))))
        around = (c.parent or c).number
        if (before := last.get(around)) is not None and page.blocks[before].container.region == c.region:
            edges.append((before, i, int(SCALE * SIBLING)))
        last[around] = i
    return edges


def minimum_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes lie on the content side of a cut of least capacity, as many as can. gain: a node's capacity to content less that to
    boilerplate. Nodes that outweigh all their edges are settled first, which shifts their neighbours; what is left is a maximum flow by
    shortest augmenting levels."""
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0) + w
        near[b][a] = near[b].get(a, 0) + w
    label: list[bool | None] = [None] * n
    wait = deque(range(n))
    while wait:
        i = wait.popleft()
        around = sum(near[i].values())
        if label[i] is None and (gain[i] >= around or -gain[i] > around):
            label[i] = gain[i] >= 0
            for j, w in near[i].items():
                gain[j] += w if label[i] else -w
                del near[j][i]
                wait.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    # Flow from nodes with gain left to nodes with loss left, in levels by distance; `near` holds what each direction can still carry.
    while True:
        level = {i: 0 for i in rest if gain[i] > 0}
        queue, reached = deque(level), False
        while queue:
            i = queue.popleft()
            for j, w in near[i].items():
                if w > 0 and j not in level:
                    level[j] = level[i] + 1
                    reached |= gain[j] < 0
                    queue.append(j)
        if not reached:
            break
        for s in [i for i in rest if gain[i] > 0]:
            untried = {}
            path = [s]
            while path and gain[s] > 0:
                i = path[-1]
                if gain[i] < 0:
                    flow = min(gain[s], -gain[i], *(near[a][b] for a, b in zip(path, path[1:], strict=False)))
                    gain[s] -= flow
                    gain[i] += flow
                    for a, b in zip(path, path[1:], strict=False):
                        near[a][b] -= flow
                        near[b][a] += flow
                    path, untried = [s], {}
                    continue
                steps = untried.setdefault(i, [j for j, w in near[i].items() if w > 0 and level.get(j) == level[i] + 1])
                if steps:
                    path.append(steps.pop())
                else:
                    level[i] = -1
                    path.pop()
    # Boilerplate is what can still reach a loss.
    lost = {i for i in rest if gain[i] < 0}
    queue = deque(lost)
    while queue:
        i = queue.popleft()
        for j in near[i]:
            if j not in lost and near[j][i] > 0:
                lost.add(j)
                queue.append(j)
    return [i not in lost if x is None else x for i, x in enumerate(label)]


def labels(page: Page, weights: np.ndarray) -> list[bool]:
    """Which blocks of a page are content."""
    if not page.blocks:
        return []
    words = np.clip(np.array([words_side(b) for b in page.blocks]) @ weights, -MOST, MOST)
    gain = [int(SCALE * (x + markup_side(page, b))) for x, b in zip(words.tolist(), page.blocks, strict=True)]
    return minimum_cut(gain, smoothness(page))


def main_text(html: str | None, weights: np.ndarray = PRIOR) -> str:
    """The content blocks of a page, a line each."""
    page = read_page(html or "")
    return "\n".join(b.text for b, keep in zip(page.blocks, labels(page, weights), strict=True) if keep)


def lessons(html: str | None, most: int = 200) -> list[tuple[bool, tuple[float, ...]]]:
    """Blocks whose page says what they are: inside its article, or inside boilerplate. At most `most` of each page, evenly spread."""
    page = read_page(html or "")
    said = [(s > 0, b) for b in page.blocks if abs(s := markup_side(page, b)) >= INSIDE and b.container.tag not in ("head",)]
    return [(y, words_side(b)) for y, b in said[:: max(1, -(-len(said) // most))]]


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", rows: int = 300, steps: int = 25, pull: float = 20.0) -> np.ndarray:
    """Weights of the words' side: logistic regression by Newton steps on the lessons of the `rows` pages with the least hash of their id,
    pulled to the prior as by `pull` blocks, both labels weighing alike."""
    order = F.xxhash64(F.col(key).cast("string"))
    some = [r[0] for r in pages.select(order.alias("_h")).orderBy("_h").limit(rows).collect()]
    if not some:
        return PRIOR
    chosen = pages.filter(order <= some[-1]).select(html).limit(rows)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [x for page in batch.column(0).to_pylist() for x in lessons(page)]
            return pa.RecordBatch.from_arrays([pa.array([y for y, _ in found], pa.bool_()), pa.array([list(x) for _, x in found], pa.list_(pa.float64()))], ["y", "x"])

        return work

    found = map_batches(chosen, make, "y boolean, x array<double>").collect()
    y, x = np.array([r["y"] for r in found], float), np.array([r["x"] for r in found], float).reshape(-1, len(PRIOR))
    if len(set(y)) < 2:
        return PRIOR
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum()) * len(y)
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - pull * (w - PRIOR)
        w = w + np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), slope)
    return w


def extract(pages: DataFrame, weights: np.ndarray, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """key, url, text, n_chars: the main text of each page, and its length in code points."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x, weights) for x in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [key, url, "text", "n_chars"])

        return work

    return map_batches(pages.select(key, url, html), make, f"`{key}` {pages.schema[key].dataType.simpleString()}, `{url}` string, text string, n_chars bigint")
