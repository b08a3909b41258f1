"""Main text of web pages by minimum cut.

A page is taken apart into text blocks. Each block is a node; its capacities to the two
terminals are a classifier's log-odds of being content. Blocks next to each other, and
blocks under the same parent, are joined by edges that cost something if their labels
differ, less the further apart they lie in the tree. A maximum flow then separates content
from boilerplate.

The classifier has two layers, fitted on a bounded sample of pages (``SAMPLE_PAGES``, chosen
by hash, at most ``SAMPLE_BLOCKS`` blocks of each) whose semantic elements label them: blocks
in ``nav``, ``footer``, ``aside`` and the like, or beside an ``article``, are boilerplate,
blocks in ``article`` or ``main`` are content. The first layer sees only what a text looks
like; its log-odds are bounded as if a share ``NOISE`` of the labels were wrong. The second
adds what elements and class names say. Weights start from expected ones (``LOOKS``,
``SIGNS``); as the labels come from some of the signs, the sample counts there as ``WORTH``
rows. An edge
costs half the log odds ratio of the labels that neighbours at that distance have in the
sample, at most ``2 / distance``. Contents of scripts, styles, forms and other elements that
never hold an article are no blocks at all.

A null page is empty and gives an empty text; so does a page without content. Rows are
independent; repeated rows give repeated results, an empty table an empty one, and other
columns are ignored. Broken markup is read as browsers do: block elements close an open
paragraph, stray end tags are ignored, the end of the page closes everything.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from townpulse.llm.common import map_batches, sample_by_hash

SAMPLE_PAGES = 2_000
SAMPLE_BLOCKS = 200

BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of a page's article.
DROPPED = set("head script style noscript template svg math iframe object canvas audio video form select textarea button title datalist dialog".split())
RAW = set("script style textarea title noscript iframe template".split())
BOILERPLATE = set("nav footer aside menu".split())
ARTICLE = set("article main".split())
ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
#: Words in class names and ids that tell boilerplate.
TELLING = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|sidebar|side|rail|"
    r"menu|nav\w*|breadcrumbs?|footer|foot|header|masthead|comments?|replies|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|"
    r"signup|login|search|pagination|pager|toolbar|widgets?|copyright|legal|disclaimer|tags?|meta)(?:$|[\s_-])", re.I,
)
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
NAMES = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: Signs of a block's place, and the log-odds they are expected to add before anything is fitted: it lies in an article,
#: it lies beside the page's article, in an element for boilerplate, under a telling class name. A word that its author
#: chose for boilerplate outweighs an article around it and any look of the text; the look alone never outweighs an article.
SIGNS = (3.5, -2.0, -10.0, -9.0)
#: The same for ``features``: articles are long sentences without links.
LOOKS = (-2.0, 1.0, -3.0, 0.5, 0.5, -0.5)
NOISE, WORTH = 0.05, 50.0
FARTHEST = 8  # distances from here on are one class
SCALE = 1_000


@dataclass
class Block:
    text: str
    path: tuple[int, ...]  # numbers of the open block elements
    tag: str
    linked: int
    signs: tuple[bool, bool, bool, bool]  # see SIGNS

    @property
    def weak(self) -> int | None:
        """Label for the fit: 1 content, 0 boilerplate, None unknown."""
        inside, beside, boilerplate, telling = self.signs
        return 0 if boilerplate or beside else 1 if inside and not telling else None


@dataclass
class Model:
    shape: np.ndarray  # weights of ``features``
    signs: np.ndarray  # weights of ``Block.signs``
    edges: list[float]  # cost of different labels by distance in the tree


@dataclass
class Open:
    tag: str
    number: int
    inside: bool  # of an article
    boilerplate: bool
    telling: bool
    hidden: bool
    parts: list[str] = field(default_factory=list)


def _signs_of(tag: str, attributes: str, parent: Open) -> tuple[bool, bool, bool]:
    """Whether an element is for boilerplate, has a telling name, and is not shown."""
    boilerplate, telling, hidden = tag in BOILERPLATE or tag == "header" and not parent.inside, False, False
    for m in NAMES.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif name == "role" and value.lower() in ROLES:
            boilerplate = True
        elif name in ("class", "id") and tag not in ("html", "body", "article", "main") and TELLING.search(value):
            telling = True
    return boilerplate, telling, hidden


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    root = Open("", 0, False, False, False, False)
    stack, found, parts, linked, number, links, has_article = [root], [], [], 0, 0, 0, False

    def close_block() -> None:
        nonlocal linked
        raw = "".join(parts)
        parts.clear()
        text = " ".join(html.unescape(raw).split()) if raw else ""
        if text:
            own = [e for e in stack if e.tag in BLOCK or e is root]
            last = stack[-1]
            found.append(Block(text, tuple(e.number for e in own), own[-1].tag, linked, (last.inside, not last.inside, last.boilerplate, last.telling)))
        linked = 0

    at, n = 0, len(page)
    while at <= n:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else n]
        if text and not stack[-1].hidden:
            parts.append(text)
            if links:
                linked += len(text)
        if not m:
            break
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                if any(e.tag in BLOCK for e in stack[depth:]):
                    close_block()
                del stack[depth:]
            continue
        if tag in BLOCK:
            close_block()
            if stack[-1].tag == "p" or tag == stack[-1].tag and tag in ("li", "dt", "dd", "td", "th", "tr"):
                stack.pop()
            elif tag in ("p", "div", "ul", "ol", "section", "article", "table") and any(e.tag == "p" for e in stack):
                del stack[next(i for i, e in enumerate(stack) if e.tag == "p"):]
        elif tag == "br":
            parts.append(" ")
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:  # no markup inside
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag == "a":
            links += 1
        elif tag in BLOCK or tag in DROPPED or m[3]:
            parent, number = stack[-1], number + 1
            boilerplate, telling, hidden = _signs_of(tag, m[3], parent)
            has_article |= tag in ARTICLE
            stack.append(Open(tag, number, parent.inside or tag in ARTICLE, parent.boilerplate or boilerplate, parent.telling or telling, parent.hidden or hidden or tag in DROPPED))
    close_block()
    if not has_article:  # nothing lies beside it
        for b in found:
            b.signs = False, False, *b.signs[2:]
    return found


def features(b: Block) -> list[float]:
    """What a block's text looks like."""
    words = b.text.count(" ") + 1
    marks = sum(map(b.text.count, ".,;:!?"))
    return [1.0, math.log1p(words), min(1.0, b.linked / len(b.text)), float(b.text[-1] in ".!?"), min(1.0, marks / words), float(b.tag == "li")]


def _logistic(x: np.ndarray, y: np.ndarray, mean: np.ndarray, offset: np.ndarray, weight: float) -> np.ndarray:
    """Most likely weights under unit Gaussians around ``mean``, by Newton steps."""
    w = mean.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        w -= np.linalg.solve(weight * (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w)), weight * x.T @ (p - y) + w - mean)
    return w


def looks(x: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Log-odds of a text's look, under labels of which ``NOISE`` are wrong."""
    p = NOISE + (1 - 2 * NOISE) / (1 + np.exp(-np.clip(x @ shape, -30, 30)))
    return np.log(p / (1 - p))


def fit(rows: list[tuple]) -> Model:
    """From (features, signs, label, label of the block before or None, distance to it).

    Without both labels all weights keep the means expected of them.
    """
    shape, signs = np.array(LOOKS), np.array(SIGNS)
    agree = np.ones((FARTHEST + 1, 2, 2)) + np.eye(2)  # so that pairs never seen still attract a little
    for _, _, label, before, distance in rows:
        if before is not None:
            agree[min(distance, FARTHEST), before, label] += 1
    if len({r[2] for r in rows}) == 2:
        x, s, y = (np.array([r[i] for r in rows], float) for i in range(3))
        shape = _logistic(x, y, shape, np.zeros(len(y)), 1.0)
        signs = _logistic(s, y, signs, looks(x, shape), WORTH / len(y))
    ratio = np.log(agree[:, 0, 0] * agree[:, 1, 1] / (agree[:, 0, 1] * agree[:, 1, 0])) / 2
    return Model(shape, signs, [max(0.0, min(r, 2 / max(d, 2))) for d, r in enumerate(ratio.tolist())])


def labelled(blocks: list[Block]) -> list[tuple]:
    """Rows for ``fit`` of the blocks that have a label."""
    return [
        (features(b), [float(x) for x in b.signs], b.weak, a.weak if a else None, distance_of(a, b) if a else None)
        for a, b in zip([None, *blocks], blocks) if b.weak is not None
    ]


def fit_classifier(pages: DataFrame, n_pages: int = SAMPLE_PAGES, n_blocks: int = SAMPLE_BLOCKS) -> Model:
    """From at most ``n_pages`` pages, labelled by their semantic elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            rows = [r for page in batch.column(0) for r in labelled(blocks_of(page.as_py() or "")[:n_blocks])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["x", "signs", "label", "before", "distance"])

    sample = sample_by_hash(pages, n_pages, "page_id").select("html")
    return fit(map_batches(sample, run, "x array<double>, signs array<double>, label int, before int, distance int").collect())


def distance_of(a: Block, b: Block) -> int:
    """Steps between two blocks in the tree."""
    shared = next((k for k, (u, v) in enumerate(zip(a.path, b.path)) if u != v), min(len(a.path), len(b.path)))
    return len(a.path) + len(b.path) - 2 * shared


def edges_of(blocks: list[Block], costs: list[float]) -> list[tuple[int, int, int]]:
    """Smoothness: the next block, and the last one under the same parent if that is another."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        parent = b.path[:-1]
        if i:
            edges.append((i - 1, i, round(SCALE * costs[min(distance_of(blocks[i - 1], b), FARTHEST)])))
            j = last.get(parent)
            if j is not None and j != i - 1:
                edges.append((j, i, round(SCALE * costs[2] / (i - j))))
        last[parent] = i
    return edges


def minimum_cut(gain: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes lie on the source's side; ``gain`` is the capacity from the source, negative towards the sink.

    A node whose terminal outweighs all its edges is decided at once and passes its edges on
    to the terminal of its neighbours; what is left goes through Dinic's algorithm.
    """
    n = len(gain)
    gain, near = gain[:], [dict() for _ in range(n)]
    for i, j, w in edges:
        if w:
            near[i][j] = near[i].get(j, 0) + w
            near[j][i] = near[j].get(i, 0) + w
    side: list[bool | None] = [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if side[i] is None and abs(gain[i]) >= sum(near[i].values()):
            side[i] = gain[i] > 0
            for j, w in near[i].items():
                gain[j] += w if side[i] else -w
                del near[j][i]
                waiting.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        source_side = _dinic(rest, gain, near)
        for i in rest:
            side[i] = i in source_side
    return [bool(s) for s in side]


def _dinic(rest: list[int], gain: list[int], near: list[dict[int, int]]) -> set[int]:
    s, t = -1, -2
    room: dict[int, dict[int, int]] = {i: dict(near[i]) for i in rest} | {s: {}, t: {}}
    for i in rest:
        if gain[i] > 0:
            room[s][i], room[i][s] = gain[i], 0
        elif gain[i] < 0:
            room[i][t], room[t][i] = -gain[i], 0
    while True:
        level, queue = {s: 0}, deque([s])
        while queue:
            u = queue.popleft()
            for v, c in room[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            return set(level) - {s}
        following, path = {u: iter(list(room[u])) for u in level}, [s]
        while path:
            u = path[-1]
            if u == t:
                least = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= least
                    room[b][a] = room[b].get(a, 0) + least
                path = path[:next(k for k, (a, b) in enumerate(zip(path, path[1:])) if room[a][b] == 0) + 1]
                continue
            v = next((v for v in following[u] if room[u][v] > 0 and level.get(v) == level[u] + 1), None)
            if v is not None:
                path.append(v)
            else:
                path.pop()
                if path:
                    level[u] = -1


def log_odds(blocks: list[Block], model: Model) -> np.ndarray:
    return looks(np.array([features(b) for b in blocks]), model.shape) + np.array([b.signs for b in blocks], float) @ model.signs


def main_text(page: str, model: Model) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    gain = [round(SCALE * z) for z in log_odds(blocks, model).tolist()]
    return "\n".join(b.text for b, keep in zip(blocks, minimum_cut(gain, edges_of(blocks, model.edges))) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    model = fit_classifier(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", model) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(pages, run, "page_id long, url string, text string, n_chars long")
