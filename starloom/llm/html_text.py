"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

Each page is parsed whole into a tree (void and unclosed tags as browsers take them).  Every element
gets features of its subtree (text density, links, attribute tokens), its depth and siblings, and its
ancestors.  Gradient-boosted trees give the log-odds that an element's own text is main content.  They are
fitted on the driver from at most ``SAMPLE_NODES`` nodes of at most ``SAMPLE_PAGES`` pages, those of least hash,
whose landmarks tell their side: inside an article or main element, or inside navigation, footers, adverts, forms and the like.
A name is a landmark as a whole: ``share``, or ``share-bar`` whose other words only tell the place, but not ``share-prices``.
A clutter word on an element that wraps the main text (``sidebar-left`` on the body) speaks of the layout and is no landmark.
They start from a prior on landmark words, so that a corpus without landmarks still gets sensible scores.

Decoding chooses for every element *content*, *clutter* or *mixed* (its children choose).  Below
content an element may be content or clutter, below clutter all is clutter: no clutter keeps content inside
and the choice of the whole page has the greatest total log-odds, weighted by text length.

The text of content elements is cut into blocks at block-level tags; character references are decoded,
white space inside a block becomes one space, empty blocks go, and blocks are joined by one newline.

Defined cases: null or empty html gives the empty text; text outside any tag is a block of the root;
markup that ends early is closed; repeated rows are extracted each; an empty table gives an empty result; other
columns stay, those named like results are replaced.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import least_hash_sample, stored, table

SAMPLE_PAGES = 2_000
SAMPLE_NODES = 40_000
TREES, DEPTH, RATE, LEAVES_MIN = 40, 3, 0.2, 20
PRIOR = 3.0  # log-odds that a landmark carries before any tree
MOST = 2.5  # the trees' sum is squeezed into +-MOST: structure decides where landmarks are silent, not against them

# Classes of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe canvas select option button".split())
NESTED = frozenset("svg template canvas select button".split())  # of these, elements of the same name may lie inside
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead
title tr ul""".split())
CLOSES_P = BLOCK - frozenset("body caption html tbody td tfoot th thead title tr".split())
CLUTTER_TAGS = frozenset("nav header footer aside form menu dialog button select label fieldset".split())
CLUTTER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination
popup promo promoted promotion recommended related replies respond reply search share sharing sidebar signup social
sponsor sponsored subscribe subscription tags toolbar widget complementary contentinfo alert alertdialog""".split())
# Words that beside others in a name only tell the place or the kind of box.
PLACE_WORDS = frozenset("""area bar block bottom box col column container div element foot form group head holder icon icons inner item items js large
left line link links list middle mobile module outer page pane panel post posts primary region right row secondary section site small sub tab
this title top unit us wrap wrapper zone""".split())
CONTENT_TAGS = frozenset("article main".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
IMPLIED = {"li": ("li", frozenset("ul ol menu".split())), "dt": ("dt dd", frozenset(["dl"])), "dd": ("dt dd", frozenset(["dl"])),
           "tr": ("tr td th", frozenset(["table"])), "td": ("td th", frozenset("tr table".split())), "th": ("td th", frozenset("tr table".split())),
           "option": ("option", frozenset(["select"]))}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FEATURES = ["own_chars", "words", "stops", "digits", "link_share", "subtree_chars", "subtree_density", "subtree_links", "depth",
            "sibling", "siblings", "sibling_chars", "paragraph", "heading", "item", "clutter_here", "content_here", "clutter_above",
            "content_above", "place", "clutter_near"]

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>\x00]*)"
                    # a quote opens a value only right after "="; a value without quotes ends at white space
                    r"((?:=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
_LANDMARKS = frozenset("class id role itemprop aria-label".split())
_RAW_TAG = {name: re.compile(rf"<(/?){name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I | re.A) for name in RAW}
_ATTRIBUTE_WORD = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")
_NAMING = CLUTTER_WORDS | CONTENT_WORDS | PLACE_WORDS


def landmark_words(attributes: str) -> frozenset[str]:
    """The clutter and content words that name an element: those of names that hold nothing else but words for a place."""
    out: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in _LANDMARKS:
            continue
        value = value.strip("\"'").lower()
        for token in value.split() if name == "class" else [value]:  # other names are one, spaces or not
            words = set(_ATTRIBUTE_WORD.findall(token))
            if words <= _NAMING:
                out |= words & CLUTTER_WORDS or words & CONTENT_WORDS
    return frozenset(out)


class Page:
    """A parsed page as parallel lists over its elements, in document order; element 0 is the root."""

    __slots__ = ("tag", "parent", "depth", "words", "pieces")

    def __init__(self, source: str):
        self.tag, self.parent, self.depth, self.words = ["#root"], [-1], [0], [frozenset()]
        self.pieces: list[tuple[int, str | None]] = []  # (element, text), or None where a block starts or ends
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, at, size = [0], 0, len(source)
        tag, pieces = self.tag, self.pieces
        while at < size:
            open_at = source.find("<", at)
            if open_at < 0:
                pieces.append((stack[-1], source[at:]))
                break
            if open_at > at:
                pieces.append((stack[-1], source[at:open_at]))
            found = _TOKEN.match(source, open_at)
            if not found:
                pieces.append((stack[-1], "<"))
                at = open_at + 1
                continue
            at = found.end()
            name = found.group(2)
            if not name:
                continue
            name = name.lower()
            if found.group(1):
                self._close(stack, name)
                continue
            if name in CLOSES_P:
                self._close_open_p(stack)
            if name in IMPLIED:
                self._close_implied(stack, name)
            words = frozenset()
            if found.group(3) and "=" in found.group(3):
                words = landmark_words(found.group(3))
            node = len(tag)
            tag.append(name)
            self.parent.append(stack[-1])
            self.depth.append(len(stack))
            self.words.append(words)
            if name in BLOCK:
                pieces.append((node, None))
            elif name == "br":
                pieces.append((stack[-1], " "))
            if name in VOID or found.group(0).endswith("/>") and name in RAW:
                continue
            if name in RAW:
                at = self._behind(source, name, at)  # nothing inside is text of the page
                if name in BLOCK:
                    pieces.append((node, None))
                continue
            stack.append(node)

    @staticmethod
    def _behind(source: str, name: str, at: int) -> int:
        """Where the element ``name``, open at ``at``, has ended."""
        open_now = 1
        for found in _RAW_TAG[name].finditer(source, at):
            if found.group(1):
                open_now -= 1
            elif name in NESTED and not found.group().endswith("/>"):
                open_now += 1
            if not open_now:
                return found.end()
        return len(source)

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == name:
                if any(self.tag[n] in BLOCK for n in stack[i:]):
                    self.pieces.append((stack[i], None))
                del stack[i:]
                return
            # an inline end tag doesn't close blocks that are open around it
            if name not in BLOCK and self.tag[stack[i]] in BLOCK:
                return

    def _close_open_p(self, stack: list[int]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[i]]
            if name == "p":
                self.pieces.append((stack[i], None))
                del stack[i:]
                return
            if name in BLOCK:
                return

    def _close_implied(self, stack: list[int], name: str) -> None:
        ends, limit = IMPLIED[name]
        ends = ends.split()
        for i in range(len(stack) - 1, 0, -1):
            at = self.tag[stack[i]]
            if at in limit:
                return
            if at in ends:
                self.pieces.append((stack[i], None))
                del stack[i:]
                return


def wrappers(page: Page, chars: np.ndarray, clutter: np.ndarray, content: np.ndarray) -> list[int]:
    """Elements named like clutter that wrap the main text.

    The main block is the content landmark that is nearest to the most text.  Clutter landmarks not around it are real.
    Those on or around it wrap the main text if they hold at least half of the text that is in no real one.  On a page
    without content landmarks, so do elements named by attributes that hold other landmarks and that half.
    """
    n, parent, tag = len(page.tag), page.parent, page.tag
    named = [i for i in range(n) if clutter[i]]
    if not named:
        return []
    held, nearest = np.zeros(n), [-1] * n
    for i in range(n):
        nearest[i] = i if clutter[i] or content[i] else nearest[parent[i]] if i else -1
        if nearest[i] >= 0:
            held[nearest[i]] += chars[i]
    blocks = [i for i in range(n) if content[i] and held[i] and tag[i] not in CLUTTER_TAGS]
    around = set()
    if blocks:
        at = max(blocks, key=held.__getitem__)
        while at >= 0:
            around.add(at)
            at = parent[at]
    else:
        for i in named:
            at = parent[i]
            while at >= 0 and at not in around:
                if tag[at] not in CLUTTER_TAGS:
                    around.add(at)
                at = parent[at]
    real, text = [False] * n, np.zeros(n)
    for i in range(n):
        real[i] = i > 0 and real[parent[i]] or bool(clutter[i]) and i not in around
        text[i] = 0 if real[i] else chars[i]
    for i in range(n - 1, 0, -1):
        text[parent[i]] += text[i]
    return [i for i in named if i in around and text[i] and text[i] >= text[0] / 2]


def node_features(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, side, characters) of every element; side is 1 content, 0 clutter, -1 unknown by landmarks."""
    n = len(page.tag)
    chars, words, stops, digits, linked = (np.zeros(n) for _ in range(5))
    first = np.zeros(n)
    parent = np.array(page.parent)
    link_depth = np.zeros(n, bool)
    clutter_here, content_here = np.zeros(n), np.zeros(n)
    clutter_above, content_above, near = np.zeros(n), np.zeros(n), np.full(n, 9.0)
    for i in range(n):
        p = page.parent[i]
        name, attributes = page.tag[i], page.words[i]
        # words on the whole page speak of its layout
        clutter_here[i] = (name in CLUTTER_TAGS) + (len(attributes & CLUTTER_WORDS) if name not in ("html", "body") else 0)
        content_here[i] = (name in CONTENT_TAGS) + len(attributes & CONTENT_WORDS)
        link_depth[i] = name == "a" or (p >= 0 and link_depth[p])
    total = 0.0
    for node, text in page.pieces:
        if text is None or not text.strip():
            continue
        size = len(text)
        if not first[node]:
            first[node] = total + 1
        total += size
        chars[node] += size
        words[node] += text.count(" ") + 1
        stops[node] += text.count(".") + text.count(",")
        digits[node] += sum(map(text.count, "0123456789"))
        if link_depth[node]:
            linked[node] += size
    clutter_here[wrappers(page, chars, clutter_here, content_here)] = 0
    for i in range(n):
        p = page.parent[i]
        if p >= 0:
            clutter_above[i] = clutter_above[p] + clutter_here[p]
            content_above[i] = content_above[p] + content_here[p]
            near[i] = min(9.0, near[p] + 1)
        if clutter_here[i]:
            near[i] = 0.0
    subtree, subtree_links, tags = chars.copy(), linked.copy(), np.ones(n)
    children, child_chars = np.zeros(n), np.zeros(n)
    order = np.zeros(n)
    for i in range(1, n):
        order[i] = children[page.parent[i]]
        children[page.parent[i]] += 1
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        subtree[p] += subtree[i]
        subtree_links[p] += subtree_links[i]
        tags[p] += tags[i]
    child_chars[:] = subtree
    up = np.maximum(parent, 0)
    tag = page.tag
    x = np.column_stack([
        np.log1p(chars), np.log1p(words), stops / np.maximum(words, 1), digits / np.maximum(chars, 1), linked / np.maximum(chars, 1),
        np.log1p(subtree), np.log1p(subtree / tags), subtree_links / np.maximum(subtree, 1), np.minimum(page.depth, 30),
        np.minimum(order, 50), np.minimum(children[up], 50), np.log1p(child_chars[up]),
        [t == "p" for t in tag], [t in HEADINGS for t in tag], [t in ("li", "td", "th", "dd", "dt") for t in tag],
        clutter_here, content_here, clutter_above, content_above, first / max(1.0, total), near])
    side = np.full(n, -1)
    side[(content_above + content_here > 0) & (clutter_above + clutter_here == 0)] = 1
    side[(clutter_above + clutter_here > 0)] = 0
    return x, side, chars


def prior(x: np.ndarray) -> np.ndarray:
    """Log-odds from landmarks alone: clutter words on the element or around it outweigh content ones."""
    clutter = x[:, FEATURES.index("clutter_here")] + x[:, FEATURES.index("clutter_above")]
    content = x[:, FEATURES.index("content_here")] + x[:, FEATURES.index("content_above")]
    plain = np.where(x[:, FEATURES.index("link_share")] > 0.5, -1.0, np.where(x[:, FEATURES.index("paragraph")] + x[:, FEATURES.index("heading")] > 0, 1.0, 0.0))
    return PRIOR * (np.minimum(content, 1) - 3 * np.minimum(clutter, 1)) + plain + 0.5


@dataclass(frozen=True)
class Trees:
    """Boosted regression trees, complete to ``DEPTH``: a feature and cut for each inner node, a value for each leaf."""

    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for f, c, v in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[np.arange(len(x)), f[at]] > c[at])
            out = out + v[at - (2 ** DEPTH - 1)]
        return prior(x) + MOST * np.tanh(out / MOST)


def without_landmarks(x: np.ndarray) -> np.ndarray:
    """The same nodes on a page that names no element: what is left is structure and text."""
    x = x.copy()
    x[:, [FEATURES.index(f) for f in ("clutter_here", "content_here", "clutter_above", "content_above")]] = 0
    x[:, FEATURES.index("clutter_near")] = 9
    return x


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss on histograms of at most 32 bins a feature."""
    inner, none = 2 ** DEPTH - 1, Trees(np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 1)))
    if len(y) < 2 * LEAVES_MIN or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    margin, features, cuts, leaves = prior(x), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at, f, c = np.zeros(len(y), np.int64), np.zeros(inner, int), np.full(inner, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-6, None, None)
            if len(rows) >= 2 * LEAVES_MIN:
                gs, hs = g[rows].sum(), h[rows].sum()
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = bins[rows, j]
                    gl, hl, nl = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], None))
                    gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                    gain[(nl < LEAVES_MIN) | (len(rows) - nl < LEAVES_MIN)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, e[k])
            if best[1] is not None:
                f[node], c[node] = best[1], best[2]
            at[rows] = 2 * node + 1 + (x[rows, f[node]] > c[node])
        leaf = at - inner
        values = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        margin = margin + values[leaf]
        features.append(f)
        cuts.append(c)
        leaves.append(values)
    return Trees(np.array(features), np.array(cuts), np.array(leaves))


def fit_both(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees that know pages with landmarks and pages without them."""
    return fit_trees(np.concatenate([x, without_landmarks(x)]), np.concatenate([y, y]))


def decode(page: Page, margin: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Whether each element is content, in the consistent choice of greatest total log-odds."""
    n = len(page.tag)
    own = np.clip(margin, -8, 8) * np.log1p(chars)
    content, clutter, mixed = own.tolist(), (-own).tolist(), [0.0] * n
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        content[p] += max(content[i], clutter[i])
        clutter[p] += clutter[i]
        mixed[p] += max(content[i], clutter[i], mixed[i])
    # text of a mixed element stands for itself
    keep, state = np.zeros(n, bool), [0] * n  # 0 mixed, 1 content, 2 clutter
    for i in range(n):
        above = state[page.parent[i]] if i else 0
        if above == 2:
            state[i] = 2
        elif above == 1:
            state[i] = 1 if content[i] >= clutter[i] else 2
        else:
            best = max(content[i], clutter[i], mixed[i])
            state[i] = 0 if mixed[i] == best and chars[i] == 0 else 1 if content[i] >= clutter[i] else 2
        keep[i] = state[i] == 1
    return keep


def main_nodes(page: Page, x: np.ndarray, margin: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """The decoded content; where that has no text, what the prior alone takes for content."""
    keep = decode(page, margin, chars)
    return keep if chars[keep].any() else decode(page, prior(x), chars)


def block_text(page: Page, keep: np.ndarray) -> str:
    blocks, line = [], []

    def end():
        text = _SPACES.sub(" ", html.unescape("".join(line))).strip()
        if text:
            blocks.append(text)
        line.clear()

    for node, text in page.pieces:
        if text is None:
            end()
        elif keep[node]:
            line.append(text)
    end()
    return "\n".join(blocks)


def _sampled(pages: DataFrame, key: str, source: str) -> DataFrame:
    whole = pages.filter(F.col(source).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(source).alias("html"))
    return least_hash_sample(whole, F.xxhash64("key", F.length("html")), SAMPLE_PAGES).select("html").repartition(16)


def train(pages: DataFrame, key: str = "page_id", source: str = "html") -> Trees:
    """Fit on text-bearing elements whose landmarks tell their side."""
    def rows(batches):
        for batch in batches:
            xs, ys = [np.zeros((0, len(FEATURES)))], [np.zeros(0, int)]
            for text in batch.column("html").to_pylist():
                x, side, chars = node_features(Page(text))
                use = (side >= 0) & (chars > 0)
                xs.append(x[use])
                ys.append(side[use])
            x, y = np.concatenate(xs), np.concatenate(ys)
            yield pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), pa.array(y, pa.int32())], names=["x", "y"])

    drawn = _sampled(pages, key, source).mapInArrow(rows, "x array<double>, y int")
    got = least_hash_sample(stored(drawn), F.xxhash64("x", "y"), SAMPLE_NODES).select("x", "y").toArrow()
    if not got.num_rows:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
    return fit_both(x, got["y"].to_numpy().astype(float))


def extract(pages: DataFrame, trees: Trees, source: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of the whole ``source``."""
    sent = pages.sparkSession.sparkContext.broadcast(trees)  # TREES * 2**DEPTH numbers

    @F.arrow_udf("string")
    def main_text(sources: pa.Array) -> pa.Array:
        texts = []
        for at in range(0, len(sources), 256):
            parsed = [Page(s or "") for s in sources.slice(at, 256).to_pylist()]
            found = [node_features(p) for p in parsed]
            margin = sent.value.margin(np.concatenate([x for x, _, _ in found]))
            cut = np.cumsum([len(x) for x, _, _ in found])[:-1]
            for page, m, (x, _, chars) in zip(parsed, np.split(margin, cut), found):
                texts.append(block_text(page, main_nodes(page, x, m, chars)))
        return pa.array(texts, pa.string())

    return pages.withColumn(out, main_text(F.col(source)))


def op1_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
