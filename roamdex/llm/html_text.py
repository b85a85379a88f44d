"""Main text of web pages by a tree-structured graphical model over the DOM.

Nodes are a page's block-level elements and its runs of text. Each has a hidden label, main text or not; a node's
features depend on its label, a node's label on its parent's. Sum-product messages pass once from the leaves up and
once from the root down and give each node its exact marginal; runs of text with a marginal of one half or more are the
page's text. Potentials are smoothed counts over labelled pages: a few labelled by hand, and a bounded hash sample
of the table (``SAMPLE_PAGES``, a parameter) whose own markup (main, article against navigation, asides and the like)
tells its main text.

Defined cases: a null or empty page, or one without main text, has the empty text; unclosed, crossed and unknown tags
are read as far as they go; what an element's own ``hidden`` or style keeps from being shown is left out; repeated rows are read each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamdex.llm.common import bounded_batches
from roamdex.llm.labelled_pages import PAGES

SAMPLE_PAGES = 2_000
#: The pages labelled by hand count as much as the sample, times this.
HAND_WEIGHT = 2.0
SMOOTHING = 0.1
#: What a text's length, sentence ends and links say goes together; taken as independent they would say it threefold.
TEXT_WEIGHT = 0.5

# --- fixed values: elements of HTML by their part in a page ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What may stand in a head; anything else begins the body, also where </head> was left out.
HEAD = frozenset("base link meta script style noscript template head title html".split())
SILENT = frozenset("script style noscript template head title svg math iframe object video audio canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Start tags that end an open element of the named kinds, where the end tag may be left out.
P_ENDERS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead"), "tfoot": ("tr", "td", "th", "tbody"),
}
SCOPES = frozenset("article aside body div footer form header html main nav ol section table td th ul dl".split())
TAGS = frozenset(
    "address article aside blockquote body button caption dd details div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header html label legend li main menu nav ol option p pre search section select summary table tbody td "
    "textarea tfoot th thead tr ul".split()
)
# --- fixed values: parts of class, id and role names ---
OFF_NAMES = (
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs bottom button comment comments consent "
    "cookie cookies copyright disclaimer discussion disqus dialog footer form header hidden legal login masthead menu modal "
    "nav navbar navigation newsletter notice notification pager pagination popup promo promoted recommended related "
    "replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags thread toolbar widget"
).split()
MAIN_NAMES = "article body content entry main maincontent post story text".split()
# --- fixed values: where a page's own markup tells its main text ---
MAIN_TAGS = frozenset(("article", "main"))
OFF_TAGS = frozenset("aside button dialog fieldset footer form header label legend menu nav option search select textarea".split())

#: Elements that begin a part of a page, beside those with a telling name.
REGIONS = frozenset("article aside body dialog footer form header main menu nav search section".split())

_OFF, _MAIN = frozenset(OFF_NAMES), frozenset(MAIN_NAMES)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


def _hint(attrs: list[tuple[str, str | None]]) -> str:
    """Which kind of names a node's class, id and role hold."""
    parts = [p.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop") for p in _PART.findall(v)]
    off, main = {p for p in parts if p in _OFF}, any(p in _MAIN for p in parts)
    # The header of an article or a post is a part of it; a site's or page's is not.
    if main and off == {"header"}:
        return "head"
    return "off" if off else "main" if main else "none" if parts else "bare"


def _is_hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether an element says that it is not shown."""
    names = dict(attrs)
    style = (names.get("style") or "").lower().replace(" ", "")
    return "hidden" in names or "display:none" in style or "visibility:hidden" in style


class Page(HTMLParser):
    """Arrays over a page's nodes, parents before children: block elements and runs of text."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.hint, self.mark = ["#root"], [-1], ["bare"], [None]
        self.text: list[str | None] = [None]
        self.within = [False]
        self.link_words: list[int] = [0]
        self.open: list[tuple[str, int]] = [("#root", 0)]
        self.silent = self.links = 0
        self.hidden: set[int] = set()  # places among the open elements
        self.run: list[tuple[str, bool]] = []
        self.feed(html)
        self.close()
        self._end_run()

    def error(self, message: str) -> None:
        """Markup errors are read over."""

    def _node(self, tag: str, hint: str, mark: str | None, text: str | None = None, link_words: int = 0) -> int:
        for column, value in zip(
            (self.tag, self.parent, self.hint, self.mark, self.text, self.link_words),
            (tag, self.open[-1][1], hint, mark, text, link_words),
        ):
            column.append(value)
        above = self.open[-1][1]
        self.within.append(self.within[above] or self.hint[above] == "off" or self.tag[above] in OFF_TAGS)
        return len(self.tag) - 1

    def _end_run(self) -> None:
        text = " ".join("".join(t for t, _ in self.run).split())
        if text:
            self._node("#text", "bare", None, text, sum(len(t.split()) for t, linked in self.run if linked))
        self.run = []

    def _pop(self, at: int) -> None:
        for k, (tag, _) in enumerate(self.open[at:], at):
            self.silent -= (tag in SILENT) + (k in self.hidden)
            self.links -= tag == "a"
            self.hidden.discard(k)
        del self.open[at:]

    def _push(self, tag: str, node: int, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in ("body", "html") and _is_hidden(attrs):
            self.hidden.add(len(self.open))
            self.silent += 1
        self.open.append((tag, node))

    def _close_open(self, kinds: tuple[str, ...] | str) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at][0]
            if tag in kinds:
                self._pop(at)
                return
            if tag in SCOPES and not (tag in ("td", "th") and "tr" in kinds):
                return

    def _leave_head(self, within: tuple[str, ...]) -> None:
        """End an open head whose innermost open element is one of those."""
        tags = [t for t, _ in self.open]
        if "head" in tags and (not within or tags[-1] in within):
            self._pop(tags.index("head"))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent and tag not in HEAD:
            self._leave_head(() if tag == "body" else ("head", "title"))
        if tag in INLINE:
            if tag in ("br", "wbr", "img"):
                self.run.append((" " if tag == "br" else "", False))
            else:
                self.links += tag == "a"
                self._push(tag, self.open[-1][1], attrs)
            return
        if tag in SILENT:
            self.silent += 1
            self.open.append((tag, self.open[-1][1]))
            return
        self._end_run()
        if tag in P_ENDERS:
            self._close_open(("p",))
        if tag in CLOSES:
            self._close_open(CLOSES[tag])
        if tag in VOID:
            return
        names = dict(attrs)
        mark = "main" if "data-main" in names else "off" if "data-off" in names else None
        if names.get("role") == "main" or names.get("itemprop") == "articleBody":
            mark = mark or "role"
        self._push(tag, self._node(tag, _hint(attrs), mark), attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("svg", "math"):
            self._leave_head(("head", "title"))
            return
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE and tag not in SILENT:
            self._end_run()
        if tag == "br":
            self.run.append((" ", False))
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self._pop(at)
                return
            if tag in INLINE and self.open[at][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.silent and self.open[-1][0] == "head" and data.strip():
            self._leave_head(("head",))
        if not self.silent:
            self.run.append((data, self.links > 0))


def _level(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value > b for b in bounds)


def features(page: Page) -> list[tuple[str, ...]]:
    """Categorical features of each node. Their values are bounded by the fixed lists above."""
    n = len(page.tag)
    words, linked, ends = [0] * n, [0] * n, [0] * n
    out: list[tuple[str, ...]] = [()] * n
    for i in range(n - 1, -1, -1):
        text = page.text[i]
        if text is not None:
            words[i], linked[i] = text.count(" ") + 1, page.link_words[i]
            ends[i] = sum(map(text.count, ".!?,"))
        share = _level(linked[i] / words[i], (0.0, 0.3, 0.7)) if words[i] else 4
        if text is not None:
            out[i] = (f"words {_level(words[i], (2, 8, 20))}", f"ends {_level(ends[i], (0, 2))}", f"links {share}")
        else:
            tag = page.tag[i] if page.tag[i] in TAGS else "other"
            # What the names of a part say depends on its element.
            tag = f"{tag} {page.hint[i]}" if tag in REGIONS or tag == "div" else tag
            out[i] = (f"tag {tag}", f"hint {page.hint[i]}", f"inside {share}")
        if i:
            p = page.parent[i]
            words[p], linked[p], ends[p] = words[p] + words[i], linked[p] + linked[i], ends[p] + ends[i]
    return out


def edge_kind(page: Page, i: int) -> str:
    """Which parent-child potential binds a node: a part of the page may differ from its parent, others seldom do.

    Nodes within an element whose tag or names say that it is no main text have a potential of their own.
    """
    if page.parent[i] == 0 and page.tag[i] != "html":
        return "part"
    if page.text[i] is not None:
        return "text"
    if page.tag[i] in REGIONS or page.hint[i] in ("off", "main"):
        return "part"
    return "within" if page.within[i] else "plain"


def own_labels(page: Page) -> list[int] | None:
    """Labels from a page's own markup, or None where it tells nothing."""
    by_hand = any(m in ("main", "off") for m in page.mark)
    labels = [0] * len(page.tag)
    told = False
    for i in range(1, len(page.tag)):
        label, tag = labels[page.parent[i]], page.tag[i]
        if by_hand:
            label = {"main": 1, "off": 0}.get(page.mark[i], label)
        elif tag in OFF_TAGS or page.hint[i] == "off":
            label = 0
        elif (tag in MAIN_TAGS or page.mark[i] == "role") and not _under_off(page, i):
            label, told = 1, True
        labels[i] = label
    return labels if told or by_hand else None


def _under_off(page: Page, i: int) -> bool:
    while i > 0:
        i = page.parent[i]
        if page.tag[i] in OFF_TAGS or page.hint[i] == "off":
            return True
    return False


def count_page(html: str | None, weight: float, into: Counter) -> None:
    """Add a labelled page's counts: (feature, label) and (parent's label, own label)."""
    page = Page(html or "")
    labels = own_labels(page)
    if labels is None:
        return
    for i, found in enumerate(features(page)):
        if i:
            into[f"edge {edge_kind(page, i)} {labels[page.parent[i]]}", labels[i]] += weight
        for f in found:
            into[f, labels[i]] += weight


class Model:
    """Log potentials: ``unary[feature]`` is a pair by label, ``edge[kind][parent][child]`` a table of probabilities."""

    def __init__(self, counts: dict[tuple[str, int], float]) -> None:
        kinds: dict[str, set[str]] = {}
        for f, _ in counts:
            kinds.setdefault(f.split(" ")[0], set()).add(f)
        self.edge: dict[str, list[list[float]]] = {}
        self.unary: dict[str, tuple[float, float]] = {}
        for kind, found in kinds.items():
            if kind == "edge":
                for k in ("text", "plain", "part", "within"):
                    rows = [[counts.get((f"edge {k} {a}", b), 0) + SMOOTHING for b in (0, 1)] for a in (0, 1)]
                    self.edge[k] = [[x / sum(row) for x in row] for row in rows]
                continue
            room = SMOOTHING * (len(found) + 1)
            total = [sum(counts.get((f, b), 0) for f in found) + room for b in (0, 1)]
            weight = TEXT_WEIGHT if kind in ("words", "ends", "links") else 1.0
            for f in found:
                self.unary[f] = tuple(weight * math.log((counts.get((f, b), 0) + SMOOTHING) / total[b]) for b in (0, 1))

    def marginals(self, page: Page) -> list[float]:
        """Probability of main text for each node, by one upward and one downward pass of messages."""
        n = len(page.tag)
        edges = [self.edge[edge_kind(page, i)] for i in range(n)]
        local = [[0.0, 0.0] for _ in range(n)]
        for i, found in enumerate(features(page)):
            for f in found:
                a, b = self.unary.get(f, (0.0, 0.0))
                local[i][0] += a
                local[i][1] += b
        # Upward: what the subtree of i says of its parent's label, and of its own.
        up = [(0.0, 0.0)] * n
        for i in range(n - 1, 0, -1):
            a, b = local[i]
            top = max(a, b)
            a, b, edge = math.exp(a - top), math.exp(b - top), edges[i]
            up[i] = tuple(math.log(edge[y][0] * a + edge[y][1] * b) for y in (0, 1))
            p = local[page.parent[i]]
            p[0] += up[i][0]
            p[1] += up[i][1]
        # Downward: the belief of the parent without i's own message, passed through the potential. The root is off.
        out = [0.0] * n
        for i in range(1, n):
            q = out[page.parent[i]]
            a = math.log(max(1 - q, 1e-300)) - up[i][0]
            b = math.log(max(q, 1e-300)) - up[i][1]
            top = max(a, b)
            a, b, edge = math.exp(a - top), math.exp(b - top), edges[i]
            off = math.log(edge[0][0] * a + edge[1][0] * b) + local[i][0]
            on = math.log(edge[0][1] * a + edge[1][1] * b) + local[i][1]
            out[i] = 1 / (1 + math.exp(min(700.0, off - on)))
        return out

    def main_text(self, html: str | None) -> str:
        if not html:
            return ""
        page = Page(html)
        return "\n".join(t for t, p in zip(page.text, self.marginals(page)) if t is not None and p >= 0.5)


def weighed(sample: Counter, hand_weight: float = HAND_WEIGHT) -> Model:
    """The model of the sample's counts and of those of the pages labelled by hand, brought to one scale."""
    hand: Counter = Counter()
    for page in PAGES:
        count_page(page, 1, hand)
    scale = hand_weight * sum(hand.values()) / max(1, sum(sample.values()))
    return Model({k: hand[k] * hand_weight + sample[k] * scale / hand_weight for k in hand.keys() | sample.keys()})


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, hand_weight: float = HAND_WEIGHT) -> Model:
    """``page_id, html`` -> the model, from the pages labelled by hand and about ``sample_pages`` of the table."""
    bounded_batches(pages.sparkSession)
    share = min(1.0, sample_pages / max(1, pages.count()))
    drawn = pages.where(F.pmod(F.xxhash64("page_id", F.lit("html")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for html in batch.column("html").to_pylist():
                count_page(html, 1, counts)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in keys], pa.string()), pa.array([b for _, b in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
            ["feature", "label", "n"],
        )

    # Not more rows than there are features and labels, whatever the table's size.
    sums = drawn.select("html").mapInArrow(count, "feature string, label int, n bigint").groupBy("feature", "label")
    counts: Counter = Counter({(r["feature"], r["label"]): r["n"] for r in sums.agg(F.sum("n").alias("n")).collect()})
    return weighed(counts, hand_weight)


def main_text_column(model: Model, html: str = "html") -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([model.main_text(h) for h in pages], dtype="object")

    return run(F.col(html))


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, html`` -> ``page_id, url, text, n_chars``."""
    model = fit(pages, sample_pages)
    found = pages.select("page_id", "url", main_text_column(model).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
