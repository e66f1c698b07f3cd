"""Main text of web pages by tag-path ratios.

A page is read into text blocks; a block knows the path of tags (with class and id words) from the root to it. Per
path are summed: characters of text, punctuation marks, characters inside links, blocks. A path's text ratio is its
unlinked text per block, its punctuation ratio the marks per block. Both ratios are laid along the page's sequence of blocks and
smoothed with a Gaussian, so that a short heading between long paragraphs shares their values; the smoothed values
are fused by their product, averaged again per path, and paths above a threshold (Otsu's, on the logarithm) are
content paths. They choose the nodes: the article or main elements that hold most of them, else the
deepest element with nearly all of their text. The main text is every block of those nodes in page order, except blocks inside menus,
headers outside the article, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments (by element or by
class and id words), and lists of links below the threshold.

White space inside a block (also line breaks and no-break spaces) becomes one space, inline tags leave no trace, blocks are
joined by one space. Character references are decoded once, after the markup is read, as browsers do.

Defined cases: null or empty html gives an empty text and 0; html without tags is one block; unclosed elements end with
their parents, a cut-off tag or comment ends the page; equal pages have equal texts; other columns are ignored,
whatever their names. A page is read whole, in time that grows with its length.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, steps

SIGMA = 1.0               # of the Gaussian along the blocks
NEARLY_ALL = 0.8          # share of the content that a node must hold to be looked into further
SIMILAR = 0.5             # an article counts beside the best one from this share of its content
LINKED = 0.8              # share of linked text from which a list is a list of links
LEAST_LINKS = 3

_ATTRS = (r"""(?:[^>=]*+=[ \t\n\f\r]*+(?:"[^"]*+"|'[^']*+'|[^"'>\s][^\s>]*+|))*+[^>=]*+""")
_TOKEN = re.compile(rf"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)({_ATTRS})>|[!?/][^>]*+>)")
_NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:[ \t\n\f\r]*=[ \t\n\f\r]*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"'>]|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？；：،؛؟।]")

# Elements by their part in a page, class and id words by what they name.
BOXES = frozenset("html body div section article main center table tbody tr td".split())
LISTS = frozenset("li ul ol td div section dd dt".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img".split())
NEVER = frozenset("head script style textarea title noscript iframe object svg math template canvas audio video select option button "
                  "input label datalist dialog nav footer aside menu".split())
ARTICLES = frozenset("article main".split())
HARD_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())
SOFT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs consent cookie cookies copyright "
    "dialog disclaimer footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "overlay pager pagination popup promo promos promotion recommended recommendations related search share sharing sidebar sidenav signup skip "
    "social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
# An element of the first kind ends open elements of the second, up to the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "option": ({"option"}, {"select"})}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup main menu nav ol p pre section summary table ul".split())
HOLDERS = frozenset("table td th article main section div body button object form".split())


class Element:
    """An open or closed element: its place in the tree, its path, and why its text may not count."""

    __slots__ = ("tag", "parent", "path", "never", "soft", "article", "linked", "weight", "depth", "holds_article", "kept")

    def __init__(self, tag, parent, path, never, soft, article, linked):
        self.tag, self.parent, self.path = tag, parent, path
        self.never, self.soft, self.article, self.linked = never, soft, article, linked
        self.weight, self.holds_article, self.depth, self.kept = 0.0, False, parent.depth + 1 if parent else 0, None


class Page:
    """Text blocks of a page, with the element and the share of linked characters of each."""

    def __init__(self, source: str):
        self.paths: dict[tuple, int] = {}
        self.root = Element("", None, -1, False, False, False, False)
        self.stack, self.open = [self.root], {}
        self.elements = [self.root]
        self.texts: list[str] = []
        self.owner: list[Element] = []
        self.links: list[int] = []
        self.parts: list[tuple[str, bool]] = []
        self.holder = self.root
        self.read(source)
        self.end_block()

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            begin = source.find("<", at)
            if begin < 0:
                self.text(source[at:])
                return
            found = _TOKEN.match(source, begin)
            if found is None:
                after = source[begin + 1:begin + 2]
                if after.isascii() and after.isalpha() or after in ("/", "!", "?") and after:
                    self.text(source[at:begin])       # a tag that the page's end cuts off
                    return
                self.text(source[at:begin + 1])
                at = begin + 1
                continue
            self.text(source[at:begin])
            at = found.end()
            if found[1]:
                end = source.find("-->", begin + 2)
                at = n if end < 0 else end + 3
            elif found[3]:
                tag = found[3].lower()
                if found[2]:
                    self.close(tag)
                else:
                    self.start(tag, found[4])
                    if tag in RAW:
                        at = self.raw(source, at, tag)

    def raw(self, source: str, at: int, tag: str) -> int:
        """Past the text of an element whose content is no markup; that text never counts."""
        end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
        self.close(tag)
        return end.end() if end else len(source)

    def text(self, piece: str) -> None:
        if piece:
            self.parts.append((entities.unescape(piece) if "&" in piece else piece, self.stack[-1].linked))

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(p for p, _ in self.parts).split())
            if text:
                self.texts.append(text)
                self.owner.append(self.holder)
                self.links.append(sum(len("".join(p.split())) for p, linked in self.parts if linked))
            self.parts = []

    def start(self, tag: str, attrs: str) -> None:
        inline = tag in INLINE
        if not inline:
            self.end_block()
        if tag in VOID:
            return
        if not inline:
            self.implied(tag)
        parent = self.stack[-1]
        words, roles, hidden = names(attrs) if attrs else ((), (), False)
        tokens = {w for w in words if w in SOFT_WORDS or w in HARD_WORDS}
        whole = tag in ("html", "body")
        never = not whole and (parent.never or tag in NEVER or hidden or tag != "main" and bool(tokens & HARD_WORDS))
        in_article = parent.article
        soft = not whole and (bool(tokens & SOFT_WORDS) or bool(ROLES & set(roles)) or tag == "form" or tag == "header" and not in_article)
        article = in_article or tag in ARTICLES or "main" in roles or "articleBody" in roles
        path = self.paths.setdefault((parent.path, tag if inline else " ".join((tag, *words))), len(self.paths)) if not inline else parent.path
        element = Element(tag, parent, path, never, soft, article, parent.linked or tag == "a")
        self.elements.append(element)
        if (never or soft) != (parent.never or parent.soft) and inline:
            self.end_block()          # an advert or hidden text inside a line
        self.stack.append(element)
        self.open[tag] = self.open.get(tag, 0) + 1
        self.holder = element if not inline or never != parent.never or soft else self.holder

    def implied(self, tag: str) -> None:
        """Ends elements that the start of ``tag`` ends."""
        if tag in CLOSES:
            ended, until = CLOSES[tag]
            if not any(self.open.get(t) for t in ended):
                return
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in until:
                    return
                if self.stack[i].tag in ended:
                    self.pop(i)
                    if tag != "tr" or not self.open.get("tr"):
                        return
        elif tag in ENDS_P and self.open.get("p"):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == "p":
                    return self.pop(i)
                if self.stack[i].tag in HOLDERS:
                    return None
        if tag == "body" and self.open.get("head"):
            i = next(i for i, e in enumerate(self.stack) if e.tag == "head")
            self.pop(i)
        return None

    def close(self, tag: str) -> None:
        inline = tag in INLINE
        if not inline:
            self.end_block()
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                if inline and any(e.tag not in INLINE for e in self.stack[i + 1:]):
                    return            # it ends with the block that it is in
                return self.pop(i)

    def pop(self, i: int) -> None:
        ended = self.stack[i:]
        if any(e.tag not in INLINE or e.never != e.parent.never or e.soft for e in ended):
            self.end_block()
        for e in ended:
            self.open[e.tag] -= 1
        del self.stack[i:]
        top = self.stack[-1]
        while top.tag in INLINE and top.parent is not None and top.never == top.parent.never and not top.soft:
            top = top.parent
        self.holder = top


def names(attrs: str) -> tuple[tuple[str, ...], tuple[str, ...], bool]:
    """Words of class and id (without digits), roles, and whether the element is hidden."""
    words, roles, hidden = [], [], False
    for name, value in _NAMED.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            words += [w.lower() for w in _WORD.findall(value)]
        elif name in ("role", "itemprop"):
            roles.append(value)
        elif name == "style":
            hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        else:
            hidden = hidden or (name == "hidden" or value.lower() == "true")
    return tuple(words), tuple(roles), hidden


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    total = np.convolve(values, kernel)[radius:radius + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[radius:radius + len(values)]


def threshold(scores: np.ndarray, weights: np.ndarray) -> float:
    """Otsu's threshold: the split of the weighted scores with the greatest variance between both sides."""
    order = np.argsort(scores, kind="stable")
    x, w = scores[order], weights[order].astype(float)
    if len(x) < 2 or x[0] == x[-1]:
        return -np.inf
    low, total = np.cumsum(w)[:-1], w.sum()
    mean_low = np.cumsum(w * x)[:-1] / low
    mean_high = ((w * x).sum() - np.cumsum(w * x)[:-1]) / (total - low)
    between = low * (total - low) * (mean_high - mean_low) ** 2
    between[x[1:] == x[:-1]] = -1
    k = int(np.argmax(between))
    return float((x[k] + x[k + 1]) / 2)


def content_blocks(page: Page, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per block, as far as ``counted``: whether its path is a content path, whether it is one of a list of links."""
    content, lists = np.zeros(len(page.texts), bool), np.zeros(len(page.texts), bool)
    at = np.flatnonzero(counted)
    if not len(at):
        return content, lists
    texts, owners = [page.texts[i] for i in at], [page.owner[i] for i in at]
    _, path = np.unique([e.path for e in owners], return_inverse=True)
    chars = np.array([len(t) - t.count(" ") for t in texts], float)
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts], float)
    links = np.minimum(np.array(page.links, float)[at], chars)
    n, total = np.bincount(path), np.bincount(path, chars)
    text_ratio, mark_ratio = np.bincount(path, chars - links) / n, np.bincount(path, marks) / n
    fused = smoothed(text_ratio[path]) * (1 + smoothed(mark_ratio[path]))
    score = np.log1p(np.bincount(path, fused) / n)
    high = score >= threshold(score, n)
    linked = ~high & (np.bincount(path, links) >= LINKED * total) & (n >= LEAST_LINKS)
    content[at] = high[path]
    lists[at] = linked[path] & np.array([e.tag in LISTS for e in owners])
    return content, lists


def excluded(element: Element, ignored: set[int]) -> bool:
    """Whether an element lies in something that isn't main text; soft marks of ``ignored`` elements don't count."""
    chain = []
    while element is not None and element.kept is None:
        chain.append(element)
        element = element.parent
    out = element.kept if element is not None else False
    for e in reversed(chain):
        out = e.kept = out or e.never or e.soft and id(e) not in ignored
    return out


def extract(source: str) -> tuple[str, str]:
    """(main text, path of the first chosen node)."""
    page = Page(source)
    if not page.texts:
        return "", ""
    chars = np.array([len(t) for t in page.texts], float)
    open_ = np.array([not o.never for o in page.owner])
    # what holds an article or the first heading is no sidebar, whatever its class; without these, what holds half of the content isn't
    weigh(page, (chars * open_).tolist())
    ignored, articles = set(), False
    for e in page.elements:
        if e.tag in ARTICLES and not e.never and e.weight:
            articles, up = True, e.parent
            while up is not None and not up.holds_article:
                up.holds_article = True
                up = up.parent
    if not articles:
        for e in page.elements:
            if e.tag == "h1" and not e.never and e.weight:
                chain = []
                while (e := e.parent) is not None:
                    chain.append(e)
                if not any(up.soft and up.tag in ("header", "form") for up in chain):
                    articles = True
                    for up in chain:
                        up.holds_article = True
                    break
        weigh(page, (chars * content_blocks(page, open_)[0]).tolist())
    for e in page.elements:
        if e.soft and not e.never and (e.holds_article or not articles and 2 * e.weight > page.root.weight):
            ignored.add(id(e))
    counted = np.array([not excluded(o, ignored) for o in page.owner])
    content, lists = content_blocks(page, counted)
    weigh(page, (chars * content).tolist())
    chosen = chosen_nodes(page, ignored)
    marked = {id(e) for e in chosen}
    inside: dict[int, bool] = {}
    texts = [t for t, o, ok in zip(page.texts, page.owner, counted & ~lists) if ok and within(o, marked, inside)]
    return " ".join(texts), path_of(chosen[0])


def weigh(page: Page, weights: list[float]) -> None:
    """Every element's sum over the blocks that it holds."""
    for e in page.elements:
        e.weight = 0.0
    for owner, w in zip(page.owner, weights):
        owner.weight += w
    for e in reversed(page.elements):          # children come after their parents
        if e.parent is not None:
            e.parent.weight += e.weight


def chosen_nodes(page: Page, ignored: set[int]) -> list[Element]:
    articles = [e for e in page.elements if e.article and not e.parent.article and e.weight > 0 and not excluded(e, ignored)]
    if articles:
        # articles inside a main element count by themselves, if they hold nearly all of it
        best = max(e.weight for e in articles)
        outer = [e for e in articles if e.weight >= SIMILAR * best]
        inner = [e for e in page.elements if e.tag == "article" and e.parent.article and e.weight > 0 and not excluded(e, ignored)]
        top = max((e.weight for e in inner), default=0)
        if outer and inner and all(o.tag != "article" for o in outer):
            alike = [e for e in inner if e.weight >= SIMILAR * top]
            if sum(e.weight for e in alike) >= NEARLY_ALL * sum(o.weight for o in outer):
                return alike
        if sum(e.weight for e in outer) >= SIMILAR * page.root.weight:
            return outer
    children: dict[int, list[Element]] = {}
    for e in page.elements[1:]:
        children.setdefault(id(e.parent), []).append(e)
    node = page.root
    while True:
        inner = max(children.get(id(node), ()), key=lambda e: e.weight, default=None)
        texts = sum(e.weight for e in children.get(id(node), ()) if e.tag not in BOXES)
        if inner is None or inner.tag not in BOXES or texts or inner.weight < NEARLY_ALL * page.root.weight or not inner.weight:
            return [node]
        node = inner


def within(element: Element, marked: set[int], known: dict[int, bool]) -> bool:
    chain = []
    while element is not None and id(element) not in known:
        chain.append(id(element))
        if id(element) in marked:
            known[id(element)] = True
            break
        element = element.parent
    out = known[id(element)] if element is not None else False
    known.update(dict.fromkeys(chain, out))
    return out


def path_of(element: Element) -> str:
    tags = []
    while element.parent is not None:
        tags.append(element.tag)
        element = element.parent
    return "/".join(reversed(tags))


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars, content_path) of every page; the names of the id and url columns stay."""
    src = df.select(F.col(id_col), F.col(url_col), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("__html"))
    new = T.StructType.fromDDL("text string, n_chars long, content_path string")
    out = T.StructType(src.schema.fields[:2] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(new)
        for batch in batches:
            for part in steps(batch, column="__html"):
                found = [extract(h) for h in part.column(2).to_pylist()]
                values = [[t for t, _ in found], [len(t) for t, _ in found], [p for _, p in found]]
                arrays = [part.column(0), part.column(1)] + [pa.array(v, f.type) for v, f in zip(values, target)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return src.mapInArrow(run, out)
