"""Main text of web pages by a tree-structured graphical model.

A page's markup becomes a tree of block elements with its text blocks as leaves. Every node
is content or not; its tag, its class, id and role words, and the amount, shape and link
share of its text give it a potential, and every parent-child edge has one. Messages passed
up and down the tree (sum-product) give each node's exact marginal, and the text blocks that
are more likely content than not are the page's text. The trees of a whole Arrow batch are
one forest, so a message pass is a few array operations per depth.

The potentials are trained by gradient ascent on the exact likelihood. Labelled pages are at
most ``SAMPLE`` pages of the table, those with the smallest hash, whose markup itself says
where the article is (one ``article`` or ``main`` element), and variants of them: the same
article in other wrappers, among menus, notices, adverts, forms, sidebars and reader
comments with other tags and class names. A few built-in template pages are always added.

Text blocks end at the start or end of a block element; ``br`` is white space. Scripts,
styles, comments, controls and the like are no text. Character references are decoded,
white space becomes single spaces, blocks are joined by one line feed.

Defined results: a null or empty page, or one without content, has an empty text; markup that
is cut off, nested wrongly or unclosed is read as far as it goes (an unclosed script, style,
textarea, title or comment takes the rest, of other silent elements only the start tag goes);
end tags that match nothing end a text block only; repeated rows give repeated results; an
empty table gives an empty result, from a model of the built-in pages; a column named like the
result is replaced by it. Reading a page takes time in proportion to its length.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import ensure_columns, small_batches

SAMPLE, VARIANTS = 300, 3
#: Blocks of a long article that its training variants are made of, and blocks that go to the
#: pool of other pages' comments; picked at random over the whole article.
BLOCKS, SPARE = 40, 6
FEATURES = 1 << 13
ROUNDS, RATE, DECAY = 160, 0.15, 1e-4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text.
SILENT = frozenset("script style noscript template svg math iframe object head title select textarea button option "
                   "canvas audio video map datalist".split())
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul caption search".split())
#: Silent elements that do not nest: a second start tag ends the first.
FLAT = frozenset("button option select".split())
#: A start tag of the key ends an open element of the values, up to the container that bounds the search.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"']+)\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s\"'>]+)")
_NAME = re.compile(r"[a-z]+")


class Page:
    """Parallel lists of nodes in page order: parent, depth, tag ('#text' for a block of
    text), attribute words, text, characters of it in links, label (-1 unknown)."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.tag: list[str] = []
        self.names: list[list[str]] = []
        self.text: list[str] = []
        self.linked: list[int] = []
        self.label: list[int] = []

    def add(self, parent: int, tag: str, names: list[str], text: str = "", linked: int = 0, label: int = -1) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.names.append(names)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.tag) - 1


def _attributes(raw: str) -> tuple[list[str], int]:
    """Lower-case words of class, id, role and itemprop, and the training label if one is given."""
    names, label = [], -1
    for key, value in _ATTR.findall(raw):
        key = key.lower()
        if key in ("class", "id", "role", "itemprop"):
            names += _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", html.unescape(value)).lower())
        elif key == "data-y":
            label = int(value.strip("\"'"))
    return names, label


def _silent_ends(source: str, tag: str, first: int, at: int) -> dict[int, int]:
    """Where each silent element ends, by the place of its start tag, from the one at ``first``
    whose tag ends at ``at``; those without an end are left out."""
    ends, open_at = {}, [first]
    for e in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).finditer(source, at):
        if e[1]:
            if open_at:
                ends[open_at.pop()] = e.end()
        elif e[0].endswith("/>"):
            continue
        elif tag in FLAT and open_at:
            # the second start of a select is its end, others start anew
            ends[open_at.pop()] = e.end() if tag == "select" else e.start()
            if tag != "select":
                open_at.append(e.start())
        else:
            open_at.append(e.start())
    return ends


def parse(source: str | None) -> Page:
    """The tree of a page."""
    page = Page()
    root = page.add(-1, "#root", [])
    stack: list[tuple[str, int]] = [("#root", root)]
    places: defaultdict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    marks = [-1]
    words: list[str] = []
    state = {"link": False, "linked": 0}

    def flush() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            page.add(stack[-1][1], "#text", [], text, min(state["linked"], len(text)), marks[-1])
        state["linked"] = 0

    def put(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            words.append(text)
            if state["link"]:
                state["linked"] += len("".join(text.split()))

    def pop_to(k: int) -> None:
        flush()
        for gone, _ in stack[k:]:
            places[gone].pop()
        del stack[k:]
        del marks[k:]
        state["link"] = False

    def innermost(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    source, at, n = source or "", 0, len(source or "")
    silent_ends: dict[str, dict[int, int]] = {}
    while at < n:
        m = _TOKEN.search(source, at)
        if m is None:
            put(source[at:])
            break
        put(source[at:m.start()])
        at = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in SILENT:
            if closing or raw.endswith("/"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else n
            else:
                # skip to the matching end tag; without one only the start tag goes
                if tag not in silent_ends:
                    silent_ends[tag] = _silent_ends(source, tag, m.start(), at)
                at = max(at, silent_ends[tag].get(m.start(), at))
            continue
        if tag == "br":
            put(" ")
        elif tag == "a":
            state["link"] = not closing
        elif tag in BLOCK:
            if closing:
                if k := innermost((tag,)):
                    pop_to(k)
                else:
                    flush()
                continue
            flush()
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] != "p"), 0)
            if k < len(stack) - 1:  # a block ends an open paragraph
                pop_to(k + 1)
            if tag in ENDS:
                kinds, bounds = ENDS[tag]
                k = innermost(kinds)
                if k > innermost(bounds):
                    pop_to(k)
            if tag in VOID:
                continue
            names, label = _attributes(raw) if raw else ([], -1)
            marks.append(label if label >= 0 else marks[-1])
            places[tag].append(len(stack))
            stack.append((tag, page.add(stack[-1][1], tag, names, label=marks[-1])))
    flush()
    return page


def _bin(x: float, *limits: float) -> int:
    return sum(x >= v for v in limits)


def _hash(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


class _Hashes(dict):
    def __missing__(self, name: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[name] = _hash(name)
        return h


def node_features(page: Page, hashes: _Hashes) -> list[list[int]]:
    """Active features of every node."""
    n = len(page.tag)
    chars, links, blocks, ends = [0] * n, [0] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):  # children follow their parents
        if page.tag[i] == "#text":
            chars[i], links[i], blocks[i] = len(page.text[i]), page.linked[i], 1
            ends[i] = page.text[i][-1] in ".!?…»”\""
        p = page.parent[i]
        if p >= 0:
            chars[p] += chars[i]
            links[p] += links[i]
            blocks[p] += blocks[i]
            ends[p] += ends[i]
    whole = max(chars[0], 1)
    out = []
    for i in range(n):
        tag = page.tag[i]
        share = _bin(links[i] / max(chars[i], 1), 0.05, 0.3, 0.6, 0.9)
        if tag == "#text":
            of = page.tag[page.parent[i]]
            size = _bin(chars[i], 4, 12, 25, 50, 100, 200, 400)
            t = page.text[i]
            f = [f"t:{of}", f"t:size{size}", f"t:link{share}", f"t:end{int(ends[i])}", f"t:size{size}link{share}",
                 f"t:sign{int('©' in t)}"]
        else:
            size = _bin(chars[i] / whole, 0.02, 0.1, 0.3, 0.5, 0.8)
            mean = _bin(chars[i] / max(blocks[i], 1), 10, 25, 50, 100, 200)
            f = [f"e:{tag}", f"e:share{size}", f"e:mean{mean}", f"e:link{share}", f"e:blocks{_bin(blocks[i], 1, 2, 4, 8)}",
                 f"e:ends{_bin(ends[i] / max(blocks[i], 1), 0.2, 0.5, 0.9)}", f"e:share{size}link{share}",
                 f"e:{tag}mean{mean}", *(f"n:{w}" for w in dict.fromkeys(page.names[i]))]
        out.append([hashes[x] for x in f])
    return out


class Forest:
    """Many pages as arrays ordered by depth."""

    def __init__(self, pages: list[Page], hashes: _Hashes):
        start, parents, depths, kinds, rows, cols = 0, [], [], [], [], []
        for page in pages:
            n = len(page.tag)
            parents.append(np.array(page.parent) + start)
            depths.append(np.array(page.depth))
            kinds.append(np.array([t == "#text" for t in page.tag], np.int64))
            for i, f in enumerate(node_features(page, hashes)):
                rows += [start + i] * len(f)
                cols += f
            start += n
        self.n = start
        self.parent, self.kind = np.concatenate(parents), np.concatenate(kinds)
        self.rows, self.cols = np.array(rows), np.array(cols)
        depth = np.concatenate(depths)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    def marginals(self, theta: np.ndarray, edge: np.ndarray, pairs: bool = False) -> tuple:
        """P(content) of every node and, if asked for, the summed edge marginals by kind."""
        unary = np.zeros((self.n, 2))
        unary[:, 1] = np.bincount(self.rows, theta[self.cols], self.n)
        inbox, up = np.zeros((self.n, 2)), np.zeros((self.n, 2))
        for at in self.levels[:0:-1]:
            own = (unary[at] + inbox[at])[:, None, :] + edge[self.kind[at]]  # parent state, own state
            up[at] = np.logaddexp(own[:, :, 0], own[:, :, 1])
            np.add.at(inbox, self.parent[at], up[at])
        total = unary + inbox
        sums = np.zeros((2, 2, 2))
        for at in self.levels[1:]:
            rest = total[self.parent[at]] - up[at]
            both = rest[:, :, None] + edge[self.kind[at]]
            if pairs:
                joint = both + total[at][:, None, :]
                joint = np.exp(joint - joint.max((1, 2), keepdims=True))
                joint /= joint.sum((1, 2), keepdims=True)
                for kind in (0, 1):
                    sums[kind] += joint[self.kind[at] == kind].sum(0)
            total[at] += np.logaddexp(both[:, 0], both[:, 1])
        p = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -50, 50)))
        return p, sums


class Model:
    def __init__(self, theta: np.ndarray, edge: np.ndarray):
        self.theta, self.edge = theta, edge


def _labels(page: Page) -> np.ndarray:
    """Text blocks as marked; an element is content if most of its text is."""
    good, total = np.zeros(len(page.tag)), np.zeros(len(page.tag))
    for i in range(len(page.tag) - 1, -1, -1):
        if page.tag[i] == "#text":
            total[i], good[i] = len(page.text[i]), len(page.text[i]) * (page.label[i] == 1)
        if page.parent[i] >= 0:
            total[page.parent[i]] += total[i]
            good[page.parent[i]] += good[i]
    return (good > 0.5 * total).astype(float)


def train(pages: list[Page]) -> Model:
    """Maximum likelihood of labelled trees, by gradient ascent with exact expectations."""
    forest = Forest(pages, _Hashes())
    y = np.concatenate([_labels(p) for p in pages])
    seen = np.bincount(forest.cols, y[forest.rows], FEATURES)
    state = y.astype(int)
    edges = np.zeros((2, 2, 2))
    for at in forest.levels[1:]:
        np.add.at(edges, (forest.kind[at], state[forest.parent[at]], state[at]), 1)
    theta, edge = np.zeros(FEATURES), np.zeros((2, 2, 2))
    scale, m, v = 1 / len(pages), [0.0, 0.0], [0.0, 0.0]
    for k in range(1, ROUNDS + 1):
        p, pairs = forest.marginals(theta, edge, True)
        grads = [(seen - np.bincount(forest.cols, p[forest.rows], FEATURES)) * scale - DECAY * theta,
                 (edges - pairs) * scale - DECAY * edge]
        for i, (w, g) in enumerate(zip((theta, edge), grads, strict=True)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w += RATE * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.99 ** k)) + 1e-4)
    return Model(theta, edge)


def extract(sources: list[str | None], model: Model, hashes: _Hashes | None = None) -> list[str]:
    """Main text of each page."""
    pages = [parse(s) for s in sources]
    p, _ = Forest(pages, hashes if hashes is not None else _Hashes()).marginals(model.theta, model.edge)
    out, start = [], 0
    for page in pages:
        out.append("\n".join(t for i, t in enumerate(page.text) if page.tag[i] == "#text" and p[start + i] > 0.5))
        start += len(page.tag)
    return out


_OUTSIDE = frozenset("nav aside footer form header menu dialog search".split())
_OTHER_NAMES = frozenset("ad ads advert comment comments sidebar share related promo menu nav footer cookie notice "
                         "newsletter".split())


def self_labelled(source: str | None) -> Page | None:
    """The tree with labels, if the page has exactly one article or else one main element."""
    page = parse(source)
    for name in ("article", "main"):
        if page.tag.count(name) == 1:
            break
    else:
        return None
    inside, other = [False] * len(page.tag), [False] * len(page.tag)
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        inside[i] = tag == name or (p >= 0 and inside[p])
        other[i] = tag in _OUTSIDE or bool(_OTHER_NAMES & set(page.names[i])) or (p >= 0 and other[p])
        page.label[i] = int(inside[i] and not other[i])
    return page


def _wrapped(rng: np.random.Generator, choices: str, inner: str, y: int) -> str:
    options = choices.split()
    tag, _, name = options[rng.integers(len(options))].partition(".")
    attr = f' {("class", "id")[rng.integers(2)]}="{name}"' if name and rng.random() > 0.1 else ""
    return f'<{tag}{attr} data-y="{y}">{inner}</{tag}>'


def variant(article: list[str], spare: list[str], rng: np.random.Generator) -> str:
    """An invented page around the blocks of an article; ``spare``: sentences for the rest."""

    def words(n: int) -> str:
        got = spare[rng.integers(len(spare))].split()
        return html.escape(" ".join(got[:n]) or "more")

    def sentence() -> str:
        return f"<p>{words(int(rng.integers(6, 40)))}</p>" if rng.random() < 0.6 else words(int(rng.integers(3, 20)))

    def links(n: int) -> str:
        items = "".join(f'<li><a href="/x">{words(int(rng.integers(1, 4)))}</a></li>' for _ in range(n))
        return f"<ul>{items}</ul>"

    def said() -> str:
        return _wrapped(rng, "div.comment li.comment article.comment div div.reply", f"<p>{words(3)}</p>"
                        f"<p>{words(int(rng.integers(8, 60)))}</p>", 0)

    menu = _wrapped(rng, "nav nav.menu div.menu div.nav div.navbar div.navigation ul.menu div.breadcrumb", links(
        int(rng.integers(3, 9))), 0)
    header = _wrapped(rng, "header header.header div.header div.masthead div.topbar", f'<a href="/">{words(2)}</a> '
                      f"{words(5)}", 0)
    footer = _wrapped(rng, "footer footer.footer div.footer div.copyright", f"&copy; {words(2)} &middot; {words(12)}", 0)
    advert = _wrapped(rng, "div.ad div.ads div.advert div.advertisement aside.promo div.sponsored div.banner", sentence(), 0)
    side = _wrapped(rng, "aside aside.sidebar div.sidebar div.related div.widget section.related", f"<h3>{words(2)}</h3>"
                    + (links(4) if rng.random() < 0.7 else sentence()), 0)
    notice = _wrapped(rng, "div.cookie div.cookie-notice div.notice div.consent div.alert section.cookie dialog "
                      "div.privacy div.popup", f"{sentence()}<button>{words(1)}</button>", 0)
    form = _wrapped(rng, "form form.search form.newsletter div.newsletter div.subscribe form.login", f"<label>{words(3)}"
                    f"</label><input><p>{words(9)}</p>", 0)
    talk = _wrapped(rng, "section.comments div.comments div.comment-list div.responses ol.comments section.discussion",
                    f"<h3>{words(2)}</h3>" + "".join(said() for _ in range(int(rng.integers(1, 5)))), 0)
    share = _wrapped(rng, "div.share div.social ul.share div.tags", links(3), 0)
    kinds = ["p", "p", "p", "p", "div", "li", "blockquote", "h2"]
    body = [f"<{'p' if len(b) > 200 else (k := kinds[rng.integers(len(kinds))])}>{html.escape(b)}</"
            f"{'p' if len(b) > 200 else k}>" for b in article]
    if body and rng.random() < 0.7:
        body[0] = f"<h1>{html.escape(article[0])}</h1>"
    inner = list(body)
    for part in (advert, share, form, side):
        if rng.random() < 0.15:
            inner.insert(int(rng.integers(0, len(inner) + 1)), part)
    if rng.random() < 0.25:
        inner.append(talk)
    main = _wrapped(rng, "article article main div.content div.post div.entry div.article div.article-body "
                    "div.post-content section.content div.story div.main div.text section div", "".join(inner), 1)
    if rng.random() < 0.3:
        main = _wrapped(rng, "main div.container div.wrapper div.page div section", main, 0)
    before = [x for x, p in ((notice, 0.3), (header, 0.6), (menu, 0.8), (form, 0.2), (advert, 0.4)) if rng.random() < p]
    after = [x for x, p in ((share, 0.2), (talk, 0.4), (side, 0.4), (advert, 0.2), (form, 0.2), (footer, 0.8),
                            (notice, 0.2)) if rng.random() < p]
    return f"<html><body data-y=\"0\">{''.join(before)}{main}{''.join(after)}</body></html>"


#: Invented text for the built-in pages.
_BUILT_IN = [
    "The river rose for three days.", "Nobody in the village had seen such a flood before, and the old bridge did not hold.",
    "By the weekend the water had gone, and people began to clean their houses, to dry their books and to count what "
    "was lost. It took most of the summer until the school could open again, and the shops on the lower street waited "
    "even longer for their new floors.", "What remains", "A line on the wall of the mill marks how high it stood.",
    "Short.", "The council has since moved the pumps to higher ground and keeps a list of volunteers for the next time."]


def labelled_pages(sources: list[str], seed: int = 9) -> list[Page]:
    """Training trees: the pages that label themselves, variants of them, and built-in ones."""
    rng = np.random.default_rng(seed)
    own = [p for p in map(self_labelled, sources) if p is not None]
    articles = [[t for t, y in zip(p.text, p.label, strict=True) if t and y == 1] for p in own]
    picks = np.random.default_rng(seed + 1)

    def some(blocks: list[str], most: int) -> list[str]:
        chosen = picks.permutation(len(blocks))[:most]
        return [blocks[k] for k in sorted(chosen)]

    articles = [some(a, BLOCKS) for a in articles * VARIANTS if a] + [_BUILT_IN] * 40
    spare = [t for a in articles for t in some(a, SPARE)]
    # some articles are a line or two among a full set of menus
    articles = [a[:int(rng.integers(1, 3))] if rng.random() < 0.25 else a for a in articles]
    return own + [parse(variant(a, spare, rng)) for a in articles]


def fit(pages: DataFrame) -> Model:
    """Train on at most SAMPLE different pages, those with the smallest hash."""
    # the hashes first (8 bytes a row from each task), then the few pages that have them
    hashed = pages.filter("html is not null").select("html", F.xxhash64("html").alias("__h"))
    least = [r[0] for r in hashed.select("__h").distinct().orderBy("__h").limit(SAMPLE).collect()]
    sample = hashed.filter(F.col("__h").isin(least)).select("html").distinct().collect() if least else []
    sample = sorted(sample, key=lambda r: r["html"])
    return train(labelled_pages([r["html"] for r in sample]))


def _batches(shared, at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            texts: list[str] = []
            sources = batch.column(at).to_pylist()
            for k in range(0, len(sources), 64):
                texts += extract(sources[k:k + 64], shared.value, hashes)
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], names=[*names, "__main"])

    return run


def main_text(pages: DataFrame, model: Model | None = None, name: str = "text") -> DataFrame:
    """``pages`` (html and anything else) without html, with the main text as ``name``."""
    ensure_columns(pages, "html")
    model = model if model is not None else fit(pages)
    spark = pages.sparkSession
    small_batches(spark)
    rest = pages.drop("html")
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields), "__main string"])
    run = _batches(spark.sparkContext.broadcast(model), pages.columns.index("html"))
    out = pages.mapInArrow(run, fields)
    return out.select(*[c for c in rest.columns if c != name], F.col("__main").alias(name))
