"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between the borders of block elements, in page
order. Each block has features of its ancestors (tags, class, id and role words) and of its text
(length, links, punctuation, whether it is the page's title). A chain with the labels *main* and
*other* scores a labelling by these features and by the step from one block to the next; Viterbi
finds the best one, and the main blocks are the text.

The field is trained on labelled pages of two kinds. Layouts below are labelled by construction
and filled with words of the pages at hand; pages that mark their article with an element of
its own are labelled by it. Ancestor features are dropped at random in training, so that text and
neighbours count too.
"""

from __future__ import annotations

import html as html_rules
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import pick

#: Pages of the sample that are learned from, their largest size in characters, and blocks in a training page at most.
SAMPLE_PAGES, SAMPLE_CHARS, SAMPLE_BLOCKS = 150, 100_000, 120
#: Pages written for each layout, steps of the fit, weight of the penalty.
PER_LAYOUT, STEPS, PENALTY = 40, 120, 0.1
#: Elements a worker remembers before it starts anew.
REMEMBERED = 50_000

# Elements that do not break a block, that hold no other, whose text is never shown,
# and that a start tag of their own kind closes.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style template noscript svg iframe object title".split())
CLOSED_BY_KIND = frozenset("p li dt dd tr td th option".split())
CONTAINERS = frozenset("ul ol dl table select article section div main body aside nav footer header form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_word = re.compile("[a-z]{2,}").findall


class Element:
    """An element as its start tag and its ancestors tell it; pages share equal ones."""

    __slots__ = ("tag", "parent", "children", "features", "score")

    def __init__(self, tag: str, attributes: str, parent: Element | None) -> None:
        self.tag, self.parent, self.children, self.score = tag, parent, {}, None
        names = {f"t={tag}"} | {f"c={w}" for value in _ATTRIBUTE.findall(attributes) for w in _word(value.lower())}
        self.features = frozenset(names | {f for f in (parent.features if parent else ()) if f[0] != "l"} | {f"leaf={tag}"})


@dataclass
class Block:
    element: Element
    text: str
    features: list[str]
    main: bool = False


class Reader:
    """Pages into leaf blocks."""

    def __init__(self) -> None:
        self.top, self.n = Element("html", "", None), 0

    def _child(self, parent: Element, tag: str, attributes: str) -> Element:
        key = (tag, attributes)
        if key not in parent.children:
            parent.children[key] = Element(tag, attributes, parent)
            self.n += 1
        return parent.children[key]

    def blocks(self, page: str | None) -> list[Block]:
        """The leaf blocks of a page in page order, whatever it is made of."""
        if self.n > REMEMBERED:
            self.top, self.n = Element("html", "", None), 0
        page = page or ""
        found: list[tuple[Element, str, int]] = []
        parts: list[str] = []
        here, links, linked, title, at = self.top, 0, 0, "", 0

        def close() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    found.append((here, text, linked))
                parts.clear()
            linked = 0

        while True:
            match = _TAG.search(page, at)
            shown = page[at : match.start() if match else None]
            if shown:
                shown = html_rules.unescape(shown) if "&" in shown else shown
                parts.append(shown)
                linked += len(shown) if links else 0
            if not match:
                break
            at = match.end()
            ending, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in UNSEEN and not ending:
                stop = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                if tag == "title" and not title:
                    title = " ".join(html_rules.unescape(page[at : stop.start() if stop else None]).split())
                at = stop.end() if stop else len(page)
            elif tag in INLINE:
                if tag == "br":
                    parts.append(" ")
                elif tag == "a":
                    links = 0 if ending else 1
            else:
                close()
                if ending:
                    here = _without(here, tag)
                elif tag not in VOID and tag != "html" and not (tag == "body" and here.tag not in ("html", "head")):
                    if tag == "body":
                        here = self.top
                    elif tag in CLOSED_BY_KIND:
                        here = _outside(here, tag)
                    elif here.tag == "p":
                        here = here.parent
                    here = self._child(here, tag, attributes if "=" in attributes else "")
        close()
        return _with_features(found, title)


def _without(here: Element, tag: str) -> Element:
    """Where an end tag leads: out of the innermost element of its kind, if one is open."""
    at = here
    while at.parent is not None:
        if at.tag == tag:
            return at.parent
        at = at.parent
    return here


def _outside(here: Element, tag: str) -> Element:
    """Where an element goes that closes an open one of its kind (and a paragraph)."""
    at = here
    while at.parent is not None and at.tag not in CONTAINERS:
        if at.tag == tag or at.tag == "p":
            return at.parent
        at = at.parent
    return here


def _with_features(found: list[tuple[Element, str, int]], title: str) -> list[Block]:
    blocks = []
    headed = False
    for element, text, linked in found:
        n = len(text)
        names = [f"len={min(11, n.bit_length())}", f"link={0 if not linked else 1 + min(2, 3 * linked // (n + 1))}", f"commas={min(3, text.count(','))}"]
        if text[-1] in ".!?…:;\"”'»)":
            names.append("ended")
        if "©" in text:
            names.append("rights")
        if text == title:
            names.append("title")
        names.append("below" if headed else "above")
        headed = headed or element.tag == "h1" or text == title
        blocks.append(Block(element, text, names))
    return blocks


@dataclass
class Chain:
    """The trained field: a weight of each feature for *main* against *other*, and of each step."""

    weights: dict[str, float] = field(default_factory=dict)
    #: by whether both blocks have the same ancestors, then the label before and the label
    steps: list = field(default_factory=lambda: [[[0.0, 0.0], [0.0, 0.0]]] * 2)

    def _score(self, block: Block) -> float:
        element, known = block.element, self.weights
        if element.score is None:
            element.score = sum(known.get(f, 0.0) for f in element.features)
        return element.score + sum([known.get(f, 0.0) for f in block.features])

    def labels(self, blocks: list[Block]) -> list[bool]:
        """The most probable labelling, by Viterbi; *other* where both are alike."""
        if not blocks:
            return []
        other, main = 0.0, self._score(blocks[0])
        back: list[tuple[bool, bool]] = []
        before = blocks[0].element
        for block in blocks[1:]:
            (oo, om), (mo, mm) = self.steps[block.element is before]
            before = block.element
            from_other, from_main = other + oo, main + mo
            into_other, into_main = other + om, main + mm
            back.append((from_main > from_other, into_main > into_other))
            other = max(from_other, from_main)
            main = max(into_other, into_main) + self._score(block)
        label = main > other
        told = [label]
        for choices in reversed(back):
            label = choices[label]
            told.append(label)
        return told[::-1]

    def main_text(self, blocks: list[Block]) -> str:
        return "\n".join(b.text for b, main in zip(blocks, self.labels(blocks)) if main)


# Layouts of labelled pages. A part is a path of elements (with .class words, $kind for one
# of the words below), then what stands in it; "!" marks what belongs to the main text, a number how
# often the part may come.
LAYOUTS = [
    "nav>ul>li=link*6 div.$ad=short article>h1=title! article>p=prose*6! footer=rights",
    "header.site>div.logo=name nav.$menu>ul>li=link*5 main>article>h1=title! main>article>p=prose*5! aside.$side>h3=name aside.$side>ul>li=link*5 footer.footer>p=rights",
    "div#header>h1=name div#$menu=links div#$main>h1=title! div#$main>p=prose*6! div#$side>ul>li=link*6 div#footer=rights",
    "div.$notice>p=notice header=name div.$main>h1=title! div.$main>div.$main>p=prose*6! div.$remarks>h3=name div.$remarks>div.$remarks>p=remark*5 footer=rights",
    "div.top.$menu>ul>li=link*6 div.$ad=short div.$main>h2=title! div.$main>p=prose*5! div.$side>ul>li=link*4 div.$legal=rights",
    "header>h1=name nav=links main>h1=title! main>p=prose*4! main>h3=heading! main>p=prose*3! main>ul>li=item*4! section.$remarks>article.$remarks>p=remark*4 form.search>label=name footer=rights",
    "div.$notice=notice div.$menu>ul>li=link*5 article.$main>header>h1=title! article.$main>p=prose*4! article.$main>div.$ad=short article.$main>p=prose*3! article.$main>footer>p=short div.$side>form>label=notice div.footer=rights",
    "table.$menu>tr>td=link*5 table.$main>tr>td>h1=title! table.$main>tr>td>p=prose*5! table.foot>tr>td=rights",
    "header=name aside>p=short aside>ul>li=link*4 article>h1=title! article>p=prose*3! article>blockquote>p=prose! article>h2=heading! article>p=prose*3! article>pre=short! section#$remarks>p=remark*6 form>p=notice footer>p=rights",
    "div.breadcrumb=link div.$main>h1=title! div.$main>p=prose*4! div.$main>div.$ad>p=prose div.$main>h3=heading! div.$main>p=prose*3! div.$side>ul>li=link*3 div.$remarks>div.$remarks=remark*4 div.$legal=rights",
    "div.$notice.$notice=notice div.$side>form>label=name div.$main.$main>h1=title! div.$main.$main>p=prose*7! div.$side>h4=name div.$side>p=short*3 footer.$legal=rights",
    "nav>ul>li=link*3 article>h1=title! article>p=prose! footer=rights",
    "nav>ul>li=link*6 div.$ad=prose article>h1=title! article>p=prose*8! article>p=short*2! article>p=item! aside=prose*2 section.$remarks>p=prose*3 footer=prose",
    "header>p=prose div.$notice>p=prose article>h1=title! article>p=prose*4! article>p=item*2! article>aside>p=prose article>p=prose! article>div.$remarks>p=prose*3 form>p=prose footer>p=prose",
    "div.$menu=links div.$notice=prose div.$ad=prose main>h1=title! main>p=prose*5! main>div.$notice=prose main>p=prose*2! div.$side=prose*2 div.$remarks>ul>li=prose*3 div.footer=prose",
    "div.top=short nav=links article>h1=title! article>section>h2=heading! article>section>p=prose*5! article>section>h3=heading! article>section>h4=heading! article>section>p=prose*3! article>table>tr>td=item*4! article>figure>figcaption=short! article>ol>li=prose*3! footer=rights",
    "header>nav>ul>li=link*4 article>h1=title! article>p=prose*2! article>div.$ad=short article>p=item*3! article>ul>li=short*4! article>form>label=name article>form>button=name article>p=prose*2! article>div.$side=link article>section.$remarks>div.$remarks=remark*4 footer>p=rights",
    "div.$main>h1=title! div.$main>p=prose*3! div.$main>nav>ul>li=link*3 div.$main>p=prose*3! div.$main>ul.$side>li=link*3 div.$main>div.$notice>p=notice aside>p=prose footer=rights",
]
CLASS_WORDS = {
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion banner".split(),
    "menu": "menu nav navbar navigation topbar links tabs".split(),
    "side": "sidebar widget related share social recommended newsletter subscribe more".split(),
    "notice": "cookie cookies notice alert consent gdpr popup modal warning disclaimer".split(),
    "remarks": "comment comments reply replies remarks discussion reviews disqus responses".split(),
    "legal": "copyright legal privacy footer imprint colophon".split(),
    "main": "article content post entry story body main text hentry page".split(),
}
PLAIN_WORDS = "the of and to in is it that was for on are with as his they at be this from have or by one had not but what all were".split()


def _written(kind: str, words: list[str], title: str, rng: random.Random) -> str:
    def some(low: int, high: int) -> str:
        return " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))

    def sentence(low: int, high: int) -> str:
        return some(low, high).capitalize() + rng.choice(".....!?,")

    match kind:
        case "title":
            return title
        case "link":
            return f'<a href="/x">{some(1, 2)}</a>'
        case "links":
            return " | ".join(f'<a href="/x">{some(1, 2)}</a>' for _ in range(rng.randint(2, 6)))
        case "name" | "heading":
            return some(1, 5)
        case "item":
            return some(1, 12) + rng.choice([".", ""])
        case "short":
            return sentence(3, 15)
        case "notice":
            return sentence(5, 20) + ' <a href="/x">' + some(1, 3) + "</a>"
        case "rights":
            return rng.choice(["&copy; ", "© 2020 ", "&copy; &middot; "]) + some(1, 8)
        case "remark":
            return " ".join(sentence(3, 12) for _ in range(rng.randint(1, 3)))
        case _:
            return " ".join(sentence(4, 20) for _ in range(rng.randint(1, 6)))


def labelled_page(layout: str, words: list[str], rng: random.Random) -> tuple[str, list[bool]]:
    """A page of a layout, and for each of its leaf blocks whether it is main text."""
    title = " ".join(rng.choice(words) for _ in range(rng.randint(2, 9))).capitalize() + rng.choice(["", "."])
    drawn = {kind: rng.choice(names) for kind, names in CLASS_WORDS.items()}
    out, labels, open_ = [f"<html><head><title>{title}</title></head><body>"], [], []
    for part in re.sub(r"\$([a-z]+)", lambda m: drawn[m[1]], layout).split():
        path, kind = part.rstrip("!").split("=")
        kind, _, most = kind.partition("*")
        outer, inner = path.split(">")[:-1], path.split(">")[-1]
        if open_ != outer:
            same = next((i for i, (a, b) in enumerate(zip(open_, outer)) if a != b), min(len(open_), len(outer)))
            out += [f"</{re.match('[a-z0-9]+', e)[0]}>" for e in reversed(open_[same:])]
            out += [_start(e) for e in outer[same:]]
            open_ = outer
        for _ in range(rng.randint(1, int(most or 1))):
            out.append(f"{_start(inner)}{_written(kind, words, title, rng)}</{re.match('[a-z0-9]+', inner)[0]}>")
            labels.append(part.endswith("!"))
    out += [f"</{re.match('[a-z0-9]+', e)[0]}>" for e in reversed(open_)]
    return "".join(out) + "</body></html>", labels


def _start(element: str) -> str:
    tag, *names = re.split(r"(?=[.#])", element)
    classes = " ".join(n[1:] for n in names if n[0] == ".")
    ids = " ".join(n[1:] for n in names if n[0] == "#")
    return f"<{tag}" + (f' class="{classes}"' if classes else "") + (f' id="{ids}"' if ids else "") + ">"


def training_pages(pages: Iterable[str], seed: int = 7) -> Iterator[list[Block]]:
    """Labelled blocks: pages of all layouts, and those of ``pages`` that mark one article."""
    reader, rng = Reader(), random.Random(seed)
    real = [b for p in pages if 0 < len(b := reader.blocks(p)) <= SAMPLE_BLOCKS]
    words = sorted({w for blocks in real for b in blocks for w in b.text.split()}) or PLAIN_WORDS
    words = [html_rules.escape(w) for w in words]
    for layout in LAYOUTS:
        for _ in range(PER_LAYOUT):
            page, labels = labelled_page(layout, words, rng)
            blocks = reader.blocks(page)
            for block, label in zip(blocks, labels, strict=True):
                block.main = label
            yield blocks
    outside = {f"t={t}" for t in ("nav", "aside", "footer", "form")} | {
        f"c={w}" for kind, names in CLASS_WORDS.items() if kind != "main" for w in names
    }
    for blocks in real:
        for block in blocks:
            block.main = "t=article" in block.element.features and not outside & block.element.features
        if any(b.main for b in blocks):
            yield blocks


def fit(pages: Iterable[str], seed: int = 7) -> Chain:
    """The field that makes the labels of the training pages most probable, with a quadratic penalty."""
    rng = np.random.default_rng(seed)
    sequences = list(training_pages(pages, seed))
    names: dict[str, int] = {}
    rows: list[list[int]] = []
    for blocks in sequences:
        hidden = rng.random() < 0.5  # half of the pages without much of their markup
        for block in blocks:
            kept = [f for f in sorted(block.element.features) if not hidden or rng.random() < 0.5]
            rows.append([names.setdefault(f, len(names)) for f in kept + block.features])
    x = np.zeros((len(rows), len(names)))
    for row, places in zip(x, rows):
        row[places] = 1
    sizes = np.array([len(s) for s in sequences])
    ends = np.cumsum(sizes)
    longest = int(sizes.max())
    # place of each block in a table of pages by blocks
    page, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(rows)) - np.repeat(ends - sizes, sizes)
    real = np.zeros((len(sizes), longest), bool)
    real[page, place] = True
    main = np.zeros((len(sizes), longest), int)
    main[page, place] = [b.main for s in sequences for b in s]
    same = np.zeros((len(sizes), longest), int)
    same[page, place] = [i > 0 and s[i].element is s[i - 1].element for s in sequences for i in range(len(s))]
    onward = real[:, 1:]
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (same[:, 1:][onward], main[:, :-1][onward], main[:, 1:][onward]), 1)
    theta = np.zeros(len(names) + 8)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, t = theta[:-8], theta[-8:].reshape(2, 2, 2)
        score = np.zeros((len(sizes), longest, 2))
        score[page, place, 1] = x @ w
        ahead = np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for i in range(1, longest):
            into = np.logaddexp.reduce(ahead[:, i - 1, :, None] + t[same[:, i]], axis=1) + score[:, i]
            ahead[:, i] = np.where(real[:, i, None], into, ahead[:, i - 1])
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        behind = np.zeros_like(score)
        expected = np.zeros((2, 2, 2))
        for i in range(longest - 1, 0, -1):
            both = ahead[:, i - 1, :, None] + t[same[:, i]] + (score[:, i] + behind[:, i])[:, None, :]
            chance = np.exp(both - total[:, None, None]) * real[:, i, None, None]
            np.add.at(expected, same[:, i], chance)
            behind[:, i - 1] = np.where(real[:, i, None], np.logaddexp.reduce(both - ahead[:, i - 1, :, None], axis=2), behind[:, i])
        probable = np.exp(ahead + behind - total[:, None, None])[page, place, 1]
        slope = np.r_[x.T @ (main[page, place] - probable), (seen - expected).ravel()] - PENALTY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = {f: round(float(theta[i]), 6) for f, i in names.items()}
    return Chain(weights, theta[-8:].reshape(2, 2, 2).round(6).tolist())


def extract(pages: DataFrame, chain: Chain, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text by a trained field, and ``n_chars``, its code points."""
    weights, steps = chain.weights, chain.steps

    @F.pandas_udf("string")
    def main_text(column: pd.Series) -> pd.Series:
        reader, trained = Reader(), Chain(weights, steps)
        return pd.Series([trained.main_text(reader.blocks(page)) for page in column], dtype=object)

    return pages.withColumn("text", main_text(html_col)).withColumn("n_chars", F.length("text").cast("long"))


def sample_of(pages: DataFrame, n: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``n`` different pages of at most ``chars`` characters, those with the smallest hashes.

    Only hashes are ordered and sent to the driver until it is known which pages are wanted.
    """
    marked = pages.where(F.length("html").between(1, chars)).select(F.xxhash64("html").alias("h"), "html")
    last = marked.select("h").distinct().orderBy("h").limit(n).agg(F.max("h")).first()[0]
    if last is None:
        return []
    wanted = marked.where(F.col("h") <= last).groupBy("h").agg(F.min("html").alias("html"))
    return [r["html"] for r in wanted.orderBy("h").collect()]


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row of ``pages``.

    The field is trained on a bounded sample (:data:`SAMPLE_PAGES` pages of :data:`SAMPLE_CHARS`
    characters at most) and layouts; then every whole page is read. Null and empty pages, and pages
    without main text, have an empty text. Nulls in the other columns stay; repeated rows are
    rows of their own; an empty table gives an empty result; other columns play no part.
    """
    read = pick(pages, page_id=id_col, url=url_col, html=html_col)
    return extract(read, fit(sample_of(read))).select("page_id", "url", "text", "n_chars")
