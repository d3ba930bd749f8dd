"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM."""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import map_batches, text_bytes

SAMPLE = 200
"""Pages of the table that the model is trained on, each as it is and in two other layouts."""
EPOCHS = 100
RATE = 1.0
DECAY = 1e-3

# elements that begin a block of their own (fixed values of the HTML standard)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul caption".split()
)
INLINE = frozenset("a abbr b button cite code em font i label mark q s small span strong sub sup time u".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template svg iframe math object canvas audio video".split())
# a start tag ends an open element of these kinds, if no element of the second set is in between
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# words in class and id names that say what an element is for
PURPOSES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs skip",
    "advert": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion banner dfp outbrain taboola commercial",
    "side": "sidebar side aside rail widget widgets related recommended popular trending more",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter "
    "subscribe subscription signup paywall disclaimer privacy",
    "comment": "comment comments commentlist discussion discuss disqus reply replies respond responses",
    "foot": "footer foot bottom copyright legal colophon imprint",
    "head": "header masthead topbar logo branding top",
    "share": "share sharing social follow tags meta byline author date",
    "form": "form search login contact input field",
    "main": "article content post entry story main body text maincontent articlebody prose",
}
# what no main text is for, where a part within it is named so
STRANGE = frozenset(("menu", "advert", "side", "notice", "comment", "form"))
PURPOSE = {word: name for name, words in PURPOSES.items() for word in words.split()}

TOKEN = re.compile(
    # a quote opens a string only after "="; elsewhere in a tag it is a character as others are
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)"
    r"((?:=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])[^\s>]*)|[^>=])*+)>|<[!?/][^>]*>|([^<]+)|(<)",
    re.S,
)
NAMED = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element(NamedTuple):
    """An open element, with what is known of it and all around it."""

    tag: str
    features: frozenset[str]
    main: bool


class Block(NamedTuple):
    """A leaf block: its text, the features of its surroundings, its share in links, its label."""

    text: str
    tag: str
    around: frozenset[str]
    linked: float
    main: bool
    article: int = 0
    """The number of the article element it is in, from 1; 0 for none."""


ROOT = Element("", frozenset(), False)
_SEEN: dict[tuple, Element] = {}


def element(parent: Element, tag: str, attributes: str) -> Element:
    """An element below ``parent``; equal ones are made once."""
    key = (parent, tag, attributes)
    found = _SEEN.get(key)
    if found is None:
        # what all blocks are in says nothing
        names = {f"in {tag if tag in BLOCKS or tag in INLINE else 'other'}"} - {"in html", "in body"}
        for value in NAMED.findall(attributes):
            for word in PARTS.findall(value):
                purpose = PURPOSE.get(word.lower())
                if purpose:
                    names.add(f"for {purpose}")
        if {"in article", "in main"} & parent.features:
            names |= {f"inner {name}" for name in names}
        main = (parent.main or "data-main" in attributes) and "data-off" not in attributes
        found = Element(tag, parent.features | names, main)
        if len(_SEEN) > 20_000:
            _SEEN.clear()
        _SEEN[key] = found
    return found


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; scripts, styles and comments are no text."""
    out: list[Block] = []
    stack = [ROOT]
    # where each kind of element is open, so that no tag looks through all that are
    places: dict[str, list[int]] = defaultdict(list)
    containers = [0]
    articles = [(0, 0)]
    parts: list[str] = []
    linked = seen = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                top = stack[-1]
                share = min(1.0, linked / len(text))
                out.append(
                    Block(text, stack[containers[-1]].tag, top.features, share, top.main, articles[-1][1])
                )
            parts.clear()
        linked = 0

    def last(tags: Iterable[str]) -> int:
        return max((places[tag][-1] for tag in tags if places[tag]), default=0)

    def cut(k: int) -> None:
        while len(stack) > k:
            places[stack.pop().tag].pop()
        while containers[-1] >= k:
            containers.pop()
        while articles[-1][0] >= k:
            articles.pop()

    def shut(tags: tuple[str, ...], within: tuple[str, ...]) -> None:
        k = last(tags)
        if k > last(within):
            close()
            cut(k)

    end_of_tags = page.rfind(">")
    at = 0
    while at < len(page):
        if at > end_of_tags:
            # no tag ends any more
            text = html.unescape(page[at:].partition("<!--")[0])
            parts.append(text)
            if places["a"]:
                linked += len(text.strip())
            break
        match = TOKEN.match(page, at)
        if match is None:
            # an open tag that never ends
            break
        at = match.end()
        text = match[4] or match[5]
        if text:
            text = html.unescape(text)
            parts.append(text)
            if places["a"]:
                linked += len(text.strip())
            continue
        name = match[2]
        if not name:
            continue
        tag = name.lower()
        if match[1]:
            if tag in BLOCKS:
                close()
            k = last((tag,))
            if k and (tag in BLOCKS or k > containers[-1]):
                cut(k)
            continue
        if tag in RAW:
            if not match[3].endswith("/"):
                end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in BLOCKS:
            close()
            # an element that is open for marked text only, as b, may lie between
            shut(("p",), ("div", "section", "article", "main", "body", "td", "li", "blockquote", "button"))
        if tag in CLOSES:
            shut(*CLOSES[tag])
        if tag == "br":
            parts.append(" ")
        elif tag not in VOID and not match[3].endswith("/"):
            places[tag].append(len(stack))
            if tag in BLOCKS:
                containers.append(len(stack))
            if tag == "article":
                seen += 1
                articles.append((len(stack), seen))
            stack.append(element(stack[-1], tag, match[3]))
    close()
    return out


def features(found: Sequence[Block]) -> list[list[str]]:
    """What the model sees of each block: its ancestors, its own tag, its text, and which parts the page has."""
    out = []
    has_main = any("in main" in b.around for b in found)
    largest = largest_article(found)
    for k, block in enumerate(found):
        words = block.text.count(" ") + 1
        size = next(n for n, limit in enumerate((3, 8, 20, 50, math.inf)) if words < limit or limit == math.inf)
        end = block.text[-1]
        own = [
            "every",
            f"is {block.tag}",
            f"size {size}",
            f"links {math.ceil(block.linked * 3)}",
            f"ends {'stop' if end in '.!?…:;”»' else 'letter' if end.isalpha() else 'other'}",
            f"at {'start' if k < 2 else 'end' if k >= len(found) - 2 else 'middle'}",
        ]
        if "©" in block.text or "(c)" in block.text:
            own.append("has copyright")
        if not has_main and not largest:
            own += [f"bare size {size}", f"bare links {math.ceil(block.linked * 3)}", f"bare is {block.tag}"]
        elif not {"in main", "in article"} & block.around:
            own.append("beside marks")
        elif has_main and "in main" not in block.around:
            own.append("beside main")
        if block.article not in (0, largest):
            own.append("lesser article")
        out.append([*own, *block.around])
    return out


def largest_article(found: Iterable[Block]) -> int:
    """The number of the article element with the longest text of its own; 0 without one."""
    sizes: Counter[int] = Counter()
    for block in found:
        if block.article:
            sizes[block.article] += len(block.text)
    return max(sizes, key=lambda number: (sizes[number], -number), default=0)


class Model(NamedTuple):
    """Weights for main text, by feature, and for neighbouring labels."""

    weights: dict[str, float]
    start: tuple[float, float]
    steps: tuple[tuple[float, float], tuple[float, float]]


def viterbi(model: Model, rows: Sequence[Iterable[str]]) -> list[bool]:
    """The most likely labels of a page's blocks together."""
    weigh = model.weights.get
    (s00, s01), (s10, s11) = model.steps
    other, main = model.start
    back: list[tuple[bool, bool]] = []
    for k, row in enumerate(rows):
        score = sum(weigh(f, 0.0) for f in row)
        if k == 0:
            main += score
            continue
        to_other = other + s00 < main + s10
        to_main = other + s01 < main + s11
        other, main = (
            max(other + s00, main + s10),
            max(other + s01, main + s11) + score,
        )
        back.append((to_other, to_main))
    if not rows:
        return []
    label = main > other
    labels = [label]
    for to_other, to_main in reversed(back):
        label = to_main if label else to_other
        labels.append(label)
    return labels[::-1]


def trained(pages: Sequence[tuple[list[list[str]], list[bool]]]) -> Model:
    """The model of greatest likelihood for labelled pages, with small weights preferred."""
    names: dict[str, int] = {}
    flat, starts, labels, lengths = [], [], [], []
    for rows, marks in pages:
        if not rows:
            continue
        for row in rows:
            starts.append(len(flat))
            flat += [names.setdefault(f, len(names)) for f in row]
        labels += marks
        lengths.append(len(rows))
    if not lengths:
        return Model({}, (0.0, 0.0), ((0.0, 0.0), (0.0, 0.0)))
    index, first = np.array(flat), np.array(starts)
    row_of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(index))))
    truth = np.array(labels, bool)
    n = len(names)
    weights, history = np.zeros(n + 6), np.full(n + 6, 1e-6)
    padded = np.full((len(lengths), max(lengths)), -1)
    at = 0
    for k, length in enumerate(lengths):
        padded[k, :length] = np.arange(at, at + length)
        at += length
    real = padded >= 0
    order = np.where(real, padded, 0)
    y = np.where(real, truth[order], False).astype(int)
    for _ in range(EPOCHS):
        score = np.add.reduceat(weights[index], first)
        gradient = likelihood_slope(score[order] * real, real, y, weights[n:])
        chance, rest = gradient
        by_row = np.zeros(len(first))
        by_row[order[real]] = chance[real]
        slope = np.concatenate([np.bincount(index, weights=by_row[row_of], minlength=n), rest])
        slope = slope / len(lengths) - DECAY * weights
        history += slope**2
        weights += RATE * slope / np.sqrt(history)
    start, steps = weights[n : n + 2], weights[n + 2 :]
    return Model(
        {f: float(weights[k]) for f, k in names.items()},
        (float(start[0]), float(start[1])),
        ((float(steps[0]), float(steps[1])), (float(steps[2]), float(steps[3]))),
    )


def likelihood_slope(
    score: np.ndarray, real: np.ndarray, y: np.ndarray, edge: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Truth less expectation, of main labels by block, and of first labels and label pairs in all."""
    pages, length = score.shape
    start, steps = edge[:2], edge[2:].reshape(2, 2)
    emit = np.stack([np.zeros_like(score), score], 2)
    ahead = np.zeros((pages, length, 2))
    behind = np.zeros((pages, length, 2))
    ahead[:, 0] = start + emit[:, 0]
    for t in range(1, length):
        new = np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, 1) + emit[:, t]
        ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
    for t in range(length - 2, -1, -1):
        new = np.logaddexp.reduce(steps + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(real[:, t + 1, None], new, behind[:, t + 1])
    total = np.logaddexp.reduce(ahead[:, -1], 1)
    chance = np.exp(ahead + behind - total[:, None, None])
    main = np.where(real, y - chance[:, :, 1], 0.0)
    first = np.array([(y[:, 0] == k).sum() - chance[:, 0, k].sum() for k in range(2)])
    pair = np.exp(
        ahead[:, :-1, :, None] + steps + (emit[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
    )
    inner = real[:, 1:]
    expected = (pair * inner[:, :, None, None]).sum((0, 1))
    seen = np.array([[((y[:, :-1] == a) & (y[:, 1:] == b) & inner).sum() for b in range(2)] for a in range(2)])
    return main, np.concatenate([first, (seen - expected).ravel()])


# layouts in which labelled texts are set again; data-main marks the main text, data-off what is not
LAYOUTS = (
    '<body><div id="header"><a href="/">{0}</a><ul class="menu">{links}</ul></div><div class="cookie-notice"><p>'
    '{long}</p><button>{1}</button></div><div id="content" data-main><h1>{title}</h1>{paragraphs}</div>'
    '<div class="sidebar"><h3>{1}</h3><ul>{links}</ul><p>{long}</p></div><div id="footer"><p>&copy; {long}</p></div>',
    "<body><header><nav><ul>{links}</ul></nav><h1>{0}</h1></header><main><article data-main><h1>{title}</h1>"
    '{paragraphs}<div class="ad" data-off><p>{long}</p></div>{more}</article><section class="comments"><h2>{1}</h2>'
    "<div><p>{long}</p></div><div><p>{long}</p></div><form><label>{0}</label><p>{long}</p></form></section></main>"
    "<aside><p>{long}</p></aside><footer><p>{long}</p><p>&copy; {0}</p></footer>",
    '<body><nav>{links}</nav><div class="banner"><p>{long}</p></div><section class="post" data-main><h1>{title}'
    "</h1>{paragraphs}<ul><li>{2}</li><li>{3}</li></ul>{more}</section><div class='related'><h3>{0}</h3>{links}</div>"
    "<form action='/s'><p>{1}</p><p>{long}</p></form><div class='newsletter'><p>{long}</p></div>",
    '<body><div class="topbar">{0}</div><div role="navigation"><ul>{links}</ul></div><div class="wrap"><div '
    "data-main><h2>{title}</h2>{paragraphs}<blockquote>{2}</blockquote>{more}</div><aside class='promo'><p>{long}</p>"
    "</aside><div id='comments'><p>{long}</p><p>{1}</p></div></div><div class='copyright'>&copy; {0}</div>",
    '<body><header><h1>{0}</h1><p>{1}</p></header><div class="notice">{long}</div><div class="story"><div data-main><h1>{title}</h1>'
    "<h2>{3}</h2>{paragraphs}{more}</div><div class='share'>{links}</div><div class='comment-list'><p>{long}</p></div>"
    "</div><aside class='widget'><h4>{1}</h4><p>{long}</p></aside><footer><ul>{links}</ul><p>{long}</p></footer>",
    '<body><table><tr><td class="nav">{links}</td><td data-main><h1>{title}</h1>{paragraphs}<pre>{2}</pre>{more}</td>'
    "<td class='ads'><p>{long}</p></td></tr></table><div class='legal'><p>{long}</p></div>",
    "<body><nav><ul>{links}</ul></nav><article data-main><h1>{title}</h1>{paragraphs}<aside data-off><h3>{0}</h3><p>{long}</p>"
    "</aside>{more}<form data-off><label>{1}</label><input><button>{0}</button><p>{long}</p></form><div class='notice' data-off><p>{long}</p></div><section class='comments' "
    "data-off><h3>{1}</h3><p>{long}</p><p>{0}</p></section></article><footer><p>{long}</p></footer>",
    "<body><div>{anchors}</div><div data-main><h1>{title}</h1>{plain}</div><div>{anchors}</div><div>&copy; {0}</div>",
    "<body><header><p>{0}</p><ul>{links}</ul></header><main data-main><h1>{title}</h1>{paragraphs}{more}</main><article><h3>"
    "<a href='/'>{0}</a></h3><p>{2}</p></article><article><h3><a href='/'>{1}</a></h3><p>{3}</p></article><footer>{0}</footer>",
    "<body><nav>{anchors}</nav><article data-main><h1>{title}</h1>{paragraphs}<div class='ad' data-off><p>{long}</p></div>{plain}<ul>"
    "<li>{2}</li><li>{3}</li></ul><p>{4}</p><aside data-off><p>{long}</p></aside>{more}</article><section class='comments'><h2>{1}</h2><div><p>{long}</p></div></section><footer><p>&copy; {0}</p></footer>",
    "<body><nav><ul>{links}</ul></nav><main><article data-main><h1>{title}</h1>{paragraphs}<div class='related' data-off><h4>"
    "{0}</h4><ul>{links}</ul></div><p>{2}</p><div class='newsletter' data-off><p>{long}</p></div>{more}<aside data-off><p>{long}</p></aside></article><section id='comments'><h2>{0}</h2><article class='comment'><p>{long}</p>"
    "</article><article class='comment'><p>{2}</p></article></section></main><footer>{0}</footer>",
    "<body><p>{anchors}</p><h1 data-main>{title}</h1><div data-main>{paragraphs}</div><div class='advert'>{long}</div><div data-main>"
    "{more}</div><p>&copy; {0}</p>",
)
NOT_MAIN = frozenset(
    f"in {t}" for t in ("nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "select")
) | {f"inner for {purpose}" for purpose in STRANGE}


def labelled(page: str, number: int) -> list[tuple[list[Block], list[bool]]]:
    """A page with labels from its own main element or largest article, and its text in two other layouts.

    Parts of the main text that are named for something else, by tag, class or id, are none of it.

    Pages without such an element have no labels and are left out.
    """
    found = blocks(page)
    whole = [b for b in found if "in main" in b.around] or [b for b in found if b.article]
    best = largest_article(whole)
    share = sum(len(b.text) for b in whole if b.article == best)
    if best and 2 * share >= sum(len(b.text) for b in whole):
        whole = [b for b in whole if b.article == best]
    chosen = {id(b) for b in whole if not (NOT_MAIN & b.around)}
    marks = [id(b) in chosen for b in found]
    main = [b.text for b, mark in zip(found, marks, strict=True) if mark]
    if not main:
        return []
    rest = [b.text for b, mark in zip(found, marks, strict=True) if not mark]
    return [(found, marks), *(set_again(main, rest, k) for k in (number, number + len(LAYOUTS) // 2))]


def set_again(main: list[str], rest: list[str], number: int) -> tuple[list[Block], list[bool]]:
    """Texts in one of the layouts, with the labels that it gives them."""
    rest = rest or ["-"]
    short = [" ".join(x.split()[:4]) for x in main[1:] or main]
    values = {
        "title": html.escape(main[0]),
        "paragraphs": "".join(f"<p>{html.escape(x)}</p>" for x in main[1 : 1 + len(main) // 2]),
        "more": "".join(f"<p>{html.escape(x)}</p>" for x in main[1 + len(main) // 2 :]),
        "plain": "".join(f"<div>{html.escape(x)}</div>" for x in main[1:]),
        "anchors": " ".join(f'<a href="/">{html.escape(x[:20])}</a>' for x in rest[:4]),
        "links": "".join(f'<li><a href="/">{html.escape(x[:20])}</a></li>' for x in rest[:5]),
        "long": html.escape(max([*rest, main[number % len(main)]], key=len)),
    }
    layout = LAYOUTS[number % len(LAYOUTS)]
    again = blocks(layout.format(*(html.escape(x) for x in (rest[0], *short, *["-"] * 5)[:5]), **values))
    return again, [b.main for b in again]


def unlabelled(page: str, number: int) -> list[tuple[list[Block], list[bool]]]:
    """The texts of a page that marks no main text in one of the layouts, the long ones as main text."""
    texts = [b.text for b in blocks(page)]
    main = [x for x in texts if x.count(" ") >= 7] or sorted(texts, key=len)[-1:]
    return [set_again(main, [x for x in texts if x not in main], number)] if main else []


def sampled(given: DataFrame, sample: int, marked: bool) -> list[str]:
    """The ``sample`` pages of least hash of number and text; if asked only those that mark a main text.

    The same in any partitioning. Tasks send what lies under a bound of the hash, about half as many pages again in all. The bound
    rises until there are enough such pages, or all have been looked at.
    """
    if marked:
        # what has no such tag is out at once; the others are parsed
        given = given.where(F.col("page").rlike(r"(?i)<(?:article|main)[\s/>]"))
    count = given.count()
    share = min(1.0, 1.5 * sample / max(1, count))
    while count:
        # the bound is reached by the share of all 64-bit numbers
        bound = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
        found = given.select(F.xxhash64("id", "page").alias("hash"), "page").where(F.col("hash") <= bound)
        if marked:
            found = map_batches(found, with_main_text, "hash long, page string")
        rows = found.orderBy("hash", "page").limit(sample).collect()
        if len(rows) >= min(sample, count) or share >= 1:
            return [row["page"] for row in rows]
        share = min(1.0, 4 * share)
    return []


def with_main_text(batch: pa.RecordBatch) -> dict:
    """The pages that mark a main text, and their hash."""
    pages = [x.decode() for x in text_bytes(batch, "page")]
    marked = [k for k, page in enumerate(pages) if labelled(page, 0)]
    return {"hash": batch.column("hash").take(pa.array(marked, pa.int64())), "page": [pages[k] for k in marked]}


def fitted(pages: DataFrame, page_id: str = "page_id", page: str = "html", sample: int = SAMPLE) -> Model:
    """The model of at most ``sample`` pages that mark their main text.

    If no page does, the model knows the layouts alone, with texts of at most ``sample`` of the pages.
    """
    given = pages.where(F.col(page).isNotNull()).select(F.col(page_id).alias("id"), F.col(page).alias("page"))
    label, found = labelled, sampled(given, sample, True)
    if not found:
        label, found = unlabelled, sampled(given, sample, False)
    examples = [x for k, page in enumerate(found) for x in label(page, k)]
    return trained([(features(found), marks) for found, marks in examples])


def main_text(page: str, model: Model) -> str:
    """The blocks that the model takes for the article, one to a line."""
    found = blocks(page)
    labels = viterbi(model, features(found))
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extracted(
    pages: DataFrame, model: Model | None = None, page_id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """page_id, url, text and n_chars of every page, whole; null pages are empty and have no text.

    Without a model, one is fitted first. No page leaves its task; the model is a few hundred numbers.
    """
    model = model or fitted(pages, page_id, page)

    def make(batch: pa.RecordBatch) -> dict:
        texts = [main_text(x.decode(), model) for x in text_bytes(batch, "page")]
        return {
            "page_id": batch.column("page_id"),
            "url": batch.column("url"),
            "text": texts,
            "n_chars": [len(x) for x in texts],
        }

    columns = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(page).alias("page"),
    )
    return map_batches(columns, make, "page_id long, url string, text string, n_chars long")
