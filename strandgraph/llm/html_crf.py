"""Main-text extraction by a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its text blocks (a block is the text between two block-level tags).  Each has
features of its ancestors' tags, of words in their class, id and role attributes, and of its text (length,
links, end marks).  The field scores blocks and neighbouring labels; Viterbi gives the best labelling, and
the blocks labelled main are joined.  The field is trained by stochastic gradient on labelled pages that
``training_pages`` writes from page layouts (a fixed seed, no corpus text), about two seconds on the driver.

Edge cases: null, empty and textless pages give an empty text; unclosed tags close at the end of the page or
where their parent closes; character references without a semicolon are decoded as browsers do; repeated rows
each give a row; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, lean

#: Fixed values of the markup language.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea svg iframe object title select".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: An attribute's value is quoted, or ends at white space or the tag's end; a quote that nothing closes is part of it.
_PAIRS = r"(?>[\s/]+|[^\s>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)*+"
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)({_PAIRS})>|<(?=[a-zA-Z/!?])[^<]*\Z", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>|</{t}\Z", re.I) for t in _RAW}
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
#: Tags that an opening tag of the same kind, or of a block, closes.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags, and words of their attributes as "tag.word"
    linked: int  # characters inside links


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = 0
    path: tuple[str, ...] = ()

    def flush():
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append(Block(text, path, min(linked, len(text))))
            parts.clear()
        linked = 0

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if tag in _RAW:
            if not m[1] and not m[3].endswith("/"):
                flush() if tag not in ("svg", "select") else None
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "hr":
            flush()
            continue
        if tag in _VOID:
            continue
        if tag in _INLINE:
            if tag == "a":
                links = max(0, links - 1) if m[1] else 1
            continue
        flush()
        links = 0
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            while stack and stack[-1][0] in _CLOSES.get(tag, ()) or stack and stack[-1][0] == "p" and tag in ("div", "article", "section", "ul", "ol", "table", "footer", "header", "aside", "nav", "form", "h1", "h2", "h3", "h4", "blockquote", "pre", "main"):
                stack.pop()
            names = [tag]
            for a in _ATTRIBUTE.finditer(m[3]):
                names += [f".{w.lower()}" for w in _NAME_WORD.findall(a[2] or a[3] or a[4] or "")]
            if not m[3].rstrip().endswith("/"):
                stack.append((tag, tuple(names)))
        path = tuple(x for _, names in stack for x in names)
    flush()
    return out


def path_features(path: tuple[str, ...]) -> list[str]:
    tags = [x for x in path if x[0] != "."]
    return ["bias", *sorted({f"up:{x}" for x in path}), f"tag:{tags[-1] if tags else ''}", f"body:{'article' in tags or 'main' in tags}"]


def shape(b: Block, i: int, n: int) -> tuple:
    """What counts of the text: size, share of links, end mark, copyright, place."""
    size = min(6, (b.text.count(" ") + 1).bit_length() - 1)
    return size, 0 if not b.linked else 1 + int(3 * b.linked / len(b.text)), b.text[-1] in ".!?…。:;”»\"'", "©" in b.text or "All rights" in b.text, i == 0, i == n - 1


def shape_features(x: tuple) -> list[str]:
    names = [f"size:{x[0]}", f"links:{x[1]}", f"ends:{x[2]}"]
    return names + [n for n, on in zip(("copyright", "first", "last"), x[3:]) if on]


def features(seq: list[Block]) -> list[list[str]]:
    """Binary features of each block."""
    return [path_features(b.path) + shape_features(shape(b, i, len(seq))) for i, b in enumerate(seq)]


class Crf:
    """Two labels (0 other, 1 main): a weight for each feature and label, and for each pair of labels."""

    def __init__(self):
        self.weight: dict[str, float] = {}  # of label 1; label 0 has 0
        self.step = np.zeros((2, 2))
        self.known: dict = {}

    def unary(self, feats: list[list[str]]) -> list[float]:
        get = self.weight.get
        return [sum(get(f, 0.0) for f in fs) for fs in feats]

    def viterbi(self, score: list[float]) -> list[int]:
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b, back = 0.0, 0.0, []
        for i, u in enumerate(score):
            if i:
                back.append((0 if a + s00 >= b + s10 else 1, 0 if a + s01 > b + s11 else 1))
                a, b = max(a + s00, b + s10), max(a + s01, b + s11) + u
            else:
                b = u
        if not score:
            return []
        path = [int(b > a)]
        for p in reversed(back):
            path.append(p[path[-1]])
        return path[::-1]

    def marginals(self, score: list[float]) -> tuple[np.ndarray, np.ndarray]:
        """P(label 1) of each block and the expected count of each pair of labels, by forward-backward."""
        n = len(score)
        u = np.zeros((n, 2))
        u[:, 1] = score
        fw, bw = np.zeros((n, 2)), np.zeros((n, 2))
        fw[0] = u[0]
        for i in range(1, n):
            fw[i] = u[i] + np.logaddexp(fw[i - 1, 0] + self.step[0], fw[i - 1, 1] + self.step[1])
        for i in range(n - 2, -1, -1):
            x = u[i + 1] + bw[i + 1]
            bw[i] = np.logaddexp(self.step[:, 0] + x[0], self.step[:, 1] + x[1])
        z = np.logaddexp(*fw[-1])
        pairs = np.zeros((2, 2))
        for i in range(1, n):
            pairs += np.exp(fw[i - 1][:, None] + self.step + (u[i] + bw[i])[None, :] - z)
        return np.exp(fw[:, 1] + bw[:, 1] - z), pairs

    def train(self, pages: list[tuple[list[list[str]], list[int]]], epochs: int = 6, rate: float = 0.5, decay: float = 1e-4) -> Crf:
        """Adagrad on the log likelihood of the labelled sequences."""
        rng, seen, step_seen = random.Random(5), {}, np.full((2, 2), 1e-6)
        for _ in range(epochs):
            order = list(range(len(pages)))
            rng.shuffle(order)
            for k in order:
                feats, labels = pages[k]
                if not feats:
                    continue
                p, pairs = self.marginals(self.unary(feats))
                grad: dict[str, float] = {}
                for fs, y, q in zip(feats, labels, p):
                    for f in fs:
                        grad[f] = grad.get(f, 0.0) + y - q
                for f, g in grad.items():
                    w = self.weight.get(f, 0.0)
                    g -= decay * w
                    seen[f] = seen.get(f, 1e-6) + g * g
                    self.weight[f] = w + rate * g / math.sqrt(seen[f])
                for a, b in zip(labels, labels[1:]):
                    pairs[a, b] -= 1
                step_seen += pairs**2
                self.step -= rate * pairs / np.sqrt(step_seen)
        return self

    def label(self, seq: list[Block]) -> list[int]:
        """Viterbi over the blocks' scores; the score of a path and of a text's shape is computed once."""
        known, score = self.known, []
        for i, b in enumerate(seq):
            form = shape(b, i, len(seq))
            for x, made in ((b.path, path_features), (form, shape_features)):
                if (made, x) not in known:
                    if len(known) > 100_000:
                        known.clear()
                    known[made, x] = self.unary([made(x)])[0]
            score.append(known[path_features, b.path] + known[shape_features, form])
        return self.viterbi(score)


# -- labelled pages ---------------------------------------------------------------------------------------

#: Names that page layouts commonly give to their parts.
_PARTS = {
    "menu": "nav navbar navigation menu menubar topnav breadcrumb breadcrumbs toc pagination pager tabs".split(),
    "header": "header masthead banner topbar site-header page-header branding logo".split(),
    "footer": "footer site-footer page-footer bottom copyright colophon legal footnote-bar".split(),
    "sidebar": "sidebar aside side-bar widget rail related recommended trending popular most-read more-stories secondary".split(),
    "notice": "notice cookie cookies cookie-banner consent gdpr alert popup modal overlay disclaimer newsletter subscribe signup paywall toast".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion banner-ad adsense ad-slot adbox commercial".split(),
    "form": "form search search-form login contact-form signin".split(),
    "comments": "comments comment comment-list reader-comments discussion replies reply disqus respond commentary comment-body".split(),
    "share": "share social sharing tags meta byline-links toolbar tools".split(),
    "main": "content main article post entry story body text post-body entry-content article-body main-content page-content".split(),
}


def _prose(rng, words, end=True):
    made = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéüñ") for _ in range(rng.randint(1, 9))) for _ in range(words))
    return made.capitalize() + (rng.choice(".....!?") if end else "")


def training_pages(n: int = 600, seed: int = 11) -> list[tuple[str, list[str]]]:
    """Pages and the texts of their main blocks, from random layouts with all the parts that are not main text."""
    rng = random.Random(seed)
    pages = []
    for _ in range(n):
        main: list[str] = []

        def attr(kind):
            name = rng.choice(_PARTS[kind])
            return rng.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {_prose(rng, 1, False).lower()}"'])

        def other(kind, tags, inner):
            tag = rng.choice(tags)
            named = attr(kind) if tag in ("div", "section", "ul", "p", "form") or rng.random() < 0.4 else ""
            return f"<{tag}{named}>{inner}</{tag}>"

        def link_list():
            return "<ul>" + "".join(f'<li><a href="/x">{_prose(rng, rng.randint(1, 4), False)}</a></li>' for _ in range(rng.randint(2, 8))) + "</ul>"

        def paragraphs(lo, hi):
            return "".join(f"<p>{_prose(rng, rng.randint(4, 60))}</p>" for _ in range(rng.randint(lo, hi)))

        def side(kind):
            if kind == "menu":
                return other(kind, ["nav", "div", "nav"], link_list())
            if kind == "header":
                return other(kind, ["header", "div"], rng.choice([link_list(), f"<p>{_prose(rng, 4, False)}</p>", f'<a href="/">{_prose(rng, 2, False)}</a>']))
            if kind == "footer":
                return other(kind, ["footer", "footer", "div"], rng.choice([f"&copy; 2024 {_prose(rng, rng.randint(2, 20))}", link_list(), paragraphs(1, 2)]))
            if kind == "sidebar":
                return other(kind, ["aside", "div", "section"], rng.choice([link_list(), f"<h3>{_prose(rng, 2, False)}</h3>" + paragraphs(1, 3)]))
            if kind == "notice":
                return other(kind, ["div", "section", "p"], _prose(rng, rng.randint(4, 30)))
            if kind == "advert":
                return other(kind, ["div", "aside", "section"], rng.choice([_prose(rng, rng.randint(2, 30)), paragraphs(1, 2)]))
            if kind == "form":
                return f"<form{rng.choice(['', attr(kind)])}><label>{_prose(rng, 2, False)}</label><input name=q><button>{_prose(rng, 1, False)}</button><p>{_prose(rng, rng.randint(2, 12))}</p></form>"
            if kind == "share":
                return other(kind, ["div", "ul"], link_list())
            who = [f"<div{attr('comments')}><p>{_prose(rng, 2, False)}</p><p>{_prose(rng, rng.randint(4, 60))}</p></div>" for _ in range(rng.randint(1, 4))]
            return other("comments", ["section", "div"], f"<h2>{_prose(rng, 1, False)}</h2>" + "".join(who))

        def some(kinds, p):
            return "".join(side(k) for k in kinds if rng.random() < p)

        def article():
            title = _prose(rng, rng.randint(2, 12), False)
            main.append(title)
            head = f"<h1>{title}</h1>"
            parts = [rng.choice([head, head, f"<header>{head}</header>"])]
            for _ in range(rng.randint(1, 12)):
                text = _prose(rng, rng.choice([rng.randint(1, 4), rng.randint(3, 30), rng.randint(1, 90), rng.randint(1, 90)]), rng.random() < 0.85)
                kind = rng.random()
                if kind < 0.75:
                    parts.append(rng.choice([f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}</b></p>"]))
                elif kind < 0.82:
                    text = text.rstrip(".!?")[:50].strip()
                    parts.append(f"<h2>{text}</h2>")
                elif kind < 0.9:
                    parts.append(f"<ul><li>{text}</li></ul>")
                elif kind < 0.95:
                    parts.append(f"<blockquote><p>{text}</p></blockquote>")
                else:
                    parts.append(f"<table><tr><td>{text}</td></tr></table>")
                main.append(text)
                if rng.random() < 0.2:
                    parts.append(some(["advert", "advert", "share", "sidebar", "notice", "form"], 0.3))
            tail = some(["share", "comments"], 0.25)
            tag = rng.choice(["article", "article", "article", "main", "div", "section"])
            named = attr("main") if tag in ("div", "section") or rng.random() < 0.3 else ""
            return f"<{tag}{named}>{''.join(parts)}{tail}</{tag}>"

        inner = some(["notice", "menu", "advert", "header", "form"], 0.55) + article() + some(["share", "comments", "sidebar", "advert", "form", "notice"], 0.4)
        if rng.random() < 0.4:
            inner = f"<div{attr('main') if rng.random() < 0.5 else ' class=\"wrapper\"'}>{inner}</div>"
        page = f"<!DOCTYPE html><html><head><title>{_prose(rng, 4, False)}</title></head><body>{some(['header', 'menu', 'notice'], 0.6)}{inner}{some(['sidebar', 'advert', 'footer', 'footer'], 0.6)}</body></html>"
        pages.append((page, main))
    return pages


def labelled(page: str, main: list[str]) -> tuple[list[list[str]], list[int]]:
    seq, wanted = blocks(page), set(main)
    return features(seq), [int(b.text in wanted) for b in seq]


_model: Crf | None = None


def model() -> Crf:
    """The field trained on ``training_pages``; trained once in a process."""
    global _model
    if _model is None:
        _model = Crf().train([labelled(*p) for p in training_pages()])
    return _model


def main_text(page: str | None, crf: Crf) -> str:
    seq = blocks(page)
    return " ".join(b.text for b, y in zip(seq, crf.label(seq)) if y)


def extract(pages: DataFrame, markup: str = "html", crf: Crf | None = None) -> DataFrame:
    """page_id, url and main text of each page."""
    bound_batches(pages.sparkSession)
    trained = crf or model()

    def run(batches):
        for batch in batches:
            texts = [main_text(x, trained) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col(markup).alias("html")).mapInArrow(lean(run), f"page_id {kind}, url string, text string")
