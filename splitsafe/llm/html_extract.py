"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is scanned once into leaf blocks: runs of text between block-level tags, with the tags that are
open there (implied end tags included). Scripts, styles, comments, the head and the like give no block.
Features of a block are its ancestor tags, the words of their class, id and role attributes, its parent, and
buckets of its length, link share, punctuation and place. The field has the labels 0 (boilerplate) and
1 (main text), is trained by gradient ascent of the exact log-likelihood (forward-backward) and decoded by
Viterbi. Its labelled pages come from ``labelled_pages``: pages written out of common page parts, each
with the label of the part (``TRAIN_PAGES`` of them, a documented bound); no URL or table is needed.

The text of a page: its main blocks in page order joined by one line feed; in a block character references
are decoded and each run of white space is one space (a ``br`` is white space). Null html is an empty page
with an empty text. Truncated pages end every open tag. Nothing is cut or capped. Null ids are carried;
repeated rows give a row each; an empty table gives no rows; extra columns have no effect.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .token_files import text_chunks

TRAIN_PAGES, EPOCHS, RATE, DECAY = 500, 12, 0.15, 1e-3
MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
# fixed values: element kinds of the HTML standard
MATH = frozenset("annotation annotation-xml math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style head title noscript template svg iframe canvas audio video annotation annotation-xml".split())
RAW = frozenset("script style title textarea iframe noscript template svg".split())
SAME_ENDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
             "option": ("select",), "optgroup": ("select",), "tbody": ("table",), "thead": ("table",)}


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: float):
        self.text, self.path, self.linked = text, path, linked


def _names(tag: str, attributes: str) -> str:
    """The tag and the words of its class, id and role: ``div.side.bar``."""
    if "=" not in attributes:
        return tag
    words = {w for m in ATTRIBUTE.finditer(attributes) for w in PART.findall((m[2] or m[3] or m[4] or "").lower())}
    return ".".join([tag, *sorted(words)]) if words else tag


IN_HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    in_link, hidden, at = 0, 0, 0
    links: list[str] = []

    def flush() -> None:
        nonlocal parts, links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                linked = len(" ".join(html.unescape(" ".join(links)).split())) / len(text) if links else 0.0
                out.append(Block(text, tuple(n for t, n in stack if t not in INLINE), min(1.0, linked)))
            parts, links = [], []

    def pop_to(k: int) -> None:
        nonlocal in_link, hidden
        while len(stack) > k:
            t = stack.pop()[0]
            in_link -= t == "a"
            hidden -= t in HIDDEN

    page = page or ""
    while at < len(page):
        m = MARKUP.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at and stack and stack[-1][0] == "head" and not page[at:stop].isspace():  # text ends an open head
            pop_to(len(stack) - 1)
        if stop > at and not hidden:
            parts.append(page[at:stop])
            if in_link:
                links.append(page[at:stop])
        if not m:
            break
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attributes = tag.lower(), (m[1] or m[4]) == "/", m[3] or m[6] or ""
        if tag not in INLINE:
            flush()
        if closing:
            if tag == "br":
                parts.append(" ")
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag not in IN_HEAD and stack and stack[-1][0] == "head":
            pop_to(len(stack) - 1)
        if tag == "br" or tag == "img":
            parts.append(" ") if not hidden else None
        if tag not in INLINE:
            if tag == "body":
                pop_to(next((k for k, (t, _) in enumerate(stack) if t == "head"), len(stack)))
            for k in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
            if tag in SAME_ENDS:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag or (tag in ("dt", "dd") and stack[k][0] in ("dt", "dd")):
                        pop_to(k)
                        break
                    if stack[k][0] in SAME_ENDS[tag]:
                        break
        # a slash closes only elements that aren't HTML; elsewhere it may end an unquoted attribute
        if tag in VOID or (attributes.endswith("/") and (tag == "svg" or tag in MATH)):
            continue
        if tag in RAW and tag != "textarea":  # its content is no markup
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((tag, _names(tag, attributes)))
        in_link += tag == "a"
        hidden += tag in HIDDEN
    flush()
    return out


def _bucket(x: float, *edges: float) -> int:
    return sum(x >= e for e in edges)


_PATHS: dict[tuple[str, ...], tuple[str, ...]] = {}


def _path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    got = _PATHS.get(path)
    if got is None:
        if len(_PATHS) > 50_000:
            _PATHS.clear()
        out = {"p:" + path[-1].split(".")[0]} if path else {"p:"}
        for name in path:
            tag, *words = name.split(".")
            if tag not in ("html", "body"):
                out.add("t:" + tag)
                out.update("c:" + w for w in words)
        got = _PATHS[path] = tuple(sorted(out))
    return got


def features(page: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(page):
        words = b.text.count(" ") + 1
        out.append([*_path_features(b.path), f"n:{_bucket(words, 3, 6, 12, 25, 60)}", f"l:{_bucket(b.linked, 0.01, 0.3, 0.7, 0.99)}",
                    f"e:{b.text[-1] in '.!?…:;' + chr(34)}", f"k:{_bucket(b.text.count(','), 1, 3)}",
                    f"y:{'©' in b.text}", f"f:{_bucket(i, 1, 3)}", f"z:{_bucket(len(page) - 1 - i, 1, 3)}", "bias"])
    return out


class Field:
    """Weights of a two-label linear-chain conditional random field."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, 2))
        self.moves, self.first = np.zeros((2, 2)), np.zeros(2)

    def _rows(self, page: list[list[str]]) -> list[np.ndarray]:
        return [np.array([j for f in x if (j := self.index.get(f)) is not None], np.int64) for x in page]

    def train(self, pages: list[tuple[list[list[str]], list[int]]]) -> "Field":
        for page, _ in pages:
            for x in page:
                for f in x:
                    self.index.setdefault(f, len(self.index))
        self.weights = np.zeros((len(self.index), 2))
        rows = [(self._rows(p), np.array(y)) for p, y in pages]
        past = [np.full_like(a, 1e-6) for a in (self.weights, self.moves, self.first)]
        order = random.Random(3)
        for _ in range(EPOCHS):
            order.shuffle(rows)
            for x, y in rows:
                if not len(y):
                    continue
                node, pair = self._marginals(np.stack([self.weights[r].sum(0) for r in x]))
                want = np.eye(2)[y]
                gw, gm = np.zeros_like(self.weights), np.zeros((2, 2))
                for r, d in zip(x, want - node):
                    gw[r] += d
                np.add.at(gm, (y[:-1], y[1:]), 1)
                gm -= pair
                for a, g, s in zip((self.weights, self.moves, self.first), (gw, gm, want[0] - node[0]), past):
                    g = g - DECAY * a
                    s += g * g
                    a += RATE * g / np.sqrt(s)
        return self

    def _marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label probabilities of each block, and the expected number of each move."""
        n, m = len(e), np.exp(self.moves)
        fwd, bwd = np.zeros((n, 2)), np.ones((n, 2))
        e = np.exp(e - e.max(1, keepdims=True))
        fwd[0] = e[0] * np.exp(self.first - self.first.max())
        fwd[0] /= fwd[0].sum()
        for i in range(1, n):
            fwd[i] = fwd[i - 1] @ m * e[i]
            fwd[i] /= fwd[i].sum()
        for i in range(n - 2, -1, -1):
            bwd[i] = m @ (e[i + 1] * bwd[i + 1])
            bwd[i] /= bwd[i].sum()
        node = fwd * bwd
        node /= node.sum(1, keepdims=True)
        pair = np.zeros((2, 2))
        for i in range(1, n):
            p = fwd[i - 1][:, None] * m * (e[i] * bwd[i])[None]
            pair += p / p.sum()
        return node, pair

    def decode(self, page: list[list[str]]) -> list[int]:
        """The best labelling, by Viterbi."""
        if not page:
            return []
        e = [self.weights[r].sum(0) for r in self._rows(page)]
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = (self.first + e[0]).tolist()
        back = []
        for x in e[1:]:
            x0, x1 = x.tolist()
            back.append((a + m00 < b + m10, a + m01 < b + m11))
            a, b = max(a + m00, b + m10) + x0, max(a + m01, b + m11) + x1
        y = [int(b > a)]
        for k in reversed(back):
            y.append(int(k[y[-1]]))
        return y[::-1]


# --- labelled pages -------------------------------------------------------------------------------

_NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs links tabs", "header": "header masthead top site branding logo",
    "footer": "footer foot bottom copyright colophon legal", "side": "sidebar side aside related widget recommended popular more toc tags archive",
    "notice": "cookie cookies consent notice gdpr banner popup modal alert message warning privacy announcement", "ad": "ad ads advert advertisement sponsor sponsored promo adsense commercial",
    "form": "form search login subscribe newsletter signup contact", "comments": "comments comment replies reply discussion disqus responses respond",
    "social": "share social sharing follow buttons tools meta", "main": "content article post entry story text body main page news blog",
}
_NAMES = {k: v.split() for k, v in _NAMES.items()}


def labelled_pages(n: int = TRAIN_PAGES, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """Pages of common parts; each block's label is its part's. Marked while written by a sign in the text."""
    rng = random.Random(seed)
    syllables = [a + b for a in "b d f g k l m n p r s t v th ch".split() for b in "a e i o u é ü ñ".split()]

    def words(lo: int, hi: int) -> str:
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(lo, hi)))

    def sentence(lo: int = 2, hi: int = 18) -> str:
        return words(lo, hi).capitalize() + rng.choice(["", ",", ""]) + rng.choice(". . . . ! ?".split() + [""])

    def prose(main: bool) -> str:
        text = " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 4, 8])))
        if rng.random() < 0.2:
            text = f"<a href='/x'>{words(1, 3)}</a> " + text
        return mark(text, main)

    def mark(text: str, main: bool) -> str:
        return ("\ue001" if main else "\ue000") + text

    def named(kind: str, tags: list[str], body: str, plain: float = 0.0) -> str:
        tag, name = rng.choice(tags), rng.choice(_NAMES[kind])
        if rng.random() < plain:
            return f"<{tag}>{body}</{tag}>"
        if rng.random() < 0.3:
            name += rng.choice(["-", "_", " "]) + rng.choice(["wrap", "box", "inner", "list", rng.choice(_NAMES[kind])])
        return f"<{tag} {rng.choice(['class', 'class', 'id'])}=\"{name}\">{body}</{tag}>"

    def items(main: bool, link: bool) -> str:
        return "<ul>" + "".join(f"<li>{'<a href=x>' * link}{mark(words(1, 4) if link else sentence(), main)}{'</a>' * link}</li>" for _ in range(rng.randint(2, 7))) + "</ul>"

    def link_row() -> str:
        return "".join(f"<{t}><a href=x>{mark(words(1, 3), False)}</a></{t}>" for t in [rng.choice(["div", "p", "li"])] for _ in range(rng.randint(2, 5)))

    def menu() -> str:
        body = items(False, True) if rng.random() < 0.8 else link_row()
        return f"<nav>{body}</nav>" if rng.random() < 0.5 else named("menu", ["nav", "div", "ul"], body)

    def header() -> str:
        body = f"<{(t := rng.choice(['div', 'p', 'h1', 'h2', 'span']))}>{mark(words(1, 4), False)}</{t}>" + (menu() if rng.random() < 0.5 else "")
        return f"<header>{body}</header>" if rng.random() < 0.5 else named("header", ["header", "div"], body)

    def footer() -> str:
        body = mark(rng.choice(["&copy; ", "", "© 2020 "]) + words(1, 3) + rng.choice([" &middot; ", " | ", " "]) + sentence(), False)
        body = f"<p>{body}</p>" * (rng.random() < 0.5) or body
        body += items(False, True) if rng.random() < 0.3 else ""
        return f"<footer>{body}</footer>" if rng.random() < 0.6 else named("footer", ["footer", "div"], body)

    def side() -> str:
        body = f"<h3>{mark(words(1, 3), False)}</h3>" + rng.choice([items(False, True), items(False, False), f"<p>{prose(False)}</p>"])
        return f"<aside>{body}</aside>" if rng.random() < 0.5 else named("side", ["aside", "div", "section"], body)

    def simple(kind: str) -> str:
        body = rng.choice([prose(False), f"<p>{prose(False)}</p>", mark(sentence(), False)])
        body += f"<button>{mark(words(1, 2), False)}</button>" if kind == "notice" and rng.random() < 0.6 else ""
        return named(kind, ["div", "div", "section", "p" if body[0] != "<" else "div", "aside"], body)

    def form() -> str:
        body = f"<label>{mark(words(1, 3), False)}</label><input name=q><button>{mark(words(1, 2), False)}</button>"
        body += f"<p>{prose(False)}</p>" if rng.random() < 0.4 else ""
        body += f"<select><option>{mark(words(1, 1), False)}<option>{mark(words(1, 1), False)}</select>" if rng.random() < 0.3 else ""
        return f"<form action=x>{body}</form>" if rng.random() < 0.7 else named("form", ["form", "div"], f"<form>{body}</form>")

    def comments() -> str:
        one = lambda: named("comments", ["div", "li", "article", "section"], f"<{(t := rng.choice(['span', 'b', 'div', 'h4']))}>{mark(words(1, 2), False)}</{t}><p>{prose(False)}</p>" + (f"<p>{prose(False)}</p>" if rng.random() < 0.3 else ""), 0.3)
        body = (f"<h3>{mark(words(1, 3), False)}</h3>" if rng.random() < 0.6 else "") + "".join(one() for _ in range(rng.randint(1, 5)))
        return named("comments", ["div", "section", "ol"], body)

    def social() -> str:
        return named("social", ["div", "ul", "p"], link_row())

    def main() -> str:
        out = [f"<h1>{mark(sentence(), True)}</h1>"] if rng.random() < 0.85 else []
        if rng.random() < 0.15:
            out.insert(0, social())
        for _ in range(rng.choice([0, 1, 2, 4, 8, 12])):
            kind = rng.random()
            if kind < 0.7:
                p = prose(True)
                p = rng.choice([p, p, f"<b>{p}<br>", f"<b>{p}</b>", f"<em>{p}</em> {words(1, 3)}"])
                out.append(f"<p>{p}" + ("</p>" if rng.random() < 0.9 else ""))
            elif kind < 0.78:
                out.append(f"<h{(k := rng.randint(2, 4))}>{mark(sentence(1, 6), True)}</h{k}>")
            elif kind < 0.84:
                out.append(items(True, False))
            elif kind < 0.88:
                out.append(f"<blockquote>{prose(True)}</blockquote>")
            elif kind < 0.91:
                out.append(f"<pre>{mark(words(3, 20), True)}</pre>")
            elif kind < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{mark(words(1, 4), True)}</td><td>{mark(words(1, 4), True)}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.96:
                out.append(f"<figure><img src=x><figcaption>{mark(sentence(), True)}</figcaption></figure>")
            else:
                out.append(rng.choice([lambda: simple("ad"), side, lambda: simple("notice"), form])())
        if rng.random() < 0.1:
            out.append(comments())
        body = "".join(out)
        how = rng.random()
        if how < 0.45:
            body = f"<article>{body}</article>"
        elif how < 0.6:
            body = f"<main>{body}</main>"
        elif how < 0.9:
            body = named("main", ["div", "section", "article", "main", "td"], body)
        return f"<main>{body}</main>" if rng.random() < 0.15 else body

    out = []
    for _ in range(n):
        before = [f() for f in (menu, header, side, lambda: simple("notice"), lambda: simple("ad"), form, social) if rng.random() < (0.6 if f is menu else 0.3)]
        after = [f() for f in (comments, side, form, social, lambda: simple("ad"), lambda: simple("notice"), menu) if rng.random() < 0.25]
        rng.shuffle(before)
        rng.shuffle(after)
        page = "<body>" + "".join(before) + main() + "".join(after) + (footer() if rng.random() < 0.85 else "") + "</body>"
        found = blocks(page)
        y = [int("\ue001" in b.text) for b in found]
        for b in found:
            b.text = b.text.replace("\ue000", "").replace("\ue001", "").strip() or "x"
        out.append((features(found), y))
    return out


def train(pages: int = TRAIN_PAGES) -> Field:
    return Field().train(labelled_pages(pages))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, y in zip(found, field.decode(features(found))) if y)


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for at, own in text_chunks(batch.column("html")):
                texts = [main_text(t, f) for t in own]
                yield pa.RecordBatch.from_arrays([batch.column("page_id").slice(at, len(own)), batch.column("url").slice(at, len(own)),
                                                  pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
            .mapInArrow(task, "page_id long, url string, text string, n_chars long"))
