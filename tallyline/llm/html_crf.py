"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is read tag by tag into leaf blocks: runs of text between block-level tags, each with the
path of its ancestors. Blocks have features of their ancestors (tags, words of ``class``, ``id``
and ``role``) and of their text (length, share of linked characters, punctuation, typical words).
The field gives every block a label, article or not, from its features and its neighbour's label.
It is trained by gradient descent on the exact log likelihood (forward and backward sums), on
labelled pages, and decoded by Viterbi.

The labelled pages are of two kinds, both bounded: at most ``TAGGED`` pages of the table that
mark their article themselves (an ``article`` or ``main`` element), and ``DRAWN`` pages drawn
from layouts (``layouts``), which cover what the table's own pages may lack: sidebars, notices,
forms, comments, articles in a ``div``. Drawing is seeded, so the model is the same each time.

Character references are decoded. White space inside a block (line breaks too) becomes one
space, blocks are trimmed and joined by two line feeds; nothing else is dropped. A null or empty
page, one without text, and one without an article give an empty text. Unclosed elements, cut
pages and stray end tags are read as browsers do in essence: the text counts. Pages without a
labelled example to learn from are still read by the drawn layouts.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages of the table that are learned from, about, and pages drawn from layouts.
TAGGED, DRAWN = 300, 500
EPOCHS, RATE, RIDGE = 12, 0.3, 1e-4

# What HTML defines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template head title svg math iframe object textarea select option".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt s samp small span "
    "strike strong sub sup time tt u var br wbr img".split()
)
#: Start tags that end an open paragraph, and elements that end one of their own kind.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
CLOSES_OWN = frozenset("li dt dd tr td th".split())


@dataclass
class Block:
    """A leaf block: its text, the characters in links, and its ancestors' features."""

    text: str
    linked: int
    path: tuple[str, ...]


class Reader(HTMLParser):
    """Cuts a page into leaf blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = self.hidden = 0

    def path(self) -> tuple[str, ...]:
        return tuple(x for _, found in self.stack for x in found)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.linked, self.path()))
        self.parts, self.linked = [], 0

    def close_to(self, place: int) -> None:
        """Ends the elements from a place of the stack on."""
        if any(tag not in INLINE for tag, _ in self.stack[place:]):
            self.flush()
        for tag, _ in self.stack[place:]:
            self.links -= tag == "a"
            self.hidden -= tag in SKIP
        del self.stack[place:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
            if self.hidden and tag not in SKIP and self.stack[-1][0] in ("head", "title"):
                self.close_to(next(i for i, (t, _) in enumerate(self.stack) if t in SKIP))
            ends = "p" if tag in CLOSES_P else tag if tag in CLOSES_OWN else ""
            for i in range(len(self.stack) - 1, -1, -1):
                t = self.stack[i][0]
                if ends and t == ends:
                    self.close_to(i)
                    break
                if t not in INLINE and t != "p":
                    break
        if tag in VOID:
            return
        found = ["t=" + tag]
        for name, value in attrs:
            if name in ("class", "id", "role", "aria-label") and value:
                found += ["c=" + w for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())]
        self.stack.append((tag, tuple(found)))
        self.links += tag == "a"
        self.hidden += tag in SKIP

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.close_to(i)
                return
        if tag not in INLINE and tag not in VOID:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks_of(html: str | None) -> list[Block]:
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.blocks


# Words by which pages name their parts.
SIGNS = {
    "copyright": r"(?i)©|\bcopyright\b|all rights reserved",
    "cookie": r"(?i)\bcookies?\b|\bconsent\b",
    "subscribe": r"(?i)\b(subscribe|newsletter|sign up|log ?in|sign in|register|search|submit)\b",
    "share": r"(?i)\b(share|tweet|follow us|related|read more|advert\w*|sponsored|promot\w*)\b",
    "reply": r"(?i)\b(repl(y|ies)|comments?|posted by|says:?|wrote:)\b",
    "terms": r"(?i)\b(privacy|terms|contact|about us|home|menu|skip to)\b",
}
_SIGNS = {name: re.compile(p) for name, p in SIGNS.items()}


def path_features(path: tuple[str, ...]) -> set[str]:
    tags = [p for p in path if p.startswith("t=")]
    return {"bias", *path, "parent" + (tags[-1][1:] if tags else "=")}


def text_features(block: Block, at: int, count: int) -> list[str]:
    n, text = len(block.text), block.text
    out = [
        f"long={min(5, n.bit_length() // 2)}",
        f"linked={min(4, int(4 * block.linked / max(1, n)))}",
        "ends=stop" if text[-1] in ".!?…\"”" else "ends=other",
        f"stops={min(3, text.count('. ') + text.count('! ') + text.count('? '))}",
    ]
    # Of a long text signs are not looked for, so that prose that mentions one is not held against it.
    if n < 200:
        out += ["sign=" + name for name, p in _SIGNS.items() if p.search(text)]
    if at == 0:
        out.append("first")
    if at == count - 1:
        out.append("last")
    return out


@dataclass
class Field:
    """Weights of the features for the two labels (as one difference) and of label pairs."""

    names: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray

    def __post_init__(self):
        self.by_name = {f: float(self.weights[i]) for f, i in self.names.items()}
        self.known: dict[tuple[str, ...], float] = {}  # of paths, which repeat from page to page

    def emissions(self, blocks: list[Block]) -> np.ndarray:
        """Score of each block for being in the article; the other label scores 0."""
        get, n, known = self.by_name.get, len(blocks), self.known
        out = []
        for k, b in enumerate(blocks):
            if b.path not in known:
                if len(known) > 20_000:
                    known.clear()
                known[b.path] = sum(get(f, 0.0) for f in path_features(b.path))
            out.append(known[b.path] + sum(get(f, 0.0) for f in text_features(b, k, n)))
        return np.array(out)

    def decode(self, blocks: list[Block]) -> list[bool]:
        """The best labels, by Viterbi."""
        if not blocks:
            return []
        e, p = self.emissions(blocks).tolist(), self.pairs.tolist()
        off, on, back = 0.0, e[0], []
        for x in e[1:]:
            stay_off, leave = off + p[0][0], on + p[1][0]
            enter, stay_on = off + p[0][1], on + p[1][1]
            back.append((leave > stay_off, stay_on > enter))
            off, on = max(stay_off, leave), max(enter, stay_on) + x
        labels = [on > off]
        for was_on_if_off, was_on_if_on in reversed(back):
            labels.append(was_on_if_on if labels[-1] else was_on_if_off)
        return labels[::-1]

    def text(self, html: str | None) -> str:
        blocks = blocks_of(html)
        return "\n\n".join(b.text for b, on in zip(blocks, self.decode(blocks)) if on)


def _features(block: Block, at: int, count: int) -> list[str]:
    return sorted(path_features(block.path)) + text_features(block, at, count)


def marginals(e: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each block is on, and the expected counts of label pairs."""
    n = len(e)
    score = np.stack([np.zeros(n), e], 1)
    forward, backward = np.empty((n, 2)), np.zeros((n, 2))
    forward[0] = score[0]
    for i in range(1, n):
        forward[i] = np.logaddexp(forward[i - 1, 0] + pairs[0], forward[i - 1, 1] + pairs[1]) + score[i]
    for i in range(n - 2, -1, -1):
        ahead = score[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(pairs[:, 0] + ahead[0], pairs[:, 1] + ahead[1])
    z = np.logaddexp(*forward[-1])
    on = np.exp(forward[:, 1] + backward[:, 1] - z)
    expected = np.zeros((2, 2))
    if n > 1:
        joint = forward[:-1, :, None] + pairs[None] + (score[1:] + backward[1:])[:, None, :] - z
        expected = np.exp(joint).sum(0)
    return on, expected


def train(pages: list[tuple[list[Block], list[bool]]], seed: int = 7) -> Field:
    """A field from labelled pages, by adaptive gradient ascent of the log likelihood."""
    names: dict[str, int] = {}
    coded = []
    for blocks, labels in pages:
        if blocks:
            found = [
                np.array([names.setdefault(f, len(names)) for f in _features(b, k, len(blocks))], np.int64)
                for k, b in enumerate(blocks)
            ]
            at = np.repeat(np.arange(len(blocks)), [len(f) for f in found])
            coded.append((np.concatenate(found), at, np.array(labels, float)))
    w, pairs = np.zeros(len(names)), np.zeros((2, 2))
    seen_w, seen_p = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    order = random.Random(seed)
    for _ in range(EPOCHS):
        order.shuffle(coded)
        for features, at, y in coded:
            e = np.bincount(at, w[features], minlength=len(y))
            on, expected = marginals(e, pairs)
            g = np.bincount(features, (y - on)[at], minlength=len(w)) - RIDGE * w
            seen_w += g * g
            w += RATE * g / np.sqrt(seen_w)
            k = y.astype(int)
            real = np.zeros((2, 2))
            np.add.at(real, (k[:-1], k[1:]), 1)
            gp = real - expected - RIDGE * pairs
            seen_p += gp * gp
            pairs += RATE * gp / np.sqrt(seen_p)
    return Field(names, w, pairs)


# --- labelled pages

OUTSIDE = frozenset(
    "t=nav t=footer t=aside t=form t=button c=nav c=menu c=ad c=ads c=advert c=sidebar c=comments c=comment c=cookie "
    "c=banner c=newsletter c=related c=share c=notice c=promo".split()
)


def tagged(html: str | None) -> tuple[list[Block], list[bool]] | None:
    """A page that marks its article itself, and what it marks; none if it does not."""
    blocks = blocks_of(html)
    own = "t=article" if any("t=article" in b.path for b in blocks) else "t=main"
    labels = [own in b.path and not OUTSIDE.intersection(b.path[b.path.index(own) :]) for b in blocks]
    return (blocks, labels) if any(labels) and not all(labels) else None


_SOUNDS = "an ber ción de en er ge heit ing ion is la le lich ment no on or que ra re sch ta the tion un ver".split()


def layouts(count: int, seed: int = 11) -> list[tuple[list[Block], list[bool]]]:
    """Pages drawn from common layouts, with labels.

    Every element that is not part of the article is built with a mark in its text, which tells
    the label and is taken away again before features are made.
    """
    r = random.Random(seed)
    mark = "\ufdd0"

    def words(low: int, high: int) -> str:
        out = " ".join("".join(r.choice(_SOUNDS) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high)))
        return out[:1].upper() + out[1:]

    def sentence(low: int = 4, high: int = 20) -> str:
        return words(low, high) + r.choice(["."] * 6 + ["!", "?"])

    def off(text: str) -> str:
        return mark + text

    def prose() -> str:
        kinds = [
            lambda: f"<p>{' '.join(sentence() for _ in range(r.randint(1, 6)))}</p>",
            lambda: f"<p>{words(1, 4)}.</p>",
            lambda: f"<h2>{words(2, 7)}</h2><p>{sentence()}</p>",
            lambda: f"<blockquote><p>{sentence()}</p></blockquote>",
            lambda: "<ul>" + "".join(f"<li>{sentence(3, 9)}</li>" for _ in range(r.randint(2, 5))) + "</ul>",
            lambda: f"<p><b>{sentence()}<br>",
            lambda: f"<p>{words(3, 9)} <a href='/x'>{words(1, 3)}</a> {sentence()}</p>",
            lambda: f"<pre>{words(3, 9)}</pre>",
            lambda: f"<div><p>{sentence()}</p></div>",
            lambda: f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>",
            lambda: f"<figure><img src=x><figcaption>{sentence(3, 8)}</figcaption></figure>",
            lambda: f"<p>{r.choice(['All rights reserved.', 'Licensed under the Apache License, Version 2.0.'])}</p>",
        ]
        return "".join(r.choices(kinds, [9, 3, 2, 1, 1, 2, 2, 0.5, 1, 0.5, 0.5, 0.7])[0]() for _ in range(r.randint(1, 9)))

    def attr(*names: str) -> str:
        return f'{r.choice(["class", "class", "id"])}="{r.choice(names)}"'

    def links(tag: str, at: str = "") -> str:
        items = "".join(f'<li><a href="/x">{off(words(1, 2))}</a></li>' for _ in range(r.randint(3, 8)))
        return f"<{tag} {at}><ul>{items}</ul></{tag}>"

    def menu() -> str:
        return links("nav") if r.random() < 0.5 else links("div", attr("menu", "navbar", "nav main-nav", "navigation", "topnav", "breadcrumbs"))

    def header() -> str:
        inner = f"<h1>{off(words(1, 3))}</h1>" if r.random() < 0.3 else f"<p>{off(words(2, 6))}</p>"
        return f"<header {attr('site-header', 'top', 'masthead')}>{inner}</header>" if r.random() < 0.6 else f"<div {attr('header', 'masthead', 'site-title', 'topbar')}>{inner}</div>"

    def footer() -> str:
        inner = off(f"&copy; {words(1, 2)} &middot; {sentence()}") if r.random() < 0.6 else f"<p>{off(sentence())}</p><p>{off('Copyright ' + words(1, 3))}</p>"
        return f"<footer>{inner}</footer>" if r.random() < 0.6 else f"<div {attr('footer', 'site-footer', 'bottom', 'copyright', 'colophon')}>{inner}</div>"

    def sidebar() -> str:
        inner = f"<h3>{off(words(1, 3))}</h3><p>{off(sentence())}</p>" + (links("div") if r.random() < 0.5 else "")
        return f"<aside>{inner}</aside>" if r.random() < 0.5 else f"<div {attr('sidebar', 'widget', 'side', 'related', 'right-column', 'related-posts', 'trending')}>{inner}</div>"

    def notice() -> str:
        text = off(r.choice(["We use cookies. ", "", "Notice: ", "This site uses cookies to improve. "]) + sentence())
        return f"<div {attr('cookie-banner', 'notice', 'alert', 'consent', 'cookie', 'gdpr', 'banner', 'popup', 'modal', 'paywall', 'disclaimer')}><p>{text}</p><button>{off('OK')}</button></div>"

    def advert() -> str:
        return f"<div {attr('ad', 'ads', 'advert', 'advertisement', 'ad-slot', 'sponsored', 'promo', 'banner-ad', 'adsbox')}>{off(' '.join(sentence() for _ in range(r.randint(1, 3))))}</div>"

    def form() -> str:
        inner = f"<label>{off(words(1, 3))}</label><input><button>{off(r.choice(['Submit', 'Search', 'Sign up', words(1, 2)]))}</button>"
        return f"<form {attr('newsletter', 'search', 'login', 'signup', 'subscribe', 'contact-form')}><p>{off(sentence(3, 9))}</p>{inner}</form>"

    def comments() -> str:
        one = lambda: f"<{(t := r.choice(['div', 'li', 'article']))} class=comment><p>{off(sentence())}</p></{t}>"
        return f"<{(t := r.choice(['section', 'div', 'div']))} {attr('comments', 'comment-list', 'responses', 'discussion', 'disqus', 'replies', 'reader-comments')}><h3>{off(r.choice(['Comments', words(1, 3)]))}</h3>{''.join(one() for _ in range(r.randint(1, 5)))}</{t}>"

    def share() -> str:
        return f"<div {attr('share', 'social', 'tags', 'share-buttons', 'byline-links', 'pagination')}><a href=x>{off('Share')}</a> <a href=x>{off(words(1, 1))}</a></div>"

    pages = []
    while len(pages) < count:
        title = words(3, 10)
        inside = f"<h1>{title}</h1>" if r.random() < 0.85 else ""
        inside = f"<header>{inside}</header>" if inside and r.random() < 0.1 else inside
        for _ in range(r.randint(1, 3)):
            inside += prose()
            if r.random() < 0.3:
                inside += r.choice([advert, sidebar, share, form, notice])()
        if r.random() < 0.15:
            inside += comments()
        wrap = r.choice(["article", "article", "article", "main", "div", "section", "main-article"])
        if wrap == "div":
            inside = f"<div {attr('content', 'post', 'entry-content', 'article-body', 'story', 'main-content', 'article', 'post-body', 'text')}>{inside}</div>"
        elif wrap == "section":
            inside = f"<section {attr('content', 'article', 'post', 'story')}>{inside}</section>"
        elif wrap == "main-article":
            inside = f"<main><article>{inside}</article>{r.choice([comments, sidebar, share, form, str])()}</main>"
        else:
            inside = f"<{wrap}>{inside}</{wrap}>"
        before = [x() for x in (header, menu, notice, advert, form, sidebar) if r.random() < 0.45]
        after = [x() for x in (comments, sidebar, advert, share, form, notice, menu) if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        body = "".join(before) + inside + "".join(after) + (footer() if r.random() < 0.85 else "")
        body = f"<div {attr('page', 'wrapper', 'container', 'site')}>{body}</div>" if r.random() < 0.3 else body
        end = "</body></html>" if r.random() < 0.8 else ""
        blocks = blocks_of(f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}{end}")
        labels = [mark not in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(mark, "").strip() or "."
        pages.append((blocks, labels))
    return pages


def fit(pages: DataFrame, html: str, key: str, tagged_pages: int = TAGGED, drawn: int = DRAWN) -> Field:
    """A field from the drawn layouts and a bounded sample of the pages that mark their article."""
    marks = F.col(html).rlike(r"(?i)<(article|main)[\s>]")
    n = pages.where(marks).count()
    part = F.pmod(F.xxhash64(key), F.lit(1_000_000))
    some = pages.where(marks & (part < int(1_000_000 * min(1.0, tagged_pages / max(1, n))) + 1))
    rows = some.select(F.col(html).alias("html")).toArrow().column("html").to_pylist()
    own = [x for h in sorted(rows) if (x := tagged(h))]
    return train(own + layouts(drawn))


def main_text(model: Field, spark, html: Column | str) -> Column:
    """The main text of a page; empty if it has none."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for pages in batches:
            yield pa.array([model.text(p.as_py()) for p in pages], pa.string())

    return run(html)
