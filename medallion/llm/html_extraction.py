"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Blocks are labelled as main text or not. Each has features of the elements around it and of
its text, the chain has weights between neighbours, and Viterbi decoding finds the labelling
of the whole page with the highest score. The field is trained by gradient ascent on the
likelihood of labelled pages; these are composed of parts of known label, since the tables
hold no labelled pages.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import bounded_batches, slices
from medallion.llm.html_blocks import Block, blocks, text_features

TRAINING_PAGES = 600
ROUNDS = 150
RATE = 0.1
DECAY = 1e-3
SEED = 7
BATCH_BYTES = 4_000_000


# Labelled pages


class Composer:
    """Composes pages out of parts whose label is known: the text of main blocks begins with a
    mark, which is taken off before features are made."""

    MARK = "\x02"

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        letters = "etaoinshrdlucmfw"
        count = self.random.randint(low, high)
        return " ".join("".join(self.random.choices(letters, k=self.random.randint(2, 9))) for _ in range(count))

    def sentences(self, low: int, high: int) -> str:
        count = self.random.randint(low, high)
        made = (self.words(3, 14).capitalize() + self.random.choice([".", ".", ".", "?", ", " + self.words(2, 6) + "."]) for _ in range(count))
        return " ".join(made)

    def named(self, *names: str) -> str:
        return f'{self.random.choice(["class", "class", "id"])}="{self.random.choice(names)}"'

    def links(self, count: int) -> str:
        return "".join(f'<li><a href="/x">{self.words(1, 3)}</a></li>' for _ in range(count))

    def menu(self) -> str:
        items = f"<ul>{self.links(self.random.randint(3, 8))}</ul>"
        wrapper = self.random.choice(["nav", "named", "both", "plain"])
        if wrapper == "nav":
            return f"<nav>{items}</nav>"
        if wrapper == "plain":
            return items
        tag = "nav" if wrapper == "both" else "div"
        return f'<{tag} {self.named("menu", "navbar", "main-nav", "navigation", "breadcrumb", "topbar")}>{items}</{tag}>'

    def header(self) -> str:
        inside = f"<div>{self.words(1, 4)}</div><p>{self.words(2, 9)}</p>"
        if self.random.random() < 0.5:
            return f"<header>{inside}</header>"
        return f'<div {self.named("header", "masthead", "site-header", "banner", "logo")}>{inside}</div>'

    def footer(self) -> str:
        line = f'{self.random.choice(["&copy; ", "Copyright ", ""])}{self.words(1, 4)} &middot; {self.sentences(1, 2)}'
        if self.random.random() < 0.6:
            return f"<footer>{line}</footer>"
        return f'<div {self.named("footer", "site-footer", "copyright", "legal", "imprint")}><p>{line}</p></div>'

    def advert(self) -> str:
        tag = self.random.choice(["div", "div", "aside", "section", "p"])
        name = self.named("ad", "ads", "advert", "advertisement", "sponsored", "promo", "adbox", "banner")
        return f"<{tag} {name}>{self.sentences(1, 3)}</{tag}>"

    def notice(self) -> str:
        name = self.named("cookie-notice", "cookie", "consent", "notice", "alert", "gdpr", "popup", "modal")
        return f"<div {name}><p>{self.sentences(1, 3)}</p><button>{self.words(1, 2)}</button></div>"

    def sidebar(self) -> str:
        inside = f"<h3>{self.words(1, 3)}</h3>"
        inside += f"<ul>{self.links(3)}</ul>" if self.random.random() < 0.5 else f"<p>{self.sentences(1, 3)}</p>"
        if self.random.random() < 0.5:
            return f"<aside>{inside}</aside>"
        return f'<div {self.named("sidebar", "related", "widget", "recommended", "trending", "tags", "share", "social")}>{inside}</div>'

    def form(self) -> str:
        inside = f"<label>{self.words(1, 3)}</label><input><p>{self.sentences(1, 2)}</p><button>{self.words(1, 2)}</button>"
        name = self.named("newsletter", "subscribe", "search", "login", "signup", "contact")
        return f"<form>{inside}</form>" if self.random.random() < 0.5 else f"<div {name}><form>{inside}</form></div>"

    def comments(self) -> str:
        item = self.random.choice(["div", "li", "article"])
        inside = "".join(
            f'<{item} class="{self.random.choice(["comment", "reply", "comment-body"])}"><p>{self.sentences(1, 4)}</p></{item}>'
            for _ in range(self.random.randint(1, 5))
        )
        tag = self.random.choice(["section", "div"])
        return f'<{tag} {self.named("comments", "comment-list", "disqus", "replies", "discussion")}><h2>{self.words(1, 3)}</h2>{inside}</{tag}>'

    def main_block(self) -> str:
        mark, kind = self.MARK, self.random.random()
        if kind < 0.6:
            return f"<p>{mark}{self.sentences(1, 8)}</p>"
        if kind < 0.7:
            return f"<p>{mark}{self.words(1, 6).capitalize()}.</p>"
        if kind < 0.78:
            return f"<h{self.random.randint(2, 4)}>{mark}{self.words(1, 8)}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{mark}{self.words(2, 12)}</li>" for _ in range(3)) + "</ul>"
        if kind < 0.9:
            return f"<blockquote><p>{mark}{self.sentences(1, 3)}</p></blockquote>"
        if kind < 0.93:
            return f"<pre>{mark}{self.words(3, 20)}</pre>"
        if kind < 0.96:
            return f"<table><tr><td>{mark}{self.words(1, 5)}</td><td>{mark}{self.words(1, 5)}</td></tr></table>"
        return f'<p>{mark}{self.sentences(1, 2)} <a href="/y">{self.words(1, 4)}</a> {self.sentences(1, 2)}</p>'

    def article(self) -> str:
        inside = []
        title = f"<h1>{self.MARK}{self.words(2, 12).capitalize()}</h1>"
        for _ in range(self.random.randint(1, 10)):
            inside.append(self.main_block())
            if self.random.random() < 0.08:
                inside.append(self.random.choice([self.advert, self.sidebar, self.form])())
        body, kind = "".join(inside), self.random.random()
        if kind < 0.45:
            top = f"<header>{title}</header>" if self.random.random() < 0.2 else title
            return f"<article>{top}{body}</article>"
        if kind < 0.6:
            return f"<main>{title}{body}</main>"
        name = self.named("content", "article", "post", "entry", "story", "main", "article-body", "post-content", "text")
        if kind < 0.85:
            return f"{title}<div {name}>{body}</div>" if self.random.random() < 0.5 else f"<div {name}>{title}{body}</div>"
        return f"<div>{title}{body}</div>" if self.random.random() < 0.5 else title + body

    def page(self) -> str:
        before = [self.menu, self.header, self.notice, self.advert, self.form]
        after = [self.footer, self.comments, self.sidebar, self.advert, self.form, self.menu]
        top = self.random.sample(before, self.random.randint(0, 3))
        bottom = self.random.sample(after, self.random.randint(0, 4))
        parts = [part() for part in top] + [self.article()] + [part() for part in bottom]
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{''.join(parts)}</body></html>"


def labelled_pages(count: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Blocks and labels (1 for main text) of composed pages."""
    composer, pages = Composer(seed), []
    for _ in range(count):
        found = blocks(composer.page())
        labels = [int(composer.MARK in b.text) for b in found]
        for block in found:
            block.text = block.text.replace(composer.MARK, "") or "-"
        pages.append((found, labels))
    return pages


# The field


@dataclass(frozen=True)
class Field:
    """Weights per feature and label, and between the labels of neighbours; a page's first block
    has a weight per label too."""

    features: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def scores(self, page: Sequence[Block]) -> np.ndarray:
        found = np.zeros((len(page), 2))
        around: dict[frozenset, np.ndarray] = {}
        for row, block in zip(found, page, strict=True):
            if block.around not in around:
                around[block.around] = self._sum(block.around)
            row += around[block.around]
            row += self._sum(text_features(block))
        return found

    def _sum(self, features) -> np.ndarray:
        known = [self.features[f] for f in features if f in self.features]
        return self.weights[known].sum(axis=0)

    def decode(self, page: Sequence[Block]) -> list[int]:
        """The labelling of highest score, by Viterbi; label 0 wins a tie."""
        if not page:
            return []
        (a0, a1), (b0, b1) = self.moves.tolist()
        rows = self.scores(page).tolist()
        first = self.start.tolist()
        zero, one = rows[0][0] + first[0], rows[0][1] + first[1]
        came = []
        for left, right in rows[1:]:
            stay, turn = zero + a0, one + b0
            go, keep = zero + a1, one + b1
            came.append((int(turn > stay), int(keep > go)))
            zero, one = max(stay, turn) + left, max(go, keep) + right
        label = int(one > zero)
        labels = [label]
        for back in reversed(came):
            label = back[label]
            labels.append(label)
        return labels[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks(page or "")
        labels = self.decode(found)
        return "\n\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def train(pages: Sequence[tuple[list[Block], list[int]]]) -> Field:
    """Maximises the penalised likelihood of the labels by Adam steps over all pages at once."""
    pages = [p for p in pages if p[0]]
    features: dict[str, int] = {}
    for page, _ in pages:
        for block in page:
            for feature in sorted(block.around) + text_features(block):
                features.setdefault(feature, len(features))
    size, longest = len(features), max(len(p) for p, _ in pages)
    active = np.zeros((len(pages), longest, size), np.float32)
    labels = np.zeros((len(pages), longest), int)
    mask = np.zeros((len(pages), longest), bool)
    for i, (page, given) in enumerate(pages):
        labels[i, : len(page)], mask[i, : len(page)] = given, True
        for j, block in enumerate(page):
            active[i, j, [features[f] for f in (*block.around, *text_features(block))]] = 1
    flat, truth = active.reshape(-1, size), np.eye(2)[labels] * mask[:, :, None]
    both = mask[:, 1:] & mask[:, :-1]
    pairs = np.einsum("nta,ntb->ab", truth[:, :-1] * both[:, :, None], truth[:, 1:])
    parameters = np.zeros(2 * size + 6)
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, ROUNDS + 1):
        weights, moves, start = _split(parameters, size)
        scores = (flat @ weights.astype(np.float32)).reshape(len(pages), longest, 2).astype(float)
        scores[:, 0] += start
        single, double = _marginals(scores, moves, mask)
        gradient = np.concatenate([
            (flat.T @ (truth - single).reshape(-1, 2).astype(np.float32)).ravel(),
            (pairs - double).ravel(),
            (truth - single)[:, 0].sum(axis=0),
        ]) / len(pages) - DECAY * parameters
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        ahead = mean / (1 - 0.9**step)
        parameters = parameters + RATE * ahead / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(features, *_split(parameters, size))


def _split(parameters: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    weights, rest = parameters[: 2 * size], parameters[2 * size :]
    return weights.reshape(size, 2), rest[:4].reshape(2, 2), rest[4:]


def _marginals(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of each block's label, and the expected number of each move, by the
    forward and backward sums over all pages at once."""
    pages, longest, _ = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for t in range(1, longest):
        step = _logsum(forward[:, t - 1, :, None] + moves, 1) + scores[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = _logsum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(mask[:, t + 1, None], step, 0)
    total = _logsum(forward[:, -1], 1)[:, None, None]
    single = np.exp(forward + backward - total) * mask[:, :, None]
    both = mask[:, 1:] & mask[:, :-1]
    joint = forward[:, :-1, :, None] + moves + (scores + backward)[:, 1:, None, :] - total[:, None]
    return single, (np.exp(np.where(both[:, :, None, None], joint, -np.inf))).sum(axis=(0, 1))


@cache
def trained() -> Field:
    return train(labelled_pages())


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its code points of each row of ``pages``.

    The blocks labelled as main text are joined by two newlines in the order of the page; in a
    block character references are decoded and white space is one blank. Null and empty pages
    and pages without main text have an empty one. Repeated rows are answered one by one;
    other columns are ignored.
    """
    bounded_batches(pages.sparkSession)
    field = pages.sparkSession.sparkContext.broadcast(trained())

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column("html"), BATCH_BYTES):
                part = batch.slice(start, end - start)
                found = [field.value.main_text(page) for page in part.column("html").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([len(t) for t in found], pa.int64())], schema=OUT
                )

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(texts, "page_id bigint, url string, text string, n_chars bigint")
