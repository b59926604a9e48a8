"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A
document is parsed greedily into phrases, each the longest piece of the rest that occurs in
that sample. Text in the language needs few phrases; the language that needs the fewest per
symbol wins.

Symbols are lower-case letters; every run of anything else is one blank. Parsing goes in
pieces of ``PIECE`` symbols, at whose ends a phrase ends in every language alike, so that
many pieces advance together through the automata as numpy arrays.

An automaton of a text of n symbols has at most 2 n states and 3 n transitions. Those of the most
frequent letters are a table of states and letters; those of other letters, of which scripts
like Han have thousands, are sorted by state and letter. So the automata take at most
2 * MODEL_CHARS * (FIRST + COMMON) * 4 bytes and 3 * MODEL_CHARS * 12, whatever the scripts:
about 45 MB.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import bounded_batches, slices

UNKNOWN = "und"
# Bounds of the labelled sample: documents of a language, code points taken of each, and
# code points of all languages together, shared evenly.
SAMPLE_DOCUMENTS = 80
SAMPLE_CHARS = 500
MODEL_CHARS = 80_000
PIECE = 1_024
BATCH_BYTES = 1_500_000
BLANK, OTHER, FIRST = 0, 1, 2
# Letters that have a column in the table.
COMMON = 64


class Automata:
    """Transitions of all languages, one after the other.

    A state is the index of its row in the flat table. An entry holds twice the following
    state, plus one if the letter does not continue the phrase; it then leads to where that
    letter, as the first of a new phrase, leads. The last state of a language is one from which
    every letter begins a new phrase: pieces start there, and a letter that the language never
    saw leads there. Transitions by letters without a column are keyed by state and letter.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        counts = Counter(c for text in samples.values() for c in text.lower() if c.isalpha())
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.codes = _codes(letters)
        self.width = FIRST + min(len(letters), COMMON)
        self.rare = FIRST + len(letters) - self.width
        tables, starts, roots, keys, targets, offset = [], [], [], [], [], 0
        for language in self.languages:
            rows, moves = _suffix_automaton(_collapsed(self.encode(samples[language])), self.width)
            tables.append(self._entries(rows, offset))
            roots.append(offset)
            starts.append(offset + len(rows) * self.width)
            state, code, target = moves.T
            keys.append((state * self.width + offset) * self.rare + code - self.width)
            targets.append(target * self.width + offset)
            offset += tables[-1].size
        self.table = np.concatenate([*tables, np.zeros(0, np.int32)])
        self.starts, self.roots = np.array(starts, np.int64), np.array(roots, np.int64)
        keys, targets = np.concatenate([*keys, np.zeros(0, np.int64)]), np.concatenate([*targets, np.zeros(0, np.int64)])
        order = np.argsort(keys)
        # One key above all others, so that every search ends at one.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.targets = np.append(targets[order], 0).astype(np.int32)

    @property
    def bytes(self) -> int:
        return self.table.nbytes + self.keys.nbytes + self.targets.nbytes

    def _entries(self, rows: np.ndarray, offset: int) -> np.ndarray:
        dead = len(rows)
        start = np.where(rows[0] < 0, dead, rows[0])
        rows = np.vstack([rows, np.full((1, self.width), -1, rows.dtype)])
        target = np.where(rows < 0, start, rows) * self.width + offset
        return (target * 2 + (rows < 0)).ravel().astype(np.int32)

    def _follow(self, state: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether there is a transition from each state, a row per language, by the letters
        without a column, and where it leads."""
        sought = state.astype(np.int64) * self.rare + (codes - self.width)
        at = np.searchsorted(self.keys, sought)
        return self.keys[at] == sought, self.targets[at]

    def _rare_steps(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The entries of letters without a column."""
        goes, target = self._follow(state, codes)
        begins, first = self._follow(np.broadcast_to(self.roots[:, None], state.shape), codes)
        anew = np.where(begins, first, self.starts[:, None])
        return np.where(goes, target * 2, anew * 2 + 1)

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        return self.codes[points]

    def phrases(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per piece and language; the pieces in falling order of length."""
        found = np.zeros((len(self.languages), len(starts)), np.int32)
        state = np.repeat(self.starts.astype(np.int32)[:, None], len(starts), axis=1)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -step, side="left"))
            letters = codes[starts[:active] + step]
            rare = np.flatnonzero(letters >= self.width)
            if len(rare):
                special = self._rare_steps(state[:, rare], letters[rare])
                letters[rare] = OTHER
            entry = self.table[state[:, :active] + letters]
            if len(rare):
                entry[:, rare] = special
            found[:, :active] += entry & 1
            state[:, :active] = entry >> 1
        return found

    def classify(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        kept, codes = [], []
        for i, text in enumerate(texts):
            of = _collapsed(self.encode(text)) if text else ()
            if len(of) and of.max() > BLANK:
                kept.append(i)
                codes.append(of)
        predicted, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not kept or not self.languages:
            return predicted, scores
        sizes = np.array([len(c) for c in codes])
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(kept)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(np.cumsum(sizes) - sizes, pieces) + number * PIECE
        lengths = np.minimum(sizes[owner] - number * PIECE, PIECE)
        order = np.argsort(-lengths, kind="stable")
        counts = self.phrases(np.concatenate(codes), starts[order], lengths[order])
        totals = np.zeros((len(self.languages), len(kept)), np.int64)
        for row, count in zip(totals, counts, strict=True):
            np.add.at(row, owner[order], count)
        rates = totals / sizes
        best = rates.argmin(axis=0)
        ranked = np.sort(rates, axis=0)
        margin = 1 - ranked[0] / ranked[1] if len(ranked) > 1 else np.ones(len(kept))
        for i, language, score in zip(kept, best, margin, strict=True):
            predicted[i], scores[i] = self.languages[language], float(score)
        return predicted, scores


def _codes(letters: Sequence[str]) -> np.ndarray:
    """The symbol of each code point."""
    symbol = {letter: FIRST + i for i, letter in enumerate(letters)}
    codes = np.zeros(sys.maxunicode + 1, np.int32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            codes[point] = symbol.get(char.lower(), OTHER)
    return codes


def _collapsed(codes: np.ndarray) -> np.ndarray:
    """Runs of blanks made one."""
    blank = codes == BLANK
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return codes[keep]


def _suffix_automaton(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of following states by codes below ``width``, -1 where there is none, and the other
    transitions as (state, code, following state); state 0 is the start.

    Built letter by letter: the state of the whole text so far gets the new letter, and so do
    its suffixes, until one has it already; that one's target is split if it also ends longer
    pieces which the new text does not have as suffixes.
    """
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes.tolist():
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and code not in following[state]:
            following[state][code] = new
            state = link[state]
        if state >= 0:
            target = following[state][code]
            if length[target] != length[state] + 1:
                twin = len(following)
                following.append(dict(following[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                link[target] = twin
                while state >= 0 and following[state].get(code) == target:
                    following[state][code] = twin
                    state = link[state]
                target = twin
            link[new] = target
        last = new
    rows = np.full((len(following), width), -1, np.int32)
    moves = []
    for i, row in enumerate(following):
        for code, target in row.items():
            if code < width:
                rows[i, code] = target
            else:
                moves.append((i, code, target))
    return rows, np.array(moves, np.int64).reshape(len(moves), 3)


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of the documents that nothing is learned from."""
    remainder = F.crc32(F.col(doc_id).cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def learn(docs: DataFrame) -> dict[str, str]:
    """A bounded sample of text per language, from documents that are not held out.

    Documents are taken by a hash of their id. Only the sample reaches the driver: at most
    ``SAMPLE_DOCUMENTS`` times ``SAMPLE_CHARS`` code points of a language. Rows without id,
    text or language are not learned from.
    """
    rows = docs.select(
        F.col("lang").alias("_lang"),
        F.xxhash64("doc_id").alias("_order"),
        F.substring("text", 1, SAMPLE_CHARS).alias("_piece"),
        F.col("doc_id").alias("_id"),
        held_out().alias("_held"),
    ).where("_lang is not null and _piece is not null and _id is not null and not _held")
    first = Window.partitionBy("_lang").orderBy("_order", "_id", "_piece")
    sample = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= SAMPLE_DOCUMENTS)
    found: dict[str, list[str]] = {}
    for row in sample.orderBy("_lang", "_n").select("_lang", "_piece").collect():
        pieces = found.setdefault(row["_lang"], [])
        if row["_piece"] not in pieces:  # copies teach nothing new
            pieces.append(row["_piece"])
    share = MODEL_CHARS // max(1, len(found))
    samples = {language: "\n".join(pieces)[:share] for language, pieces in found.items()}
    return {k: v for k, v in samples.items() if any(c.isalpha() for c in v)}


@lru_cache(maxsize=1)
def _automata(samples: tuple[tuple[str, str], ...]) -> Automata:
    return Automata(dict(samples))


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
    ]
)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs``.

    The score is one minus the ratio of the phrases needed in the best and in the second best
    language: 0 for a tie (the first language by name wins), 1 if there is one language only.
    A text that is null or has no letter is ``und`` with score 0, and so is every text if there
    is nothing to learn from. Repeated rows are answered one by one; other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(tuple(sorted(learn(docs).items())))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(model.value)
        for batch in batches:
            for start, end in slices(batch.column("text"), BATCH_BYTES):
                part = batch.slice(start, end - start)
                languages, scores = automata.classify(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(languages, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    schema=OUT,
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have a language, with their own columns; a missing ``lang`` is
    filled with the predicted one.

    Texts that are null or without a letter are rejected; so is every text if there is nothing
    to learn from. Rows that share an id and a text share the verdict.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(tuple(sorted(learn(docs).items())))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(model.value)
        for batch in batches:
            at, lang = batch.schema.get_field_index("text"), batch.schema.get_field_index("lang")
            for start, end in slices(batch.column(at), BATCH_BYTES):
                part = batch.slice(start, end - start)
                predicted, _ = automata.classify(part.column(at).to_pylist())
                given = part.column(lang).to_pylist()
                filled = [g if g is not None else p for g, p in zip(given, predicted, strict=True)]
                part = part.set_column(lang, batch.schema.field(lang), pa.array(filled, pa.string()))
                yield part.filter(pa.array([p != UNKNOWN for p in predicted], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
