"""Replacing personal data by surrogates.

Each entity, a kind and a value in normal form, gets one replacement drawn from a secret key:
the same wherever it occurs, so that mentions of one entity still agree. A check over the
distinct entities of the whole corpus keeps them apart: of entities that drew the same
replacement one keeps it, and none may draw what is another entity's real value; the others
draw again until none is left.

Texts are read twice and never shuffled: once for the entities, once to replace them. Only
entities that had to draw again are looked up, by a join with the texts they occur in; all
others draw where they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import arrow_table, bounded_batches, slices, written
from medallion.llm.pii_entities import entities_of, find, replacement_of, surrogate, written_like

BATCH_BYTES = 2_000_000
OWN_TRIES, MOST_TRIES = 8, 100
ENTITY = "kind string, value string"
MENTIONS = pa.schema([("_text", pa.int64()), ("kind", pa.string()), ("value", pa.string())])
DRAWN = pa.schema([("kind", pa.string()), ("value", pa.string()), ("tries", pa.int32()), ("drawn", pa.string())])
DRAWN_DDL = f"{ENTITY}, tries int, drawn string"


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end in slices(batch.column("text"), BATCH_BYTES):
            part = batch.slice(start, end - start)
            rows = set()
            for key, text in zip(part.column("_text").to_pylist(), part.column("text").to_pylist(), strict=True):
                rows.update((key, *entity) for m in find(text) for entity in entities_of(m))
            yield arrow_table(MENTIONS, *(zip(*sorted(rows), strict=True) if rows else ([], [], [])))


def _drawer(key: bytes):
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "tries")), strict=True))
            drawn = [surrogate(key, *row) for row in rows]
            yield arrow_table(DRAWN, *(zip(*rows, strict=True) if rows else ([], [], [])), drawn)

    return draw


def drawn_again(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, tries) of the entities whose first draw may not stand.

    An entity keeps its draw if nothing before it has the same, those that have settled first
    and then by value, and if it is no entity's real value, of whatever kind. After ``OWN_TRIES`` a real value
    will do, as it is replaced itself: a kind may have few values that no entity has.
    """
    settled = entities.sparkSession.createDataFrame([], DRAWN_DDL)
    waiting = entities.withColumn("tries", F.lit(0))
    real = entities.select(F.col("value").alias("drawn"))
    for tries in range(MOST_TRIES):
        drawn = written(waiting.mapInArrow(_drawer(key), DRAWN_DDL), "drawn")
        both = settled.withColumn("_new", F.lit(1)).unionByName(drawn.withColumn("_new", F.lit(2)))
        first = both.groupBy("kind", "drawn").agg(F.min(F.struct("_new", "value")).alias("_first"))
        free = drawn.join(first, ["kind", "drawn"]).where(
            (F.col("_first._new") == 2) & (F.col("_first.value") == F.col("value"))
        ).drop("_first")
        if tries < OWN_TRIES:
            free = free.join(real, "drawn", "left_anti")
        free = written(free.select(*drawn.columns), "free")
        settled = settled.unionByName(free)
        losers = drawn.join(free, ["kind", "value"], "left_anti")
        waiting = written(losers.select("kind", "value", (F.col("tries") + 1).alias("tries")), "waiting")
        if waiting.isEmpty():
            return settled.where("tries > 0").select("kind", "value", "tries")
    raise ValueError("there are more entities of a kind than surrogates for them")


OUT = pa.schema([("doc_id", pa.int64()), ("n_replaced", pa.int64()), ("text", pa.string())])


def _replacer(key: bytes):
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column("text"), BATCH_BYTES):
                part = batch.slice(start, end - start)
                texts, again = part.column("text").to_pylist(), part.column("_again").to_pylist()
                replaced = [_replaced(key, t, a) for t, a in zip(texts, again, strict=True)]
                counts, texts = zip(*replaced, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(texts, pa.string())],
                    schema=OUT,
                )

    return replace


def _replaced(key: bytes, text: str | None, again: list | None) -> tuple[int, str | None]:
    if text is None:
        return 0, None
    tries = {(a["kind"], a["value"]): a["tries"] for a in again or ()}
    pieces, at, mentions = [], 0, find(text)
    for mention in mentions:
        drawn = replacement_of(key, mention, tries)
        pieces += [text[at : mention.start], written_like(text[mention.start : mention.end], mention.kind, drawn)]
        at = mention.end
    return len(mentions), "".join([*pieces, text[at:]])


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, n_replaced (mentions replaced) and text of each row of ``docs``.

    Texts without mentions come back as they are, null texts as null. Rows are answered one by
    one, whatever their doc_id; equal texts get equal answers. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("_text"), "text")
    mentions = rows.select("_text", "text").where("text is not null")
    mentions = written(mentions.mapInArrow(_mentions, f"_text bigint, {ENTITY}"), "mentions")
    entities = written(mentions.select("kind", "value").distinct(), "entities")
    again = mentions.join(drawn_again(entities, key), ["kind", "value"])
    again = again.distinct().groupBy("_text").agg(F.collect_list(F.struct("kind", "value", "tries")).alias("_again"))
    known = rows.join(written(again, "again"), "_text", "left").select("doc_id", "text", "_again")
    return known.mapInArrow(_replacer(key), "doc_id bigint, n_replaced bigint, text string")
