"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Each source gets a target number of words. A source is taken as often as the target holds it
whole, and once more in part: the documents below a threshold of their hash. The threshold is
found by histograms of words over hash buckets: the bucket in which the running sum passes
what is wanted is refined by the next bits of the hash, and only its documents are read
again, until the bucket is a single hash. Nothing is sorted but a source's few thousand
buckets, and the hash of the id decides, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import WORD, unused, written

# Weights of the sources in code point order, over and over.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
HASH_BITS, LEVEL_BITS = 60, 12


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_of(doc_id: Column) -> Column:
    """60 bits of the id's MD5; a null id counts as an empty one."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source from (source, size): the weights share all words; no target goes
    above three times its source, whose excess the others share by weight.

    In order of size per weight a source is above its limit if it is so once all before it are
    held to theirs. There is one row per source here.
    """
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place % len(WEIGHTS) + 1)
    one = one.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * MOST_COPIES)
    ratio = F.col("_limit") / F.col("_weight")
    order = Window.orderBy(ratio, F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def rest(amount: Column) -> Column:
        held = F.coalesce(F.sum(amount).over(before), F.lit(0))
        return F.sum(amount).over(everything) - held

    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    one = one.withColumn("_share", left / rest(F.col("_weight")))
    one = one.withColumn("_free", ratio >= F.col("_share"))
    share = F.first(F.when(F.col("_free"), F.col("_share")), ignorenulls=True).over(everything)
    wanted = share * F.col("_weight")
    one = one.withColumn("target", F.least(wanted, F.col("_limit").cast("double")))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    one = one.withColumn("_copies", F.coalesce(copies, F.lit(0)).cast("int"))
    part = F.col("target") - F.col("_copies") * F.col("source_size")
    return one.select("source", "source_size", "target", "_copies", part.alias("_part"))


def thresholds(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with the hash below which a source's documents are taken once more.

    The threshold takes the documents of lowest hash whose words fit into ``_part``, and those
    of the next hash if that comes nearer.
    """
    found = wanted.select("source", "_part", F.lit(0).alias("_below"), F.lit(0).alias("_prefix"))
    rows, shift = sizes.where("size > 0"), HASH_BITS
    while shift:
        bucket = F.shiftright("_hash", shift)
        inside = rows.select(F.col("source").alias("_source"), "size", "_hash").withColumn(
            "_bucket", bucket
        )
        matches = F.col("_source").eqNullSafe(F.col("source"))
        if shift < HASH_BITS:
            matches &= F.col("_bucket") == F.col("_prefix")
            inside = written(inside.join(found.select("source", "_prefix"), matches, "left_semi"), "bucket")
            rows = inside.select(F.col("_source").alias("source"), "size", "_hash")
        shift -= LEVEL_BITS
        sums = inside.groupBy("_source", F.shiftright("_hash", shift).alias("_next")).agg(
            F.sum("size").alias("_words")
        )
        running = Window.partitionBy("_source").orderBy("_next")
        sums = sums.withColumn("_sum", F.sum("_words").over(running))
        both = found.drop("_words").join(sums, F.col("_source").eqNullSafe(F.col("source")))
        below = F.col("_below") + F.col("_sum") - F.col("_words")
        passing = (below <= F.col("_part")) & (F.col("_part") < below + F.col("_words"))
        found = written(
            both.where(passing).select(
                "source", "_part", below.alias("_below"), F.col("_next").alias("_prefix"), "_words"
            ),
            "boundary",
        )
    over = F.col("_below") + F.col("_words") - F.col("_part")
    nearer = over < F.col("_part") - F.col("_below")
    cut = F.col("_prefix") + F.when(nearer, 1).otherwise(0)
    cuts = found.select(F.col("source").alias("_source"), cut.alias("_threshold"))
    joined = wanted.join(cuts, F.col("_source").eqNullSafe(F.col("source")), "left")
    return joined.select(*wanted.columns, F.coalesce("_threshold", F.lit(0)).alias("_threshold"))


def _planned(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").alias("source"),
        words("text").alias("size"),
        hash_of(F.col("doc_id")).alias("_hash"),
    )
    sizes = written(rows, "sizes")
    wanted = written(targets(sizes), "targets")
    return sizes, written(thresholds(sizes, wanted), "thresholds")


def _times(hashed: Column, plan: DataFrame) -> Column:
    more = F.when(hashed < plan["_threshold"], 1).otherwise(0)
    return F.least(plan["_copies"] + more, F.lit(MOST_COPIES))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row of ``docs``.

    A null source is a source of its own, the last one. Null and empty texts have size 0 and
    take nothing. Rows that share an id share its hash; each counts with its own size. No
    source's words miss the target by more than the documents of one hash; a table without
    words has targets 0, an empty table no rows. Other columns are ignored.
    """
    sizes, plan = _planned(docs)
    plan = plan.withColumnRenamed("source", "_source")
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    times = _times(sizes["_hash"], plan)
    return joined.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows that the mix takes, all columns of ``docs``, each as often as it is taken; see
    ``mix``. Rows without words go with their hash like any other."""
    _, plan = _planned(docs)
    joined = docs.join(plan, docs["source"].eqNullSafe(plan["source"]))
    copy = unused(docs, "_copy")
    copies = F.array_repeat(F.lit(0), _times(hash_of(docs["doc_id"]), plan))
    often = joined.select(*[docs[c] for c in docs.columns], F.explode(copies).alias(copy))
    return often.drop(copy)


ORACLE = r"""
WITH sizes AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents
), one AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sizes GROUP BY source
), shares AS (
    SELECT *, 3 * source_size / weight AS ratio,
        ((sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::DOUBLE) AS share
    FROM one
    WINDOW earlier AS (ORDER BY 3 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), wanted AS (
    SELECT source, source_size, least(
            (SELECT min_by(share, (ratio, source)) FROM shares WHERE ratio >= share) * weight,
            (3 * source_size)::DOUBLE) AS target
    FROM shares
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies
    FROM wanted
), running AS (
    SELECT s.doc_id, s.size, p.source_size, p.target, p.copies,
        p.target - p.copies * p.source_size AS part,
        sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto,
        sum(s.size) OVER (PARTITION BY s.source, s.h) AS here
    FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
    (size * least(3, copies + CASE
        WHEN upto <= part THEN 1
        WHEN upto - here <= part AND upto - part < part - (upto - here) THEN 1
        ELSE 0 END))::BIGINT AS taken
FROM running
"""
