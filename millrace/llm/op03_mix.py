"""Mixing sources to target weights by hash-threshold histograms.

Sizes are counted once and stored. Tokens are then summed by source and hash bucket; the
bucket in which a source's budget ends is the only one that is refined, by the next bits of
the hash, until it holds one hash value. Documents are filtered by comparing their hash with
their source's threshold, so nothing is sorted but the histogram itself (at most 4096 rows a
source and level). The same rows give the same mix on every run.

The budget of a source is nested in that of any higher budget: a larger target keeps what a
smaller one took. Above the source's own size every document is taken once and the threshold
decides which are taken a second time.

Cases: a null text has size 0 and takes 0 words; a null source is a source of its own, after
all others; null ids and repeated rows work: rows equal in doc_id and text share one hash, and
where a budget ends among such rows, as many of them are taken as come nearest to it, no matter
which; a source whose texts are all empty gets target 0; an empty table gives no rows. Only
doc_id, text and source are read for the decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import WORD, durable, pick

# Fixed values of the contract: weights by source in code point order, repeating; the sum of
# targets in halves of the whole size; the most repeats of a source.
WEIGHTS = (5, 2, 1)
SHARE_HALVES = 3
MOST_REPEATS = 2

HASH_HEX = 15
LEVEL_HEX = 3


def mix_hash() -> Column:
    """60 bits of md5 over doc_id and text, as a bigint below 2**60."""
    key = F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.lit("\x01"),
        F.coalesce(F.col("text"), F.lit("")),
    )
    return F.conv(F.substring(F.md5(key), 1, HASH_HEX), 16, 10).cast("bigint")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, h and size: the one pass over the texts."""
    return pick(docs, "doc_id", "text", "source").select(
        "doc_id",
        "source",
        mix_hash().alias("h"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("size"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target: shares by weight, stopped at twice the source's size.

    One row a source goes through the two windows without partition, whatever the input.
    Sorted by size per weight, the stopped sources come first; sums are whole numbers, so
    that the only rounding is in the last division.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), ((rank - 1) % len(WEIGHTS) + 1).cast("int")
    ).cast("bigint")
    weighed = by_source.withColumn("weight", weight)
    everything = Window.partitionBy()
    order = Window.orderBy(
        (F.col("source_size") / F.col("weight")).asc(), F.asc_nulls_last("source")
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    most = MOST_REPEATS * F.col("source_size")
    left2 = F.col("total") * SHARE_HALVES - 2 * F.coalesce(F.sum(most).over(before), F.lit(0))
    weight_left = F.col("all_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stopped = (
        weighed.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("stopped", 2 * most * weight_left <= F.col("weight") * left2)
    )
    rest2 = F.col("total") * SHARE_HALVES - 2 * F.coalesce(
        F.sum(F.when(F.col("stopped"), most)).over(everything), F.lit(0)
    )
    rest_weight = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(everything)
    return stopped.select(
        "source",
        "source_size",
        F.when(F.col("stopped"), most.cast("double"))
        .otherwise((F.col("weight") * rest2).cast("double") / (2 * rest_weight).cast("double"))
        .alias("target"),
    )


def thresholds(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """source, source_size, target, floor_copies, threshold and split, as a written table.

    Rows with h below threshold are taken once more than floor_copies, and so are split of the
    rows whose h is threshold. The running budget is what is still to be filled after all buckets
    below the boundary bucket.
    """
    floor = F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    state = goals.select(
        "source",
        "source_size",
        "target",
        floor.alias("floor_copies"),
        (F.col("target") - floor * F.col("source_size")).alias("budget"),
        F.lit(0).cast("bigint").alias("prefix"),
        F.lit(False).alias("closed"),
        F.lit(0).cast("bigint").alias("threshold"),
        F.lit(0).cast("bigint").alias("split"),
    )
    state = durable(state)
    for level in range(1, HASH_HEX // LEVEL_HEX + 1):
        bits = 4 * (HASH_HEX - LEVEL_HEX * level)
        open_ = state.where(~F.col("closed")).select(
            F.col("source").alias("s"), F.col("prefix").alias("p")
        )
        inside = sizes if level == 1 else sizes.join(
            open_,
            F.col("source").eqNullSafe(F.col("s"))
            & (F.shiftright("h", bits + 4 * LEVEL_HEX) == F.col("p")),
            "left_semi",
        )
        histogram = inside.groupBy("source", F.shiftright("h", bits).alias("bucket")).agg(
            F.sum("size").alias("tokens"), F.count("*").alias("alike")
        )
        up_to = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket"))
        running = histogram.select(
            F.col("source").alias("s"), "bucket", "tokens", "alike", up_to.alias("up_to")
        )
        # The boundary is the first bucket whose running sum passes the budget.
        joined = state.where(~F.col("closed")).join(
            running,
            F.col("source").eqNullSafe(F.col("s")) & (F.col("up_to") > F.col("budget")),
            "left",
        )
        boundary = joined.groupBy(
            "source", "source_size", "target", "floor_copies", "budget", "prefix"
        ).agg(F.min(F.struct("bucket", "up_to", "tokens", "alike")).alias("b"))
        passed = F.col("b.bucket").isNotNull()
        left = F.col("budget") - (F.col("b.up_to") - F.col("b.tokens"))
        last = bits == 0
        # At the last level one hash value is left, of rows that are alike: take as many as come
        # nearest. The bucket passes the budget, so its tokens are not 0.
        each = F.col("b.tokens") / F.col("b.alike")
        fitting = F.ceil(left / each - F.lit(0.5)) if last else F.lit(0)
        whole = fitting >= F.col("b.alike")
        edge = F.when(whole, F.col("b.bucket") + 1).otherwise(F.col("b.bucket")) if last else F.lit(0)
        split = F.when(passed & ~whole, fitting).otherwise(0)
        refined = boundary.select(
            "source",
            "source_size",
            "target",
            "floor_copies",
            F.when(passed, left).otherwise(F.col("budget")).alias("budget"),
            F.when(passed, F.col("b.bucket")).otherwise(F.col("prefix")).alias("prefix"),
            (~passed | F.lit(last)).alias("closed"),
            # A source whose budget is never passed is taken whole.
            F.when(passed, edge).otherwise(F.lit(1 << 60)).cast("bigint").alias("threshold"),
            split.cast("bigint").alias("split"),
        )
        state = durable(state.where("closed").unionByName(refined))
    return state.select("source", "source_size", "target", "floor_copies", "threshold", "split")


def decide(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """docs (with source and h) and, from their source's row in limits, the copies to take."""
    own = limits.withColumnRenamed("source", "_source")
    decided = docs.join(own, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "copies",
        F.col("floor_copies") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0),
    )
    if limits.where("split > 0").isEmpty():
        return decided
    return _with_split(decided)


def _with_split(decided: DataFrame) -> DataFrame:
    """decided, where split of the rows at a source's threshold get one copy more.

    Rows at thresholds are numbered within what one task wrote and moved by the counts of the
    tasks before, so that no task needs all of them, however many rows are alike.
    """
    names = decided.columns
    at_edge = (F.col("split") > 0) & (F.col("h") == F.col("threshold"))
    edge = durable(decided.where(at_edge).withColumn("_at", F.monotonically_increasing_id()))
    edge = edge.withColumn("_part", F.shiftright("_at", 33))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        edge.groupBy(F.col("source").alias("_of"), F.col("_part").alias("_in"))
        .agg(F.count("*").alias("_n"))
        .select("_of", "_in", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    number = F.row_number().over(Window.partitionBy("source", "_part").orderBy("_at"))
    numbered = edge.withColumn("_number", number).join(
        shifts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    )
    more = F.when(F.col("_number") + F.col("_shift") <= F.col("split"), 1).otherwise(0)
    return decided.where(~at_edge).unionByName(
        numbered.withColumn("copies", F.col("floor_copies") + more).select(*names)
    )


def mix_sources(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, size, source_size, target, taken (and source, copies)."""
    sizes = durable(sized(docs))
    goals = durable(targets(sizes))
    return decide(sizes, thresholds(sizes, goals)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"),
        "source",
        F.col("copies").cast("int").alias("copies"),
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, each as often as the mix takes it."""
    sizes = durable(sized(docs))
    limits = durable(thresholds(sizes, durable(targets(sizes))))
    names = docs.columns
    numbered = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    at = {c: f"_c{i}" for i, c in reversed(list(enumerate(names)))}
    keyed = numbered.select(
        "*", *[F.col(at[c]).alias(c) for c in ("doc_id", "text", "source")]
    ).withColumn("h", mix_hash())
    return (
        decide(keyed.drop("doc_id", "text"), limits)
        .where("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)])
    )


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(1) || coalesce(text, '')), 1, 15)
              AS BIGINT) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source
), p AS (
  SELECT *, sum(source_size) OVER () AS total,
         sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_left,
         coalesce(sum(2 * source_size) OVER b, 0) AS stopped_before
  FROM s
  WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (
  SELECT *, 4 * source_size * weight_left <= weight * (3 * total - 2 * stopped_before) AS stopped
  FROM p
), g AS (
  SELECT source, source_size,
         CASE WHEN stopped THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST(weight * (3 * total - 2 * coalesce(sum(CASE WHEN stopped THEN 2 * source_size END) OVER (), 0)) AS DOUBLE)
                   / CAST(2 * sum(CASE WHEN NOT stopped THEN weight END) OVER () AS DOUBLE) END AS target
  FROM q
), r AS (
  SELECT d.doc_id, d.size, d.source, g.source_size, g.target,
         CASE WHEN g.target >= g.source_size THEN 1 ELSE 0 END AS once,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS BIGINT) AS up_to,
         CAST(sum(d.size) OVER (PARTITION BY d.source, d.h) AS BIGINT) AS alike,
         count(*) OVER (PARTITION BY d.source, d.h) AS n_alike,
         row_number() OVER (PARTITION BY d.source, d.h) AS number
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), t AS (
  SELECT *, target - once * source_size AS budget FROM r
), k AS (
  SELECT *, once + CASE WHEN up_to <= budget OR number <= ceil((budget - (up_to - alike)) / (alike / n_alike) - 0.5)
                        THEN 1 ELSE 0 END AS copies
  FROM t
)
SELECT doc_id, size, source_size, target, source, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INTEGER) AS copies
FROM k
"""
