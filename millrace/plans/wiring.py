"""One filtered group-by over lineitem that proves the driver contract end to end.

It checks loading, pushdown, aggregation and the oracle comparison. It stands
for no operator of the inventory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import read_table

SHIPPED_BY = "1998-09-02"


def exact(column: str, digits: int) -> Column:
    """The column as decimal(digits, 2); a value that two decimals cannot hold ends the query."""
    value = F.col(column)
    short = value.cast(f"decimal({digits},2)")
    return (
        F.when(value.isNull() | (short.cast("double") == value), short)
        .otherwise(F.raise_error(F.concat(F.lit(f"{column} has more than two decimals: "), value)))
        .cast(f"decimal({digits},2)")
    )


def lineitem_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Money is stored as double with two decimals. Summed as decimal, totals do
    # not depend on the order in which partitions arrive.
    price = exact("l_extendedprice", 12)
    discount = exact("l_discount", 4)
    return (
        read_table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") <= F.lit(SHIPPED_BY).cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum(exact("l_quantity", 12)).cast("double").alias("sum_qty"),
            F.sum(price).cast("double").alias("sum_base_price"),
            F.sum(price * (F.lit(1).cast("decimal(1,0)") - discount))
            .cast("double")
            .alias("sum_disc_price"),
            F.count("*").alias("count_order"),
        )
    )


def _exact_sql(column: str, digits: int) -> str:
    short = f"CAST({column} AS DECIMAL({digits},2))"
    return (
        f"CASE WHEN {column} IS NULL OR CAST({short} AS DOUBLE) = {column} THEN {short} "
        f"ELSE error('{column} has more than two decimals') END"
    )


LINEITEM_SUMMARY_SQL = f"""
SELECT l_returnflag,
       l_linestatus,
       CAST(sum({_exact_sql("l_quantity", 12)}) AS DOUBLE) AS sum_qty,
       CAST(sum({_exact_sql("l_extendedprice", 12)}) AS DOUBLE) AS sum_base_price,
       CAST(sum({_exact_sql("l_extendedprice", 12)}
                * (1 - {_exact_sql("l_discount", 4)})) AS DOUBLE) AS sum_disc_price,
       count(*) AS count_order
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '{SHIPPED_BY} 00:00:00'
GROUP BY l_returnflag, l_linestatus
"""
