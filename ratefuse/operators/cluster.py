"""Chained year clusters per title, and titles made equal under one signature."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratefuse.operators.keyed import lookup_by_key


def year_clusters(years: DataFrame, key: str, year: str = "year", base: int = 0) -> DataFrame:
    """Number the runs of years with no gap above one, per key, from ``base``.

    Takes one row per (key, year): the rows of a popular title are aggregated to its
    distinct years before, so a window partition holds a title's years, not its rows.
    A null year is a cluster of its own behind the others.
    """
    in_order = Window.partitionBy(key).orderBy(F.col(year).asc_nulls_last())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag(year).over(in_order)
    gap = F.col(year).isNull() | (F.col(year) - before > 1)
    step = F.when(before.isNotNull() & gap, 1).otherwise(0)
    numbered = years.withColumn("_step", step)
    cluster = (F.sum("_step").over(so_far) + base).cast("int")
    return numbered.withColumn("year_cluster", cluster).drop("_step")


def distinct_years(rows: DataFrame, key: str, year: str = "year") -> DataFrame:
    return rows.groupBy(key, year).agg(F.count(F.lit(1)).alias("n_rows"))


def unify_by_signature(long: DataFrame, signature: str, row_id: list[str]) -> DataFrame:
    """Give all rows of a shared signature its most frequent title (longest, then last in
    text order, on a tie) and its smallest year.  Rows without a shared signature stay.
    """
    per_title = long.groupBy(signature, "norm_title").agg(
        F.count(F.lit(1)).alias("_n"), F.min("year").alias("_year")
    )
    chosen = per_title.groupBy(signature).agg(
        F.sum("_n").alias("_size"),
        F.max(F.struct("_n", F.length("norm_title"), "norm_title")).alias("_best"),
        F.min("_year").alias("_min_year"),
    )
    shared = chosen.filter((F.col("_size") > 1) & (F.col(signature) != "")).select(
        signature, F.col("_best.norm_title").alias("_title"), "_min_year",
        F.lit(True).alias("_shared"),
    )
    joined = lookup_by_key(long, shared, [signature], row_id)
    return joined.withColumns(
        {
            "norm_title": F.coalesce("_title", "norm_title"),
            "year": F.when(F.col("_shared"), F.col("_min_year")).otherwise(F.col("year")),
        }
    ).drop("_title", "_min_year", "_shared")
