"""Work per key that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratefuse.operators.stored import stored

# A key of fewer rows is never split.
HOT_ROWS = 100_000


def first_per_key(
    df: DataFrame, keys: list[str], order: Column, columns: list[str] | None = None
) -> DataFrame:
    """The first row of each key; null is a key value like any other.

    An aggregate, not a window: every task keeps one row per key before the shuffle.
    """
    kept = columns or [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*kept), order).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def first_ids(
    df: DataFrame, keys: list[str], row_id: str, eligible: Column | None = None
) -> DataFrame:
    """Row id of the first row of each key, among the eligible rows.

    Rows are ruled out inside the aggregate: a filter before it would make Spark compute
    the columns it reads twice.
    """
    ids = F.col(row_id) if eligible is None else F.when(eligible, F.col(row_id))
    first = df.groupBy(*keys).agg(F.min(ids).alias(row_id))
    return first.filter(F.col(row_id).isNotNull())


def heavy_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys to be split (as ``_hot_…``) and the number of their parts."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    even = sizes.agg(F.ceil(F.sum("_rows") / tasks).alias("_even")).scalar()
    share = F.greatest(F.lit(hot_rows), even)
    return sizes.select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.ceil(F.col("_rows") / share).cast("int").alias("_parts"),
    ).filter("_parts > 1")


def lookup_by_key(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    row_id: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows to a table with one row per key (null keys match null keys).

    A key of more rows than an even share of a shuffle partition (and than ``hot_rows``) is
    spread by row id over as many parts as it has such shares, and its lookup row is copied to
    each part; all other keys join as usual. So there are fewer keys to broadcast than
    shuffle partitions, and no part grows beyond the share of a partition.
    """
    hot = heavy_keys(rows, keys, hot_rows)

    def marked(df: DataFrame) -> DataFrame:
        same = F.lit(True)
        for k in keys:
            same = same & df[k].eqNullSafe(hot[f"_hot_{k}"])
        joined = df.join(F.broadcast(hot), same, "left")
        return joined.drop(*[f"_hot_{k}" for k in keys])

    parts = F.coalesce("_parts", F.lit(1))
    part = F.pmod(F.xxhash64(*row_id), parts).cast("int")
    spread = marked(rows).withColumn("_part", part).drop("_parts")
    every = F.sequence(F.lit(0), parts - 1)
    copies = marked(lookup).withColumn("_part", F.explode(every)).drop("_parts")
    renamed = copies.withColumnsRenamed({k: f"_key_{k}" for k in [*keys, "_part"]})
    same = spread["_part"] == renamed["_key__part"]
    for k in keys:
        same = same & spread[k].eqNullSafe(renamed[f"_key_{k}"])
    joined = spread.join(renamed, same, how)
    return joined.drop("_part", *[f"_key_{k}" for k in [*keys, "_part"]])


def prefix_sums(sizes: DataFrame, size: str, order: list[str], name: str) -> DataFrame:
    """Running sum of the sizes before each row, for a table with one row per block."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))


def numbered(df: DataFrame, order: list[Column | str], name: str = "row_id") -> DataFrame:
    """Rows numbered from 1 in the given order, whatever the values of its columns are.

    Spark sorts into ranges, whose bounds it samples, and a row's number is its place in its
    range behind the rows of the ranges before.  The sorted rows are stored first, so that
    places stay as they are; only one row per range goes through the running sum.
    """
    placed = df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed, "ordered").withColumn("_range", F.shiftright("_at", 33))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    offsets = prefix_sums(sizes, "_size", ["_range"], "_offset").drop("_size")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_offset") + 1
    # One row for each range: there are no more of them than shuffle partitions.
    joined = placed.join(F.broadcast(offsets), "_range").withColumn(name, place)
    return joined.drop("_at", "_range", "_offset")


def dense_row_id(df: DataFrame, key: str, name: str = "row_id") -> DataFrame:
    """Rows numbered from 1 along a unique key, which may be as sparse as a hash."""
    return numbered(df, [key], name)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one row, with their row count."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    )


def flag_duplicates(df: DataFrame, keys: list[str], row_id: list[str]) -> DataFrame:
    """Every row of a key that occurs more than once."""
    return lookup_by_key(df, duplicate_keys(df, keys), keys, row_id, how="inner")
