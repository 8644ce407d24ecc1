"""Statistics of the merged result and of what became of the sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratefuse.functions.parse import half_even
from ratefuse.functions.text import normalize_title
from ratefuse.operators.quantiles import quantile_table


def _unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def rating_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, standard deviation, min, max, median (two places) and count per column.

    A column without values has nulls and the count 0.
    """
    stats = _unpivot(df, columns).groupBy("name").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("count"),
    )
    medians = quantile_table(df, columns, [0.5]).select("name", F.col("value").alias("median"))
    joined = stats.join(F.broadcast(medians), "name")
    rounded = [half_even(F.col(c), 2).alias(c) for c in ("mean", "std", "min", "max", "median")]
    return joined.select("name", *rounded, "count")


def rating_corr(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every two columns over the rows that have both."""
    pairs = [(a, b) for a in columns for b in columns]
    once = {(a, b): f"c_{i}" for i, (a, b) in enumerate(p for p in pairs if p[0] <= p[1])}
    one = df.agg(*[F.corr(a, b).alias(name) for (a, b), name in once.items()])
    rows = [
        F.struct(
            F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
            F.col(once[min(a, b), max(a, b)]).alias("corr"),
        )
        for a, b in pairs
    ]
    return one.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Rows per equal-width bin (from 1) between each column's minimum and maximum."""
    pairs = []
    for c in columns:
        pairs.append(
            F.struct(F.lit(c).alias("name"), bin_of(c, bins).alias("bin"))
        )
    binned = with_span(df, columns).select(F.inline(F.array(*pairs))).filter(F.col("bin").isNotNull())
    return binned.groupBy("name", "bin").agg(F.count(F.lit(1)).alias("rows"))


def with_span(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``_span``, the minimum and maximum of each column: one struct for all rows."""
    span = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"{c}_lo") for c in columns],
            *[F.max(F.col(c).cast("double")).alias(f"{c}_hi") for c in columns],
        )
    ).scalar()
    return df.withColumn("_span", span)


def bin_of(column: str, bins: int):
    """Bin of a value; the maximum belongs to the last bin, a constant column to the first."""
    low, high = F.col(f"_span.{column}_lo"), F.col(f"_span.{column}_hi")
    v = F.col(column).cast("double")
    inside = F.least(F.width_bucket(v, low, high, F.lit(bins)), F.lit(bins))
    return F.when(v.isNotNull(), F.when(low == high, F.lit(1)).otherwise(inside)).cast("int")


def pair_density(df: DataFrame, columns: list[str], bins: int = 20) -> DataFrame:
    """Rows per two-dimensional bin for every pair of columns."""
    placed = with_span(df, columns).select(*[bin_of(c, bins).alias(c) for c in columns])
    pairs = [
        F.struct(
            F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
            F.col(a).alias("bin_a"), F.col(b).alias("bin_b"),
        )
        for i, a in enumerate(columns) for b in columns[i + 1:]
    ]
    both = placed.select(F.inline(F.array(*pairs))).filter(
        F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull()
    )
    return both.groupBy("col_a", "col_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("rows"))


def score_line(df: DataFrame, a: str, b: str) -> DataFrame:
    """Ends of the identity line for a plot of two scores."""
    return df.agg(
        F.least(F.min(a), F.min(b)).alias("low"), F.greatest(F.max(a), F.max(b)).alias("high")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in order of the value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("films")).orderBy(column)


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of every column."""
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n_{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"n_{i}").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return one.select(F.inline(F.array(*rows)))


def with_genres(df: DataFrame) -> DataFrame:
    """How many rows have at least one genre, of how many."""
    return df.agg(
        F.count_if(F.size("genres") > 0).alias("with_genres"), F.count(F.lit(1)).alias("rows")
    )


def _merged_keys(merged: DataFrame) -> DataFrame:
    return merged.select(
        normalize_title(F.col("title")).alias("title"), F.col("release_year").alias("year")
    )


def _source_keys(clean: DataFrame, merged: DataFrame) -> DataFrame:
    """Distinct (source, title, year) with a flag: is (title, year) in the merge?

    Sources and merge are folded together by key, so no key is multiplied by a join.
    """
    own = clean.select("title", "year", "source", F.lit(False).alias("merged"))
    none = F.lit(None).cast("string")
    other = _merged_keys(merged).select(
        "title", "year", none.alias("source"), F.lit(True).alias("merged")
    )
    keys = own.unionByName(other).groupBy("title", "year").agg(
        F.collect_set("source").alias("sources"), F.max("merged").alias("merged")
    )
    return keys.select("title", "year", "merged", F.explode("sources").alias("source"))


def source_coverage(clean: DataFrame, merged: DataFrame) -> DataFrame:
    """Per source: rows, distinct keys, keys found in the merge, and their percentage."""
    rows = clean.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    keys = _source_keys(clean, merged).groupBy("source").agg(
        F.count(F.lit(1)).alias("keys"), F.count_if("merged").alias("found")
    )
    percent = half_even(F.col("found") / F.col("keys") * 100, 2)
    return rows.join(F.broadcast(keys), "source").withColumn("percent", percent)


def lost_keys(clean: DataFrame, merged: DataFrame) -> DataFrame:
    """Keys of each source that are not in the merge."""
    keys = _source_keys(clean, merged)
    return keys.filter(~F.col("merged")).select("source", "title", "year")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The same ``n`` rows however the data is partitioned: smallest hash of key and seed."""
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(rank, key).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
