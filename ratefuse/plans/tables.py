"""The given tables, and four rating sources that Spark derives from them.

Every order is one rated record of the part its customer number points to; the order
priority says which of the four sources it comes from.  Titles, dates, genres and
ratings are written in the format of that source, with gaps and bad values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Order priority -> source.
PRIORITY = {
    "imdb": ["1-URGENT"], "metacritic": ["2-HIGH"], "movielens": ["3-MEDIUM"],
    "rt_audience": ["4-NOT SPECIFIED", "5-LOW"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with the values that the raw formats of the sources are printed from.

    A filter on ``priority`` behind this reaches the scan of the orders.
    """
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    joined = orders.join(part, F.col("p_partkey") == F.col("o_custkey"))
    n = F.col("o_orderkey")
    year = F.year("o_orderdate") + (F.col("o_custkey") % 7).cast("int") * 3
    year = F.when(n % 97 != 0, F.when(n % 89 == 0, 1800).otherwise(year))
    day = F.least(F.day("o_orderdate"), F.lit(28))
    score = F.floor("o_totalprice") % 101
    return joined.select(
        n.alias("row_id"),
        F.col("o_orderpriority").alias("priority"),
        F.concat_ws(" ", "p_name", "p_brand").alias("base"),
        year.alias("y"),
        F.make_date(year, F.month("o_orderdate"), day).alias("d"),
        F.when(n % 11 != 0, score.cast("int")).alias("r"),
        "p_type", "p_name",
    )


def of_source(rows: DataFrame, source: str) -> DataFrame:
    return rows.filter(F.col("priority").isin(PRIORITY[source]))


def _genres(separator: str) -> Column:
    both = F.concat_ws(separator, "p_type", "p_name")
    return F.when(F.col("row_id") % 13 == 0, F.lit("")).otherwise(both)


def _printed_date(pattern: str) -> Column:
    n = F.col("row_id")
    return (
        F.when(n % 17 == 0, F.date_format("d", "yyyy"))
        .when(n % 19 == 0, F.date_format("d", "MMMM yyyy"))
        .otherwise(F.date_format("d", pattern))
    )


def imdb(rows: DataFrame) -> DataFrame:
    return of_source(rows, "imdb").select(
        "row_id",
        F.col("base").alias("originalTitle"), F.col("base").alias("primaryTitle"),
        _genres(",").alias("genres"),
        (F.col("r") / 10).cast("string").alias("averageRating"),
        _printed_date("MMMM d, yyyy").alias("release_date"),
    )


def metacritic(rows: DataFrame) -> DataFrame:
    by_users = F.col("row_id") % 5 == 0
    return of_source(rows, "metacritic").select(
        "row_id",
        F.concat(F.upper("base"), F.lit("!")).alias("movie_title"),
        _genres(",").alias("genre"),
        F.when(~by_users, F.col("r").cast("string")).alias("metascore"),
        F.coalesce((F.col("r") / 10).cast("string"), F.lit("tbd")).alias("userscore"),
        _printed_date("d-MMM-yy").alias("release_date"),
    )


def movielens(rows: DataFrame) -> DataFrame:
    suffix = F.concat(F.lit(" ("), F.col("y").cast("string"), F.lit(")"))
    return of_source(rows, "movielens").select(
        "row_id",
        F.concat("base", F.lit(", The"), F.coalesce(suffix, F.lit(""))).alias("title"),
        _genres("|").alias("genres"),
        (F.col("r") / 20).cast("string").alias("average_rating"),
    )


def rotten_tomatoes(rows: DataFrame) -> DataFrame:
    n, day = F.col("row_id"), F.date_format("d", "yyyy-MM-dd")
    return of_source(rows, "rt_audience").select(
        "row_id",
        F.regexp_replace("base", "e", "é").alias("movie_title"),
        _genres(",").alias("genres"),
        F.when(n % 17 != 0, day).alias("original_release_date"),
        F.when(n % 17 == 0, day).alias("streaming_release_date"),
        F.when(n % 3 != 0, F.col("r").cast("string")).alias("tomatometer_rating"),
        F.col("r").cast("string").alias("audience_rating"),
    )


def undescribed(rows: DataFrame) -> DataFrame:
    """A source that no definition exists for: all records under names of their own."""
    n = F.col("row_id")
    return rows.select(
        "row_id",
        F.concat(n.cast("string"), F.lit(".0")).alias("ID_X"),
        F.concat("base", F.lit(" (Remake)")).alias("film_title"),
        F.when(n % 4 != 0, F.col("y").cast("string")).alias("release_year"),
        F.date_format("d", "yyyy-MM-dd").alias("first_release_date"),
        _genres("|").alias("genres_x"),
        F.when(n % 5 != 0, F.col("r").cast("string")).otherwise("tbd").alias("critic_score"),
        F.coalesce((F.col("r") / 10).cast("string"), F.lit("tbd")).alias("user_score"),
        F.lit("12").alias("score_count"),
    )


WRITERS = {
    "imdb": imdb, "metacritic": metacritic, "movielens": movielens, "rt_audience": rotten_tomatoes,
}


def raw_source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return WRITERS[source](records(spark, sf_dir))


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = records(spark, sf_dir)
    return {name: write(rows) for name, write in WRITERS.items()}
