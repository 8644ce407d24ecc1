"""Long to wide: one row per film from the canonical rows of all sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratefuse.functions.parse import count_present
from ratefuse.functions.text import film_signature, normalize_title
from ratefuse.operators.cluster import unify_by_signature, year_clusters
from ratefuse.operators.keyed import duplicate_keys, flag_duplicates, lookup_by_key, numbered

# Source name -> id column, in the order sources are read.
ID_COLUMNS = {
    "imdb": "ID_IMDB", "metacritic": "ID_METACRITIC", "movielens": "ID_MOVIELENS",
    "rt_audience": "ID_RT",
}
COUNTED_RATINGS = ["rating_imdb", "rating_movielens", "rating_metacritic", "rating_rt_audience"]


@dataclass(frozen=True)
class Dialect:
    """The points in which the two ways of merging and scoring differ."""

    name: str
    renormalize: bool          # group by the title normalised once more
    first_cluster: int
    claim: str                 # who takes a (title, year): first row or first valid row
    empty_genres_count: bool   # an empty list is a value for "first genres"
    drop_ambiguous: bool       # remove all films that share (title, release_year)
    inferred_scale: bool       # rescale by the column maximum, not by source
    round_scores: bool


STATIC = Dialect("static", True, 0, "before", False, False, False, False)
ADAPTIVE = Dialect("adaptive", False, 1, "after", True, True, True, True)


def group_title(dialect: Dialect) -> Column:
    return normalize_title(F.col("title")) if dialect.renormalize else F.col("title")


def with_group_title(
    clean: DataFrame, dialect: Dialect = STATIC, signatures: list[str] | None = None
) -> DataFrame:
    """Add ``norm_title``; with ``signatures`` (shared id columns) also unify titles."""
    long = clean.withColumn("norm_title", group_title(dialect))
    if not signatures:
        return long
    signed = long.withColumn("film_sig", film_signature(signatures))
    return unify_by_signature(signed, "film_sig", ["source", "row_id"])


def _by_title_and_year(long: DataFrame, sources: list[str], dialect: Dialect) -> DataFrame:
    """One row per (norm_title, year); each field keeps the rank it was chosen by.

    Most rows of a popular title collapse here, inside the tasks that read them.
    """
    fields = []
    for s in sources:
        own = F.col("source") == s
        for name, value in ((f"rating_{s}", "rating"), (ID_COLUMNS.get(s, f"ID_{s.upper()}"), "id")):
            known = own & F.col(value).isNotNull()
            fields.append(F.min(F.when(known, F.struct("row_id", value))).alias(name))
    genres = F.struct("source", "row_id", "genres")
    if not dialect.empty_genres_count:
        genres = F.when(F.size("genres") > 0, genres)
    return long.groupBy("norm_title", "year").agg(
        *fields,
        F.min(F.struct("source", "title", "row_id")).alias("title"),
        F.min("release_date").alias("release_date"),
        F.min(genres).alias("genres"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def merge_long(long: DataFrame, sources: list[str], dialect: Dialect = STATIC) -> DataFrame:
    """Unfiltered wide table: first valid rating, id, genres per film; its title and year.

    Two shuffles in all: by (title, year), then the much smaller rest by title, which
    serves both the clustering window and the last aggregation.
    """
    yearly = _by_title_and_year(long, sources, dialect)
    clustered = year_clusters(yearly, "norm_title", "year", dialect.first_cluster)
    ratings = [f"rating_{s}" for s in sources]
    ids = [ID_COLUMNS.get(s, f"ID_{s.upper()}") for s in sources]
    picked = clustered.groupBy("norm_title", "year_cluster").agg(
        *[F.min(c).alias(c) for c in (*ids, *ratings, "title", "genres")],
        F.min("year").alias("release_year"),
        F.min("release_date").alias("release_date"),
        F.sum("n_rows").alias("n_rows"),
    )
    no_genres = F.array().cast("array<string>")
    return picked.select(
        "norm_title", "year_cluster",
        *[F.col(f"{c}.id").alias(c) for c in ids],
        F.col("title.title").alias("title"),
        "release_year",
        F.coalesce("genres.genres", no_genres).alias("genres"),
        "release_date",
        *[F.col(f"{c}.rating").alias(c) for c in ratings],
        "n_rows",
    )


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns that are missing, as nulls of the given type."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def rating_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("rating_")]


def id_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("ID_")]


def keep_rated(wide: DataFrame, dialect: Dialect = STATIC, min_ratings: int = 2) -> DataFrame:
    """Films with enough ratings, with their count, ids first."""
    wide = ensure_columns(wide, {c: "double" for c in COUNTED_RATINGS})
    counted = rating_columns(wide) if dialect.name == "adaptive" else COUNTED_RATINGS
    count = count_present([F.col(c) for c in counted])
    rated = wide.withColumn("count_ratings", count).filter(F.col("count_ratings") >= min_ratings)
    ratings = rating_columns(wide) if dialect.name == "adaptive" else COUNTED_RATINGS
    rated = rated.select(
        *id_columns(wide), "title", "release_year", "genres", "release_date", *ratings,
        "count_ratings",
    )
    if not dialect.drop_ambiguous:
        return rated
    unique = rated.groupBy("title", "release_year").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(F.struct(*rated.columns)).alias("_film")
    )
    return unique.filter(F.col("_copies") == 1).select("_film.*")


def ambiguous_films(films: DataFrame) -> DataFrame:
    """All films that share (title, release_year) with another one."""
    keyed = films.withColumn("_film", F.concat_ws("|", *id_columns(films)))
    return flag_duplicates(keyed, ["title", "release_year"], ["_film"]).drop("_film", "copies")


def merge_sources(clean: DataFrame, sources: list[str], dialect: Dialect = STATIC,
                  min_ratings: int = 2) -> DataFrame:
    """Clean canonical rows of all sources -> one row per film with enough ratings."""
    wide = merge_long(with_group_title(clean, dialect), sources, dialect)
    return keep_rated(wide, dialect, min_ratings)


def rank_order(films: DataFrame) -> list[Column]:
    """Most ratings first, then newest; title and ids settle the rest."""
    return [
        F.col("count_ratings").desc(), F.col("release_year").desc_nulls_last(), F.col("title"),
        *[F.col(c).asc_nulls_last() for c in id_columns(films)],
    ]


def rank_key(films: DataFrame) -> Column:
    """``rank_order`` as one value that only grows from film to film."""
    ids = [f(c) for c in id_columns(films) for f in (F.isnull, F.col)]
    year = F.col("release_year")
    return F.struct(-F.col("count_ratings"), year.isNull(), -year, "title", *ids)


def ranked(films: DataFrame) -> DataFrame:
    return films.orderBy(*rank_order(films))


def with_rank(films: DataFrame) -> DataFrame:
    """Films with their place (from 1) in ``rank_order``."""
    return numbered(films, rank_order(films), "rank")


def long_union(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of source tables with different columns, tagged with the source."""
    out = None
    for source, df in frames.items():
        tagged = df.withColumn("source", F.lit(source))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def canonicalize_columns(df: DataFrame, source: str) -> DataFrame:
    """Own column names of a cleaned file -> release_year, rating_<source>, ID_<SOURCE>."""
    # File stem -> rating column and id column.
    ratings = {
        "imdb_data": "rating_imdb", "movielens_aggregated": "rating_movielens",
        "metacritic_movies": "rating_metacritic", "rotten_tomatoes_movies": "rating_rt_audience",
    }
    ids = {
        "imdb_data": "ID_IMDB", "movielens_aggregated": "ID_MOVIELENS",
        "metacritic_movies": "ID_METACRITIC", "rotten_tomatoes_movies": "ID_RT",
    }
    rating = ratings.get(source, f"rating_{source}")
    target = ids.get(source, f"ID_{source.upper()}")
    renames = {}
    if "release_year" not in df.columns:
        renames["year"] = "release_year"
    if rating not in df.columns:
        renames["rating"] = rating
    if target not in df.columns:
        candidates = [c for c in df.columns if c.upper().startswith("ID_")]
        renames["ID" if "ID" in df.columns else next(iter(candidates), "ID")] = target
    out = df.withColumnsRenamed(renames)
    if target in out.columns:
        out = out.withColumn(target, F.col(target).try_cast("double").try_cast("long"))
    return out


def group_provenance(long: DataFrame, dialect: Dialect = STATIC) -> DataFrame:
    """Every member row of every film group with the title and year the group got."""
    per_year = long.groupBy("norm_title", "year").agg(
        F.min(F.struct("source", "title", "row_id")).alias("_first")
    )
    clustered = year_clusters(per_year, "norm_title", "year", dialect.first_cluster)
    group = Window.partitionBy("norm_title", "year_cluster")
    chosen = clustered.select(
        "norm_title", "year", "year_cluster",
        F.min("_first").over(group)["title"].alias("chosen_title"),
        F.min("year").over(group).alias("chosen_year"),
    )
    members = long.select("norm_title", "year", "source", "row_id", "title")
    return lookup_by_key(members, chosen, ["norm_title", "year"], ["source", "row_id"], "inner")
