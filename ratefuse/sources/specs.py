"""What a source looks like: its columns, and how each canonical field is read.

A source is data plus a few column expressions, so that cleaning is one projection
that Spark plans like any other.  Register further sources with ``register``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ratefuse.functions import parse, text

# Column names of the four sources.
IMDB_COLUMNS = [
    "id", "primaryTitle", "originalTitle", "isAdult", "runtimeMinutes", "genres",
    "averageRating", "numVotes", "budget", "gross", "release_date", "directors",
]
METACRITIC_COLUMNS = [
    "movie_title", "release_date", "genre", "meta_mixed", "meta_negative",
    "meta_positive", "metascore", "user_mixed", "user_negative", "user_positive",
    "userscore",
]
MOVIELENS_COLUMNS = ["movieId", "title", "genres", "average_rating", "rating_count"]
ROTTEN_TOMATOES_COLUMNS = [
    "rotten_tomatoes_link", "movie_title", "movie_info", "critics_consensus",
    "content_rating", "genres", "directors", "authors", "actors",
    "original_release_date", "streaming_release_date", "runtime",
    "production_company", "tomatometer_status", "tomatometer_rating",
    "tomatometer_count", "audience_status", "audience_rating", "audience_count",
    "tomatometer_top_critics_count", "tomatometer_fresh_critics_count",
    "tomatometer_rotten_critics_count",
]
RESCALE_FACTORS = {"imdb": 1.0, "movielens": 2.0, "metacritic": 0.1, "rt_audience": 0.1}


@dataclass(frozen=True)
class SourceSpec:
    """One source.  Each field is an expression over the raw columns.

    ``fields`` maps a raw DataFrame to the columns title_raw, release_date, year, genres and
    rating, and id where the source has one of its own; else rows are numbered.
    ``title_options`` go to ``normalize_title``.
    """

    name: str
    id_column: str
    columns: tuple[str, ...]
    fields: Callable[[DataFrame], dict[str, Column]]
    rating_required: bool = True
    year_first: bool = False
    title_options: tuple[tuple[str, object], ...] = ()
    multi_line: bool = False
    strict: bool = False

    @property
    def rating_column(self) -> str:
        return f"rating_{self.name}"


def column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _imdb(df: DataFrame) -> dict[str, Column]:
    released = parse.date_cascade(F.col("release_date"), parse.MONTH_DAY_YEAR)
    return {
        "title_raw": F.col("originalTitle"),
        "release_date": released,
        "year": F.year(released),
        "genres": parse.split_genres(F.col("genres"), "pipe_or_comma"),
        "rating": parse.number(column_or_null(df, "averageRating")),
    }


def _metacritic(df: DataFrame) -> dict[str, Column]:
    parsed = parse.date_cascade(F.col("release_date"), parse.DAY_MONTH_SHORT_YEAR)
    released = parse.roll_century(parsed)
    return {
        "title_raw": F.col("movie_title"),
        "release_date": released,
        "year": F.year(released),
        "genres": parse.split_genres(F.col("genre"), "comma"),
        "rating": parse.first_score(F.col("metascore"), F.col("userscore")),
    }


def _movielens(df: DataFrame) -> dict[str, Column]:
    fallback = parse.whole_number(column_or_null(df, "release_year"))
    year = F.coalesce(parse.year_in_text(F.col("title"), "first_parens"), fallback)
    return {
        "title_raw": F.col("title"),
        "release_date": F.lit(None).cast("date"),
        "year": parse.pivot_year(year),
        "genres": parse.split_genres(F.col("genres"), "pipe"),
        "rating": parse.number(column_or_null(df, "average_rating")),
    }


def _rotten_tomatoes(df: DataFrame) -> dict[str, Column]:
    released = parse.date_fallback(F.col("original_release_date"), F.col("streaming_release_date"))
    return {
        "title_raw": F.col("movie_title"),
        "release_date": released,
        "year": F.year(released),
        "genres": parse.split_genres(F.col("genres"), "comma"),
        "rating": F.coalesce(
            parse.number(F.col("tomatometer_rating")), parse.number(F.col("audience_rating"))
        ),
    }


def _imdb_adaptive(df: DataFrame) -> dict[str, Column]:
    year = parse.year_in_text(F.trim(F.col("release_date")), "end")
    return _imdb(df) | {
        "title_raw": text.first_non_blank(F.col("originalTitle"), F.col("primaryTitle")),
        "year": year,
        "genres": parse.split_genres(F.col("genres"), "comma"),
    }


def _metacritic_adaptive(df: DataFrame) -> dict[str, Column]:
    released = F.try_to_date(F.trim(F.col("release_date")), parse.DAY_MONTH_SHORT_YEAR)
    released = parse.roll_century(released, 2068)
    return _metacritic(df) | {
        "release_date": released,
        "year": F.year(released),
        "rating": parse.first_score_0_10(F.col("metascore"), F.col("userscore")),
    }


def _movielens_adaptive(df: DataFrame) -> dict[str, Column]:
    explicit = parse.whole_number(column_or_null(df, "release_year"))
    found = parse.year_in_text(F.col("title"), "trailing_parens")
    return _movielens(df) | {
        "year": F.coalesce(explicit, parse.pivot_year(found, -1)),
        "genres": parse.split_genres(F.col("genres"), "pipe", (parse.NO_GENRES,)),
    }


def _rotten_tomatoes_adaptive(df: DataFrame) -> dict[str, Column]:
    def year_of(name: str) -> Column:
        digits = F.regexp_extract(F.col(name), parse.YEAR_PATTERNS["first_digits"], 1)
        value = digits.try_cast("int")
        return F.when(F.length(digits).isin(2, 4), parse.pivot_year(value))

    return _rotten_tomatoes(df) | {
        "year": F.coalesce(year_of("original_release_date"), year_of("streaming_release_date")),
        "genres": parse.split_genres(F.col("genres"), "comma_amp_slash"),
    }


STATIC_SPECS = {
    "imdb": SourceSpec("imdb", "ID_IMDB", tuple(IMDB_COLUMNS), _imdb, rating_required=False),
    "metacritic": SourceSpec("metacritic", "ID_METACRITIC", tuple(METACRITIC_COLUMNS), _metacritic),
    "movielens": SourceSpec(
        "movielens", "ID_MOVIELENS", tuple(MOVIELENS_COLUMNS), _movielens, year_first=True,
        strict=True,
    ),
    "rt_audience": SourceSpec(
        "rt_audience", "ID_RT", tuple(ROTTEN_TOMATOES_COLUMNS), _rotten_tomatoes, multi_line=True
    ),
}
ADAPTIVE_SPECS = {
    "imdb": SourceSpec("imdb", "ID_IMDB", tuple(IMDB_COLUMNS), _imdb_adaptive),
    "metacritic": SourceSpec(
        "metacritic", "ID_METACRITIC", tuple(METACRITIC_COLUMNS), _metacritic_adaptive,
        title_options=(("fold", "translit"),),
    ),
    "movielens": SourceSpec(
        "movielens", "ID_MOVIELENS", tuple(MOVIELENS_COLUMNS), _movielens_adaptive,
        title_options=(("bare_the", "keep"),), strict=True,
    ),
    "rt_audience": SourceSpec(
        "rt_audience", "ID_RT", tuple(ROTTEN_TOMATOES_COLUMNS), _rotten_tomatoes_adaptive,
        title_options=(("punct", "list"),), multi_line=True,
    ),
}

_registered: dict[str, SourceSpec] = dict(STATIC_SPECS)


def register(spec: SourceSpec) -> None:
    """Make a further source known by name."""
    _registered[spec.name] = spec


def lookup(name: str) -> SourceSpec | None:
    return _registered.get(name)
