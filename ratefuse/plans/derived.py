"""Stages of the fusion over the derived sources, in either dialect."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratefuse.operators import clean, compare, merge, score
from ratefuse.operators.merge import ADAPTIVE, STATIC, Dialect
from ratefuse.operators.stored import stored
from ratefuse.plans.tables import raw_sources
from ratefuse.sources.specs import ADAPTIVE_SPECS, STATIC_SPECS

SOURCES = ["imdb", "metacritic", "movielens", "rt_audience"]


def parsed(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC) -> DataFrame:
    specs = ADAPTIVE_SPECS if dialect is ADAPTIVE else STATIC_SPECS
    return clean.parse_sources(raw_sources(spark, sf_dir), specs)


def cleaned(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC,
            columns: list[str] | None = None) -> DataFrame:
    return clean.keep_clean(parsed(spark, sf_dir, dialect), dialect.claim, columns)


def long(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC) -> DataFrame:
    rows = cleaned(spark, sf_dir, dialect, clean.MERGED)
    return merge.with_group_title(rows, dialect)


def wide(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC) -> DataFrame:
    return merge.merge_long(long(spark, sf_dir, dialect), SOURCES, dialect)


def films(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC) -> DataFrame:
    return merge.keep_rated(wide(spark, sf_dir, dialect), dialect)


def stored_films(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC) -> DataFrame:
    """Films as a table, for steps that go over them several times."""
    return stored(films(spark, sf_dir, dialect), f"films_{dialect.name}")


def scored(spark: SparkSession, sf_dir: str, dialect: Dialect = STATIC, **options) -> DataFrame:
    """Scored films; stored before if the score needs whole columns first."""
    several_passes = dialect.inferred_scale or options.get("outliers", "none") != "none"
    source = stored_films if several_passes else films
    return score.keep_scored(score.score(source(spark, sf_dir, dialect), dialect, **options))


def final(spark: SparkSession, sf_dir: str, dialect: Dialect) -> DataFrame:
    """Films with keys, for a step that goes over them once."""
    return compare.with_keys(films(spark, sf_dir, dialect))


def finals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Films of the adaptive and the static side; both are worked out in one job."""
    return final(spark, sf_dir, ADAPTIVE), final(spark, sf_dir, STATIC)


@dataclass(frozen=True)
class Side:
    """The stages of one dialect with keys, the wide table stored."""

    clean: DataFrame
    wide: DataFrame
    final: DataFrame


def side(spark: SparkSession, sf_dir: str, dialect: Dialect, keep_clean: bool = True) -> Side:
    """``keep_clean``: the cleaned rows are read again, too, and stored before the wide table."""
    clean_rows = cleaned(spark, sf_dir, dialect, clean.MERGED)
    if keep_clean:
        clean_rows = stored(clean_rows, f"clean_{dialect.name}")
    whole = merge.merge_long(merge.with_group_title(clean_rows, dialect), SOURCES, dialect)
    whole = stored(whole, f"wide_{dialect.name}")
    rated = merge.keep_rated(whole, dialect)
    return Side(clean_rows, compare.with_keys(whole), compare.with_keys(rated))


def both_sides(spark: SparkSession, sf_dir: str, keep_clean: bool = True) -> tuple[Side, Side]:
    """Adaptive and static."""
    return side(spark, sf_dir, ADAPTIVE, keep_clean), side(spark, sf_dir, STATIC, keep_clean)


def four_stages(ad: Side, st: Side) -> dict[str, DataFrame]:
    return {"ad_wide": ad.wide, "st_wide": st.wide, "ad_final": ad.final, "st_final": st.final}


def flat(df: DataFrame, places: int = 6) -> DataFrame:
    """Arrays as joined text, dates as text, doubles rounded: the same in every engine."""
    shown = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("array"):
            c = F.array_join(c, "|")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "double":
            c = F.round(c, places)
        shown.append(c.alias(name))
    return df.select(*shown)
