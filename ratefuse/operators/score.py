"""Common 0-10 scale, outlier treatment, superscores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratefuse.functions.parse import count_present, half_even, row_mean, row_median
from ratefuse.operators.merge import STATIC, Dialect, rating_columns
from ratefuse.operators.quantiles import quantile_values
from ratefuse.sources.specs import RESCALE_FACTORS

# Normalised columns in order, and the sources they come from.
NORM_COLUMNS = {
    "imdb_norm": "imdb", "movielens_norm": "movielens", "metacritic_norm": "metacritic",
    "rt_norm": "rt_audience",
}
METHODS = ("cap", "nan", "percentile_cap", "none")


def rescale_fixed(wide: DataFrame) -> DataFrame:
    """Add the normalised columns by the factor of each source; absent ones are null."""
    out = {}
    for norm, source in NORM_COLUMNS.items():
        rating, factor = f"rating_{source}", RESCALE_FACTORS[source]
        if rating not in wide.columns:
            out[norm] = F.lit(None).cast("double")
        elif factor < 1:
            out[norm] = F.col(rating) / (1 / factor)
        else:
            out[norm] = F.col(rating) * factor
    return wide.withColumns(out)


def rescale_inferred(wide: DataFrame) -> DataFrame:
    """Add a normalised column per rating, scaled by the maximum of the whole column."""
    ratings = rating_columns(wide)
    top = wide.agg(F.struct(*[F.max(c).alias(c) for c in ratings])).scalar()
    out = {}
    for c in ratings:
        highest = F.col(f"_top.{c}")
        scaled = (
            F.when(highest <= 5.5, F.col(c) * 2)
            .when(highest > 10, F.col(c) / 10)
            .otherwise(F.col(c))
        )
        out[c.removeprefix("rating_") + "_norm"] = scaled
    return wide.withColumn("_top", top).withColumns(out).drop("_top")


def treat_outliers(
    df: DataFrame,
    columns: list[str],
    method: str = "cap",
    iqr_factor: float = 1.5,
    lower: float = 0.05,
    upper: float = 0.95,
    **quantile_options,
) -> DataFrame:
    """Cap outliers at the bounds (``cap``, ``percentile_cap``) or blank them (``nan``).

    The bounds are found in rounds of counting first, and then stand in the plan as numbers.
    A column without spread, or without values, is left alone.
    """
    if method not in METHODS:
        raise ValueError(f"unknown outlier method {method!r}, expected one of {METHODS}")
    by_percentile = method == "percentile_cap"
    if method == "none" or (by_percentile and not 0 <= lower < upper <= 1):
        return df
    probs = [lower, upper] if by_percentile else [0.25, 0.75]
    bounds = quantile_values(df, columns, probs, **quantile_options)
    out = {}
    for c in columns:
        low, high = (bounds[c, p][1] for p in probs)
        if low is None or (low == high and not by_percentile):
            continue
        if not by_percentile:
            spread = high - low
            low, high = low - spread * iqr_factor, high + spread * iqr_factor
        bound = F.when(F.col(c) < low, F.lit(low)).otherwise(F.lit(high))
        new = F.lit(None).cast("double") if method == "nan" else bound
        outside = (F.col(c) < low) | (F.col(c) > high)
        out[c] = F.when(outside, new).otherwise(F.col(c))
    return df.withColumns(out)


def superscores(df: DataFrame, columns: list[str], min_ratings: int = 2, rounded: bool = False,
                suffix: str = "") -> DataFrame:
    """Count of the ratings present, and their mean and median if there are enough."""
    values = [F.col(c) for c in columns]
    enough = F.col("num_available_ratings") >= min_ratings

    def shown(c):
        return F.when(enough, half_even(c) if rounded else c)

    return df.withColumn("num_available_ratings", count_present(values)).withColumns(
        {
            f"superscore_mean{suffix}": shown(row_mean(values)),
            f"superscore_median{suffix}": shown(row_median(values)),
        }
    )


def score(
    films: DataFrame,
    dialect: Dialect = STATIC,
    min_ratings: int = 2,
    outliers: str = "none",
    **outlier_options,
) -> DataFrame:
    """Merged films -> normalised ratings and superscores."""
    if dialect.inferred_scale:
        scaled = rescale_inferred(films)
        norms = [c for c in scaled.columns if c.endswith("_norm")]
        return superscores(scaled, norms, min_ratings, dialect.round_scores, "_0_10")
    scaled = rescale_fixed(films)
    norms = list(NORM_COLUMNS)
    treated = treat_outliers(scaled, norms, outliers, **outlier_options)
    return superscores(treated, norms, min_ratings, dialect.round_scores)


def keep_scored(scored: DataFrame, min_ratings: int = 2) -> DataFrame:
    """Films with enough normalised ratings; all of them if there is no count."""
    if "num_available_ratings" not in scored.columns:
        return scored
    return scored.filter(F.col("num_available_ratings") >= min_ratings)
