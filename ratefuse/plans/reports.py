"""All tables of a comparison and of an analysis, by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ratefuse.operators import analyze, compare, merge
from ratefuse.operators.stored import stored


@dataclass(frozen=True)
class Result:
    """The stages of one run: cleaned rows, unfiltered wide table, final films."""

    clean: DataFrame
    wide: DataFrame
    final: DataFrame


def compare_results(tested: Result, truth: Result) -> dict[str, DataFrame]:
    """Metrics, misses with causes, id conflicts, field differences and stage losses.

    Pass tables that are stored (a run writes them): every report reads them anew.  What several
    reports read (misses and pairs) is stored before.
    """
    a_wide, a = compare.with_keys(tested.wide), compare.with_keys(tested.final)
    b_wide, b = compare.with_keys(truth.wide), compare.with_keys(truth.final)
    a_ids = compare.source_ids(tested.clean, merge.ID_COLUMNS)
    b_ids = compare.source_ids(truth.clean, merge.ID_COLUMNS)
    fields = [
        c for c in ("title", "release_year", "release_date", "genres", *merge.rating_columns(a),
                    "count_ratings")
        if c in a.columns and c in b.columns
    ]
    numeric = [c for c in fields if c not in ("title", "genres", "release_date")]
    pairs = stored(compare.paired(a, b, fields), "pairs")
    missed, extra = stored(compare.only_in(b, a), "missed"), stored(compare.only_in(a, b), "extra")
    stages = {"ad_wide": a_wide, "st_wide": b_wide, "ad_final": a, "st_final": b}
    sides = {tuple(s.split("_")): df for s, df in stages.items()}
    cleaned = {"ad": tested.clean, "st": truth.clean}
    return {
        "summary": compare.match_summary(a, b),
        "confusion": compare.confusion_cells(compare.match_metrics(a, b)),
        "preview": compare.pair_preview(pairs, fields, numeric, 20),
        "lineage": compare.trace(missed, cleaned, sides),
        "false_negatives": compare.root_cause(
            missed, a_wide, a_ids, "adaptive", "imdb_conflict_static_vs_adaptive"
        ),
        "false_positives": compare.root_cause(
            extra, b_wide, b_ids, "static", "imdb_conflict_adaptive_vs_static"
        ),
        "id_conflicts": compare.id_conflicts(missed, a_wide),
        "pairs": compare.field_deltas(pairs, numeric),
        "field_mismatch": compare.field_mismatch(pairs, fields),
        "triples": compare.pair_triples(stages),
        "stage_loss": compare.stage_loss(stages),
    }


def analyze_result(clean: DataFrame, final: DataFrame) -> dict[str, DataFrame]:
    """Statistics of the final films and coverage of the sources."""
    ratings = merge.rating_columns(final)
    scores = [c for c in final.columns if c.endswith("_norm") or c.startswith("superscore_")]
    tables = {
        "profile": analyze.column_profile(final),
        "genres": analyze.with_genres(final),
        "rating_stats": analyze.rating_stats(final, ratings + scores),
        "histograms": analyze.histogram(final, ratings + scores),
        "rating_pairs": analyze.pair_density(final, ratings),
        "coverage": analyze.source_coverage(clean, final),
        "lost_keys": analyze.lost_keys(clean, final),
    }
    for name, columns in (("rating_corr", ratings), ("score_corr", scores)):
        if len(columns) > 1:
            tables[name] = analyze.rating_corr(final, columns)
    for c in ("count_ratings", "num_available_ratings"):
        if c in final.columns:
            tables[c] = analyze.value_counts(final, c)
    return tables
