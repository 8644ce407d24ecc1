"""Two results side by side: matches, misses, causes, field differences, lineage.

``a`` is the result under test, ``b`` the one taken as the truth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratefuse.functions.parse import count_present, half_even, number
from ratefuse.functions.text import canonical_id, joined_key
from ratefuse.operators.keyed import first_per_key, lookup_by_key
from ratefuse.operators.merge import ID_COLUMNS, ensure_columns

# Id columns in key order, compared fields, cause texts.
ENTITY_IDS = ["ID_IMDB", "ID_RT", "ID_METACRITIC", "ID_MOVIELENS"]
TRIPLE_IDS = ["ID_RT", "ID_METACRITIC", "ID_MOVIELENS"]
SHORT_NAMES = {"ID_RT": "RT", "ID_METACRITIC": "MC", "ID_MOVIELENS": "ML"}
COMPARED_RATINGS = ["rating_imdb", "rating_rt_audience", "rating_metacritic", "rating_movielens"]
OVERALL = "entity_key_overall"


def with_keys(df: DataFrame, canonical: bool = True) -> DataFrame:
    """Ids as text, ``entity_key`` of all four and ``triple_key`` without the first."""
    df = ensure_columns(df, {c: "string" for c in ENTITY_IDS})
    as_text = {c: canonical_id(F.col(c)) if canonical else F.col(c).cast("string")
               for c in ENTITY_IDS}
    keyed = df.withColumns(as_text)
    return keyed.withColumns(
        {
            "entity_key": joined_key([F.col(c) for c in ENTITY_IDS], canonical=False),
            "triple_key": joined_key([F.col(c) for c in TRIPLE_IDS], canonical=False),
        }
    )


def _by_key(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Left rows by whether the right table has their key.

    Keys are nearly unique.  Both sides are plain exchanges below the join, so adaptive
    execution splits a key that many left rows share.
    """
    keys = right.select(F.col(key).alias("_key"))
    return left.join(keys, F.col(key) == F.col("_key"), how)


def only_in(left: DataFrame, right: DataFrame, key: str = "entity_key") -> DataFrame:
    """Rows of the left table whose key the right one does not have."""
    return _by_key(left, right, key, "left_anti")


def in_both(left: DataFrame, right: DataFrame, key: str = "entity_key") -> DataFrame:
    """Rows of the left table whose key the right one has, too."""
    return _by_key(left, right, key, "left_semi")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def set_metrics(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and Jaccard (four places) from tp, fp, fn; 0 if undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    values = {
        "precision": p, "recall": r, "f1": _ratio(2 * p * r, p + r),
        "jaccard": _ratio(tp, tp + fp + fn),
    }
    return counts.withColumns({k: half_even(v, 4) for k, v in values.items()})


def _compare_sets(a: DataFrame, b: DataFrame, scope: str, member: str) -> DataFrame:
    """tp, fp, fn per scope.  One shuffle by member instead of a join of two distincts."""
    tagged = a.select(scope, member, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(scope, member, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    members = tagged.groupBy(scope, member).agg(
        F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b")
    )
    counts = members.groupBy(scope).agg(
        F.count_if(F.col("in_a") + F.col("in_b") == 2).alias("tp"),
        F.count_if((F.col("in_a") == 1) & (F.col("in_b") == 0)).alias("fp"),
        F.count_if((F.col("in_a") == 0) & (F.col("in_b") == 1)).alias("fn"),
    )
    return set_metrics(counts)


def match_metrics(a: DataFrame, b: DataFrame, key: str = "entity_key") -> DataFrame:
    """Agreement of the two key sets, one row."""
    overall = F.lit(OVERALL).alias("scope")
    return _compare_sets(a.select(overall, key), b.select(overall, key), "scope", key)


def _ids(df: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("scope"), F.col(c).alias("id")) for c in ENTITY_IDS]
    return df.select(F.inline(F.array(*pairs))).filter(F.col("id").isNotNull())


def match_metrics_by_source(a: DataFrame, b: DataFrame) -> DataFrame:
    """Agreement of the id sets, one row per id column."""
    return _compare_sets(_ids(a), _ids(b), "scope", "id")


def match_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    return match_metrics(a, b).unionByName(match_metrics_by_source(a, b))


def _first_per_triple(wide: DataFrame) -> DataFrame:
    """One row per triple key, the first in group order."""
    kept = wide.select(
        "triple_key",
        F.struct("norm_title", "year_cluster").alias("_order"),
        F.col("title").alias("other_title"),
        F.col("ID_IMDB").alias("other_imdb"),
        count_present([F.col(c) for c in COMPARED_RATINGS]).alias("other_count"),
    )
    return first_per_key(
        kept, ["triple_key"], F.col("_order"), ["other_title", "other_imdb", "other_count"]
    )


def _present_ids(missed: DataFrame, other_ids: DataFrame) -> DataFrame:
    """Which ids of each missed film the other side's cleaned sources hold.

    Only ids that exist are shuffled, so films without an id do not pile up on a null.
    """
    pairs = [F.struct(F.lit(c).alias("id_column"), F.col(c).alias("id")) for c in TRIPLE_IDS]
    wanted = missed.select("entity_key", F.inline(F.array(*pairs))).filter(
        F.col("id").isNotNull()
    )
    held = wanted.join(other_ids, ["id_column", "id"], "left_semi")
    return held.groupBy("entity_key").agg(
        *[F.max(F.col("id_column") == c).alias(f"has_{c}") for c in TRIPLE_IDS]
    )


def source_ids(clean: DataFrame, id_columns: dict[str, str]) -> DataFrame:
    """Distinct (id_column, id) of cleaned canonical rows."""
    column = F.element_at(
        F.create_map(*[F.lit(x) for pair in id_columns.items() for x in pair]), F.col("source")
    )
    return clean.select(column.alias("id_column"), canonical_id(F.col("id")).alias("id")).distinct()


def root_cause(missed: DataFrame, other_wide: DataFrame, other_ids: DataFrame,
               other: str, conflict: str) -> DataFrame:
    """Why each missed film is missing on the other side.

    ``missed`` is read several times; pass a stored table.
    Its triple is in the other unfiltered table: filtered there (with the number of
    ratings it had, and a remark if the first id differs).  Else the sources that lack
    its ids; else the merge failed.
    """
    with_other = lookup_by_key(
        missed, _first_per_triple(other_wide), ["triple_key"], ["entity_key"]
    )
    known = with_other.join(_present_ids(missed, other_ids), "entity_key", "left")
    filtered = F.concat(
        F.lit(f"{other}_filtered_or_postmerge_change(count_ratings="),
        F.col("other_count").cast("string"), F.lit(")"),
    )
    differs = F.when(F.col("ID_IMDB") != F.col("other_imdb"), conflict)
    lacking = F.concat_ws(",", *[
        F.when(~F.coalesce(F.col(f"has_{c}"), F.lit(False)), short)
        for c, short in SHORT_NAMES.items()
    ])
    absent = F.when(lacking != "", F.concat(F.lit(f"{other}_source_missing:"), lacking)).otherwise(
        f"{other}_merge_failed_or_id_mismatch"
    )
    cause = F.when(F.col("other_count").isNotNull(), F.concat_ws(";", filtered, differs)).otherwise(
        absent
    )
    return known.withColumn("root_cause", cause).drop(*[f"has_{c}" for c in TRIPLE_IDS])


def id_conflicts(missed: DataFrame, other_wide: DataFrame) -> DataFrame:
    """Missed films whose triple the other side has under a different first id."""
    joined = lookup_by_key(
        missed, _first_per_triple(other_wide), ["triple_key"], ["entity_key"], "inner"
    )
    return joined.filter(F.col("ID_IMDB") != F.col("other_imdb")).select(
        "triple_key", "title", "other_title", "ID_IMDB", "other_imdb"
    )


def top_causes(causes: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent causes."""
    counts = causes.groupBy("root_cause").agg(F.count(F.lit(1)).alias("films"))
    return counts.orderBy(F.col("films").desc(), "root_cause").limit(n)


def cause_examples(causes: DataFrame, text: str, n: int = 8) -> DataFrame:
    """First films whose cause contains a text."""
    found = causes.filter(F.col("root_cause").contains(text))
    return found.orderBy("title", "entity_key").limit(n)


def paired(a: DataFrame, b: DataFrame, fields: list[str], key: str = "entity_key") -> DataFrame:
    """Fields of both sides for the keys both have, with equality flags.

    Blank equals null.  A key that occurs more than once on a side counts with its
    first row, so copies of a key never multiply.
    """
    def side(df: DataFrame, suffix: str) -> DataFrame:
        shown = df.select(key, *[_as_text(df, c).alias(c) for c in fields])
        one = first_per_key(shown, [key], F.struct(*fields), fields)
        return one.select(key, *[F.col(c).alias(c + suffix) for c in fields])

    both = side(a, "_ad").join(side(b, "_st"), key)
    blank = F.lit("")
    return both.withColumns(
        {
            f"{c}_eq": F.coalesce(f"{c}_ad", blank) == F.coalesce(f"{c}_st", blank)
            for c in fields
        }
    )


def _as_text(df: DataFrame, column: str) -> Column:
    if df.schema[column].dataType.typeName() == "array":
        return F.to_json(column)
    return F.col(column).cast("string")


def field_mismatch(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """Number of differing pairs per field, most first."""
    one = pairs.agg(*[F.count_if(~F.col(f"{c}_eq")).alias(c) for c in fields])
    rows = [F.struct(F.lit(c).alias("field"), F.col(c).alias("mismatches")) for c in fields]
    out = one.select(F.inline(F.array(*rows)))
    return out.orderBy(F.col("mismatches").desc(), "field")


def mismatch_examples(pairs: DataFrame, field: str, n: int = 8) -> DataFrame:
    """First pairs that differ in a field."""
    shown = ["entity_key", f"{field}_ad", f"{field}_st"]
    return pairs.filter(~F.col(f"{field}_eq")).select(*shown).orderBy("entity_key").limit(n)


def field_deltas(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """Numeric difference of the two sides, per field; null where a side is no number."""
    return pairs.withColumns(
        {f"{c}_delta": number(F.col(f"{c}_ad")) - number(F.col(f"{c}_st")) for c in fields}
    )


def stage_titles_lost(stages: dict[str, DataFrame], token: str) -> DataFrame:
    """Per triple key: in which stage a token left the title.

    ``stages`` has ad_wide, st_wide, ad_final and st_final.  All rows of a triple are
    folded to one flag per stage, so shared (or empty) triples do not multiply.
    """
    def flags(stage: str, df: DataFrame) -> DataFrame:
        has = F.coalesce(F.lower("title").contains(token), F.lit(False))
        return df.select(
            "triple_key",
            *[(F.lit(s == stage) & has).alias(s) for s in stages],
            *[F.lit(s == stage).alias(f"in_{s}") for s in ("ad_wide", "st_wide")],
        )

    tagged = reduce(DataFrame.unionByName, [flags(s, d) for s, d in stages.items()])
    folded = tagged.groupBy("triple_key").agg(
        *[F.max(c).alias(c) for c in tagged.columns if c != "triple_key"]
    )
    both = folded.filter(F.col("in_ad_wide") & F.col("in_st_wide"))
    diagnosis = (
        F.when(F.col("ad_wide") & ~F.col("ad_final"), "adaptive_lost")
        .when(F.col("st_wide") & ~F.col("st_final"), "static_lost")
        .when(F.col("ad_wide") & F.col("ad_final"), "adaptive_kept")
        .otherwise("without_token")
    )
    return both.select("triple_key", diagnosis.alias("diagnosis"))


def pair_triples(stages: dict[str, DataFrame]) -> DataFrame:
    """Titles of all four stages per triple key that both wide tables have.

    The first title (in text order) and the number of rows stand for each stage.
    """
    tagged = reduce(
        DataFrame.unionByName,
        [d.select("triple_key", "title", F.lit(s).alias("stage")) for s, d in stages.items()],
    )
    aggs = []
    for s in stages:
        here = F.col("stage") == s
        aggs += [
            F.min(F.when(here, F.col("title"))).alias(f"title_{s}"),
            F.count_if(here).alias(f"rows_{s}"),
        ]
    folded = tagged.groupBy("triple_key").agg(*aggs)
    return folded.filter((F.col("rows_ad_wide") > 0) & (F.col("rows_st_wide") > 0))


TARGET_PAIR = "ID_METACRITIC|ID_MOVIELENS"


def _keys(rows: DataFrame, columns: list[str], pair: bool) -> Column:
    """(found_by, key) of the ids a row has, the pair of the second and third source as one."""
    entries = [F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("found_by"), F.col(c).alias("key")))
               for c in columns]
    if pair:
        both = F.concat_ws("|", "ID_METACRITIC", "ID_MOVIELENS")
        known = F.col("ID_METACRITIC").isNotNull() & F.col("ID_MOVIELENS").isNotNull()
        entries.append(F.when(known, F.struct(F.lit(TARGET_PAIR).alias("found_by"), both.alias("key"))))
    return F.inline(F.array_compact(F.array(*entries)))


def trace(
    films: DataFrame, sources: dict[str, DataFrame], stages: dict[tuple[str, str], DataFrame]
) -> DataFrame:
    """Every row of every stage that belongs to one of the films, with the id it was found by.

    ``films`` has ``entity_key`` and the id columns, ``sources`` the cleaned rows of each side,
    ``stages`` the wide and final tables by (side, stage).  A cleaned row is found by the id of
    its source; a merged one by the third id alone (in whatever triple it ended up) and by the
    pair of the other two.  All stages go into one index by id, and the films meet it in one
    join, however many they are.
    """
    wanted = with_keys(films).select("entity_key", _keys(films, ENTITY_IDS, True))
    parts = []
    for side, clean in sources.items():
        column = F.element_at(
            F.create_map(*[F.lit(x) for pair in ID_COLUMNS.items() for x in pair]), F.col("source")
        )
        key = canonical_id(F.col("id"))
        parts.append(
            clean.withColumns({"found_by": column, "key": key}).select(
                F.lit(side).alias("side"), F.lit("source").alias("stage"), "found_by", "key", "title",
                F.col("year").alias("release_year"),
                *[F.when(F.col("found_by") == c, F.col("key")).alias(c) for c in ENTITY_IDS],
            ).filter(F.col("found_by").isNotNull() & F.col("key").isNotNull())
        )
    for (side, stage), df in stages.items():
        rows = with_keys(ensure_columns(df, {"release_year": "int"}))
        parts.append(
            rows.select(
                F.lit(side).alias("side"), F.lit(stage).alias("stage"), _keys(rows, ["ID_RT"], True),
                "title", "release_year", *ENTITY_IDS,
            ).select(*parts[0].columns)
        )
    index = reduce(DataFrame.unionByName, parts)
    return wanted.join(index, ["found_by", "key"]).drop("key")


def pair_preview(pairs: DataFrame, fields: list[str], numeric: list[str], n: int) -> DataFrame:
    """The first pairs with both sides, equality flags and numeric differences."""
    shown = [f"{c}_{s}" for c in fields for s in ("ad", "st")] + [f"{c}_eq" for c in fields]
    deltas = [f"{c}_delta" for c in numeric]
    return field_deltas(pairs, numeric).orderBy("entity_key").limit(n).select("entity_key", *shown, *deltas)


def confusion_cells(metrics: DataFrame) -> DataFrame:
    """The four cells of one row of metrics; nothing counts films that neither side has."""
    cells = [("tp", True, True), ("fp", True, False), ("fn", False, True), (None, False, False)]
    rows = [
        F.struct(F.lit(a).alias("in_result"), F.lit(b).alias("in_truth"),
                 (F.col(c) if c else F.lit(0).cast("long")).alias("films"))
        for c, a, b in cells
    ]
    return metrics.select(F.inline(F.array(*rows)))


def stage_loss(stages: dict[str, DataFrame]) -> DataFrame:
    """For every (Metacritic id, MovieLens id) pair: the stage in which it got lost.

    ``stages`` has ad_wide, st_wide, ad_final and st_final.  A pair that the adaptive wide table
    lacks is looked for by the third id the static side has for it.
    """
    parts = []
    for s, df in stages.items():
        parts.append(
            df.select(
                canonical_id(F.col("ID_METACRITIC")).alias("mc"),
                canonical_id(F.col("ID_MOVIELENS")).alias("ml"),
                F.col("ID_RT").isNotNull().alias("has_rt"), F.lit(s).alias("stage"),
                canonical_id(F.col("ID_RT")).alias("rt"),
            ).filter(F.col("mc").isNotNull() & F.col("ml").isNotNull())
        )
    tagged = reduce(DataFrame.unionByName, parts)
    aggs = []
    for s in stages:
        here = F.col("stage") == s
        aggs += [
            F.max(here).alias(s),
            F.coalesce(F.max(F.when(here, F.col("has_rt"))), F.lit(False)).alias(f"{s}_rt"),
        ]
    static_rt = F.min(F.when(F.col("stage").startswith("st_"), F.col("rt"))).alias("rt")
    seen = tagged.groupBy("mc", "ml").agg(*aggs, static_rt)
    elsewhere = stages["ad_wide"].select(canonical_id(F.col("ID_RT")).alias("_rt")).filter(
        F.col("_rt").isNotNull()
    ).distinct().withColumn("elsewhere", F.lit(True))
    # A pair without that id matches nothing; its own ids keep such pairs from meeting in one task.
    place = F.coalesce("rt", F.concat_ws("|", F.lit("none"), "mc", "ml"))
    seen = seen.withColumn("_rt", place).join(elsewhere, "_rt", "left")
    ad_wide, st_wide = F.col("ad_wide"), F.col("st_wide")
    ad_final, st_final = F.col("ad_final"), F.col("st_final")
    issues = [
        F.when(~ad_wide, "not_in_adaptive_wide"),
        F.when(ad_wide & ~F.col("ad_wide_rt"), "adaptive_wide_without_rt"),
        F.when(~ad_wide & F.col("elsewhere"), "rt_in_other_triple_of_adaptive_wide"),
        F.when(ad_final & ~F.col("ad_final_rt") & st_final, "adaptive_final_without_rt"),
        F.when(~st_wide, "not_in_static_wide"),
        F.when(~st_final & st_wide, "filtered_in_static_final"),
    ]
    found = F.concat_ws(";", *issues)
    return seen.select("mc", "ml", F.when(found == "", "none").otherwise(found).alias("issues"))
