"""Registered queries: the adaptive result against the static one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ratefuse.operators import analyze, compare, merge
from ratefuse.operators.merge import ADAPTIVE, STATIC
from ratefuse.operators.stored import stored
from ratefuse.plans import derived, sql
from ratefuse.plans.derived import flat
from ratefuse.plans.registry import query

_TEXTS = ["title", "genres", "release_date"]
_FIELDS = [*_TEXTS, "release_year", "rating_imdb", "rating_metacritic", "rating_movielens",
           "rating_rt_audience", "count_ratings"]
_COUNTED = " + ".join(
    f"CAST(rating_{s} IS NOT NULL AS INTEGER)"
    for s in ("imdb", "rt_audience", "metacritic", "movielens")
)


def _hits(p, condition):
    return (
        f"WITH {sql.BOTH} SELECT title, release_year, entity_key, triple_key FROM {p}_films_k"
        f" WHERE entity_key {condition}"
    )


_SHOWN = ["title", "release_year", "entity_key", "triple_key"]


@query("true_positives", _hits("ad", "IN (SELECT entity_key FROM st_films_k)"))
def true_positives(spark, d):
    ad, st = derived.finals(spark, d)
    return compare.in_both(ad.select(_SHOWN), st)


@query("false_positives", _hits("ad", "NOT IN (SELECT entity_key FROM st_films_k)"))
def false_positives(spark, d):
    ad, st = derived.finals(spark, d)
    return compare.only_in(ad.select(_SHOWN), st)


@query("false_negatives", _hits("st", "NOT IN (SELECT entity_key FROM ad_films_k)"))
def false_negatives(spark, d):
    ad, st = derived.finals(spark, d)
    return compare.only_in(st.select(_SHOWN), ad)


_METRICS = """SELECT scope, tp, fp, fn,
  round_even((CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) * 10000, 0) / 10000 AS precision,
  round_even((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) * 10000, 0) / 10000 AS recall,
  round_even((CASE WHEN tp > 0 THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn))
    / (tp / (tp + fp) + tp / (tp + fn)) ELSE 0 END) * 10000, 0) / 10000 AS f1,
  round_even((CASE WHEN tp + fp + fn > 0 THEN tp / (tp + fp + fn) ELSE 0 END) * 10000, 0) / 10000
    AS jaccard"""


def _sets(scope, column):
    a = f"(SELECT DISTINCT {column} AS k FROM ad_films_k WHERE {column} IS NOT NULL)"
    b = f"(SELECT DISTINCT {column} AS k FROM st_films_k WHERE {column} IS NOT NULL)"
    return (
        f"SELECT '{scope}' AS scope, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS tp,"
        f" count(*) FILTER (b.k IS NULL) AS fp, count(*) FILTER (a.k IS NULL) AS fn"
        f" FROM {a} a FULL JOIN {b} b ON a.k = b.k"
    )


_OVERALL = _sets("entity_key_overall", "entity_key")
_BY_SOURCE = " UNION ALL ".join(_sets(c, f"k{i}") for i, c in enumerate(compare.ENTITY_IDS))


@query("match_metrics", f"WITH {sql.BOTH}, s AS ({_OVERALL}) {_METRICS} FROM s")
def match_metrics(spark, d):
    return compare.match_metrics(*derived.finals(spark, d))


@query("match_metrics_by_source", f"WITH {sql.BOTH}, s AS ({_BY_SOURCE}) {_METRICS} FROM s")
def match_metrics_by_source(spark, d):
    return compare.match_metrics_by_source(*derived.finals(spark, d))


@query(
    "match_summary", f"WITH {sql.BOTH}, s AS ({_OVERALL} UNION ALL {_BY_SOURCE}) {_METRICS} FROM s"
)
def match_summary(spark, d):
    keyed = [df.select("entity_key", *compare.ENTITY_IDS) for df in derived.finals(spark, d)]
    return compare.match_summary(*[stored(df, "keys") for df in keyed])


def _value(side, c):
    """A field as it is compared: lists as JSON text (the films have them joined)."""
    if c != "genres":
        return f"{side}.{c}"
    return (
        f"CASE WHEN {side}.genres = '' THEN '[]'"
        f" ELSE CAST(to_json(string_split({side}.genres, '|')) AS VARCHAR) END"
    )


_PAIRS = f"""{sql.BOTH}, p AS (SELECT a.entity_key, """ + ", ".join(
    f"{_value('a', c)} AS {c}_ad, {_value('s', c)} AS {c}_st,"
    f" {_value('a', c)} IS NOT DISTINCT FROM {_value('s', c)} AS {c}_eq" for c in _FIELDS
) + " FROM ad_films_k a JOIN st_films_k s USING (entity_key))"


def _pairs(spark, d):
    return compare.paired(*derived.finals(spark, d), _FIELDS)


def _number(c):
    return f"round(CAST({c} AS DOUBLE), 6) AS {c}" if "rating_" in c and c.startswith("rating_") else (
        f"CAST({c} AS VARCHAR) AS {c}"
    )


_PAIR_COLUMNS = ", ".join(
    [_number(f"{c}_{s}") for c in _FIELDS for s in ("ad", "st")] + [f"{c}_eq" for c in _FIELDS]
)


@query("paired_compare", f"WITH {_PAIRS} SELECT entity_key, {_PAIR_COLUMNS} FROM p")
def paired_compare(spark, d):
    pairs = _pairs(spark, d)
    numbers = {
        f"{c}_{s}": F.col(f"{c}_{s}").cast("double")
        for c in _FIELDS if c.startswith("rating_") for s in ("ad", "st")
    }
    return flat(pairs.withColumns(numbers))


@query(
    "field_mismatch",
    f"WITH {_PAIRS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) FILTER (NOT {c}_eq) AS mismatches FROM p" for c in _FIELDS
    ),
)
def field_mismatch(spark, d):
    return compare.field_mismatch(_pairs(spark, d), _FIELDS)


@query(
    "mismatch_examples",
    f"WITH {_PAIRS} SELECT entity_key, round(rating_metacritic_ad, 6) AS rating_metacritic_ad,"
    " round(rating_metacritic_st, 6) AS rating_metacritic_st FROM p WHERE NOT rating_metacritic_eq"
    " ORDER BY entity_key LIMIT 8",
)
def mismatch_examples(spark, d):
    found = compare.mismatch_examples(_pairs(spark, d), "rating_metacritic")
    sides = {c: F.col(c).cast("double") for c in ("rating_metacritic_ad", "rating_metacritic_st")}
    return flat(found.withColumns(sides))


_NUMERIC = [c for c in _FIELDS if c not in _TEXTS]


@query(
    "field_delta",
    f"WITH {_PAIRS} SELECT entity_key, " + ", ".join(
        f"round(CAST({c}_ad AS DOUBLE) - CAST({c}_st AS DOUBLE), 6) AS {c}_delta" for c in _NUMERIC
    ) + " FROM p",
)
def field_delta(spark, d):
    deltas = compare.field_deltas(_pairs(spark, d), _NUMERIC)
    return flat(deltas.select("entity_key", *[f"{c}_delta" for c in _NUMERIC]))


_DELTA = "rating_metacritic_ad - rating_metacritic_st"


@query(
    "delta_histogram",
    f"""WITH {_PAIRS}, v AS (SELECT {_DELTA} AS v FROM p WHERE {_DELTA} <> 0),
    b AS (SELECT least(CAST(floor(30::DOUBLE * (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()))
      AS INTEGER) + 1, 30) AS bin FROM v)
    SELECT 'rating_metacritic_delta' AS name, bin, count(*) AS rows FROM b GROUP BY bin""",
)
def delta_histogram(spark, d):
    deltas = compare.field_deltas(_pairs(spark, d), ["rating_metacritic"])
    changed = deltas.filter(F.col("rating_metacritic_delta") != 0)
    return analyze.histogram(stored(changed, "deltas"), ["rating_metacritic_delta"], 30)


_ALL_EXAMPLES = " UNION ALL ".join(
    f"(SELECT '{c}' AS field, entity_key, CAST({c}_ad AS VARCHAR) AS ad_text, CAST({c}_st AS VARCHAR)"
    " AS st_text, CAST(NULL AS DOUBLE) AS ad_number, CAST(NULL AS DOUBLE) AS st_number"
    f" FROM p WHERE NOT {c}_eq ORDER BY entity_key LIMIT 8)" if c in _TEXTS else
    f"(SELECT '{c}' AS field, entity_key, NULL AS ad_text, NULL AS st_text,"
    f" round(CAST({c}_ad AS DOUBLE), 6) AS ad_number, round(CAST({c}_st AS DOUBLE), 6) AS st_number"
    f" FROM p WHERE NOT {c}_eq ORDER BY entity_key LIMIT 8)"
    for c in _FIELDS
)


@query("mismatch_examples_all", f"WITH {_PAIRS} {_ALL_EXAMPLES}")
def mismatch_examples_all(spark, d):
    pairs = stored(_pairs(spark, d), "pairs")
    parts = []
    for c in _FIELDS:
        text = (lambda x: F.col(x)) if c in _TEXTS else (lambda x: F.lit(None).cast("string"))
        number = (lambda x: F.lit(None)) if c in _TEXTS else F.col
        parts.append(compare.mismatch_examples(pairs, c).select(
            F.lit(c).alias("field"), "entity_key",
            *[text(f"{c}_{s}").alias(f"{s}_text") for s in ("ad", "st")],
            *[number(f"{c}_{s}").cast("double").alias(f"{s}_number") for s in ("ad", "st")],
        ))
    return flat(reduce(DataFrame.unionByName, parts))


def _delta_bins(c):
    v = f"(CAST({c}_ad AS DOUBLE) - CAST({c}_st AS DOUBLE))"
    return f"""SELECT '{c}_delta' AS name, bin, count(*) AS rows FROM (SELECT CASE WHEN max(v) OVER ()
      = min(v) OVER () THEN 1 ELSE least(CAST(floor(30::DOUBLE * (v - min(v) OVER ())
      / nullif(max(v) OVER () - min(v) OVER (), 0)) AS INTEGER) + 1, 30) END AS bin
      FROM (SELECT {v} AS v FROM p WHERE {v} <> 0)) GROUP BY bin"""


@query("delta_histogram_all", f"WITH {_PAIRS} " + " UNION ALL ".join(map(_delta_bins, _NUMERIC)))
def delta_histogram_all(spark, d):
    deltas = compare.field_deltas(_pairs(spark, d), _NUMERIC)
    names = [f"{c}_delta" for c in _NUMERIC]
    changed = deltas.select(*[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in names])
    return analyze.histogram(stored(changed, "deltas"), names, 30)


def _causes(missed, truth, other, conflict):
    """SQL of the cause of each film of ``missed`` that the other side lacks."""
    lacking = ", ".join(
        f"CASE WHEN k{i} IS NULL OR k{i} NOT IN (SELECT CAST(id AS VARCHAR) FROM {truth}_clean"
        f" WHERE source = '{s}') THEN '{short}' END"
        for i, s, short in ((1, "rt_audience", "RT"), (2, "metacritic", "MC"), (3, "movielens", "ML"))
    )
    return f"""{sql.BOTH}, o AS (SELECT triple_key, title AS other_title, k0 AS other_imdb,
      {_COUNTED} AS n FROM {truth}_wide_k QUALIFY row_number() OVER
      (PARTITION BY triple_key ORDER BY norm_title, year_cluster) = 1),
    m AS (SELECT * FROM {missed}_films_k WHERE entity_key NOT IN
      (SELECT entity_key FROM {truth}_films_k)),
    c AS (SELECT m.*, other_title, other_imdb, array_to_string(list_filter([{lacking}],
      lambda x: x IS NOT NULL), ',') AS lacking, n FROM m LEFT JOIN o USING (triple_key)),
    causes AS (SELECT title, entity_key, triple_key, other_title, k0, other_imdb,
      CASE WHEN n IS NOT NULL THEN '{other}_filtered_or_postmerge_change(count_ratings=' || n || ')'
        || CASE WHEN k0 <> other_imdb THEN ';{conflict}' ELSE '' END
      WHEN lacking <> '' THEN '{other}_source_missing:' || lacking
      ELSE '{other}_merge_failed_or_id_mismatch' END AS root_cause FROM c)"""


_FN = _causes("st", "ad", "adaptive", "imdb_conflict_static_vs_adaptive")
_FP = _causes("ad", "st", "static", "imdb_conflict_adaptive_vs_static")


def _missed(spark, d, mine, theirs, other, conflict):
    """Causes of the films of one side that the other one lacks; only the other needs all stages."""
    right = derived.side(spark, d, theirs)
    missed = stored(compare.only_in(derived.final(spark, d, mine), right.final), "missed")
    ids = compare.source_ids(right.clean, merge.ID_COLUMNS)
    return compare.root_cause(missed, right.wide, ids, other, conflict)


def _fn_causes(spark, d):
    return _missed(spark, d, STATIC, ADAPTIVE, "adaptive", "imdb_conflict_static_vs_adaptive")


def _fp_causes(spark, d):
    return _missed(spark, d, ADAPTIVE, STATIC, "static", "imdb_conflict_adaptive_vs_static")


_CAUSE = ["title", "entity_key", "triple_key", "root_cause"]


@query("root_cause_fn", f"WITH {_FN} SELECT title, entity_key, triple_key, root_cause FROM causes")
def root_cause_fn(spark, d):
    return _fn_causes(spark, d).select(_CAUSE)


@query("root_cause_fp", f"WITH {_FP} SELECT title, entity_key, triple_key, root_cause FROM causes")
def root_cause_fp(spark, d):
    return _fp_causes(spark, d).select(_CAUSE)


@query(
    "cause_top",
    f"WITH {_FN} SELECT root_cause, count(*) AS films FROM causes GROUP BY root_cause"
    " ORDER BY films DESC, root_cause LIMIT 10",
)
def cause_top(spark, d):
    return compare.top_causes(_fn_causes(spark, d))


@query(
    "cause_examples",
    f"WITH {_FN} SELECT title, entity_key, root_cause FROM causes"
    " WHERE contains(root_cause, 'adaptive_merge_failed') ORDER BY title, entity_key LIMIT 8",
)
def cause_examples(spark, d):
    found = compare.cause_examples(_fn_causes(spark, d), "adaptive_merge_failed")
    return found.select("title", "entity_key", "root_cause")


@query(
    "id_conflicts",
    f"WITH {_FN} SELECT triple_key, title, other_title, k0 AS \"ID_IMDB\", other_imdb FROM causes"
    " WHERE k0 <> other_imdb",
)
def id_conflicts(spark, d):
    ad = derived.side(spark, d, ADAPTIVE, keep_clean=False)
    missed = compare.only_in(derived.final(spark, d, STATIC), ad.final)
    return compare.id_conflicts(stored(missed, "missed"), ad.wide)


_STAGES = {"ad_wide": "ad_wide_k", "st_wide": "st_wide_k", "ad_final": "ad_films_k",
           "st_final": "st_films_k"}
_TAGGED = " UNION ALL ".join(
    f"SELECT triple_key, title, '{s}' AS stage FROM {t}" for s, t in _STAGES.items()
)


@query(
    "triple_pairing",
    f"WITH {sql.BOTH}, t AS ({_TAGGED}) SELECT triple_key, " + ", ".join(
        f"min(title) FILTER (stage = '{s}') AS title_{s}, count(*) FILTER (stage = '{s}') AS rows_{s}"
        for s in _STAGES
    ) + " FROM t GROUP BY triple_key HAVING rows_ad_wide > 0 AND rows_st_wide > 0",
)
def triple_pairing(spark, d):
    return compare.pair_triples(derived.four_stages(*derived.both_sides(spark, d, keep_clean=False)))


@query(
    "stage_title_loss",
    f"WITH {sql.BOTH}, t AS ({_TAGGED}), f AS (SELECT triple_key, " + ", ".join(
        f"count(*) FILTER (stage = '{s}' AND contains(title, 'gear')) > 0 AS {s},"
        f" count(*) FILTER (stage = '{s}') > 0 AS in_{s}" for s in _STAGES
    ) + """ FROM t GROUP BY triple_key)
    SELECT triple_key, CASE WHEN ad_wide AND NOT ad_final THEN 'adaptive_lost'
      WHEN st_wide AND NOT st_final THEN 'static_lost' WHEN ad_wide AND ad_final THEN 'adaptive_kept'
      ELSE 'without_token' END AS diagnosis FROM f WHERE in_ad_wide AND in_st_wide""",
)
def stage_title_loss(spark, d):
    return compare.stage_titles_lost(derived.four_stages(*derived.both_sides(spark, d, keep_clean=False)), "gear")


@query(
    "stage_loss",
    f"WITH {sql.BOTH}, t AS (" + " UNION ALL ".join(
        f"SELECT k2 AS mc, k3 AS ml, k1 IS NOT NULL AS rt, k1 AS rt_id, '{s}' AS stage FROM {t}"
        " WHERE k2 IS NOT NULL AND k3 IS NOT NULL" for s, t in _STAGES.items()
    ) + "), f AS (SELECT mc, ml, " + ", ".join(
        f"count(*) FILTER (stage = '{s}') > 0 AS {s},"
        f" count(*) FILTER (stage = '{s}' AND rt) > 0 AS {s}_rt" for s in _STAGES
    ) + """, min(rt_id) FILTER (stage LIKE 'st_%') IN (SELECT k1 FROM ad_wide_k WHERE k1 IS NOT NULL)
      AS elsewhere FROM t GROUP BY mc, ml), i AS (SELECT mc, ml, array_to_string(list_filter([
      CASE WHEN NOT ad_wide THEN 'not_in_adaptive_wide' END,
      CASE WHEN ad_wide AND NOT ad_wide_rt THEN 'adaptive_wide_without_rt' END,
      CASE WHEN NOT ad_wide AND elsewhere THEN 'rt_in_other_triple_of_adaptive_wide' END,
      CASE WHEN ad_final AND NOT ad_final_rt AND st_final THEN 'adaptive_final_without_rt' END,
      CASE WHEN NOT st_wide THEN 'not_in_static_wide' END,
      CASE WHEN NOT st_final AND st_wide THEN 'filtered_in_static_final' END],
      lambda x: x IS NOT NULL), ';') AS issues FROM f)
    SELECT mc, ml, CASE WHEN issues = '' THEN 'none' ELSE issues END AS issues FROM i""",
)
def stage_loss(spark, d):
    return compare.stage_loss(derived.four_stages(*derived.both_sides(spark, d, keep_clean=False)))


_TOP = """top AS (SELECT * FROM st_films_k ORDER BY count_ratings DESC, release_year DESC NULLS LAST,
  title, ID_IMDB NULLS LAST, ID_METACRITIC NULLS LAST, ID_MOVIELENS NULLS LAST, ID_RT NULLS LAST
  LIMIT 1)"""


def _trace_sql(wanted):
    """Stage rows that carry an id of the wanted films (entity_key and k0 to k3)."""
    names = {"imdb": ("ID_IMDB", "k0"), "rt_audience": ("ID_RT", "k1"),
             "metacritic": ("ID_METACRITIC", "k2"), "movielens": ("ID_MOVIELENS", "k3")}
    out = [
        f"SELECT entity_key, '{side}' AS side, 'source' AS stage, '{column}' AS found_by, c.title,"
        " c.year AS release_year, " + ", ".join(
            f"{'CAST(c.id AS VARCHAR)' if column == other else 'CAST(NULL AS VARCHAR)'} AS {other}"
            for other, _ in names.values()
        ) + f" FROM {wanted} w JOIN {side}_clean c ON c.source = '{source}' AND CAST(c.id AS VARCHAR) = w.{k}"
        for side in ("ad", "st") for source, (column, k) in names.items()
    ]
    for s, table in _STAGES.items():
        for found_by, on in (("ID_RT", "t.k1 = w.k1"), ("ID_METACRITIC|ID_MOVIELENS", "t.k2 = w.k2 AND t.k3 = w.k3")):
            out.append(
                f"SELECT w.entity_key, '{s[:2]}', '{s[3:]}', '{found_by}', t.title, t.release_year,"
                f" t.k0, t.k1, t.k2, t.k3 FROM {wanted} w JOIN {table} t ON {on}"
            )
    return " UNION ALL ".join(out)


def _trace(films, ad, st):
    stages = {tuple(s.split("_")): df for s, df in derived.four_stages(ad, st).items()}
    return compare.trace(films, {"ad": ad.clean, "st": st.clean}, stages)


@query("lineage_lookup", f"WITH {sql.BOTH}, {_TOP} {_trace_sql('top')}")
def lineage_lookup(spark, d):
    ad, st = derived.both_sides(spark, d)
    return _trace(merge.ranked(st.final).limit(1), ad, st)


@query(
    "lineage_missed",
    f"WITH {sql.BOTH}, missed AS (SELECT * FROM st_films_k WHERE entity_key NOT IN"
    f" (SELECT entity_key FROM ad_films_k)) {_trace_sql('missed')}",
)
def lineage_missed(spark, d):
    ad, st = derived.both_sides(spark, d)
    return _trace(compare.only_in(st.final, ad.final), ad, st)


_PREVIEW = ["title", "genres", "release_year", "rating_metacritic"]


@query(
    "pair_preview",
    f"WITH {_PAIRS} SELECT entity_key, " + ", ".join(
        [_number(f"{c}_{s}") for c in _PREVIEW for s in ("ad", "st")] + [f"{c}_eq" for c in _PREVIEW]
        + [f"round(CAST({c}_ad AS DOUBLE) - CAST({c}_st AS DOUBLE), 6) AS {c}_delta" for c in _PREVIEW[2:]]
    ) + " FROM p ORDER BY entity_key LIMIT 20",
)
def pair_preview(spark, d):
    shown = compare.pair_preview(_pairs(spark, d), _PREVIEW, _PREVIEW[2:], 20)
    sides = {c: F.col(c).cast("double") for c in ("rating_metacritic_ad", "rating_metacritic_st")}
    return flat(shown.withColumns(sides))


@query(
    "confusion_cells",
    f"WITH {sql.BOTH}, a AS (SELECT DISTINCT entity_key AS k FROM ad_films_k), s AS (SELECT DISTINCT"
    " entity_key AS k FROM st_films_k), j AS (SELECT a.k AS x, s.k AS y FROM a FULL JOIN s ON a.k = s.k)"
    " SELECT true AS in_result, true AS in_truth, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS films FROM j"
    " UNION ALL SELECT true, false, count(*) FILTER (y IS NULL) FROM j"
    " UNION ALL SELECT false, true, count(*) FILTER (x IS NULL) FROM j UNION ALL SELECT false, false, 0",
)
def confusion_cells(spark, d):
    return compare.confusion_cells(compare.match_metrics(*derived.finals(spark, d)))
