"""Operators against plain Python on small tables, hot keys and row order included."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ratefuse.operators import analyze, clean, cluster, compare, keyed, merge, score, validate
from ratefuse.operators.quantiles import quantile_table

PARSED = (
    "source string, row_id long, id long, title string, title_raw string, year int,"
    " release_date date, genres array<string>, rating double, reason string"
)


def parsed_rows(n=400, seed=1, hot=0.4):
    """Rows of which a large share has one (source, title, year)."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["imdb", "metacritic", "movielens", "rt_audience"])
        title, year = f"t{rng.randint(0, 9)}", rng.choice([None, *range(1990, 2000)])
        if rng.random() < hot:
            source, title, year = "imdb", "hot", 1999
        reason = "invalid year" if year is None else rng.choice([None, None, "missing rating"])
        rating = rng.choice([None, float(rng.randint(0, 10))])
        genres = rng.choice([[], ["a"], ["b", "c"]])
        rows.append((source, i, i, title, title.upper(), year, None, genres, rating, reason))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("claim", ["before", "after"])
def test_routing(spark, claim):
    rows = parsed_rows()
    owner, want = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        key, reason = (r[0], r[3], r[5]), r[9]
        if claim == "after" and reason:
            want[r[1]] = "invalid"
        elif key in owner:
            want[r[1]] = "duplicate"
        else:
            owner[key] = r[1]
            want[r[1]] = "invalid" if reason else "clean"
    df = spark.createDataFrame(rows, PARSED)
    routed = {r.row_id: r.kind for r in clean.route(df, claim).collect()}
    assert routed == want
    kept = {r.row_id for r in clean.keep_clean(df, claim).collect()}
    assert kept == {i for i, k in want.items() if k == "clean"}


def test_rows_without_a_year_have_no_key(spark):
    rows = [("movielens", i, i, "x", "x", None, None, [], 1.0, clean.MISSING_YEAR) for i in range(3)]
    kinds = [r.kind for r in clean.route(spark.createDataFrame(rows, PARSED)).collect()]
    assert kinds == ["invalid"] * 3


def plain_clusters(years, base):
    known = sorted({y for y in years if y is not None})
    out, current = {}, base
    for i, y in enumerate(known):
        if i and y - known[i - 1] > 1:
            current += 1
        out[y] = current
    out[None] = current + 1 if known else base
    return out


@pytest.mark.parametrize("base", [0, 1])
def test_year_clusters(spark, base):
    rng = random.Random(3)
    titles = {f"t{i}": [rng.choice([None, *range(1980, 2000)]) for _ in range(8)] for i in range(40)}
    titles["only null"] = [None]
    titles["chain"] = [1990, 1991, 1992, 1995, None]
    rows = [(t, y) for t, ys in titles.items() for y in ys]
    df = cluster.distinct_years(spark.createDataFrame(rows, "title string, year int"), "title")
    got = {(r.title, r.year): r.year_cluster
           for r in cluster.year_clusters(df, "title", base=base).collect()}
    want = {(t, y): plain_clusters(ys, base)[y] for t, ys in titles.items() for y in ys}
    assert got == want


@pytest.mark.parametrize("hot_rows", [10, 10**9])
def test_lookup_splits_hot_keys_and_matches_nulls(spark, hot_rows):
    rows = [(i, None if i % 3 == 0 else i % 7) for i in range(300)] + [(i, 5) for i in range(300, 700)]
    table = [(None, "none"), (1, "one"), (5, "five")]
    left = spark.createDataFrame(rows, "id long, k int")
    right = spark.createDataFrame(table, "k int, v string")
    for how in ("left", "inner"):
        got = keyed.lookup_by_key(left, right, ["k"], ["id"], how, hot_rows=hot_rows)
        values = dict(table)
        want = Counter((i, k, values.get(k)) for i, k in rows if how == "left" or k in values)
        assert Counter(tuple(r) for r in got.select("id", "k", "v").collect()) == want


def test_lookup_with_many_hot_keys(spark):
    left = spark.createDataFrame([(i, i % 10) for i in range(500)], "id long, k int")
    right = spark.createDataFrame([(k, str(k)) for k in range(9)], "k int, v string")
    got = keyed.lookup_by_key(left, right, ["k"], ["id"], "inner", hot_rows=10)
    assert sorted((r.id, r.v) for r in got.collect()) == [
        (i, str(i % 10)) for i in range(500) if i % 10 < 9
    ]


def test_parts_follow_the_rows_of_a_key(spark):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(i, None if i < 900 else i) for i in range(1000)]  # one key has 90 % of the rows
    left = spark.createDataFrame(rows, "id long, k int")
    even = -(-1000 // tasks)
    for hot_rows in (1, 10, 400, 2000):
        got = [tuple(r) for r in keyed.heavy_keys(left, ["k"], hot_rows).collect()]
        parts = -(-900 // max(even, hot_rows))
        assert got == ([(None, parts)] if parts > 1 else [])
    assert keyed.heavy_keys(left.limit(0), ["k"], 1).collect() == []
    marks = spark.createDataFrame([(None, "most"), (950, "one")], "k int, v string")
    found = keyed.lookup_by_key(left, marks, ["k"], ["id"], "inner", hot_rows=1)
    assert {r.id for r in found.collect()} == {*range(900), 950} and found.count() == 901


def test_flag_duplicates(spark):
    rows = [(i, f"k{i % 5 if i < 50 else i}") for i in range(60)]
    got = keyed.flag_duplicates(spark.createDataFrame(rows, "id long, k string"), ["k"], ["id"])
    assert {r.id for r in got.collect()} == set(range(50))


def test_dense_row_id(spark):
    keys = random.Random(5).sample(range(-5000, 5000), 700)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.row_id for r in keyed.dense_row_id(df, "k").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("n,bins", [(7, 1024), (20_000, 1024), (500, 32)])
def test_quantiles(spark, n, bins):
    import numpy as np

    rng = np.random.default_rng(2)
    skewed = np.where(rng.random(n) < 0.4, 5.0, np.exp(rng.normal(0, 6, n)))
    wide = rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n)
    uniform = rng.random(n)
    df = spark.createDataFrame(
        [(float(a), float(b) if i % 5 else None, float(c), float("nan"))
         for i, (a, b, c) in enumerate(zip(skewed, uniform, wide))],
        "a double, b double, c double, d double",
    )
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = quantile_table(df, ["a", "b", "c", "d"], probs, bins).collect()
    known = {"a": skewed, "b": np.array([b for i, b in enumerate(uniform) if i % 5]), "c": wide}
    assert len(got) == 4 * len(probs)
    for r in got:
        if r.name == "d":
            assert (r.n, r.value) == (0, None)
            continue
        assert r.value == pytest.approx(np.quantile(known[r.name], r.prob), rel=1e-12)
        assert r.n == len(known[r.name])


def test_quantiles_of_infinities_whole_numbers_and_nothing(spark):
    inf = float("inf")
    rows = [(-inf, 1), (-1.7e308, 2), (0.0, 3), (1.7e308, 3), (inf, None), (None, None)]
    df = spark.createDataFrame(rows, "x double, k int")
    got = {(r.name, r.prob): r.value for r in quantile_table(df, ["x", "k"], [0.0, 0.25, 0.5, 1.0]).collect()}
    assert [got["x", p] for p in (0.0, 0.25, 0.5, 1.0)] == [-inf, -1.7e308, 0.0, inf]
    assert [got["k", p] for p in (0.0, 0.25, 0.5, 1.0)] == [1.0, 1.75, 2.5, 3.0]
    assert [r.value for r in quantile_table(df.limit(0), ["x"], [0.5]).collect()] == [None]


def test_quantile_rounds_send_one_row_a_bin(spark, monkeypatch):
    from ratefuse.operators import quantiles

    sent = []
    counted = quantiles._counted

    def seen(values, brackets, scale, bins):
        out = counted(values, brackets, scale, bins)
        sent.append((len(brackets), max(map(len, out))))
        return out

    monkeypatch.setattr(quantiles, "_counted", seen)
    df = spark.range(50_000).selectExpr("cast(id * id as double) x")
    assert quantiles.quantile_values(df, ["x"], [0.5])["x", 0.5][1] == (24999**2 + 25000**2) / 2
    assert len(sent) <= 5 and all(k <= 2 and rows <= quantiles.BINS for k, rows in sent)


def test_outliers(spark):
    values = [1.0, 2.0, 2.0, 3.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v, 7.0) for v in values], "x double, flat double")

    def treated(method, **k):
        return sorted(
            (r.x is None, r.x, r.flat)
            for r in score.treat_outliers(df, ["x", "flat"], method, **k).collect()
        )

    high = 3.5 + 1.5 * 1.5
    assert treated("cap") == sorted((False, min(v, high), 7.0) for v in values)
    assert [t[1] for t in treated("nan") if not t[0]] == values[:-1]
    assert treated("none") == sorted((False, v, 7.0) for v in values)
    assert max(t[1] for t in treated("percentile_cap", lower=0.0, upper=0.5)) == 3.0
    assert treated("percentile_cap", lower=0.9, upper=0.1) == treated("none")
    with pytest.raises(ValueError):
        score.treat_outliers(df, ["x"], "other")


def plain_merge(rows, base):
    """Wide rows by the definition, from clean rows in any order."""
    by_title = defaultdict(list)
    for r in rows:
        by_title[r[3]].append(r)
    out = {}
    for title, members in by_title.items():
        clusters = plain_clusters([m[5] for m in members], base)
        for c in set(clusters[m[5]] for m in members):
            group = sorted((m for m in members if clusters[m[5]] == c), key=lambda m: (m[0], m[1]))
            film = {"genres": next((m[7] for m in group if m[7]), [])}
            for s in merge.ID_COLUMNS:
                own = [m for m in group if m[0] == s]
                film[f"id_{s}"] = own[0][2] if own else None
                film[f"rating_{s}"] = next((m[8] for m in own if m[8] is not None), None)
            years = [m[5] for m in group if m[5] is not None]
            film["year"] = min(years) if years else None
            out[title, c] = film
    return out


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_merge(spark, partitions):
    rows = [r for r in parsed_rows(600, 9) if r[9] is None]
    rows += [("imdb", 10_000, 10_000, "t1", "T1", None, None, ["z"], 3.0, None)]
    df = spark.createDataFrame(rows, PARSED).drop("reason").repartition(int(partitions))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        wide = merge.merge_long(merge.with_group_title(df), list(merge.ID_COLUMNS)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain_merge(rows, 0)
    assert len(wide) == len(want)
    for r in wide:
        film = want[r.norm_title, r.year_cluster]
        assert r.release_year == film["year"] and r.genres == film["genres"]
        for s, i in merge.ID_COLUMNS.items():
            assert r[i] == film[f"id_{s}"] and r[f"rating_{s}"] == film[f"rating_{s}"]


def test_unify_by_signature(spark):
    rows = [(1, "s", "aa", 2001), (2, "s", "aa", 1999), (3, "s", "bbb", None), (4, "u", "c", 1990),
            (5, "", "d", 1980), (6, "", "e", 1981)]
    df = spark.createDataFrame(rows, "row_id long, film_sig string, norm_title string, year int")
    got = cluster.unify_by_signature(df, "film_sig", ["row_id"]).collect()
    assert {(r.row_id, r.norm_title, r.year) for r in got} == {
        (1, "aa", 1999), (2, "aa", 1999), (3, "aa", 1999), (4, "c", 1990), (5, "d", 1980),
        (6, "e", 1981),
    }


def test_validation(spark):
    rows = [("a", 2000, 5.0), ("a", 2000, 11.0), ("b", None, None), ("c", 1700, 3.0)]
    df = spark.createDataFrame(rows, "title string, year int, rating_imdb double")
    found = {(r.check, r.column): r.n_bad for r in validate.validate_table(df, "t", 2026).collect()}
    assert found == {("year", "year"): 2, ("range", "rating_imdb"): 1, ("duplicate", "title,year"): 2}
    assert validate.invalid_rows(df, 2026).count() == 3
    empty = validate.validate_table(df.limit(0), "t", 2026).collect()
    assert [r.check for r in empty] == ["empty"]
    bare = validate.validate_table(df.select("rating_imdb"), "t", 2026, ["genres"]).collect()
    assert {(r.check, r.column) for r in bare} == {
        ("required", "genres"), ("required", "title"), ("required", "year"), ("range", "rating_imdb"),
    }
    with pytest.raises(ValueError):
        validate.validate_or_raise(df, "t", 2026)
    custom = validate.validate_table(df, "t", 2026, ranges={"nope": (0, 1), "title": (0, 1)})
    assert {("rating", "nope"), ("type", "title")} <= {(r.check, r.column) for r in custom.collect()}


SPEC_ROWS = "ID long, title string, release_year int, genres array<string>, rating double"


def test_schema_policies(spark):
    rows = [(1, "a", 2000, [], 1.0), (2, "a", 2000, [], 2.0), (3, "B!", None, [], 1.0),
            (4, "", 1700, [None], None)]
    df = spark.createDataFrame(rows, SPEC_ROWS)
    checked = {r.ID: r for r in validate.check_schema(df).collect()}
    assert checked[1].errors == [] and checked[2].errors == [validate.ERR_DUPLICATE]
    assert checked[3].errors == [validate.ERR_DIRTY]
    assert checked[4].errors == [
        validate.ERR_TITLE, validate.ERR_YEAR, validate.ERR_GENRES, validate.ERR_RATING,
    ]
    first = validate.check_schema(df, validate.RulePolicy(all_errors=False)).filter("ID = 4").first()
    assert first.errors == [validate.ERR_TITLE]

    def kept(**policy):
        p = validate.RulePolicy(**policy)
        return {(r.ID, r.title) for r in validate.valid_rows(validate.check_schema(df, p), p).collect()}

    assert kept(on_duplicate="drop") == {(1, "a")}
    assert kept(on_duplicate="count") == {(1, "a"), (2, "a")}
    assert kept(on_duplicate="drop", on_dirty_title="rewrite") == {(1, "a"), (3, "b")}
    assert kept(on_null_year="error", on_dirty_title="rewrite", on_duplicate="drop") == {(1, "a")}
    with pytest.raises(AssertionError):
        validate.fail_on_errors(validate.check_schema(df))


def test_compare_with_copies_and_empty_sides(spark):
    schema = "ID_IMDB string, ID_RT string, title string, rating_imdb double"
    a = compare.with_keys(spark.createDataFrame(
        [("1.0", None, "x", 1.0), ("2", "7", "y", 2.0), (None, None, "z", None),
         (None, None, "z", None)], schema))
    b = compare.with_keys(spark.createDataFrame(
        [("1", None, "x", 3.0), (None, None, "q", None), (None, None, "q", None)], schema))
    m = compare.match_metrics(a, b).first()
    assert (m.tp, m.fp, m.fn, m.precision, m.recall) == (2, 1, 0, 0.6667, 1.0)
    assert compare.only_in(a, b).count() == 1 and compare.in_both(a, b).count() == 3
    pairs = compare.paired(a, b, ["title", "rating_imdb"])
    assert pairs.count() == 2
    found = {r.field: r.mismatches for r in compare.field_mismatch(pairs, ["title", "rating_imdb"]).collect()}
    assert found == {"title": 1, "rating_imdb": 1}
    none = compare.match_metrics(a.limit(0), b.limit(0)).collect()
    assert none == []


def test_histogram_counts_no_nulls(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 1.0), (None, 1.0), (5.0, None)], "x double, c double")
    got = {(r.name, r.bin): r.rows for r in analyze.histogram(df, ["x", "c"], 20).collect()}
    assert got == {("x", 1): 1, ("x", 11): 1, ("x", 20): 1, ("c", 1): 3}


def test_stages_fold_empty_triples(spark):
    df = compare.with_keys(spark.createDataFrame(
        [("1", "avp x"), ("2", "other")], "ID_IMDB string, title string"))
    stages = {s: df for s in ("ad_wide", "st_wide")} | {s: df.limit(0) for s in ("ad_final", "st_final")}
    got = compare.stage_titles_lost(stages, "avp").collect()
    assert [tuple(r) for r in got] == [("NA|NA|NA", "adaptive_lost")]
    paired = compare.pair_triples(stages).first()
    assert (paired.rows_ad_wide, paired.rows_st_final) == (2, 0)


def test_fixed_rescale_and_scores(spark):
    df = spark.createDataFrame(
        [(7.0, 4.0, 60.0, None), (5.0, None, None, None)],
        "rating_imdb double, rating_movielens double, rating_metacritic double, rating_rt_audience double",
    )
    rows = score.score(df).orderBy(F.col("num_available_ratings").desc()).collect()
    assert rows[0].superscore_mean == 7.0 and rows[0].superscore_median == 7.0
    assert rows[1].superscore_mean is None and rows[1].num_available_ratings == 1
    assert score.keep_scored(score.score(df)).count() == 1
