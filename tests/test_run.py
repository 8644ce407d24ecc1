"""Readers, sinks and the whole run on small files."""

import csv
import hashlib
import json

import pytest

from ratefuse.operators import validate
from ratefuse.plans import fuse, reports
from ratefuse.sources import readers, specs, writers


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def test_csv_keeps_short_rows_and_skips_long_ones(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('a,b,c\n1,"x ""q"", y",3\n4,5\n6,7,8,9\n1,2,,4\n"p,q",5\n10,11,12\n')
    rows = [tuple(r) for r in readers.read_csv(spark, path).collect()]
    assert rows == [("1", 'x "q", y', "3"), ("4", "5", None), ("p,q", "5", None), ("10", "11", "12")]
    assert readers.read_csv(spark, path).select("a").count() == 4
    numbered = readers.with_file_row_id(readers.read_csv(spark, path)).collect()
    assert sorted((r.row_id, r.a) for r in numbered) == [(1, "1"), (2, "4"), (3, "p,q"), (4, "10")]
    with pytest.raises(Exception):
        readers.read_csv(spark, path, strict=True).collect()


def test_row_ids_follow_file_order_over_blocks(spark, tmp_path):
    path = str(tmp_path / "many.csv")
    write_csv(path, ["k", "v"], [(i, "x" * 20) for i in range(5000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.with_file_row_id(readers.read_csv(spark, path))
        assert rows.rdd.getNumPartitions() > 1
        assert all(r.row_id == int(r.k) + 1 for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_directory_scan(spark, tmp_path):
    for name in ("imdb_data", "x_duplicates", "all_movies_wide"):
        write_csv(tmp_path / f"{name}.csv", ["ID", "title"], [(1, name)])
    write_csv(tmp_path / "other.csv", ["title", "year", "ID", "extra"], [("x", 2001, 7, "y")])
    found = readers.read_directory(spark, str(tmp_path / "*.csv"), ["ID", "title", "rating"])
    rows = {(r.source, r.ID, r.title, r.rating, r.year, r.extra) for r in found.collect()}
    assert rows == {
        ("imdb_data", "1", "imdb_data", None, None, None), ("other", "7", "x", None, "2001", "y"),
    }
    none = readers.read_directory(spark, str(tmp_path / "*_duplicates.csv"), ["ID"])
    assert none.columns == ["ID", "source"] and none.isEmpty()


def test_inventory(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    row = readers.file_inventory(spark, str(tmp_path / "*.bin")).first()
    assert tuple(row) == (hashlib.sha256(b"abc").hexdigest(), "f.bin", 3)


def test_csv_sink_writes_arrays_as_json(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_table(spark.createDataFrame([(1, ["a", "b"])], "i int, g array<string>"), path, "csv")
    row = readers.read_csv(spark, path + "/*.csv").first()
    assert (row.i, json.loads(row.g)) == ("1", ["a", "b"])


def sources(tmp_path):
    imdb, meta, ml, rt = (str(tmp_path / f"{n}.csv") for n in ("imdb", "meta", "ml", "rt"))

    def row(columns, **values):
        return [values.get(c, "") for c in columns]

    c = specs.IMDB_COLUMNS
    write_csv(imdb, c, [
        row(c, originalTitle="The Matrix", release_date="March 31, 1999", averageRating="8.7", genres="Action,Sci-Fi"),
        row(c, originalTitle="The Matrix", release_date="March 1, 1999", averageRating="1.0"),
        row(c, originalTitle="Nowhere", release_date="", averageRating="5.0"),
        row(c, originalTitle="Solo", release_date="2018", averageRating="6.9"),
    ])
    c = specs.METACRITIC_COLUMNS
    write_csv(meta, c, [
        row(c, movie_title="THE MATRIX!", release_date="31-Mar-99", metascore="73", userscore="8.8", genre="Action"),
        row(c, movie_title="Bad", release_date="x", metascore="10", userscore="tbd"),
    ])
    c = specs.MOVIELENS_COLUMNS
    write_csv(ml, c, [
        row(c, movieId="1", title="The Matrix (1998)", genres="Action|Thriller", average_rating="4.5"),
        row(c, movieId="2", title="Death Note (2006–2007)", genres="Action", average_rating="4"),
        row(c, movieId="3", title="Solo (2018)", genres="Action", average_rating="3.0"),
    ])
    c = specs.ROTTEN_TOMATOES_COLUMNS
    write_csv(rt, c, [
        row(c, movie_title="The Matrix", original_release_date="1999-03-31", tomatometer_rating="83",
            movie_info="two\nlines", genres="Action & Adventure, Drama"),
    ])
    return {
        "imdb": {"file_path": imdb}, "metacritic": {"file_path": meta},
        "movielens": {"file_path": ml}, "rt_audience": {"file_path": rt},
        "unknown": {"file_path": rt}, "later": {"file_path": "/nowhere.csv"},
    }


@pytest.mark.parametrize("dialect", ["static", "adaptive"])
def test_run(spark, tmp_path, dialect):
    config = fuse.RunConfig(str(tmp_path / "out"), sources(tmp_path), "r1", 2026, dialect)
    paths = fuse.run(spark, config)
    final = {r.title: r for r in spark.read.parquet(paths["final"]).collect()}
    assert set(final) == {"the matrix", "solo"}
    film = final["the matrix"]
    assert (film.ID_IMDB, film.ID_METACRITIC, film.ID_MOVIELENS, film.ID_RT) == (1, 1, 1, 1)
    assert film.release_year == 1998 and film.genres == ["Action", "Sci-Fi"]
    if dialect == "static":
        assert film.superscore_mean == pytest.approx((8.7 + 9.0 + 7.3 + 8.3) / 4)
    rejects = {(r.source, r.kind, r.reason) for r in spark.read.parquet(paths["rejects"]).collect()}
    assert ("imdb", "duplicate", "duplicate title+year") in rejects
    assert ("imdb", "invalid", "invalid year") in rejects
    assert ("movielens", "invalid", "missing year" if dialect == "static" else "invalid year") in rejects
    assert spark.read.schema(validate.FINDING).json(paths["findings"]).isEmpty()
    assert spark.read.parquet(paths["duplicates"] + "/cleaned").isEmpty()
    summary = spark.read.json(paths["summary"]).first()
    assert summary.films == 2 and summary.run_id == "r1"
    stages = readers.load_stages(spark, {"final": paths["final"], "none": str(tmp_path / "none")})
    assert set(stages) == {"final"}


def test_films_and_single_ratings(spark, tmp_path):
    movies, ratings = str(tmp_path / "m.csv"), str(tmp_path / "r.csv")
    write_csv(movies, ["movieId", "title", "genres"], [(1, "A (2000)", "x"), (2, "B (2001)", "y")])
    write_csv(ratings, ["movieId", "rating"], [(1, 4), (1, 5), (1, 4)])
    config = fuse.RunConfig(
        str(tmp_path), {"movielens": {"movies_path": movies, "ratings_path": ratings}}, "r", 2026
    )
    rows, names = fuse.parse_configured(spark, config)
    assert names == ["movielens"]
    assert {(r.title, r.rating, r.reason) for r in rows.collect()} == {
        ("a", 4.33, None), ("b", None, "missing rating"),
    }


def test_latest_year_is_an_option(spark, tmp_path):
    path = str(tmp_path / "ml.csv")
    rows = [(k, f"Film {k} ({y})", "x", 3, 1) for k, y in enumerate((2025, 2026, 2027), 1)]
    write_csv(path, specs.MOVIELENS_COLUMNS, rows)
    kept = {}
    for options in ({}, {"last_year": 2026}):
        config = fuse.RunConfig(str(tmp_path), {"movielens": {"file_path": path}}, "r", 2026, **options)
        parsed, _ = fuse.parse_configured(spark, config)
        kept[len(options)] = {r.year for r in parsed.filter("reason IS NULL").collect()}
    assert kept == {0: {2025}, 1: {2025, 2026}}


def test_nothing_left_fails(spark, tmp_path):
    path = str(tmp_path / "ml.csv")
    write_csv(path, specs.MOVIELENS_COLUMNS, [(1, "No year", "x", 3, 1)])
    config = fuse.RunConfig(str(tmp_path / "o"), {"movielens": {"file_path": path}}, "r", 2026)
    with pytest.raises(ValueError):
        fuse.run(spark, config)


def test_reports_of_two_runs(spark, tmp_path):
    """One film of the first source comes without, then with a rating: only the static
    run keeps the first row, so the film has one rating there and is filtered."""
    files = sources(tmp_path)
    with open(files["imdb"]["file_path"], encoding="utf-8") as f:
        lines = list(csv.reader(f))
    unrated = list(lines[4])
    unrated[lines[0].index("averageRating")] = ""
    write_csv(files["imdb"]["file_path"], lines[0], [*lines[1:4], unrated, lines[4]])
    results = {}
    for dialect in ("static", "adaptive"):
        config = fuse.RunConfig(str(tmp_path / dialect), files, "r", 2026, dialect)
        paths = fuse.run(spark, config)
        stages = readers.load_stages(spark, {s: paths[s] for s in ("cleaned", "wide", "final")})
        results[dialect] = reports.Result(*stages.values())
    tables = reports.compare_results(results["adaptive"], results["static"])
    overall = tables["summary"].filter("scope = 'entity_key_overall'").first()
    assert (overall.tp, overall.fp, overall.fn) == (1, 1, 0)
    assert {k: t.count() for k, t in tables.items()} == {
        "summary": 5, "false_negatives": 0, "false_positives": 1, "id_conflicts": 0, "pairs": 1,
        "field_mismatch": 9, "triples": 2, "stage_loss": 1, "confusion": 4, "preview": 1, "lineage": 0,
    }
    assert tables["false_positives"].first().root_cause == (
        "static_filtered_or_postmerge_change(count_ratings=1);imdb_conflict_adaptive_vs_static"
    )
    analysis = reports.analyze_result(results["static"].clean, results["static"].final)
    assert all(t.count() > 0 for t in analysis.values())
    assert {r.source: r.found for r in analysis["coverage"].collect()}["movielens"] == 1


def test_sources_are_checked_by_themselves(spark):
    rows = spark.createDataFrame(
        [("imdb", 1, "a", 2000, 99.0), ("metacritic", 1, "a", 2000, 99.0), ("imdb", 2, "b", 1700, 5.0),
         ("imdb", 3, "c", 2001, None), ("imdb", 4, "c", 2001, float("nan")), ("new", 1, "c", 2001, 11.0)],
        "source string, row_id long, title string, year int, rating double",
    )
    found = validate.validate_by_source(rows, "t", 2026).collect()
    assert {(f.df_name, f.check, f.n_bad) for f in found} == {
        ("t/imdb", "range", 1), ("t/imdb", "year", 1), ("t/imdb", "duplicate", 2), ("t/new", "range", 1),
    }
    bad = {(r.source, r.row_id) for r in validate.invalid_by_source(rows, 2026).collect()}
    assert bad == {("imdb", 1), ("imdb", 2), ("new", 1)}


def test_run_twice_replaces_its_results(spark, tmp_path):
    path = str(tmp_path / "ml.csv")
    write_csv(path, specs.MOVIELENS_COLUMNS, [(1, "No year", "x", 3, 1), (2, "A (2000)", "x", 4, 1)])
    config = fuse.RunConfig(
        str(tmp_path / "o"), {"movielens": {"file_path": path}}, "2025-09-01", 2026, min_ratings=1
    )
    for _ in range(2):
        paths = fuse.run(spark, config)
    assert spark.read.parquet(paths["rejects"]).count() == 1
    assert spark.read.json(paths["summary"]).count() == 1


def test_null_genres_break_the_rule(spark):
    rows = spark.createDataFrame(
        [(1, "a", 2000, None, 1.0)],
        "ID long, title string, release_year int, genres array<string>, rating double",
    )
    assert validate.check_schema(rows).first().errors == [validate.ERR_GENRES]


def test_rule_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([{"field": "rating", "type": "float", "rule": "never NaN"}], indent=1))
    rules = readers.read_rules(spark, str(path))
    assert rules == [{"field": "rating", "type": "float", "rule": "never NaN"}]
    rows = spark.createDataFrame(
        [(1, "", 2000, [], float("nan"))],
        "ID long, title string, release_year int, genres array<string>, rating double",
    )
    assert validate.check_schema(rows, spec=rules).first().errors == [validate.ERR_RATING]


def test_a_source_that_fails_while_read_stops_no_other(spark, tmp_path):
    files = {k: v for k, v in sources(tmp_path).items() if k in ("imdb", "movielens", "unknown", "later")}
    with open(files["movielens"]["file_path"], "a", encoding="utf-8") as f:
        f.write("9,Too long (2001),x,4.0,1,2,3\n")
    config = fuse.RunConfig(str(tmp_path / "out"), files, "r1", 2026, min_ratings=1)
    paths = fuse.run(spark, config)
    final = {r.title: r for r in spark.read.parquet(paths["final"]).collect()}
    assert set(final) == {"the matrix", "solo"} and final["solo"].rating_movielens is None
    failed = {r.df_name: r for r in spark.read.json(paths["failures"]).collect()}
    assert set(failed) == {"movielens", "unknown", "later"}
    assert failed["movielens"].check == "source" and failed["movielens"].run_id == "r1"
    summary = spark.read.json(paths["summary"]).first()
    assert sorted(summary.failed) == ["later", "movielens", "unknown"]
    assert [s.source for s in summary.sources] == ["imdb"]


def test_rejects_keep_every_raw_column(spark, tmp_path):
    paths = fuse.run(spark, fuse.RunConfig(str(tmp_path / "o"), sources(tmp_path), "r", 2026))
    rejects = spark.read.parquet(paths["rejects"]).collect()
    found = {(r.source, r.row_id): json.loads(r.record) for r in rejects}
    columns = {"imdb": specs.IMDB_COLUMNS, "metacritic": specs.METACRITIC_COLUMNS,
               "movielens": specs.MOVIELENS_COLUMNS}
    assert {s for s, _ in found} == set(columns)
    assert all(list(record) == columns[s] for (s, _), record in found.items())
    assert found["metacritic", 2]["userscore"] == "tbd"
    assert found["imdb", 3]["originalTitle"] == "Nowhere" and found["imdb", 3]["release_date"] is None


def test_counts_of_the_run_agree_with_the_stage(spark, tmp_path):
    from ratefuse.operators import clean

    paths = fuse.run(spark, fuse.RunConfig(str(tmp_path / "o"), sources(tmp_path), "r", 2026))
    counted = clean.stage_counts(spark.read.parquet(paths["routed"])).orderBy("source").collect()
    summary = spark.read.json(paths["summary"]).first()
    assert [r.asDict() for r in summary.sources] == [r.asDict() for r in counted]
    assert summary.films == spark.read.parquet(paths["merged"]).count()


def test_final_films_lie_in_order(spark, tmp_path):
    from ratefuse.operators import merge

    path = str(tmp_path / "ml.csv")
    rows = [(i, f"Film {i * 7919 % 500} ({1950 + i * 31 % 60})", "x", 1 + i % 5, 1) for i in range(500)]
    write_csv(path, specs.MOVIELENS_COLUMNS, rows)
    config = fuse.RunConfig(str(tmp_path / "o"), {"movielens": {"file_path": path}}, "r", 2026, min_ratings=1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = fuse.run(spark, config)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spark.read.parquet(paths["final"]).inputFiles()) > 1
    assert readers.order_breaks(spark, paths["final"], merge.rank_key).isEmpty()
    mixed = str(tmp_path / "mixed")
    spark.read.parquet(paths["final"]).orderBy("title").write.parquet(mixed)
    assert not readers.order_breaks(spark, mixed, merge.rank_key).isEmpty()


def test_shared_ids_give_one_title(spark, tmp_path):
    files = {k: v for k, v in sources(tmp_path).items() if k in ("imdb", "movielens")}
    for key, column, value in (("imdb", "id", "tt1"), ("movielens", "movieId", "tt1")):
        path = files[key]["file_path"]
        with open(path, encoding="utf-8") as f:
            header, first, *rest = list(csv.reader(f))
        first[header.index(column)] = value
        if key == "movielens":
            first[header.index("title")] = "Die Matrix (1999)"
        write_csv(path, header, [first, *rest])
    plain = fuse.RunConfig(str(tmp_path / "a"), files, "r", 2026)
    assert "matrix" not in {r.norm_title for r in spark.read.parquet(fuse.run(spark, plain)["wide"]).collect()
                            if r.rating_imdb and r.rating_movielens}
    shared = {"imdb": files["imdb"] | {"shared_id": "id"}, "movielens": files["movielens"] | {"shared_id": "movieId"}}
    paths = fuse.run(spark, fuse.RunConfig(str(tmp_path / "b"), shared, "r", 2026))
    film = {r.norm_title: r for r in spark.read.parquet(paths["wide"]).collect()}["the matrix"]
    assert (film.ID_IMDB, film.ID_MOVIELENS, film.release_year) == (1, 1, 1999)


def test_a_source_described_by_its_names(spark, tmp_path):
    path = str(tmp_path / "critics.csv")
    header = ["ID_X", "film_title", "released_year", "genres_x", "critic_score", "user_score", "score_count"]
    write_csv(path, header, [
        ("17.0", "The Matrix", "1999", "Action|Sci-Fi", "tbd", "8.5", "3"),
        ("18", "Solo", "2018", "", "61", "4", "3"), ("19", "Unrated", "2001", "x", "", "tbd", "3"),
    ])
    files = sources(tmp_path) | {"critics": {"file_path": path, "discover": True}}
    paths = fuse.run(spark, fuse.RunConfig(str(tmp_path / "o"), files, "r", 2026, "adaptive"))
    film = {r.title: r for r in spark.read.parquet(paths["final"]).collect()}
    assert film["the matrix"].rating_critics == 85 and film["the matrix"].ID_CRITICS == 17
    assert film["solo"].rating_critics == 61 and film["solo"].count_ratings == 3
    assert film["solo"].critics_norm == pytest.approx(6.1)
    reasons = {r.reason for r in spark.read.parquet(paths["rejects"]).collect() if r.source == "critics"}
    assert reasons == {"missing rating"}


def test_names_that_cannot_be_a_source():
    from ratefuse.sources import discover

    with pytest.raises(ValueError, match="title, rating"):
        discover.discover("x", ["a", "rating_count"])
    assert discover.rating_candidates(["score", "rating_a", "rating_b"]) == ["rating_a"]
    assert discover.rating_candidates(["audience_rating", "tomatometer_rating"]) == ["tomatometer_rating"]
