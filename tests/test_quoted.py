"""CSV rows with quoted newlines, cut at true ends whatever the file blocks are."""

import csv
import random

import pytest

from ratefuse.plans import fuse
from ratefuse.sources import quoted, readers, specs


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("6000", "100")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def texts(rng):
    return rng.choice([
        "plain", "", 'says "so", twice', "two\nlines", "a,b,c", "\n\n", '"', 'x"y', "é\r\nü",
        "long " * rng.randrange(900), "line\n" * rng.randrange(1200), "ends\n", ',"\n",',
    ])


def test_rows_equal_a_sequential_reader(spark, tmp_path, small_blocks):
    rng = random.Random(3)
    want, n = [], 0
    for k in range(3):
        rows = [[str(i), texts(rng), texts(rng), texts(rng)] for i in range(60)]
        with open(tmp_path / f"f{k}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["k", "a", "b", "c"])
            for row in rows:
                if rng.random() < 0.1:
                    out.writerow([*row, "too", "long"])
                    f.write("\n")
                    continue
                if rng.random() < 0.1:
                    row = row[:2]
                out.writerow(row)
                n += 1
                want.append((n, *[v or None for v in row], *[None] * (4 - len(row))))
    path = str(tmp_path / "*.csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 12
    got = quoted.read_quoted(spark, path, ["k", "a", "b", "c"]).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == want
    with pytest.raises(Exception):
        quoted.read_quoted(spark, path, ["k", "a", "b", "c"], strict=True).collect()


def test_a_source_of_many_blocks(spark, tmp_path, small_blocks):
    path, c = str(tmp_path / "rt.csv"), specs.ROTTEN_TOMATOES_COLUMNS
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(c)
        for i in range(300):
            values = {"movie_title": f"Film {i}", "original_release_date": "1999-03-31",
                      "tomatometer_rating": "50", "movie_info": "one,\n\"two\"\n" * (i % 40)}
            out.writerow([values.get(name, "") for name in c])
    config = fuse.RunConfig(str(tmp_path / "o"), {"rt_audience": {"file_path": path}}, "r", 2026)
    rows, _ = fuse.parse_configured(spark, config)
    assert [(r.row_id, r.title, r.reason) for r in rows.orderBy("row_id").collect()] == [
        (i + 1, f"film {i}", None) for i in range(300)
    ]


def test_states_of_blocks():
    ends = [("b", 0, False, False, True), ("a", 0, True, False, True), ("a", 9, False, True, False),
            ("a", 12, False, True, True), ("a", 20, False, False, True), ("a", 30, False, True, True)]
    assert quoted.open_rows(ends) == {
        ("a", 0): None, ("a", 9): 0, ("a", 12): 0, ("a", 20): 12, ("a", 30): None, ("b", 0): None,
    }


def test_an_empty_file_has_no_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n")
    assert readers.read_csv(spark, str(tmp_path / "e.csv"), multi_line=True).collect() == []
