"""Rule texts as checks, and repeated rows with and without an ID."""

import pytest

from ratefuse.operators import rules, validate

ROWS = "ID long, title string, release_year int, genres array<string>, rating double"


def errors(spark, row, spec, schema=ROWS):
    return validate.check_schema(spark.createDataFrame([row], schema), spec=spec).first().errors


@pytest.mark.parametrize("text,bounds", [
    ("value <=2025 & realistic (1870-2025)", (("<=", 2025), (">=", 1870), ("<=", 2025))),
    ("<=1980", (("<=", 1980),)), ("> 0 and < 10.5", ((">", 0), ("<", 10.5))),
    ("between 1 and 5", ((">=", 1), ("<=", 5))), ("-5 to 5", ((">=", -5), ("<=", 5))),
    ("optional", ()),
])
def test_bounds(text, bounds):
    rule = rules.compile_rule("x", "float", text)
    assert rule.bounds == bounds and rule.unknown == ()


def test_a_changed_rule_changes_the_errors(spark):
    row = (1, "a", 1999, [], 5.0)
    for text, found in (("value <=2025 & realistic (1870-2025)", []), ("<=1980", [rules.ERR_YEAR])):
        assert errors(spark, row, [{"field": "release_year", "type": "int64 | pd.NA", "rule": text}]) == found


def test_types_presence_and_cleanliness(spark):
    spec = [
        {"field": "ID", "type": "int64", "rule": "must be preserved unchanged"},
        {"field": "title", "type": "str", "rule": "must not be empty, clean the title so it is presentable"
         " (lowercase, no special characters etc.), prefer the original title"},
        {"field": "release_year", "type": "int64", "rule": ""},
        {"field": "genres", "type": "list[str]", "rule": "optional"},
        {"field": "rating", "type": "float", "rule": "must never be NaN, >= 0"},
    ]
    assert rules.unknown_clauses(rules.compile_rules(spec), [s["field"] for s in spec]) == []
    nan = float("nan")
    assert errors(spark, (None, " ", None, None, nan), spec) == [
        rules.ERR_ID, rules.ERR_TITLE, rules.ERR_YEAR, rules.ERR_GENRES, rules.ERR_RATING,
    ]
    assert errors(spark, (1, "A!", 1, ["x", None], -1.0), spec) == [
        rules.ERR_DIRTY, rules.ERR_GENRES, "rating out of range",
    ]
    texts = "ID string, title string, release_year string, genres string, rating string"
    assert errors(spark, ("1.5", "a", "x", "a,b", "good"), spec, texts) == [
        rules.ERR_ID, "release_year not of type int", rules.ERR_GENRES, "rating not of type float",
    ]
    assert errors(spark, ("2.0", "a", "1999", "a", "1e1"), spec, texts) == [rules.ERR_GENRES]


def test_what_cannot_be_checked_is_reported():
    spec = [{"field": "rating", "type": "decimal", "rule": "> 0, looks plausible"},
            {"field": "nowhere", "type": "str", "rule": "optional"}]
    assert rules.unknown_clauses(rules.compile_rules(spec), ["rating"]) == [
        ("nowhere", "column nowhere is missing"), ("rating", "decimal"), ("rating", "looks plausible"),
    ]


def test_repeated_rows_without_an_id(spark):
    rows = [(None, "a", 2000, [], 1.0), (None, "a", 2000, [], 1.0), (7, "a", 2000, [], 9.0),
            (None, "b", 2000, [], 1.0), (None, "b", 2000, [], 1.0), (None, "b", None, [], 2.0),
            (3, "c", 1, [], 1.0), (3, "c", 1, [], 1.0), (None, "d", 2000, [], None), (None, "d", 2000, [], 4.0)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    found = validate.check_schema(df).collect()
    count = lambda rs: sorted((r.ID or 0, r.title, r.rating or 0.0) for r in rs)
    assert count(r for r in found if not r.is_duplicate) == [
        (0, "b", 1.0), (0, "b", 2.0), (0, "d", 0.0), (3, "c", 1.0), (7, "a", 9.0),
    ]
    assert all((rules.ERR_DUPLICATE in r.errors) == r.is_duplicate for r in found)
    spec = [{"field": "title", "type": "str", "rule": "unique (title, release_year)"},
            {"field": "rating", "type": "float", "rule": "never NaN"}]
    kept = {}
    for mode in ("drop", "drop_first"):
        policy = validate.RulePolicy(mode)
        kept[mode] = count(validate.valid_rows(validate.check_schema(df, policy, spec), policy).collect())
    assert kept["drop"] == [(0, "b", 1.0), (0, "b", 2.0), (0, "d", 4.0), (3, "c", 1.0), (7, "a", 9.0)]
    assert kept["drop_first"] == [(0, "b", 1.0), (0, "b", 2.0), (3, "c", 1.0), (7, "a", 9.0)]


def test_no_rows_and_no_key(spark):
    empty = spark.createDataFrame([], ROWS)
    assert validate.check_schema(empty).collect() == []
    assert not validate.check_schema(empty, spec=[]).columns == []
