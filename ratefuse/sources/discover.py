"""A source definition from column names alone, for sources that nobody has described.

Each field is taken from the first column whose name fits, in the order of the patterns and
then of the columns; ratings may come from several columns, the first usable value counts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratefuse.functions import parse, text
from ratefuse.sources.specs import SourceSpec

# Name patterns of each field, best first (whole names, any case).
PATTERNS = {
    "title": ("original_?title", "title", ".*title.*", "name"),
    "release_date": ("release_date", ".*release.*date.*", "date"),
    "year": ("release_year", "year", ".*year.*"),
    "genres": ("genres.*", "genre.*"),
    "id": ("id_.*", "id"),
}
RATING_WORDS = ("score", "rating")
NO_RATING = ("count", "votes", "status", "number")
DATE_FORMATS = (parse.MONTH_DAY_YEAR, parse.DAY_MONTH_SHORT_YEAR, parse.ISO_DATE)


def column_for(field: str, columns: Sequence[str]) -> str | None:
    for pattern in PATTERNS[field]:
        for c in columns:
            if re.fullmatch(pattern, c, re.IGNORECASE):
                return c
    return None


def rating_candidates(columns: Sequence[str]) -> list[str]:
    """Columns that may hold the rating, in order; a ``rating_…`` column decides alone, and so
    does ``tomatometer_rating``."""
    for c in columns:
        if c.lower().startswith("rating_") and not any(w in c.lower() for w in NO_RATING):
            return [c]
        if c.lower() == "tomatometer_rating":
            return [c]
    return [
        c for c in columns
        if any(w in c.lower() for w in RATING_WORDS) and not any(w in c.lower() for w in NO_RATING)
    ]


def first_usable(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first candidate that is a number; user scores up to ten are brought to a hundred
    if another candidate is there, whose scale they then share."""
    values = []
    for c in candidates:
        value = parse.number(F.col(c).cast("string"))
        if "user" in c.lower() and len(candidates) > 1:
            value = F.when(value <= 10, value * 10).otherwise(value)
        values.append(value)
    return F.coalesce(*values) if values else F.lit(None).cast("double")


def _date(c: Column) -> Column:
    cascades = [parse.date_cascade(c, f) for f in DATE_FORMATS]
    return parse.roll_century(F.coalesce(*cascades))


def discover(name: str, columns: Sequence[str]) -> SourceSpec:
    """The definition of a source with these columns; a ValueError without a title or rating."""
    found = {field: column_for(field, columns) for field in PATTERNS}
    candidates = rating_candidates(columns)
    lacking = [f for f, c in (("title", found["title"]), ("rating", candidates)) if not c]
    if lacking:
        raise ValueError(f"source {name}: no column for {', '.join(lacking)} among {list(columns)}")

    def fields(df: DataFrame) -> dict[str, Column]:
        title = F.col(found["title"]).cast("string")
        date = F.lit(None).cast("date")
        if found["release_date"]:
            date = _date(F.col(found["release_date"]).cast("string"))
        years = [F.year(date), parse.year_in_text(title, "first_parens")]
        if found["year"]:
            years.insert(0, parse.whole_number(F.col(found["year"]).cast("string")))
        genres = F.col(found["genres"]) if found["genres"] else F.lit(None).cast("string")
        if not (found["genres"] and df.schema[found["genres"]].dataType.typeName() == "array"):
            genres = parse.split_genres(genres.cast("string"), "pipe_or_comma", (parse.NO_GENRES,))
        out = {
            "title_raw": title, "release_date": date, "year": reduce(F.coalesce, years),
            "genres": genres, "rating": first_usable(df, candidates),
        }
        if found["id"]:
            own = text.canonical_id(F.col(found["id"]).cast("string"))
            out["id"] = own.try_cast("long")
        return out

    return SourceSpec(name, f"ID_{name.upper()}", tuple(columns), fields)
