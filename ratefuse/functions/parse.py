"""Genres, dates, years and numbers read from messy text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Formats, patterns and limits the results depend on.
MONTH_DAY_YEAR = "MMMM d, yyyy"
MONTH_YEAR = "MMMM yyyy"
DAY_MONTH_SHORT_YEAR = "d-MMM-yy"
ISO_DATE = "yyyy-MM-dd"
FIRST_PAREN_YEAR = r"\((\d{4})\)"
YEAR_PATTERNS = {
    "first_parens": r"\((\d{4})\)",
    "trailing_parens": r"\((\d{2,4})\)\s*$",
    "end": r"(\d{4})$",
    "start": r"^(\d{2,4})",
    "first_digits": r"(\d{2,4})",
}
GENRE_PATTERNS = {
    "pipe_or_comma": r"[|,]",
    "pipe": r"\|",
    "comma": ",",
    "comma_amp": "[,&]",
    "comma_amp_slash": "[,&/]",
}
NO_GENRES = "(no genres listed)"
PLACEHOLDER_SCORE = "tbd"
LAST_YEAR = 2025
FIRST_YEAR = 1870
PIVOT = 25


def split_genres(c: Column, separator: str = "pipe_or_comma", stop_values: tuple = ()) -> Column:
    """Trimmed, non-blank parts; a null text gives an empty list."""
    # A lambda: a bare F.trim would take the element index for its second argument.
    parts = F.transform(F.split(c, GENRE_PATTERNS[separator]), lambda g: F.trim(g))
    parts = F.filter(parts, lambda g: (g != "") & ~g.isin("", *stop_values))
    return F.coalesce(parts, F.array().cast("array<string>"))


def number(c: Column) -> Column:
    """Double, or null where the text is no number (NaN counts as null)."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def whole_number(c: Column) -> Column:
    """Integer through double, so ``"8.0"`` is 8."""
    return number(c).try_cast("int")


def date_cascade(c: Column, first_format: str) -> Column:
    """Full date, else month and year, else a bare year (1 January), else null."""
    text = F.trim(c)
    bare = F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01")))
    return F.coalesce(
        F.try_to_date(text, first_format),
        F.try_to_date(text, MONTH_YEAR),
        F.try_to_date(bare, ISO_DATE),
    )


def roll_century(d: Column, last_year: int = LAST_YEAR) -> Column:
    """Move a date behind ``last_year`` one century back."""
    return F.when(F.year(d) > last_year, F.add_months(d, -1200)).otherwise(d)


def date_fallback(*columns: Column) -> Column:
    """First column that holds an ISO date."""
    return F.coalesce(*[F.try_to_date(F.trim(c), ISO_DATE) for c in columns])


def year_in_text(c: Column, where: str = "first_parens") -> Column:
    digits = F.regexp_extract(c, YEAR_PATTERNS[where], 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def pivot_year(year: Column, pivot: int = PIVOT, low: int = 2000, high: int = 1900) -> Column:
    """Four-digit year of a two-digit one: up to the pivot ``low``, above it ``high``."""
    short = F.when(year <= pivot, year + low).otherwise(year + high)
    return F.when(year < 100, short).otherwise(year)


def first_score(critic: Column, user: Column) -> Column:
    """Critic score 0-100, else the user score (0-10 brought to 0-100)."""
    u = number(user)
    return F.coalesce(number(critic), F.when(u <= 10, u * 10).otherwise(u))


def first_score_0_10(critic: Column, user: Column) -> Column:
    """Critic score above zero as 0-10, else the user score as it is."""
    c = number(critic)
    return F.coalesce(F.when(c > 0, c / 10), number(user))


def half_even(c: Column, places: int = 1) -> Column:
    """Round a double the way numpy does: scale, round half to even, scale back."""
    factor = float(10**places)
    return F.rint(c * factor) / factor


def count_present(columns: list[Column]) -> Column:
    """How many of the columns are not null."""
    total = F.lit(0)
    for c in columns:
        total = total + c.isNotNull().cast("int")
    return total


def row_mean(columns: list[Column]) -> Column:
    """Mean over the values that are present; null if there is none."""
    total, present = F.lit(0.0), count_present(columns)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(present > 0, total / present)


def row_median(columns: list[Column]) -> Column:
    """Median over the values that are present (even count: mean of the middle two)."""
    values = F.array_sort(F.array_compact(F.array(*columns)))
    n = F.size(values)
    lower = F.try_element_at(values, ((n + 1) / 2).cast("int"))
    upper = F.try_element_at(values, (n / 2).cast("int") + 1)
    return F.when(n > 0, (lower + upper) / 2)
