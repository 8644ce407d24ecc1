"""Row rules compiled from a rule file: type and rule text of each field become expressions.

A rule text is a list of clauses, parted by commas, ``&`` and ``and``.  Known clauses are bounds
(``<= 2025``, ``> 0``, ``between 1 and 5``, ``(1870-2025)``), presence (``must not be empty``,
``never NaN``, ``preserved``, ``required``, ``optional``), cleanliness (``clean the title``) and
uniqueness (``unique (title, release_year)``).  A clause that says nothing that can be checked on
a row is reported by ``unknown_clauses``, never silently taken as checked.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field as attribute

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FractionalType, IntegralType, NumericType, StringType

from ratefuse.functions.parse import FIRST_YEAR, LAST_YEAR
from ratefuse.functions.text import strip_to_alnum

# Errors of the row schema.
ERR_ID = "ID missing or not int"
ERR_TITLE = "title missing or empty"
ERR_DIRTY = "title not cleaned"
ERR_YEAR = "release_year out of range"
ERR_GENRES = "genres not a list of strings"
ERR_RATING = "rating missing or NaN"
ERR_DUPLICATE = "duplicate title/release_year"
WORDING = {
    ("ID", "missing"): ERR_ID, ("ID", "type"): ERR_ID, ("title", "missing"): ERR_TITLE,
    ("title", "dirty"): ERR_DIRTY, ("release_year", "missing"): ERR_YEAR,
    ("release_year", "range"): ERR_YEAR, ("genres", "missing"): ERR_GENRES,
    ("genres", "type"): ERR_GENRES, ("rating", "missing"): ERR_RATING,
}
# The rules that hold without a rule file.
DEFAULT_RULES = [
    {"field": "ID", "type": "int64", "rule": "must be preserved unchanged"},
    {"field": "title", "type": "str", "rule": "must not be empty, clean, unique (title, release_year)"},
    {"field": "release_year", "type": "int64 | pd.NA", "rule": f"({FIRST_YEAR}-{LAST_YEAR})"},
    {"field": "genres", "type": "list[str]", "rule": "optional"},
    {"field": "rating", "type": "float", "rule": "must never be NaN"},
]

_NUMBER = r"(-?\d+(?:\.\d+)?)"
_KINDS = {"int": "int", "str": "str", "list": "list", "float": "float", "double": "float"}
_PRESENT = re.compile(r"not (be )?(empty|null|nan|missing)|never (be )?(nan|null|empty)|preserved|required")
_GUIDANCE = re.compile(r"^(etc\.?|optional|realistic|value|prefer .*|.*original title)$")


@dataclass(frozen=True)
class FieldRule:
    """What one field has to keep."""

    field: str
    kind: str = ""
    nullable: bool = True
    filled: bool = False
    clean: bool = False
    bounds: tuple[tuple[str, float], ...] = ()
    unique: tuple[str, ...] = ()
    unknown: tuple[str, ...] = attribute(default=(), compare=False)


def _clauses(rule: str) -> list[str]:
    """Clauses of a rule text; commas and ``and`` inside brackets or a range do not part them."""
    kept = re.sub(r"\(([^)]*)\)", lambda m: m[0].replace(",", "\x00").replace("&", "\x00"), rule)
    kept = re.sub(rf"between\s+{_NUMBER}\s+and\s+{_NUMBER}", r"(\1-\2)", kept, flags=re.I)
    parts = re.split(r",|&|;|\band\b", kept)
    return [p.replace("\x00", ",").strip() for p in parts if p.strip()]


def compile_rule(field: str, type_text: str, rule: str) -> FieldRule:
    kind = next((k for name, k in _KINDS.items() if (type_text or "").strip().lower().startswith(name)), "")
    nullable = bool(re.search(r"\bNA\b|null|none|optional", type_text or "", re.I))
    filled = clean = False
    bounds, unique, unknown = [], (), []
    if (type_text or "").strip() and not kind:
        unknown.append(type_text)
    for clause in _clauses(rule or ""):
        text, known = clause.lower(), False
        for sign, value in re.findall(rf"(<=|>=|<|>|=)\s*{_NUMBER}", text):
            bounds.append((sign, float(value)))
            known = True
        for low, high in re.findall(rf"(?<![\d.]){_NUMBER}\s*(?:-|–|to)\s*{_NUMBER}", text):
            bounds += [(">=", float(low)), ("<=", float(high))]
            known = True
        if "unique" in text:
            inside = re.search(r"\(([^)]*)\)", clause)
            unique = tuple(c.strip() for c in inside[1].split(",")) if inside else (field,)
            known = True
        if _PRESENT.search(text):
            filled = known = True
        if re.search(r"\bclean", text):
            clean = known = True
        if "optional" in text:
            nullable = True
        # Examples in brackets behind a known clause are part of it.
        if not known and not _GUIDANCE.match(text) and not text.startswith("no special"):
            unknown.append(clause)
    nullable = nullable and not filled
    return FieldRule(field, kind, nullable, filled, clean, tuple(bounds), unique, tuple(unknown))


def compile_rules(spec: Sequence[dict]) -> list[FieldRule]:
    return [compile_rule(s["field"], s.get("type") or "", s.get("rule") or "") for s in spec]


def unknown_clauses(rules: list[FieldRule], columns: Sequence[str]) -> list[tuple[str, str]]:
    """(field, text) of everything in the rules that no check stands for."""
    missing = [(r.field, f"column {r.field} is missing") for r in rules if r.field not in columns]
    return missing + [(r.field, clause) for r in rules for clause in r.unknown]


def unique_key(rules: list[FieldRule], columns: Sequence[str]) -> tuple[str, ...]:
    """The key that no two rows may share; empty if there is none among the columns."""
    return next((r.unique for r in rules if r.unique and set(r.unique) <= set(columns)), ())


def _error(rule: FieldRule, check: str) -> str:
    general = {
        "missing": "missing", "type": f"not of type {rule.kind}", "range": "out of range",
        "dirty": "not cleaned",
    }
    return WORDING.get((rule.field, check), f"{rule.field} {general[check]}")


def _number(rows: DataFrame, field: str) -> Column:
    kind = rows.schema[field].dataType
    return F.col(field).cast("double") if isinstance(kind, NumericType) else F.col(field).try_cast("double")


def field_error(
    rows: DataFrame, rule: FieldRule, rewrite: bool = False, allow_null: bool | None = None
) -> Column:
    """The error of one field in a row, null if it has none.

    ``rewrite``: an unclean text is cleaned elsewhere, and only an error if nothing is left.
    ``allow_null`` overrides the rule.
    """
    c, kind = F.col(rule.field), rows.schema[rule.field].dataType
    nullable = rule.nullable if allow_null is None else allow_null
    if isinstance(kind, StringType) and rule.kind not in ("int", "float"):
        absent = F.trim(F.coalesce(c, F.lit(""))) == ""
    elif isinstance(kind, FractionalType):
        absent = c.isNull() | F.isnan(c.cast("double"))
    else:
        absent = c.isNull()
    checks = []
    if rule.kind == "list":
        if not isinstance(kind, ArrayType):
            return F.lit(_error(rule, "type"))
        checks.append(F.when(c.isNull() | F.exists(c, lambda x: x.isNull()), _error(rule, "type")))
    elif not nullable:
        checks.append(F.when(absent, _error(rule, "missing")))
    if rule.kind in ("int", "float") and not isinstance(kind, IntegralType):
        value = _number(rows, rule.field)
        wrong = value.isNull() if rule.kind == "float" else value.isNull() | (value != F.floor(value))
        checks.append(F.when(~absent & wrong, _error(rule, "type")))
    if rule.clean:
        cleaned = strip_to_alnum(F.coalesce(c, F.lit("")))
        if rewrite:
            checks.append(F.when(cleaned == "", _error(rule, "missing")))
        else:
            checks.append(F.when(c != cleaned, _error(rule, "dirty")))
    value = _number(rows, rule.field)
    for sign, bound in rule.bounds:
        limit = F.lit(bound)
        tests = {"<=": value <= limit, "<": value < limit, ">=": value >= limit, ">": value > limit,
                 "=": value == limit}
        checks.append(F.when(~absent & ~tests[sign], _error(rule, "range")))
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")
