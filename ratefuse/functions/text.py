"""Title normalisation, ids and keys, as plain column expressions (no UDF)."""

from __future__ import annotations

import string
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Results depend on exactly these patterns, words and letters.
WHITESPACE = r"[\s\x1c-\x1f]"
SPACES = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f"  # what WHITESPACE matches
NON_ASCII = r"[^\x00-\x7F]"
TRAILING_YEAR = WHITESPACE + r"*\(\d{4}\)" + WHITESPACE + r"*$"
TRAILING_PARENS = WHITESPACE + r"*\([^)]*\)" + WHITESPACE + r"*$"
NOT_WORD_OR_SPACE = r"[^\w\s]"
NOT_ALNUM_OR_SPACE = r"[^a-z0-9\s]"
TRAILING_THE = r"\bthe" + WHITESPACE + r"*$"
TRAILING_SPACE_THE = r" the$"
MISSING_ID = "NA"
KEY_SEPARATOR = "|"
TRANSLIT_LETTERS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe",
    "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d", "ı": "i", "ĸ": "k",
}


@lru_cache(maxsize=None)
def _fold_tables(style: str) -> tuple[dict[str, str], dict[str, str]]:
    """Non-ASCII characters that fold to one, and to several, ASCII characters."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if not folded and style == "translit":
            folded = TRANSLIT_LETTERS.get(ch) or _base_letter(ch)
        if len(folded) == 1:
            single[ch] = folded
        elif folded:
            several[ch] = folded
    return single, several


def _base_letter(ch: str) -> str:
    """``LATIN SMALL LETTER O WITH STROKE`` -> ``o``; empty for anything else."""
    words = unicodedata.name(ch, "").split()
    if len(words) > 4 and words[0] == "LATIN" and words[2] == "LETTER" and words[4] == "WITH":
        if len(words[3]) == 1:
            return words[3].lower() if words[1] == "SMALL" else words[3]
    return ""


def fold_ascii(c: Column, style: str = "nfkd") -> Column:
    """Compatibility-decompose and keep the ASCII part (``é`` -> ``e``, ``½`` -> ``12``).

    ``style='translit'`` also rewrites Latin letters that do not decompose
    (``ß`` -> ``ss``, ``ø`` -> ``o``).  Text that is ASCII already is returned as is;
    the per-character step runs only on text with a character of several letters.
    """
    single, several = _fold_tables(style)
    replaced = F.translate(c, "".join(single), "".join(single.values()))
    pairs = "\n".join(f"{ch}\t{folded}" for ch, folded in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))
    expanded = F.array_join(
        F.transform(
            F.split(replaced, ""),
            lambda ch: F.when(ch.rlike(NON_ASCII), F.try_element_at(table, ch)).otherwise(ch),
        ),
        "",
    )
    has_several = F.length(F.translate(c, "".join(several), "")) != F.length(c)
    return (
        F.when(~c.rlike(NON_ASCII), c)
        .when(has_several, expanded)
        .otherwise(F.regexp_replace(replaced, NON_ASCII + "+", ""))
    )


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WHITESPACE + "+", " "))


def dedupe_tokens(c: Column) -> Column:
    """Keep the first occurrence of each whitespace-separated token, in order."""
    return F.array_join(F.array_remove(F.array_distinct(F.split(c, WHITESPACE + "+")), ""), " ")


def normalize_title(
    title: Column,
    fold: str = "nfkd",
    punct: str = "nonword",
    bare_the: str = "drop",
    the_before_collapse: bool = False,
) -> Column:
    """Comparable form of a title; null becomes the empty string.

    ``punct='list'`` turns every ASCII punctuation mark into a space, the underscore
    too.  ``bare_the='keep'`` drops a trailing "the" only behind another word.
    ``the_before_collapse`` looks for it before the spaces are collapsed.
    """
    t = F.lower(fold_ascii(F.coalesce(title, F.lit("")), fold))
    t = _at_end(t, ")", TRAILING_YEAR, TRAILING_PARENS)
    if punct == "list":
        t = F.translate(t, string.punctuation, " " * len(string.punctuation))
    else:
        t = F.regexp_replace(t, NOT_WORD_OR_SPACE + "+", " ")
    trailing = TRAILING_SPACE_THE if bare_the == "keep" else TRAILING_THE
    if trailing == TRAILING_SPACE_THE and not the_before_collapse:
        t = collapse_spaces(t)
    return dedupe_tokens(_at_end(t, "the", trailing))  # which collapses and trims


def _at_end(c: Column, last: str, *patterns: str) -> Column:
    """Drop matches of the patterns, which are looked for only in text that ends like them.

    The lambda holds the text, so that Spark does not work it out again for every use.
    """

    def dropped(t: Column) -> Column:
        out = t
        for pattern in patterns:
            out = F.regexp_replace(out, pattern, "")
        return F.when(F.rtrim(t, F.lit(SPACES)).endswith(last), out).otherwise(t)

    return F.transform(F.array(c), dropped)[0]


def strip_to_alnum(title: Column) -> Column:
    """Lower-case and delete everything but letters, digits and single spaces."""
    return collapse_spaces(F.regexp_replace(F.lower(title), NOT_ALNUM_OR_SPACE + "+", ""))


def first_non_blank(*columns: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def canonical_id(c: Column) -> Column:
    """Id as text: null or empty -> null, trimmed, without a trailing ``.0``."""
    text = c.cast("string")
    trimmed = F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")
    return F.when(text != "", F.regexp_replace(trimmed, r"\.0$", ""))


def joined_key(columns: list[Column], canonical: bool = True) -> Column:
    """Ids joined by ``|``, a missing one written as ``NA``."""
    ids = [canonical_id(c) if canonical else c.cast("string") for c in columns]
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(i, F.lit(MISSING_ID)) for i in ids])


def film_signature(id_columns: list[str]) -> Column:
    """Sorted ``column=value`` pairs of the ids that are present, joined by ``|``."""
    pairs = [
        F.when(F.col(c).isNotNull(), F.concat(F.lit(c + "="), F.col(c).cast("string")))
        for c in id_columns
    ]
    return F.array_join(F.array_sort(F.array_compact(F.array(*pairs))), KEY_SEPARATOR)


def has_keyword(c: Column, words: list[str]) -> Column:
    """Whether one of the words occurs as a whole word, in any case."""
    return F.coalesce(c.rlike(r"(?i)\b(" + "|".join(words) + r")\b"), F.lit(False))


def fingerprint(c: Column) -> Column:
    """First twelve hex digits of the SHA-256 of a text."""
    return F.substring(F.sha2(c.cast("binary"), 256), 1, 12)
