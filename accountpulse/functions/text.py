"""Cleaning of identifiers, enumerations and free labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Texts that stand for a missing company id, and for a missing token.
NULL_IDS = ("", "nan", "None")
NULL_TOKENS = ("", "nan", "none")
# WhatsApp conversation types: the four that are billed, the three that are reported.
BILLED_TYPES = ("MARKETING", "MARKETING_LITE", "UTILITY", "AUTHENTICATION")
REPORTED_TYPES = ("MARKETING", "UTILITY", "AUTHENTICATION")
# White space at the ends of a text: control characters, then the space separators.
WHITE_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# ----------------------------------------------------------------------------

PLAIN_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
SCIENTIFIC_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[eE][+-]?[0-9]+$"


def stripped(col: Column) -> Column:
    """Text without white space at its ends; tabs, line ends and no-break spaces count as such."""
    return F.btrim(col.cast("string"), F.lit(WHITE_SPACE))


def has_company_id(col: Column) -> Column:
    """False for NULL and for the texts that stand for a missing id."""
    return col.isNotNull() & ~stripped(col).isin(*NULL_IDS)


def normalize_company_id(col: Column) -> Column:
    """One text form per company: trimmed, missing markers NULL, numbers as integer text."""
    text = stripped(col)
    whole = F.regexp_extract(text, "^[+-]?[0-9]+", 0).try_cast("decimal(38,0)").cast("string")
    scientific = text.try_cast("double").try_cast("bigint").cast("string")
    return (
        F.when(text.isin(*NULL_IDS), None)
        .when(text.rlike("^[+-]?[0-9]+([.][0-9]*)?$"), F.coalesce(whole, text))
        .when(text.rlike(SCIENTIFIC_NUMBER), F.coalesce(scientific, text))
        .otherwise(text)
    )


def clean_token(col: Column, case: str = "lower") -> Column:
    """Trim and fold case; blanks and missing markers become NULL."""
    folded = {"lower": F.lower, "upper": F.upper}[case](stripped(col))
    return F.when(~F.lower(folded).isin(*NULL_TOKENS), folded)


def fold_conversation_type(col: Column) -> Column:
    """Reported conversation type; NULL for the types outside the report."""
    folded = F.upper(stripped(col))
    folded = F.when(folded == "MARKETING_LITE", "MARKETING").otherwise(folded)
    return F.when(folded.isin(*REPORTED_TYPES), folded)


def slug(col: Column, default: str) -> Column:
    """Lower-case name with every run of other characters turned into one ``_``."""
    runs = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(runs, "^_+|_+$", ""), F.lit("")), F.lit(default))


def blank_to_null(col: Column) -> Column:
    return F.nullif(stripped(col), F.lit(""))


def contains_any(col: Column, patterns: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of the (lower-case) patterns."""
    found = F.lit(False)
    for pattern in patterns:
        found = found | F.contains(F.lower(col), F.lit(pattern))
    return found


def is_external(col: Column, patterns: Sequence[str]) -> Column:
    """Keep-rule of one field: missing, empty, or free of every pattern."""
    return col.isNull() | (col == "") | ~contains_any(col, patterns)


def company_order(col: Column | str = "companyId") -> list[Column]:
    """Sort keys that put numeric company ids in number order, others after in text order."""
    c = F.col(col) if isinstance(col, str) else col
    return [c.try_cast("decimal(38,0)").asc_nulls_last(), c.asc_nulls_last()]
