"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank around a value.
BLANKS = " \t\n\r\f\x0b"
# Texts that stand for a missing value.
NULL_LIKE = ("nan", "none", "null", "n/a")
# Texts that are no field name.
NOT_A_FIELD = ("nan", "none", "null", "", "n/a", "unknown")
# The sheet types a comparison id may end with.
SHEET_TYPES = ("highly_cited_only", "incites_researchers")


def strip(c: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.btrim(c, F.lit(BLANKS))


def fold(c: Column) -> Column:
    """Matching key: trimmed and lower case."""
    return F.lower(strip(c))


def snake_case(c: Column) -> Column:
    """``Highly Cited Papers`` to ``highly_cited_papers``; null to ``''``."""
    words = F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "_")
    return F.btrim(words, F.lit("_"))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def valid_name(c: Column) -> Column:
    """Not null, not blank, not ``nan`` (this case only), not ``none``."""
    return c.isNotNull() & (strip(c) != "") & (c != "nan") & (F.lower(c) != "none")


def comparable_name(c: Column) -> Column:
    """The looser name test used before matching on a folded key."""
    return c.isNotNull() & (strip(c) != "") & (fold(c) != "nan")


def null_like(c: Column) -> Column:
    return is_blank(c) | fold(c).isin(*NULL_LIKE)


def digits_only(c: Column) -> Column:
    return strip(c).rlike("^[0-9]+$")


def plausible_field(c: Column) -> Column:
    """At least two characters, not a null-like word and not a number."""
    ok = (F.length(strip(c)) >= 2) & ~fold(c).isin(*NOT_A_FIELD) & ~digits_only(c)
    return F.coalesce(ok, F.lit(False))


def canonical(c: Column, mapping: dict[str, str], unknown: str = "keep_original", default: str = "Unknown") -> Column:
    """Map a category to its canonical spelling.

    Keys of ``mapping`` are folded texts. A blank stays as it is and null
    becomes ``''``. An unmapped value is kept trimmed, replaced by ``default``
    (``use_default``) or raises when read (``flag_error``).
    """
    if mapping:
        pairs = [F.lit(x) for kv in mapping.items() for x in kv]
        found = F.try_element_at(F.create_map(*pairs), category_lookup(c))
    else:
        found = F.lit(None).cast("string")
    return settle_category(c, found, unknown, default)


def category_lookup(c: Column) -> Column:
    return fold(F.coalesce(c, F.lit("")))


def settle_category(c: Column, found: Column, unknown: str, default: str) -> Column:
    """The canonical spelling if one was found, else what the strategy says."""
    original = F.coalesce(c, F.lit(""))
    if unknown == "keep_original":
        other = strip(original)
    elif unknown == "use_default":
        other = F.lit(default)
    elif unknown == "flag_error":
        other = F.raise_error(F.concat(F.lit("unknown category: "), original))
    else:
        raise ValueError(f"unknown strategy: {unknown}")
    return F.when(strip(original) == "", original).when(found.isNotNull(), found).otherwise(other)


def table_name(subject: Column, period: Column, sheet: Column) -> Column:
    """``{subject}_{period}_{sheet}`` with each part in snake case."""
    return F.concat_ws("_", snake_case(subject), snake_case(period), snake_case(sheet))


def parse_table_name(name: Column, periods: Sequence[str]) -> Column:
    """Struct (subject, period, sheet_type), cut at the first period token.

    All fields are null when the name has fewer than three parts or no period.
    """
    token = "|".join(periods)
    pattern = f"^(?:(.*?)_)?({token})(?:_(.*))?$"

    readable = name.rlike(pattern) & (F.size(F.split(name, "_")) >= 3)

    def part(i: int) -> Column:
        return F.when(readable, F.regexp_extract(name, pattern, i))

    return F.struct(part(1).alias("subject"), part(2).alias("period"), part(3).alias("sheet_type"))


def comparison_id(subject: Column, sheet: Column) -> Column:
    return F.concat_ws("_", subject, sheet)


def dataset_type(cid: Column, other: str = "general_research") -> Column:
    """The sheet type named inside a comparison id."""
    low = F.lower(cid)
    out = F.when(low.contains(SHEET_TYPES[0]), SHEET_TYPES[0])
    for s in SHEET_TYPES[1:]:
        out = out.when(low.contains(s), s)
    return out.otherwise(other)


def display_subject(cid: Column) -> Column:
    """``space_science_highly_cited_only`` to ``Space Science``."""
    bare = cid
    for s in SHEET_TYPES:
        bare = F.replace(bare, F.lit(f"_{s}"), F.lit(""))
    return F.initcap(F.replace(bare, F.lit("_"), F.lit(" ")))
