"""Text expressions shared by the cleaning, chunking and answering plans.

Two whitespace rules live side by side in this data model and must not be
mixed.  Relational cleaning knows the space character only (``sql_trim``,
``space_tokens``); word splitting for chunks, categories and vectors knows all
Unicode whitespace (``py_strip``, ``py_words``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters Python's ``str.split`` and ``str.strip`` treat
# as whitespace.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# The same set for a Java pattern; the Unicode flag is much faster than the
# characters written out.
PY_WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

LONG_MIN = -(2**63)
LONG_MAX = 2**63 - 1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_trim(c: Column | str) -> Column:
    """Strip U+0020 from both ends and nothing else."""
    return F.trim(_col(c))


def py_strip(c: Column | str) -> Column:
    """Strip all Unicode whitespace from both ends."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def py_words(c: Column | str) -> Column:
    """Split on runs of Unicode whitespace; blank text gives an empty array."""
    return F.array_remove(F.split(_col(c), PY_WHITESPACE_RUN), "")


def space_tokens(c: Column | str) -> Column:
    """Tokens between runs of U+0020."""
    return F.array_remove(F.split(_col(c), " +"), "")


def word_count(c: Column | str) -> Column:
    """Number of words, where CR, LF, TAB and space separate and nothing else."""
    return F.regexp_count(_col(c), F.lit(r"[^ \r\n\t]+"))


def comma_names(c: Column | str) -> Column:
    """Non-blank, space-trimmed entries of a comma-separated list, in order."""
    return F.array_remove(F.split(sql_trim(c), " *, *"), "")


def before_first(c: Column | str, mark: str) -> Column:
    """Text before the first ``mark``; the whole text when there is none."""
    return F.substring_index(_col(c), mark, 1)


def _saturated(digits: Column) -> Column:
    """A string of optional sign and digits as bigint, clamped at its ends."""
    return F.coalesce(
        digits.try_cast("bigint"),
        F.when(digits.startswith("-"), F.lit(LONG_MIN)),
        F.when(digits != "", F.lit(LONG_MAX)),
    )


def prefix_integer(c: Column | str) -> Column:
    """Numeric prefix of a text as bigint: ``2007x`` is 2007, ``d`` is 0."""
    digits = F.regexp_extract(_col(c), r"^[ \t-\r]*([+-]?[0-9]+)", 1)
    return F.coalesce(_saturated(digits), F.when(digits == "", F.lit(0)))


def strict_integer(c: Column | str) -> Column:
    """Whole text as bigint, or null when it is not an integer literal.

    A literal beyond bigint clamps to its end, so that it still counts as a
    number that no stored year equals.
    """
    text = py_strip(_col(c).cast("string"))
    return F.when(
        text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), _saturated(F.replace(text, F.lit("_"), F.lit("")))
    )


def blank_to_null(c: Column | str) -> Column:
    """Empty text to null: the filter fields treat both as 'not given'."""
    return F.nullif(_col(c), F.lit(""))


def status_label(c: Column | str) -> Column:
    """Stored publication state to its display label, ignoring case."""
    return F.when(F.lower(py_strip(c)) == "published", "Published").otherwise("Preprint")


def snippet(c: Column | str, limit: int = 280) -> Column:
    """One-line excerpt: over ``limit`` characters it is cut and ends in ``...``."""
    line = F.replace(py_strip(c), F.lit("\n"), F.lit(" "))
    short = F.rtrim(F.substring(line, 1, limit - 3), F.lit(PY_WHITESPACE))
    return F.when(F.length(line) > limit, F.concat(short, F.lit("..."))).otherwise(line)
