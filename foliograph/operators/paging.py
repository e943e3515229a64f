"""Pages of a listing sorted by a number, largest first, and then by a text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows a top-k may hold: a page that ends within them is found at once, and
# the rows before any other page are counted until so many are left.
TOP_K_ROWS = 2_000
# Characters of the text by which counts are refined.
_STEP = 2


def page(df: DataFrame, number: str, text: str, limit: int, offset: int, top_k_rows: int = TOP_K_ROWS) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in order of ``number`` downwards (nulls last) and ``text`` upwards.

    Texts are hardly repeated within one number.  Rows per number, then per
    beginning of the text within the number that holds the first wanted row,
    are counted until at most ``top_k_rows`` lie between a known place and that
    row.  What lies before is filtered out, so no skipped row is sorted or
    moved, wherever the page is.
    """
    order = [F.desc(number), F.asc(text)]
    if offset + limit <= top_k_rows:
        return df.orderBy(*order).offset(offset).limit(limit)

    keys = df.select(number, text)
    cell = _cell(keys.groupBy(number).agg(F.count("*").alias("n")).orderBy(F.desc(number)), offset)
    if cell is None:
        return df.limit(0)
    value, rows, skipped = cell
    inside = F.col(number).isNull() if value is None else F.col(number) == value
    prefix = ""
    while rows > top_k_rows:
        own = keys.filter(inside & F.col(text).startswith(prefix))
        head = F.substring(text, 1, len(prefix) + _STEP)
        counts = own.groupBy(head.alias("head")).agg(F.count("*").alias("n")).orderBy("head")
        longer, rows, before = _cell(counts, offset - skipped)
        skipped += before
        if longer == prefix:  # copies of one text
            break
        prefix = longer
    later = inside & (F.col(text) >= prefix)
    if value is not None:
        later = (F.col(number) < value) | F.col(number).isNull() | later
    return df.filter(later).orderBy(*order).offset(offset - skipped).limit(limit)


def _cell(counts: DataFrame, place: int) -> tuple[object, int, int] | None:
    """The key whose rows hold this place, their number, and the rows before them; ``counts`` has a row per key."""
    before = 0
    for key, n in counts.collect():
        if place < before + n:
            return key, n, before
        before += n
    return None
