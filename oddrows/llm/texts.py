"""Column expressions that several text operators share. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space; a word is a run of anything else
SPACE = "[\\x20\\x09-\\x0D]"


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def has_word(line: Column) -> Column:
    return F.length(F.translate(line, " \t\x0b\f\r\n", "")) > 0


def bound(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, also where lambdas use it per element:
    the optimizer may put a column's expression in the place of the column, here it cannot."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def without_ranges(items: Column, starts: Column, width: int) -> Column:
    """`items` without the positions start .. start + width - 1 of each of the sorted 0-based
    `starts`; ranges may overlap. Linear in the two lengths."""
    def gaps(x: Column, s: Column) -> Column:
        head = F.slice(x, F.lit(1), F.coalesce(F.get(s, F.lit(0)), F.size(x)))
        after = F.transform(s, lambda p, i: F.slice(
            x, p + width + 1, F.greatest(F.coalesce(F.get(s, i + 1), F.size(x)) - p - width, F.lit(0))))
        return F.flatten(F.concat(F.array(head), after))
    return bound(items, lambda x: bound(starts, lambda s: gaps(x, s)))


def row_key(text: str) -> Column:
    """Together with doc_id it tells rows apart: rows equal in both are one document."""
    return F.xxhash64(text_or_empty(text))


def same_row(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    """Null-safe join condition on columns of one name."""
    match = F.lit(True)
    for c in columns:
        match = match & a[c].eqNullSafe(b[c])
    return match


def carried(docs: DataFrame, text: str) -> Column:
    """All columns but the text in one struct, so that their names cannot clash with an operator's own."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text]).alias("carried")


def restored(rows: DataFrame, columns: list[str], text: str, value: Column) -> DataFrame:
    """The columns of a table again, from `carried` and a new text."""
    return rows.select(*[value.alias(c) if c == text else F.col("carried").getField(c).alias(c) for c in columns])
