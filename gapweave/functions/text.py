from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts that a spreadsheet or CSV reader takes for "no value".
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Unicode blanks, and the four separators that are blanks to str.split() but not to the JVM.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def quoted(name: str) -> Column:
    """Column by exact name, also when it holds blanks or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_if_na_token(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def normalize_text(c: Column) -> Column:
    """Trim, turn every run of blanks into one space; null becomes the empty text."""
    return F.coalesce(F.trim(F.regexp_replace(c, _BLANKS, " ")), F.lit(""))


def is_blank(c: Column) -> Column:
    """Null, or nothing but blanks; decided at the first other character."""
    return ~F.coalesce(c.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def combine_fields(labelled: dict[str, Column]) -> Column:
    """`Label: value` parts joined by ` | `, without null, blank or literal `nan` values."""
    parts = [
        F.when(~is_blank(c) & (c != "nan"), F.concat(F.lit(f"{label}: "), c))
        for label, c in labelled.items()
    ]
    return F.concat_ws(" | ", *parts)


def truncate_tokens(c: Column, limit: int = 512) -> Column:
    """The first `limit` blank-separated tokens, the input bound of a fixed-length encoder."""
    return F.array_join(F.slice(F.split(normalize_text(c), " "), 1, limit), " ")


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def percent_text(c: Column) -> Column:
    return F.format_string("%.1f%%", c)
