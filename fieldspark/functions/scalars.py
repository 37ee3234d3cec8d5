"""Column builders for dirty text: slugs, numbers, days, three-valued flags, keys and labels.

Nothing here fails on bad data: what cannot be read is null. NaN counts as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words of a written truth value.
TRUE_WORDS, FALSE_WORDS = ("true", "t", "1", "yes", "y"), ("false", "f", "0", "no", "n")


def col_or_null(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, exactly so named, or typed nulls."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def pick_column(df: DataFrame, names: list[str]) -> str | None:
    """The table's first column that has one of the names."""
    return next((c for c in df.columns if c in set(names)), None)


def slugify(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def trimmed(x: Column) -> Column:
    """Without spaces, tabs and line ends at both ends."""
    return F.regexp_replace(x, "^[ \t\r\n]+|[ \t\r\n]+$", "")


def safe_double(x: Column) -> Column:
    n = x.try_cast("double")
    return F.when(~F.isnan(n), n)


def safe_int(x: Column) -> Column:
    """Whole part of a number; '2020.0' is 2020."""
    n = safe_double(x)
    return F.when(F.abs(n) < 2147483648, F.when(n >= 0, F.floor(n)).otherwise(F.ceil(n))).cast("int")


def parse_day(x: Column) -> Column:
    """The first yyyy-mm-dd of a text as a date; null for ranges (a slash), blanks and impossible days."""
    return F.when(~F.contains(x, F.lit("/")), F.try_to_date(F.nullif(F.regexp_extract(x, r"\d{4}-\d{2}-\d{2}", 0), F.lit("")), "yyyy-MM-dd"))


def parse_day_lenient(x: Column) -> Column:
    """The first ten characters as a date."""
    return F.try_to_date(F.substring(x, 1, 10), "yyyy-MM-dd")


def parse_boolish(x: Column) -> Column:
    word = F.lower(trimmed(x))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def parse_utc(x: Column) -> Column:
    return F.try_to_timestamp(x, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))


def coord_key(x: Column, dp: int = 4) -> Column:
    """A coordinate rounded half up to dp places, as a whole number: equal in every engine."""
    return F.floor(x * (10**dp) + 0.5).cast("long")


def date_precision(day: Column, year: Column) -> Column:
    return F.when(day.isNotNull(), "day").when(year.isNotNull(), "year").otherwise("unknown")


def cell_id(row: Column, col: Column) -> Column:
    return F.format_string("r%05d_c%05d", row, col)


def degree_label(x: Column, positive: str, negative: str) -> Column:
    return F.concat(F.abs(x).cast("int").cast("string"), F.lit("°"), F.when(x > 0, positive).when(x < 0, negative).otherwise(""))


def has_token(x: Column, tokens: list[str], by: str = ";") -> Column:
    """Whether any of the tokens stands in a delimited text, white space ignored."""
    if not tokens:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(F.split(F.regexp_replace(x, r"\s+", ""), by), F.array(*map(F.lit, tokens))), F.lit(False))
