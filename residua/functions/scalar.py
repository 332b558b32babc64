"""Row expressions.  Missing values follow three-valued logic: an unknown condition stays unknown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str, to: str = "double") -> Column:
    """A number from text; NULL where the text is none."""
    return _col(c).try_cast(to)


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0.0))


def present(c: Column | str) -> Column:
    """Neither NULL nor NaN."""
    return _col(c).isNotNull() & ~F.isnan(_col(c))


# --- text


def has_tag(tags: Column | str, token: Column | str) -> Column:
    """Case-sensitive substring test, so ``old`` is also found in ``cold``."""
    return F.contains(_col(tags), F.lit(token) if isinstance(token, str) else token)


def sql_text(value: str) -> str:
    """A string literal for SQL expressions."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def token_hits(tags: str, tokens: Sequence[str]) -> Column:
    """Places of the tokens found in the text of column ``tags``, ascending; NULL for a NULL text."""
    if not tokens:
        return F.when(F.col(tags).isNotNull(), F.array().cast("array<int>"))
    listed = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(t).alias("token")) for i, t in enumerate(tokens)])
    found = F.filter(listed, lambda t: has_tag(tags, t["token"]))
    return F.when(F.col(tags).isNotNull(), F.transform(found, lambda t: t["place"]))


def first_token(text: Column | str) -> Column:
    """The first alphabetic run, NULL if there is none."""
    return F.nullif(F.regexp_extract(_col(text), "[a-zA-Z]+", 0), F.lit(""))


def release_year(title: Column | str) -> Column:
    """The year in parentheses that ends the title, NULL if there is none."""
    return number(F.nullif(F.regexp_extract(_col(title), r"(\d{4})\)$", 1), F.lit("")), "int")


# --- dates, always in UTC whatever the session time zone is


def utc_date(epoch_seconds: Column | str) -> Column:
    days = F.floor(_col(epoch_seconds) / SECONDS_PER_DAY).cast("int")
    return F.date_from_unix_date(days)


def whole_weeks(start: Column, end: Column) -> Column:
    return F.floor(F.datediff(end, start) / 7).cast("int")


def whole_months(start: Column, end: Column) -> Column:
    """Completed calendar months from ``start`` to ``end``."""
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return months - F.when(F.dayofmonth(end) < F.dayofmonth(start), 1).otherwise(0)


def age_in_years(date: Column, year: Column) -> Column:
    return F.year(date) - year


# --- parameter grids


def grid(start: float, stop: float, step: float = 1.0) -> list[float]:
    """``start`` to ``stop`` inclusive."""
    count = int((stop - start) / step + 1e-9) + 1
    return [start + i * step for i in range(count)]
