"""Tolerant reading of cells: truth values, counts, dates, versions, enumerations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Tokens of truth values; date patterns in the order in which they are tried.
TRUE, FALSE = ["true", "1", "yes", "y", "t"], ["false", "0", "no", "n", "f"]
PATTERNS = ["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy"]
SHAPES = [r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{4}/\d{1,2}/\d{1,2}$", r"^\d{1,2}-\d{1,2}-\d{4}$"]
_LOOSE = {"yyyy-MM-dd": "y-M-d", "MM/dd/yyyy": "M/d/y", "dd/MM/yyyy": "d/M/y", "yyyy/MM/dd": "y/M/d", "dd-MM-yyyy": "d-M-y"}


def boolean(cell: Column, blank: bool | None = None) -> Column:
    """A blank or unknown cell is the caller's default."""
    token = F.lower(F.trim(cell))
    return F.when(token.isin(TRUE), True).when(token.isin(FALSE), False).otherwise(F.lit(blank))


def whole_count(cell: Column) -> Column:
    """Thousands separators and a zero fraction are read over; negative, blank or other text is null."""
    number = F.expr("try_cast(null as double)") if cell is None else F.replace(F.trim(cell), F.lit(","), F.lit("")).try_cast("double")
    return F.when((number >= 0) & (number == F.floor(number)), number.cast("int"))


def enumeration(cell: Column, known: list[str], default: str) -> Column:
    token = F.lower(F.trim(cell))
    return F.when(token.isin(known), token).otherwise(F.lit(default))


def is_numeric_version(version: Column) -> Column:
    return version.rlike(r"^\d+(\.\d+)*$")


def natural_key(version: Column) -> Column:
    """Parts that sort as numbers (before text) or as lower-cased text."""
    parts = F.regexp_extract_all(F.lower(version), F.lit(r"(\d+|[^\d.]+)"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(F.when(p.rlike(r"^\d"), 0).otherwise(1).alias("rank"), F.coalesce(p.try_cast("bigint"), F.lit(0)).alias("number"), F.when(p.rlike(r"^\d"), "").otherwise(p).alias("text")))


def _date(cell: Column, pattern: str, shape: str) -> Column:
    return F.when(cell.rlike(shape), F.try_to_timestamp(cell, F.lit(_LOOSE.get(pattern, pattern))).cast("date"))


def iso_date(cell: Column) -> Column:
    """ISO date text where the cell can be read as a date, else the trimmed cell."""
    text = F.trim(cell)
    epoch = F.when(text.rlike(r"^\d{12,13}$"), F.timestamp_millis(text.try_cast("bigint")).cast("date"))
    epoch = F.when((F.year(epoch) >= 1990) & (F.year(epoch) <= 2100), epoch)
    stamp = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.substring(text, 1, 10).try_cast("date"))
    found = F.coalesce(stamp, epoch, *[_date(text, p, s) for p, s in zip(PATTERNS, SHAPES)])
    return F.coalesce(F.date_format(found, "yyyy-MM-dd"), text, F.lit(""))


def report_date(cell: Column) -> Column:
    """Month-day-year only; anything else is kept as it is."""
    text = F.trim(cell)
    return F.coalesce(F.date_format(_date(text, "M-d-y", r"^\d{1,2}-\d{1,2}-\d{4}$"), "yyyy-MM-dd"), text)


def _month_year(text: Column) -> Column:
    shaped = text.rlike(r"^[A-Za-z]+ \d{4}$")
    return F.when(shaped, F.coalesce(F.try_to_timestamp(text, F.lit("MMMM yyyy")), F.try_to_timestamp(text, F.lit("MMM yyyy"))).cast("date"))


def release_date(cell: Column) -> Column:
    iso = iso_date(cell)
    return F.coalesce(F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}$"), iso.try_cast("date")), _month_year(F.trim(cell)))


def release_year(cell: Column) -> Column:
    return F.coalesce(F.year(release_date(cell)).cast("string"), F.lit(""))


def release_month(cell: Column) -> Column:
    return F.coalesce(F.date_format(release_date(cell), "MMM yyyy"), F.lit(""))


def listed_title(version: Column, cell: Column) -> Column:
    month = release_month(cell)
    return F.when(month != "", F.concat(version, F.lit(" ("), month, F.lit(")"))).otherwise(version)


def percent(part: Column, whole: Column) -> Column:
    """One decimal, halves to even; nothing of nothing is all."""
    return F.when(whole == 0, 100.0).otherwise(F.bround(part * 100.0 / whole, 1))
