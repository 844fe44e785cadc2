"""Scalar expressions: keys, ids, coercions, clock values. All are columns in, columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compound_key(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def split_well(compound: Column) -> tuple[Column, Column]:
    """(rec, well) of `rec/well`, split at the first slash; null unless both exist."""
    parts = F.split(compound, "/", 2)
    ok = (F.size(parts) == 2) & (F.try_element_at(parts, F.lit(1)) != "") & (F.try_element_at(parts, F.lit(2)) != "")
    return F.when(ok, F.try_element_at(parts, F.lit(1))), F.when(ok, F.try_element_at(parts, F.lit(2)))


def well_number(well_id: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(well_id, r"(\d+)$", 1), F.lit("")), F.lit("999999999")).cast("int")


def well_name(number: Column, columns: int = 6) -> Column:
    """A1-style name, `?` without a number; rows after Z are AA, AB and so on, up to ZZ."""
    row = F.floor(number / columns)
    letters = F.when(row < 26, F.char(65 + row)).otherwise(F.concat(F.char(64 + F.floor(row / 26)), F.char(65 + row % 26)))
    return F.when(number.isNull(), "?").otherwise(F.concat(letters, (number % columns + 1).cast("string")))


def coerced(text: Column) -> Column:
    """A struct with the one typed field that a setting's text stands for: bool, int (no leading zero), float (d.d), or text."""
    t = F.trim(text)
    is_bool, is_int, is_float = F.lower(t).isin("true", "false"), t.rlike(r"^-?(0|[1-9]\d{0,17})$"), t.rlike(r"^-?\d+\.\d+$")
    return F.struct(
        F.when(is_bool, F.lower(t) == "true").alias("b"), F.when(is_int, t.try_cast("bigint")).alias("i"), F.when(is_float, t.try_cast("double")).alias("f"), F.when(~(is_bool | is_int | is_float), t).alias("s")
    )


def unix_iso(seconds: Column, latest: int | None = 4102444800) -> Column:
    """ISO 8601 in UTC for seconds from 2000 on up to `latest` (2100; None: no end), else null. Years past 9999 have as many digits as they need."""
    ok = seconds >= 946684800 if latest is None else (seconds >= 946684800) & (seconds <= latest)
    t = F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone())
    return F.when(ok, F.concat(F.year(t).cast("string"), F.date_format(t, "-MM-dd'T'HH:mm:ss'Z'")))


def megabytes(size: Column) -> Column:
    return F.floor(size / 1048576)


def clamp(x: Column, low, high) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def split_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def short_hash(text: Column, digits: int = 16) -> Column:
    return F.substring(F.sha1(text), 1, digits)


def padded_id(prefix: str, number: Column, width: int = 3) -> Column:
    return F.format_string(f"{prefix}%0{width}d", number)


def iso_seconds(t: Column) -> Column:
    """A time in ISO 8601, to the second."""
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")


def guarded(x: Column) -> Column:
    """NaN, infinities and nulls as 0."""
    return F.coalesce(finite(x), F.lit(0.0))


def finite(x: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(F.abs(x) < float("inf"), F.nanvl(x, F.lit(None)))


def exact_avg(x: Column, digits: int = 4) -> Column:
    """The mean of a group's numbers, the same in whatever order rows come: numbers of up to `digits` places are summed as whole ones.

    Numbers with more places, large ones, NaN and infinities make it the plain mean.
    """
    unit = F.lit(10.0**digits)
    whole = F.when(F.abs(x) < 1e9, F.rint(x * unit).cast("long"))
    plain = F.count_if(x.isNotNull() & ~F.coalesce(whole / unit == x, F.lit(False)))
    return F.when(plain == 0, F.try_divide(F.try_sum(whole) / unit, F.count(x))).otherwise(F.avg(x))
