"""Scalar column functions used across the library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_wallclock(text_or_ts: Column) -> Column:
    """Zoned timestamp (string like ``2015-01-01T00:00:00Z`` or TIMESTAMP)
    → UTC wall-clock TIMESTAMP_NTZ, independent of the session zone.

    The instant's microseconds since the epoch are added to the NTZ epoch;
    NTZ arithmetic involves no zone, so a UTC time that falls into a
    daylight-saving gap of the session zone stays exact (a cast from
    TIMESTAMP to NTZ would pass through the session zone).
    """
    instant = F.try_to_timestamp(text_or_ts)        # unparsable text → null, not an error
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def date_utc(ts_ntz: Column) -> Column:
    """Basic ISO date with zone letter, e.g. ``20150101Z``.  The NTZ value
    is truncated to a DATE first (zone-free); formatting the timestamp
    itself would pass through the session zone, where a wall-clock time in
    a daylight-saving gap moves by an hour."""
    return F.date_format(F.to_date(ts_ntz), "yyyyMMdd'Z'")


def hour_utc(ts_ntz: Column) -> Column:
    """Hour of day of the NTZ wall clock (``hour`` reads NTZ without a zone)."""
    return F.hour(ts_ntz).cast("int")


def first_regex_group(text: Column, pattern: str, missing: str | None = None) -> Column:
    """First match, group 1, as an option: null (or ``missing``) when the
    pattern does not match at all.  An empty group-1 match stays ``''``."""
    value = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))
    return F.coalesce(value, F.lit(missing)) if missing is not None else value


def json_field(text: Column, name: str, missing: str | None = None) -> Column:
    """Top-level JSON field by name, as text; null (or ``missing``) if absent."""
    value = F.get_json_object(text, f"$.{name}")
    return F.coalesce(value, F.lit(missing)) if missing is not None else value


def regex_all_ints(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` (group 1) as ``array<int>``, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), 1),
                       lambda x: x.try_cast("int"))


def starts_with_any(text: Column, prefixes: list[str], ignore_case: bool = True) -> Column:
    """True when ``text`` starts with one of ``prefixes``."""
    probe = F.upper(text) if ignore_case else text
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | probe.startswith(p.upper() if ignore_case else p)
    return cond


def record_text(lines: Column) -> Column:
    """Serialise a record ``[header, l1, l2, …]`` as ``header,{l1;l2;…}``;
    a record without followers is its header alone."""
    followers = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.when(F.size(lines) > 1,
                  F.concat(F.element_at(lines, 1), F.lit(",{"),
                           F.array_join(followers, ";"), F.lit("}"))) \
            .otherwise(F.element_at(lines, 1))
