"""Column expressions (all built-in, JVM-side; no Python UDFs)."""

from loomlog.functions.scalar import (  # noqa: F401
    date_utc,
    first_regex_group,
    hour_utc,
    json_field,
    record_text,
    regex_all_ints,
    starts_with_any,
    utc_wallclock,
)
