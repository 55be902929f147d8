"""Scalar column expressions (built-in Spark functions only, so they stay
inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse contract.
# Risk bands: code, label, min (inclusive), max (exclusive, None = open top), sort order.
RISK_CLASSES = [
    ("low", "Low", 0, 10, 1),
    ("moderate", "Moderate", 10, 25, 2),
    ("high", "High", 25, 50, 3),
    ("critical", "Critical", 50, None, 4),
]
# Warning levels of threshold rules, in severity order.
WARNING_LEVELS = ["low", "moderate", "high", "critical"]
RUN_TYPES = ["initial", "incremental", "manual"]
RUN_STATUSES = ["running", "succeeded", "failed", "partial"]
ALERT_STATUSES = ["open", "reviewed", "closed"]
OUTBOX_EVENT_TYPES = ["created", "status_changed"]
PARTS_OF_DAY = ["night", "morning", "afternoon", "evening"]
DEFAULT_UNIT = "ug/m3"
UNKNOWN_UNIT = "unknown"          # unit when a payload names none
LOCATION_NAME_PREFIX = "OpenAQ location"  # default name: '<prefix> <source id>'
VALUE_OPEN_MIN = -1000      # C4: value > -1000
VALUE_OPEN_MAX = 100000     # C4: value < 100000
ERROR_TEXT_CAP = 4000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """'' becomes NULL, so coalesce chains skip empty values the way the
    source's "a or b" fallbacks do (whitespace is a value, as there)."""
    c = col_(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


def normalize_unit(c) -> Column:
    """F1: micro sign -> 'u', superscript three -> '3'."""
    return F.translate(col_(c), "µ³", "u3")


def city_name(locality, city, name) -> Column:
    """locality, city, name, else 'Unknown' (empty strings count as missing)."""
    return F.coalesce(blank_to_null(locality), blank_to_null(city),
                      blank_to_null(name), F.lit("Unknown"))


def country_name(code, name) -> Column:
    """country code, else country name, else 'Unknown'."""
    return F.coalesce(blank_to_null(code), blank_to_null(name), F.lit("Unknown"))


def default_name(name, prefix: str, source_id) -> Column:
    """'<prefix> <id>' when the name is missing."""
    return F.coalesce(blank_to_null(name),
                      F.concat(F.lit(prefix + " "), col_(source_id).cast("string")))


def lenient_timestamp(c) -> Column:
    """parse ISO-8601 text to a UTC timestamp; unparsable -> NULL.

    Handles a trailing 'Z' / numeric offset and fractional seconds.
    """
    c = col_(c)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
    )


def reading_time_text(datetime_utc, period_from_utc, date_text, datetime_utc_alt) -> Column:
    """time precedence datetime.utc, period.datetimeFrom.utc, date, datetimeUtc."""
    return F.coalesce(*[blank_to_null(c) for c in (datetime_utc, period_from_utc, date_text, datetime_utc_alt)])


def row_hash(*cols) -> Column:
    """md5 over '|'-joined text; NULLs are skipped as in concat_ws."""
    return F.md5(F.concat_ws("|", *[col_(c).cast("string") for c in cols]))


def date_key(ts) -> Column:
    """YYYYMMDD integer (session time zone is UTC)."""
    return F.date_format(col_(ts), "yyyyMMdd").cast("int")


def time_key(ts) -> Column:
    """hour*100 + minute."""
    ts = col_(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def iso_weekday(d) -> Column:
    """F8: ISO weekday 1 (Monday) .. 7 (Sunday)."""
    return (F.weekday(col_(d)) + 1).cast("int")


def part_of_day(hour) -> Column:
    """0-5 night, 6-11 morning, 12-17 afternoon, else evening."""
    h = col_(hour)
    return (F.when(h.between(0, 5), "night").when(h.between(6, 11), "morning")
            .when(h.between(12, 17), "afternoon").otherwise("evening"))


def hour_floor(ts) -> Column:
    """date_trunc('hour'), keeping a timestamp without time zone."""
    return F.date_trunc("hour", col_(ts)).cast("timestamp_ntz")


def risk_class_code(value) -> Column:
    """Value -> risk band [min, max), open top; NULL below 0.

    The four bands are a fixed conformed dimension, so the band lookup is a
    CASE expression generated from them (no join, stays in codegen).
    """
    v = col_(value)
    expr = None
    for code, _label, lo, hi, _order in RISK_CLASSES:
        cond = v >= F.lit(lo)
        if hi is not None:
            cond = cond & (v < F.lit(hi))
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def risk_class_key(value) -> Column:
    """Sort order of the band the value falls in (the dimension's key)."""
    v = col_(value)
    expr = None
    for _code, _label, lo, hi, order in RISK_CLASSES:
        cond = v >= F.lit(lo)
        if hi is not None:
            cond = cond & (v < F.lit(hi))
        expr = F.when(cond, F.lit(order)) if expr is None else expr.when(cond, F.lit(order))
    return expr.cast("int")


def risk_label_for_code(code) -> Column:
    c = col_(code)
    expr = None
    for cd, label, _lo, _hi, _order in RISK_CLASSES:
        expr = F.when(c == cd, label) if expr is None else expr.when(c == cd, label)
    return expr


def risk_key_for_code(code) -> Column:
    """Alert level -> risk class key by code (left lookup, NULL if unknown)."""
    c = col_(code)
    expr = None
    for cd, _label, _lo, _hi, order in RISK_CLASSES:
        expr = F.when(c == cd, F.lit(order)) if expr is None else expr.when(c == cd, F.lit(order))
    return expr.cast("int")


def json_object_keep_nulls(**fields) -> Column:
    """F16: JSON object with explicit nulls (to_json drops them by default)."""
    return F.to_json(F.struct(*[col_(v).alias(k) for k, v in fields.items()]),
                     {"ignoreNullFields": "false"})


def cap_text(c, cap: int = ERROR_TEXT_CAP) -> Column:
    """cap text at ``cap`` characters, ending in '...' when cut."""
    c = col_(c)
    return F.when(F.length(c) > cap, F.concat(F.substring(c, 1, cap - 3), F.lit("..."))).otherwise(c)


def exact_mean(c, scale: int = 4) -> Column:
    """Mean of a fixed-scale value as DOUBLE, computed in decimal: exact sum,
    one rounding (half-up) at the result scale, then one conversion. The
    result does not depend on the order rows are summed in, so every task
    layout (and another engine) gets the same bits."""
    return F.avg(col_(c).cast(f"decimal(18,{scale})")).cast("double")


def absolute_error(pred, actual) -> Column:
    """F13."""
    return F.abs(col_(pred) - col_(actual))
