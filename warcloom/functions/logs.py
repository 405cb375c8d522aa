"""Crawl-log line expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DASH

_IP = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
_TRIES = r"^\d+t$"
_ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def dash_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(DASH))


def is_numeric_status(status: Column, allow_negative: bool = False) -> Column:
    pattern = r"^-*[0-9]+$" if allow_negative else r"^[0-9]+$"
    return F.coalesce(status.rlike(pattern), F.lit(False))


def status_int(status: Column) -> Column:
    """Status as integer; NULL for ``-``, empty or broken values."""
    return status.try_cast("int")


def status_class(status: Column) -> Column:
    """2 for 2xx and so on, truncating toward zero."""
    return F.try_divide(status_int(status), F.lit(100)).cast("int")


def log_day(timestamp: Column) -> Column:
    return F.concat(F.substr(timestamp, F.lit(1), F.lit(10)), F.lit("T00:00:00Z"))


def log_hour(timestamp: Column) -> Column:
    return F.concat(F.substr(timestamp, F.lit(1), F.lit(13)), F.lit(":00:00Z"))


def log_datetime(timestamp: Column) -> Column:
    return F.try_to_timestamp(timestamp, F.lit(_ISO_MILLIS))


def wayback_timestamp(start_time_plus_duration: Column) -> Column:
    return F.substr(start_time_plus_duration, F.lit(1), F.lit(14))


def annotation_list(annotation_string: Column) -> Column:
    return F.split(annotation_string, ",")


def strip_extra_json(annotation_string: Column) -> Column:
    """Annotations without a trailing empty or non-empty JSON object."""
    return (
        F.when(annotation_string.endswith(" {}"), F.regexp_replace(annotation_string, r" \{\}$", ""))
        .when(_has_json(annotation_string), F.regexp_extract(annotation_string, r'^(.*?) \{"', 1))
        .otherwise(annotation_string)
    )


def extra_json(annotation_string: Column) -> Column:
    """The trailing JSON object of the annotations, NULL when absent or empty."""
    return F.when(
        ~annotation_string.endswith(" {}") & _has_json(annotation_string),
        F.regexp_extract(annotation_string, r'^.*? (\{".*)$', 1),
    )


def _has_json(annotation_string: Column) -> Column:
    return annotation_string.contains(' {"') & annotation_string.endswith("}")


def extra_info(json_text: Column) -> Column:
    return F.from_json(json_text, "map<string,string>")


def line_stats(log_columns: dict[str, Column] | None = None) -> Column:
    """Array of (key, value) facts of one line that can be added up.

    Fixed facts are the line itself, status, type, last hop and content
    length; each distinct annotation adds one key. Launch timestamps are left
    out because their cardinality is unbounded.
    """
    c = log_columns or {
        n: F.col(n) for n in ("status_code", "mime", "hop_path", "content_length", "annotations")
    }

    def fact(key: Column | str, value: Column) -> Column:
        return F.struct((F.lit(key) if isinstance(key, str) else key).alias("key"), value.alias("value"))

    annotation_keys = F.transform(
        F.array_distinct(
            F.filter(c["annotations"], lambda a: (a != DASH) & ~a.startswith("launchTimestamp:"))
        ),
        lambda a: F.when(a.rlike(_TRIES), F.concat(F.lit("tries:"), a))
        .when(a.rlike(_IP), F.concat(F.lit("ip:"), a))
        .otherwise(a),
    )
    fixed = F.array(
        fact("lines", F.lit("")),
        fact("status_code", c["status_code"]),
        fact("content_type", c["mime"]),
        fact("hop", F.right(c["hop_path"], F.lit(1))),
        fact("sum:content_length", c["content_length"]),
    )
    # An annotation that spells a fixed key replaces that fact.
    names = F.array(*[F.lit(n) for n in ("lines", "status_code", "content_type", "hop", "sum:content_length")])
    fixed = F.when(
        F.arrays_overlap(annotation_keys, names), F.filter(fixed, lambda f: ~F.array_contains(annotation_keys, f["key"]))
    ).otherwise(fixed)
    return F.concat(fixed, F.transform(annotation_keys, lambda k: fact(k, F.lit(""))))


def stat_property(fact: Column) -> Column:
    """Name under which a fact is totalled: summed facts keep their key,
    counted facts are ``key:value`` or the bare key."""
    summed = fact["key"].startswith("sum:") & fact["value"].try_cast("bigint").isNotNull()
    return F.when(summed | (fact["value"] == ""), fact["key"]).otherwise(
        F.concat(fact["key"], F.lit(":"), fact["value"])
    )


def stat_amount(fact: Column) -> Column:
    summed = F.when(fact["key"].startswith("sum:"), fact["value"].try_cast("bigint"))
    return F.coalesce(summed, F.lit(1).cast("bigint"))


def annotation_kv(annotations: Column) -> Column:
    """(key, value) of every annotation with a colon, split at the first one."""
    return F.transform(
        F.filter(annotations, lambda a: a.contains(":")),
        lambda a: F.struct(
            F.regexp_extract(a, r"^([^:]*):", 1).alias("key"), F.regexp_extract(a, r"^[^:]*:(.*)$", 1).alias("value")
        ),
    )


def _last_value(annotations: Column, key: str) -> Column:
    found = F.filter(annotation_kv(annotations), lambda kv: kv["key"] == key)
    return F.try_element_at(found, F.lit(-1))["value"]


def annotation_ip(annotations: Column) -> Column:
    return _last_value(annotations, "ip")


def annotation_virus(annotations: Column) -> Column:
    """Second-last word of the ``1:`` scanner annotation."""
    words = F.split(F.regexp_replace(_last_value(annotations, "1"), r"^\s+|\s+$", ""), r"\s+")
    return F.try_element_at(words, F.lit(-2))


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def is_live_status(status: Column) -> Column:
    """200 to 399, digits only."""
    return is_numeric_status(status) & F.coalesce(status_int(status).between(200, 399), F.lit(False))


def is_dead_seed_line(status: Column, hop_path: Column, via: Column) -> Column:
    return (
        is_numeric_status(status)
        & F.coalesce(status_int(status) == 404, F.lit(False))
        & (hop_path == DASH)
        & (via == DASH)
    )
