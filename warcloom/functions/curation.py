"""Expressions over curated targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RIGHTS_OPEN, RIGHTS_READING_ROOM


def access_rights(is_open: Column) -> Column:
    return F.when(F.coalesce(is_open, F.lit(False)), F.lit(RIGHTS_OPEN)).otherwise(F.lit(RIGHTS_READING_ROOM))


def access_url(is_open: Column, timestamp: Column, url: Column, open_prefix: str, restricted_prefix: str) -> Column:
    """Replay URL under the public or the reading-room prefix."""
    prefix = F.when(F.coalesce(is_open, F.lit(False)), F.lit(open_prefix)).otherwise(F.lit(restricted_prefix))
    return F.concat(prefix, timestamp, F.lit("/"), url)


def source_tag(target_id: Column, seeds: Column) -> Column:
    return F.concat(F.lit("tid:"), target_id.cast("string"), F.lit(":"), F.try_element_at(seeds, F.lit(1)))


def crawl_sheets(ignore_robots: Column, scope: Column, depth: Column) -> Column:
    """Crawler settings overlays a target asks for, in a fixed order."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(ignore_robots, F.lit(False)), F.lit("ignoreRobots")),
            F.when(scope == "subdomains", F.lit("subdomainsScope")).when(scope == "plus1Scope", F.lit("plus1Scope")),
            F.when(depth == "CAPPED_LARGE", F.lit("higherLimit")).when(depth == "DEEP", F.lit("noLimit")),
        )
    )


def parallel_queues(seed: Column) -> Column:
    return F.when(seed.contains("twitter.com"), F.lit(2)).otherwise(F.lit(1))


def schedule_is_due(schedule: Column, now: Column) -> Column:
    """Whether one (startDate, endDate, frequency) schedule fires in the hour of ``now``."""
    start = F.try_to_timestamp(schedule["startDate"], F.lit("yyyy-MM-dd HH:mm:ss"))
    end = F.try_to_timestamp(schedule["endDate"], F.lit("yyyy-MM-dd HH:mm:ss"))
    same_day = F.dayofmonth(now) == F.dayofmonth(start)
    by_frequency = {
        "DAILY": F.lit(True),
        "WEEKLY": F.weekday(now) == F.weekday(start),
        "MONTHLY": same_day,
        "QUARTERLY": same_day & (F.month(now) % 3 == F.month(start) % 3),
        "SIXMONTHLY": same_day & (F.month(now) % 6 == F.month(start) % 6),
        "ANNUAL": same_day & (F.month(now) == F.month(start)),
    }
    matches = F.lit(False)
    for frequency, rule in by_frequency.items():
        matches = F.when(schedule["frequency"] == frequency, rule).otherwise(matches)
    return F.coalesce(
        (start <= now) & (end.isNull() | (now <= end)) & matches & (F.hour(now) == F.hour(start)), F.lit(False)
    )


def is_embed(request_headers: Column, response_headers: Column) -> Column:
    """A transfer is an embed unless HTML was asked for or came back."""
    asked = F.exists(request_headers, lambda h: (h["name"] == "Accept") & h["value"].contains("text/html"))
    got = F.exists(
        response_headers,
        lambda h: (h["name"] == "Content-Type")
        & (h["value"].contains("text/html") | h["value"].contains("application/xhtml")),
    )
    return ~(F.coalesce(asked, F.lit(False)) | F.coalesce(got, F.lit(False)))
