"""File-store path expressions: classification, names, permissions, times."""

from __future__ import annotations

import re
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RENDER_WARC_PATTERN, WARC_TIMESTAMP_PATTERN
from .urls import basename

# Folder layouts of the file store in rule order. The second item
# spells collection|stream|job|launch|layout|kind from the pattern's groups.
LAYOUT_RULES = [
    (r"^/data/([0-9]+)/([0-9]+)/(?:(DLX|Logs|WARCS)/)?[^/]+$", "selective|selective|$1|$2|wct|$3"),
    (
        r"^/heritrix/output/(warcs|viral|logs)/(?:dc|crawl)[0-3]-([0-9]{4})([0-9]{4})(?:[0-9]{6})?/[^/]+$",
        "npld|domain|dc$2|$2$3|npld-2013|$1",
    ),
    (
        r"^/heritrix/output/(warcs|viral|logs)/([a-z\-0-9]+)[-/]([0-9]{12,14})/[^/]+$",
        "npld|frequent|$2|$3|npld-2013|$1",
    ),
    (
        r"^/heritrix/output/(dc2[a-z\-0-9]*)/([0-9]{12,14})[^/]*/(warcs|viral|logs)/[^/]+$",
        "npld|domain|$1|$2|npld-2018|$3",
    ),
    (
        r"^/heritrix/output/(frequent-bypm)/([0-9]{12,14})[^/]*/(warcs|viral|logs)/[^/]+$",
        "bypm|frequent|$1|$2|npld-2018|$3",
    ),
    (
        r"^/heritrix/output/(frequent[a-z\-0-9]*)/([0-9]{12,14})[^/]*/(warcs|viral|logs)/[^/]+$",
        "npld|frequent|$1|$2|npld-2018|$3",
    ),
    (
        r"^/1_data/(npld|bypm|selective)/([a-z\-_0-9]+)/([a-z\-_0-9]+)/(warcs|viral|logs)/[^/]+$",
        "$1|$2|$3||npld-2018-project|$4",
    ),
    (r"^/_to_be_deleted/.*$", "|||||to-be-deleted"),
]
# What a path keeps when it lies under a known root but fits no
# rule (stream and layout); its collection is then its first folder.
ROOT_RULES = [
    (r"^/heritrix/output/(dc2.+|frequent.*)/.*$", "||npld-2018"),
    (r"^/heritrix/output/(warcs|viral|logs)/.*$", "||npld-2013"),
    (r"^/data/.*$", "|selective|wct"),
]
FACTS = ["collection", "stream", "job", "launch", "layout", "kind", "recognised"]


def file_name(path: Column) -> Column:
    return basename(path)


def file_ext(path: Column) -> Column:
    """From the first dot of the name on; NULL when there is no dot."""
    name = file_name(path)
    return F.when(name.contains("."), F.substr(name, F.locate(".", name)))


def launch_datetime(launch: Column, short_minutes: bool = False) -> Column:
    """Timestamp of an 8, 12 or 14 digit launch id.

    Twelve digits are read as ``yyyyMMddHHmm``. ``short_minutes=True`` reads
    them as hour, single-digit minute and second pairs filled greedily
    (``…1230`` is 12:03:00), which is how older listings were stamped.
    """
    twelve = F.concat(launch, F.lit("00"))
    if short_minutes:
        twelve = F.concat(
            F.substr(launch, F.lit(1), F.lit(10)),
            F.lit("0"),
            F.substr(launch, F.lit(11), F.lit(1)),
            F.lit("0"),
            F.substr(launch, F.lit(12), F.lit(1)),
        )
    digits = (
        F.when(F.length(launch) == 8, F.concat(launch, F.lit("000000")))
        .when(F.length(launch) == 12, twelve)
        .when(F.length(launch) == 14, launch)
    )
    return F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss"))


def refine_kind(kind: Column, collection: Column, name: Column) -> Column:
    """Split unfinished WARCs, selective-era indexes and crawl logs from the folder kind."""
    bad_warc = (kind == "warcs") & ~name.endswith(".warc.gz")
    return (
        F.when(bad_warc & (F.coalesce(collection, F.lit("")) == "selective") & name.endswith(".warc.cdx"), F.lit("cdx"))
        .when(bad_warc, F.lit("warcs-invalid"))
        .when((kind == "logs") & name.startswith("crawl.log"), F.lit("crawl-logs"))
        .otherwise(kind)
    )


def _start(pattern: str) -> str:
    return re.match(r"\^([/_0-9a-z]*)", pattern).group(1)


def _first_fit(path: Column, rules: list[tuple[str, Column]]) -> Column:
    """Value of the first rule whose pattern fits, else NULL. Patterns that follow each
    other with the same literal start share one cheap test of it."""
    found = []
    for start, group in groupby(rules, lambda rule: _start(rule[0])):
        inner = None
        for pattern, value in group:
            inner = F.when(path.rlike(pattern), value) if inner is None else inner.when(path.rlike(pattern), value)
        found.append(F.when(path.startswith(start), inner))
    return F.coalesce(*found)


_BAR = "\x1f"


def path_facts(path: Column) -> Column:
    """Array of the FACTS of a path, '' where unknown.

    Each rule is one match and one rewrite, so a path costs at most one
    rewrite however many facts are read from the array. A ``|`` in the path
    stands as ``_BAR`` in the array, where ``|`` separates the facts.
    """
    # Named by every rule, so it must be cheap: replace leaves a text without bars alone.
    path = F.replace(path, F.lit("|"), F.lit(_BAR))
    root = F.try_element_at(F.split(path, "/", 3), F.lit(2))
    # A root's value is |stream|layout; facts are collection|stream|job|launch|layout|kind|recognised.
    known = [(pattern, F.lit("|{1}|||{2}|unknown|false".format(*value.split("|")))) for pattern, value in ROOT_RULES]
    unknown = F.concat(F.coalesce(root, F.lit("")), F.coalesce(_first_fit(path, known), F.lit("|||||unknown|false")))
    whole = [(pattern, F.regexp_replace(path, pattern, template + "|true")) for pattern, template in LAYOUT_RULES]
    facts = F.coalesce(_first_fit(path, whole), unknown)
    return F.split(facts, r"\|", -1)


def facts_struct(facts: Column, path: Column) -> Column:
    """Struct of the facts with name and extension; kind not refined yet."""
    f = {name: F.nullif(F.replace(facts[i], F.lit(_BAR), F.lit("|")), F.lit("")) for i, name in enumerate(FACTS)}
    return F.struct(
        (facts[FACTS.index("recognised")] == "true").alias("recognised"),
        *[f[name].alias(name) for name in ("collection", "stream", "job", "launch", "layout")],
        F.coalesce(F.lower(f["kind"]), F.lit("unknown")).alias("kind"),
        file_name(path).alias("file_name"),
        file_ext(path).alias("file_ext"),
    )


def classify_path(path: Column) -> Column:
    """Struct of what a path tells: recognised, collection, stream, job,
    launch, layout, kind, file_name, file_ext.

    The first rule that fits decides. A path under a known root that fits no
    rule keeps that root's layout and stream but takes its first folder as
    collection.
    """
    facts = facts_struct(path_facts(path), path)
    return facts.withField("kind", refine_kind(facts["kind"], facts["collection"], facts["file_name"]))


def file_timestamp(modified_at: Column, kind: Column, name: Column, stream: Column, launch_at: Column) -> Column:
    """When the content dates from: the WARC name's 17 digits, else the launch
    (streams only), else the modification time."""
    digits = F.regexp_extract(name, WARC_TIMESTAMP_PATTERN, 1)
    seconds = F.try_to_timestamp(F.substr(digits, F.lit(1), F.lit(14)), F.lit("yyyyMMddHHmmss"))
    millis = F.substr(digits, F.lit(15), F.lit(3)).try_cast("int")
    from_name = F.when(digits != "", F.timestamp_millis(F.unix_millis(seconds) + millis))
    from_launch = F.when((digits == "") & stream.isNotNull(), launch_at)
    return F.when(kind == "warcs", F.coalesce(from_name, from_launch, modified_at)).otherwise(modified_at)


def permissions_to_string(octal: Column, is_directory: Column) -> Column:
    """``750`` to ``-rwxr-x---``; text that is already symbolic passes through."""
    bits = F.lpad(F.conv(octal, 8, 2), 9, "0")
    letters = F.array(*[F.lit(c) for c in "rwxrwxrwx"])
    symbolic = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.lit(9)),
            lambda i: F.when(F.substr(bits, i, F.lit(1)) == "1", F.element_at(letters, i)).otherwise(F.lit("-")),
        ),
        "",
    )
    prefix = F.when(is_directory, F.lit("d")).otherwise(F.lit("-"))
    return F.when(octal.rlike("^[0-7]+$"), F.concat(prefix, symbolic)).otherwise(octal)


def month_prefix(path: Column) -> Column:
    """``yyyy-MM`` of the first 14 or 17 digit run inside the name, else ``none``."""
    digits = F.regexp_extract(basename(path), r"[^0-9]([0-9]{17}|[0-9]{14})[^0-9]", 1)
    return F.when(digits == "", F.lit("none")).otherwise(
        F.concat(F.substr(digits, F.lit(1), F.lit(4)), F.lit("-"), F.substr(digits, F.lit(5), F.lit(2)))
    )


def index_name(stream: Column, year: Column) -> Column:
    """Search index that a stream and year belong to."""
    return (
        F.when(stream == "domain", F.concat(F.lit("NPLD-DC"), year.cast("string")))
        .when(stream == "selective", F.lit("selective"))
        .otherwise(F.concat(F.lit("NPLD-FC"), year.cast("string")))
    )


def wren_destination(path: Column, prefix: str = "") -> Column:
    """Folder a rendered-page WARC belongs in; NULL when its name does not match."""
    name = basename(path)
    job = F.regexp_extract(name, RENDER_WARC_PATTERN, 1)
    launch = F.regexp_extract(name, RENDER_WARC_PATTERN, 2)
    return F.when(
        name.rlike(RENDER_WARC_PATTERN),
        F.concat(F.lit(f"{prefix}/heritrix/output/"), job, F.lit("/"), launch, F.lit("/warcs")),
    )


def sha512_ok(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-fA-F]{128}$"), F.lit(False))


def job_launch_ok(text: Column, any_job: bool = False) -> Column:
    """``job/launch`` messages; ``any_job`` accepts any non-slash job name
    and trailing text."""
    return text.rlike("^[^/]+/[0-9]+" if any_job else "^[a-z]+/[0-9]+$")
