"""Index (CDX) record expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DASH, DEDUPED, REVISIT_MIME
from .urls import surt_canonical, surt_host_key

CDX_FIELDS = [
    "urlkey", "timestamp", "original", "mimetype", "statuscode", "digest",
    "redirecturl", "robotflags", "length", "offset", "filename",
]
_EXTENDED_SCHEME = r"^[a-z]+:http"


def is_extended_scheme(original: Column) -> Column:
    return original.rlike(_EXTENDED_SCHEME)


def cdx_host_key(original: Column, urlkey: Column) -> Column:
    """Key that spreads index rows: ``screenshot-http-host`` for extended
    schemes, else the SURT up to its bracket."""
    scheme = F.regexp_extract(original, r"^([a-z]+):", 1)
    inner = F.lower(F.regexp_extract(original, r"^[a-z]+:([A-Za-z]+):", 1))
    host = F.lower(F.regexp_extract(original, r"^[a-z]+:[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(is_extended_scheme(original), F.concat_ws("-", scheme, inner, host)).otherwise(
        surt_host_key(urlkey)
    )


def cdx_status_ok(status: Column) -> Column:
    """``-`` or a whole number below 600."""
    number = F.when(status.rlike("^[0-9]+$"), status.try_cast("int"))
    return (status == DASH) | F.coalesce(number < 600, F.lit(False))


def normalise_mime(mime: Column) -> Column:
    return F.lower(mime)


def cdx_line(cols: dict[str, Column] | None = None) -> Column:
    """The eleven fields joined by spaces, NULLs as ``-``."""
    c = cols or {n: F.col(n) for n in CDX_FIELDS}
    return F.concat_ws(" ", *[F.coalesce(c[n].cast("string"), F.lit(DASH)) for n in CDX_FIELDS])


def record_to_cdx(record: dict[str, Column] | None = None, post_query: Column | None = None) -> Column:
    """Index line of one archived record.

    Revisits and records without an HTTP status carry ``-`` there; only
    redirect statuses keep the Location. ``post_query`` stands for the body of
    the request that was answered and becomes part of the key alone.
    """
    r = record or {
        n: F.col(n)
        for n in ("rec_type", "target_uri", "warc_date", "http_status", "location", "mime", "digest", "length", "offset", "filename")
    }
    asked = r["target_uri"]
    if post_query is not None:
        joint = F.when(asked.contains("?"), "&").otherwise("?")
        asked = F.when(post_query.isNull(), asked).otherwise(F.concat(F.substring_index(asked, "#", 1), joint, post_query))
    revisit = r["rec_type"] == "revisit"
    redirect = F.when(r["http_status"].between(300, 399), r["location"])
    return cdx_line(
        {
            "urlkey": surt_canonical(asked),
            "timestamp": F.substr(F.regexp_replace(r["warc_date"], "[^0-9]", ""), F.lit(1), F.lit(14)),
            "original": r["target_uri"],
            "mimetype": F.when(revisit, F.lit(REVISIT_MIME)).otherwise(normalise_mime(r["mime"])),
            "statuscode": F.when(~revisit, r["http_status"]),
            "digest": r["digest"],
            "redirecturl": redirect,
            "robotflags": F.lit(DASH),
            "length": r["length"],
            "offset": r["offset"],
            "filename": r["filename"],
        }
    )


def event_is_indexable(url: Column, status: Column, warc_filename: Column) -> Column:
    return url.startswith("http") & F.coalesce(status > 0, F.lit(False)) & warc_filename.isNotNull()


def event_to_cdx(root: str = "") -> Column:
    """Index line of a crawl event (see schemas.CRAWL_EVENT); use with
    :func:`event_is_indexable`. De-duplicated events become revisits."""
    deduped = F.coalesce(F.col("annotations").contains(DEDUPED), F.lit(False))
    redirect = F.when(F.floor(F.col("status_code") / 100) == 3, F.col("redirecturl"))
    return F.concat_ws(
        " ",
        F.lit(DASH),
        F.substr("start_time_plus_duration", F.lit(1), F.lit(14)),
        F.col("url"),
        F.when(deduped, F.lit(REVISIT_MIME)).otherwise(F.coalesce("mimetype", F.lit(DASH))),
        F.when(deduped, F.lit(DASH)).otherwise(F.col("status_code").cast("string")),
        F.coalesce("content_digest", F.lit(DASH)),
        F.coalesce(redirect, F.lit(DASH)),
        F.lit(DASH),
        F.lit(DASH),
        F.coalesce(F.col("warc_offset").cast("string"), F.lit(DASH)),
        F.concat_ws("/", F.lit(f"{root}/output/warcs"), "job_name", "launch_id", "warc_filename"),
    )
