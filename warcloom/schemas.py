"""Explicit schemas, one per data abstraction."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _B, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


CRAWL_LOG_FIELDS = [
    "timestamp", "status_code", "content_length", "url", "hop_path", "via", "mime",
    "thread", "start_time_plus_duration", "hash", "source", "annotation_string",
]

CRAWL_EVENT = _struct(
    timestamp=_S, url=_S, status_code=_I, mimetype=_S, size=_L, content_length=_L,
    start_time_plus_duration=_S, hop_path=_S, via=_S, seed=_S, annotations=_S, thread=_S,
    crawl_name=_S, job_name=_S, launch_id=_S, content_digest=_S, redirecturl=_S,
    warc_filename=_S, warc_offset=_L, extra_info=T.MapType(_S, _S),
)

LISTING = _struct(
    permissions=_S, number_of_replicas=_I, userid=_S, groupid=_S, filesize=_L, modified_at=_TS, filename=_S,
)

SCHEDULE = _struct(startDate=_S, endDate=_S, frequency=_S)

TARGET = _struct(
    id=_L, title=_S, seeds=T.ArrayType(_S), urls=T.ArrayType(_S), watched=_B, scope=_S, depth=_S,
    crawl_frequency=_S, isOA=_B, license_ids=T.ArrayType(_S), subject_ids=T.ArrayType(_L),
    schedules=T.ArrayType(SCHEDULE), ignoreRobotsTxt=_B,
)

DOCUMENT = _struct(
    document_url=_S, wayback_timestamp=_S, filename=_S, source=_S, landing_page_url=_S, launch_id=_S,
    job_name=_S, size=_L, title=_S, target_id=_L, status=_S,
)

WARC_RECORD = _struct(
    filename=_S, offset=_L, length=_L, rec_type=_S, record_id=_S, concurrent_to=_S, target_uri=_S, warc_date=_S, http_status=_I, location=_S,
    content_type=_S, mime=_S, digest=_S, http_method=_S, post_query=_S, outlinks=T.ArrayType(_S), warc_error=_S,
)

_HEADERS = T.ArrayType(_struct(name=_S, value=_S))
HAR_ENTRY = _struct(
    request=_struct(method=_S, url=_S, headers=_HEADERS), response=_struct(status=_I, headers=_HEADERS),
)
HAR = _struct(log=_struct(entries=T.ArrayType(HAR_ENTRY), pages=T.ArrayType(_struct(map=T.ArrayType(_struct(href=_S))))))
