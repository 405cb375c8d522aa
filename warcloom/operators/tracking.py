"""Tracking records: queries, updates, indexing state, task events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import STORE_ID_PREFIX, STORE_KINDS
from ..functions import urls as U

NONE_VALUE = "_NONE_"


def on_that_day(column: Column, day: Column, inclusive_end: bool = True) -> Column:
    """From midnight of ``day`` to the next midnight, which counts unless
    ``inclusive_end`` is off."""
    start = F.date_trunc("day", day)
    end = start + F.expr("INTERVAL 1 DAY")
    return (column >= start) & (column <= end if inclusive_end else column < end)


def _value_matches(records: DataFrame, field: str, value: str) -> Column:
    """Exact or trailing-star match on a single or multi-valued field."""
    def match(v: Column) -> Column:
        return v.startswith(value[:-1]) if value.endswith("*") else v == value

    if records.schema[field].dataType.typeName() == "array":
        return F.coalesce(F.exists(field, match), F.lit(False))
    return F.coalesce(match(F.col(field).cast("string")), F.lit(False))


def field_filter(records: DataFrame, field: str, value: str) -> Column:
    """``_NONE_`` asks for an unset field; a leading ``-`` negates."""
    negate, name = field.startswith("-"), field.lstrip("-")
    if value == NONE_VALUE:
        empty = F.col(name).isNull()
        if records.schema[name].dataType.typeName() == "array":
            empty = empty | (F.size(name) == 0)
        return ~empty if negate else empty
    hit = _value_matches(records, name, value)
    return ~hit if negate else hit


def track_query(
    records: DataFrame, kind: str, service: str | None = None, stream: str | None = None, year: int | None = None,
    modified_after: Column | None = None, that_day: bool = False, field: str | None = None, value: str | None = None,
    sort: list[Column] | None = None, limit: int | None = None,
) -> DataFrame:
    """All given conditions must hold; newest first, all rows unless a limit is given."""
    out = records.filter(F.col("kind_s") == kind)
    for column, wanted in (("hdfs_service_id_s", service), ("stream_s", stream), ("year_i", year)):
        if wanted is not None:
            out = out.filter(F.col(column) == wanted)
    if modified_after is not None:
        modified = F.col("modified_at_dt")
        out = out.filter(on_that_day(modified, modified_after) if that_day else modified >= modified_after)
    if field is not None:
        out = out.filter(field_filter(records, field, value))
    out = out.orderBy(*(sort or [F.desc("timestamp_dt"), F.asc("id")]))
    return out if limit is None else out.limit(limit)


def track_get(records: DataFrame, kind: str, record_id: str) -> DataFrame:
    """The record with that id, or no row unless there is exactly one."""
    found = records.filter((F.col("kind_s") == kind) & (F.col("id") == record_id))
    return (
        found.groupBy("id").agg(F.count("*").alias("_n"), F.first(F.struct(*records.columns)).alias("_r"))
        .filter("_n = 1").select("_r.*")
    )


def recent_tracked(records: DataFrame, now: Column, kinds: list[str] | None = None) -> DataFrame:
    """Records of the given kinds refreshed within the last day."""
    since = now - F.expr("INTERVAL 1 DAY")
    return records.filter(F.col("kind_s").isin(kinds or ["warcs", "crawl-logs", "logs"]) & (F.col("refresh_date_dt") >= since))


def not_yet_indexed(records: DataFrame, status_field: str, collection: str, kind: str = "warcs", stream: str | None = None,
                    modified_after: Column | None = None, limit: int | None = None) -> DataFrame:
    return track_query(records, kind, stream=stream, modified_after=modified_after, field=f"-{status_field}",
                       value=f"{collection}*", limit=limit)


def warcs_for_dates(records: DataFrame, start: str, end: str, stream: str, status_field: str, status_value: str,
                    kind: str = "warcs", limit: int | None = None) -> DataFrame:
    """Paths of a kind and stream dated from start to end day, both whole, that
    do not carry the status yet."""
    day = F.to_date("timestamp_dt")
    return (
        records.filter((F.col("kind_s") == kind) & (F.col("stream_s") == stream))
        .filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        .filter(field_filter(records, f"-{status_field}", status_value))
        .orderBy("timestamp_dt", "file_path_s").select("file_path_s")
        .transform(lambda d: d if limit is None else d.limit(limit))
    )


def delete_preview(records: DataFrame, field: str, values: DataFrame) -> DataFrame:
    """How many rows hold one of the listed values (column ``value``)."""
    return records.join(values.select(F.col("value").alias(field)).distinct(), field, "left_semi").agg(F.count("*").alias("n_matching"))


def delete_by_values(records: DataFrame, field: str, values: DataFrame) -> DataFrame:
    """Rows left after removing those with a listed value. Values with double
    quotes are not usable as selectors and raise an error."""
    checked = values.select(
        F.when(F.col("value").contains('"'), F.raise_error(F.concat(F.lit("quote in value: "), "value"))).otherwise(F.col("value")).alias(field)
    ).distinct()
    return records.join(checked, field, "left_anti")


def upsert_ignore(existing: DataFrame, incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows to append: the first new row per key, keys already held left out.

    Copies of a key are folded by a minimum in each task before the exchange.
    """
    columns = incoming.columns
    first = incoming.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r")).select("r.*")
    return first.join(existing.select(key), key, "left_anti").select(*columns)


def import_records(records: DataFrame, kind: str) -> DataFrame:
    """Records ready to store, with ``import_error`` set where one is refused.

    Documents get an id from their URL; store kinds must bring a store id;
    other kinds cannot be imported.
    """
    out = records
    for name in ("kind_s", "id"):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast("string"))
    out = out.withColumn("kind_s", F.coalesce("kind_s", F.lit(kind)))
    no_error = F.lit(None).cast("string")
    if kind == "documents":
        return out.withColumn("id", F.coalesce("id", F.concat(F.lit("document:document_url:"), "document_url"))).withColumn("import_error", no_error)
    if kind in STORE_KINDS:
        return out.withColumn(
            "import_error",
            F.when(F.col("id").isNull(), "id missing").when(~F.col("id").startswith(STORE_ID_PREFIX), "id is not a store id"),
        )
    return out.withColumn("import_error", F.lit("kind cannot be imported"))


def accepted(imported: DataFrame) -> DataFrame:
    return imported.filter("import_error IS NULL").drop("import_error")


def refused(imported: DataFrame) -> DataFrame:
    return imported.filter("import_error IS NOT NULL")


def refused_updates(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates that name a field the base does not have, or none. The version
    field, which the store keeps for itself, is not reported."""
    known = [f for f in base.columns if f != "id"] + ["_version_"]
    return updates.filter(F.col("field").isNull() | ~F.col("field").isin(known))


def apply_updates(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Base records with field updates applied; unknown ids become records.

    updates: id, field, action (set, add-distinct, remove, inc), value (text),
    seq. A later ``set`` replaces what came before, an empty one clears the
    field; of several adds and removes of one value the last counts. Updates
    of fields the base does not have are not applied; ``refused_updates`` lists
    them.

    Updates are reduced per (id, field, value) first, so a busy record sends
    its distinct values, not every update.
    """
    fields = {f.name: f.dataType for f in base.schema.fields if f.name != "id"}
    u = updates.filter(F.col("field").isin(list(fields)))
    last_set = u.filter("action = 'set'").groupBy("id", "field").agg(
        F.max("seq").alias("set_seq"), F.max_by("value", "seq").alias("set_value")
    )
    changes = (
        u.filter("action <> 'set'").join(last_set.select("id", "field", "set_seq"), ["id", "field"], "left")
        .filter(F.col("set_seq").isNull() | (F.col("seq") > F.col("set_seq")))
    )
    member = changes.filter("action <> 'inc'").groupBy("id", "field", "value").agg(F.max_by("action", "seq").alias("action"))
    lists = member.groupBy("id", "field").agg(
        F.sort_array(F.collect_set(F.when(F.col("action") == "add-distinct", F.col("value")))).alias("added"),
        F.collect_set(F.when(F.col("action") == "remove", F.col("value"))).alias("removed"),
    )
    sums = changes.filter("action = 'inc'").groupBy("id", "field").agg(F.sum(F.col("value").cast("bigint")).alias("inc"))
    merged = (
        last_set.withColumn("was_set", F.lit(True)).join(lists, ["id", "field"], "full").join(sums, ["id", "field"], "full")
        .select("id", "field", F.struct("was_set", "set_value", "added", "removed", "inc").alias("u"))
    )
    # One column per updated field; the field list is the base schema, so no extra pass.
    wide = merged.groupBy("id").pivot("field", list(fields)).agg(F.first("u")).select(
        "id", *[F.col(f).alias(f"_u_{f}") for f in fields]
    )

    def updated(name: str) -> Column:
        t, u_, old = fields[name], F.col(f"_u_{name}"), F.col(name)
        was_set = F.coalesce(u_["was_set"], F.lit(False))
        value = F.nullif(u_["set_value"], F.lit(""))
        if t.typeName() == "array":
            start = F.when(was_set, F.when(value.isNotNull(), F.array(value))).otherwise(old)
            start = F.coalesce(start, F.array().cast(t))
            none = F.array().cast(t)
            out = F.array_except(F.array_union(start, F.coalesce(u_["added"], none)), F.coalesce(u_["removed"], none))
            return F.when(u_.isNull(), old).otherwise(F.when(F.size(out) > 0, out)).alias(name)
        start = F.when(was_set, value.cast(t)).otherwise(old)
        if t.typeName() in ("long", "integer"):
            start = F.when(u_["inc"].isNotNull(), F.coalesce(start, F.lit(0)) + u_["inc"]).otherwise(start)
        else:
            # Adding to a single-valued field replaces it.
            start = F.coalesce(F.array_max(u_["added"]).cast(t), start)
        return start.cast(t).alias(name)

    return base.join(wide, "id", "full").select("id", *[updated(f) for f in fields])


def merge_item_metrics(items: DataFrame, metrics: DataFrame, status_field: str, status_value: str) -> DataFrame:
    """Items with their per-file metrics (by path) and the new status."""
    path = F.regexp_replace("id", r"^[a-z0-9]+://[^/]*", "")
    return (
        items.withColumn("_path", path)
        .join(metrics.withColumnRenamed("filename", "_path"), "_path", "left").drop("_path")
        .withColumn(status_field, F.lit(status_value))
    )


def tracked_status(files: DataFrame, tracked: DataFrame, path: str = "file_path") -> DataFrame:
    """Files on disk by whether they are tracked: finished WARCs in and out of
    tracking, open WARCs, other files."""
    known = tracked.select(F.col("file_path_s").alias(path), F.lit(True).alias("_known")).distinct()
    done = F.col(path).endswith("warc.gz")
    is_open = F.col(path).endswith("warc.gz.open")
    return files.join(known, path, "left").agg(
        F.count_if(done).alias("warcs"),
        F.count_if(done & F.col("_known").isNotNull()).alias("warcs_in_tracking"),
        F.count_if(done & F.col("_known").isNull()).alias("warcs_not_in_tracking"),
        F.count_if(is_open).alias("warcs_open"),
        F.count_if(~done & ~is_open).alias("other_files"),
    )


def verify_search_index(warcs: DataFrame, documents: DataFrame, path: str = "file_path") -> DataFrame:
    """Number of search documents per WARC (by base name); 0 means missing.

    documents: source_file. They are counted per file before the join.
    """
    per_file = documents.groupBy(U.basename(F.col("source_file")).alias("_name")).agg(F.count("*").alias("n_documents"))
    return (
        warcs.select(path).withColumn("_name", U.basename(F.col(path))).join(per_file, "_name", "left")
        .select(path, F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.col("n_documents").isNotNull().alias("found"))
    )


def verify_totals(verified: DataFrame) -> DataFrame:
    return verified.agg(F.count_if("found").alias("found"), F.count_if(~F.col("found")).alias("missing"))


def status_updates(items: DataFrame, status_field: str, status_value: str, seq: int = 1) -> DataFrame:
    """add-distinct updates (see apply_updates) that mark items."""
    return items.select("id", F.lit(status_field).alias("field"), F.lit("add-distinct").alias("action"), F.lit(status_value).alias("value"), F.lit(seq).alias("seq"))


def task_events(runs: DataFrame) -> DataFrame:
    """Task-event records of a frame of runs.

    runs: task, date, started and finished (timestamps), status, params
    (map of texts), metrics (map of counts). The id holds the parameters in their
    order; a run that has not finished has no runtime.
    """
    pairs = F.transform(F.map_entries(F.coalesce("params", F.create_map().cast("map<string,string>"))), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return runs.select(
        F.concat_ws(":", F.lit("task"), "task", "date", F.array_join(pairs, ":")).alias("id"), F.lit("tasks").alias("kind_s"),
        F.col("started").alias("started_at_dt"), F.col("finished").alias("finished_at_dt"), F.col("status").alias("task_status_s"),
        ((F.unix_micros("finished") - F.unix_micros("started")) / F.lit(1_000_000.0)).alias("runtime_secs"),
        F.coalesce("metrics", F.create_map().cast("map<string,bigint>")).alias("metrics"))


def task_metrics(runs: DataFrame) -> DataFrame:
    """(task, metric, total, last, runs): what a task's runs counted; runs as in :func:`task_events`."""
    rows = runs.select("task", "finished", "date", F.explode("metrics").alias("metric", "n"))
    return rows.groupBy("task", "metric").agg(
        F.sum("n").alias("total"), F.max_by("n", F.struct("finished", "date", "n")).alias("last"), F.count("*").alias("runs"))


def task_outcomes(events: DataFrame) -> DataFrame:
    """Runs, successes, last status and runtime per task.

    events: task, finished_at, status, runtime_secs, and id as tie-break.
    """
    latest = F.struct("finished_at", "id")
    return events.groupBy("task").agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("successes"),
        F.max_by("status", latest).alias("last_status"), F.max_by("runtime_secs", latest).alias("last_runtime_secs"),
        F.sum("runtime_secs").alias("total_runtime_secs"),
    )
