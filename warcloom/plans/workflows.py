"""Workflows: operators put together the way the archive runs them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import captures, harvest, holdings, logs, tracking
from ..session import cut_lineage


def index_batch(tracked: DataFrame, cdx: DataFrame, collection: str, batch_size: int | None = None, status_field: str = "cdx_index_ss",
                stream: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Pick WARCs not indexed yet, measure them from their index rows and mark
    them. Returns the updated items and the status updates (for
    tracking.apply_updates; leave them out for a dry run)."""
    items = tracking.not_yet_indexed(tracked, status_field, collection, stream=stream, limit=batch_size)
    paths = items.select(F.col("file_path_s").alias("filename"))
    metrics = captures.cdx_file_metrics(cdx.join(paths, "filename", "left_semi"))
    merged = tracking.merge_item_metrics(items.select("id", "file_path_s"), metrics, "status", collection)
    return merged, tracking.status_updates(items, status_field, collection)


def log_analysis_run(log: DataFrame, targets: DataFrame, day: str, job_name: str | None = None) -> dict[str, DataFrame]:
    """Summaries, documents and seed results of one day from one parse, which is checkpointed."""
    lines = cut_lineage(log.filter(F.col("timestamp").startswith(day)))
    return {
        "summary": logs.summarise_logs(lines),
        "documents": harvest.document_candidates(lines, targets, job_name),
        "seeds": logs.seed_results(lines),
    }


def daily_reports(files: DataFrame, stored: DataFrame | None = None) -> dict[str, DataFrame]:
    """``stored``: the same files with file_path, file_size and permissions only, for the
    reports that need nothing else; classified files are classified by each report."""
    stored = files if stored is None else stored
    return {
        "total-file-size-by-stream": holdings.holdings_by_stream(files, "size"),
        "total-file-count-by-stream": holdings.holdings_by_stream(files, "count"),
        "npld-total-file-size-by-stream-per-month": holdings.npld_by_month(files),
        "npld-total-file-size-by-stream-totals": holdings.npld_totals(files),
        "totals-by-kind": holdings.totals_by_kind(files),
        "unparsed-file-paths": holdings.unparsed_paths(files),
        "duplicates": holdings.duplicate_files(stored),
        "empty": holdings.empty_files(stored),
    }


def sanity_problems(metrics: DataFrame, required: str, dropped: str | None = None) -> DataFrame:
    """Rows of a metrics frame that make a job's result unbelievable: the
    required counter is missing or zero, or records were dropped."""
    n = F.col(required)
    problem: Column = F.when(n.isNull(), f"{required} missing").when(n == 0, f"{required} is zero")
    if dropped is not None:
        problem = problem.when(F.coalesce(F.col(dropped), F.lit(0)) > 0, f"{dropped} above zero")
    return metrics.withColumn("problem", problem).filter("problem IS NOT NULL")


def check_job(metrics: DataFrame, required: str, dropped: str | None = None) -> None:
    bad = sanity_problems(metrics, required, dropped).select("problem").first()
    if bad is not None:
        raise RuntimeError(f"job result looks wrong: {bad.problem}")
