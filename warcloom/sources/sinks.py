"""Text, CSV and table sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tsv_json(df: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of joined key, tab, and the other columns as JSON."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(F.concat_ws("\t", F.concat_ws(",", *keys), F.to_json(F.struct(*rest))).alias("value"))


def write_tsv_json(df: DataFrame, keys: list[str], path: str, mode: str = "errorifexists") -> None:
    tsv_json(df, keys).write.mode(mode).text(path)


def write_report_csv(df: DataFrame, path: str, order: list[str] | None = None, mode: str = "overwrite") -> None:
    """A report as headed CSV files, in order when one is given. Small reports
    come out as one file through adaptive coalescing."""
    out = df.orderBy(*order) if order else df
    out.write.mode(mode).option("header", True).csv(path)


def append_new(existing_path: str, incoming: DataFrame, key: str, order: list) -> int:
    """Append rows whose key a Parquet table does not hold yet; the first row
    per key wins. Returns how many were added."""
    from ..operators.tracking import upsert_ignore
    from ..session import cut_lineage

    spark = incoming.sparkSession
    try:
        existing = spark.read.schema(incoming.schema).parquet(existing_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = incoming.limit(0)  # first run: nothing stored yet
    fresh = cut_lineage(upsert_ignore(existing, incoming, key, order))
    fresh.write.mode("append").parquet(existing_path)
    return fresh.count()
