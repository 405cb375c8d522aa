"""Small awkward tables shared by the tests of the training-data operators."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, base string, label int"


def docs(spark, rows):
    """Documents with extra columns, some of whose names clash with what operators add."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "x", 1) for i, t in rows], DOCS)


def plain(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
