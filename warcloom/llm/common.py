"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two multiply-xorshift rounds) on uint64."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which driver and executors share."""
    return ensure_checkpoint_dir(spark)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the same on driver and executors."""
    import public_tokenizers

    return public_tokenizers.path(name)
