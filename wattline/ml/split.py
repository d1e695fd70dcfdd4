"""Deterministic train/test split (ML-01)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.contracts import FOREST_SEED, TEST_SHARE


def test_flag(key: Column, test_share: float = TEST_SHARE, seed: int = FOREST_SEED) -> Column:
    """True for rows in the test share.

    The first 32 bits of md5('<seed>:<key>') are compared with
    share * 2^32, as fixed-width hex text. Unlike `randomSplit`, the answer
    depends on the key alone, so it survives repartitioning, retries and a
    lost executor.
    """
    threshold = format(int(test_share * 2 ** 32), "08x")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.substring(digest, 1, 8) < F.lit(threshold)


def hash_split(df: DataFrame, key: Column, test_share: float = TEST_SHARE,
               seed: int = FOREST_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames split on `key`."""
    flagged = df.withColumn("_is_test", test_flag(key, test_share, seed))
    return (flagged.where(~F.col("_is_test")).drop("_is_test"),
            flagged.where(F.col("_is_test")).drop("_is_test"))


def split_sql(key_sql: str, test_share: float = TEST_SHARE, seed: int = FOREST_SEED) -> str:
    """DuckDB twin of `test_flag`."""
    threshold = format(int(test_share * 2 ** 32), "08x")
    return f"(substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8) < '{threshold}')"
