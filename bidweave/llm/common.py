"""Reading tables and staging intermediate ones in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.session import staged  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.

    ``lower`` does the same for pure ASCII, and faster.
    """
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def tasks(spark: SparkSession, least: int = 1) -> int:
    """Partitions for an explicit exchange."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def smallest_hashes(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest hashes of ``keys``: a bounded sample that is the same each time.

    Rows whose hash is far above the ``n``-th smallest are left out before the
    sort, so the task that merges gets little more than ``n`` rows however
    many partitions there are.
    """
    total = rows.count()
    order = F.xxhash64(*keys)
    if total > n:
        share = n / total
        share += 8 * (share / total) ** 0.5 + 8 / total
        rows = rows.where(order <= F.lit(int((min(share, 1.0) - 0.5) * 2**64) - (share >= 1.0)))
    return rows.orderBy(order, *keys).limit(n)
