"""Writing log rows into the partitioned log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.functions.columns import bucket_of, event_day, event_hour
from bidweave.schema import PARTITION_COLUMNS

#: Rows with a long payload take many times their stored size in memory, so a task that reads
#: the log gets few of them.
ROW_GROUP_BYTES = 8 << 20
#: Payloads repeat their names in every row and are most of the log.
CODEC = "zstd"


def log_keys() -> dict[str, Column]:
    """Partition columns of a row's own hour and bucket, from ``epoch`` and ``campaign_group_id``."""
    epoch = F.col("epoch")
    return {
        "dt": event_day(epoch),
        "hh": F.lpad(event_hour(epoch).cast("string"), 2, "0"),
        "cgid_mod": bucket_of(F.col("campaign_group_id")),
    }


def append_keyed(keyed: DataFrame, path: str) -> str:
    """Appends rows that have their partition columns and are dealt out by them."""
    options = {"parquet.block.size": ROW_GROUP_BYTES, "compression": CODEC}
    writer = keyed.write.mode("append").options(**options)
    writer.partitionBy(*PARTITION_COLUMNS).parquet(path)
    return path


def append_log(log: DataFrame, path: str) -> str:
    """Appends raw log rows to the log at ``path``, in the partitions of their own hour and bucket."""
    return append_keyed(log.withColumns(log_keys()).hint("rebalance", *PARTITION_COLUMNS), path)
