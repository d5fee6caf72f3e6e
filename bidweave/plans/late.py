"""Rows stored in another partition than the one their hour and group belong to.

An overwriting run replaces whole hours, so it must read every row of an hour,
wherever it is stored. Each run looks at the ids and times of the partitions it
is given, notes which other hours and buckets have rows there, and rolls those
up again as well. The notes stay next to the target, so later runs of an hour
find its rows without any assumption on how late they can be.

The notes and the partitions that a run adds to its window are tables that meet
the log in joins; the driver sees the days among them, to list no more folders
than needed. Runs on one target must not overlap.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.functions.columns import bucket_of, event_day, event_hour
from bidweave.schema import PARTITION_COLUMNS
from bidweave.session import delete_path, hadoop_path
from bidweave.sources.bid_log import read_bid_log
from bidweave.sources.windows import Window, in_mods

NOTES = "_placements"
OWN = ["own_dt", "own_hh", "own_mod"]
NOTES_SCHEMA = "own_dt date, own_hh int, own_mod int, dt date, hh int, cgid_mod int"
#: Files of notes from which on they are written anew as one.
MOST_NOTE_FILES = 32


def with_time(log: DataFrame) -> DataFrame:
    """Rows without ``epoch`` count at the start of the hour they are stored in."""
    stored = F.col("dt").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hh"))
    start = F.unix_millis(stored.cast("timestamp"))
    return log.withColumn("epoch", F.coalesce("epoch", start))


def own_key() -> dict[str, Column]:
    """Day, hour and bucket that a row belongs to."""
    epoch = F.col("epoch")
    return {
        "own_dt": event_day(epoch).cast("date"),
        "own_hh": event_hour(epoch).cast("int"),
        "own_mod": bucket_of(F.col("campaign_group_id")).cast("int"),
    }


def moved_rows(log: DataFrame) -> DataFrame:
    """Distinct (own_dt, own_hh, own_mod, dt, hh, cgid_mod) of rows stored elsewhere."""
    keyed = with_time(log).withColumns(own_key()).select(*OWN, *PARTITION_COLUMNS)
    return keyed.where(elsewhere(PARTITION_COLUMNS)).distinct()


def elsewhere(stored: list[str]) -> Column:
    """Whether the key a row belongs to is another than the one it is ``stored`` by."""
    return ~reduce(and_, [F.col(o).eqNullSafe(F.col(s)) for o, s in zip(OWN, stored, strict=True)])


def matched(rows: DataFrame, keys: DataFrame, names: list[str], how: str, key_names: list[str]) -> DataFrame:
    """Rows whose ``names`` are (not) among the keys, NULL equal to NULL."""
    a, b = rows.alias("a"), keys.alias("b")
    pairs = zip(names, key_names, strict=True)
    same = reduce(and_, [F.col(f"a.{x}").eqNullSafe(F.col(f"b.{y}")) for x, y in pairs])
    return a.join(b, same, how)


@dataclass
class Scope:
    """What one overwriting run replaces: a window's buckets, and single keys outside of it.

    ``extra`` (dt, hh, cgid_mod) are those keys, ``stored`` the partitions
    outside the window that can hold rows of the scope, their own among them;
    both are staged tables without repeated rows, or None if there are none.
    """

    window: Window
    mods: list[int] | None
    extra: DataFrame | None = None
    stored: DataFrame | None = None
    late_days: frozenset[date] = frozenset()
    """Days of ``stored``, which holds ``extra`` too."""

    def days(self) -> set[date]:
        return {*self.window.hours_by_day(), *self.late_days}

    def inside(self, names: list[str]) -> Column:
        """Whether a key is one of the window and its buckets."""
        day, hour, bucket = names
        chosen = self.window.on_partitions(day, hour) & in_mods(F.col(bucket), self.mods)
        return F.coalesce(chosen, F.lit(False))

    def stored_rows(self, log: DataFrame) -> DataFrame:
        """Rows of all partitions that hold rows of the scope; two scans of different partitions."""
        here = log.where(self.window.on_partitions() & in_mods(F.col("cgid_mod"), self.mods))
        if self.stored is None:
            return here
        elsewhere = log.where(~self.inside(PARTITION_COLUMNS))
        return here.unionByName(
            matched(elsewhere, self.stored, PARTITION_COLUMNS, "left_semi", PARTITION_COLUMNS)
        )

    def replaced(self, rows: DataFrame, names: list[str]) -> DataFrame:
        """Rows whose key belongs to the scope."""
        if self.extra is None:
            return rows.where(self.inside(names))
        marked = matched(rows, self.extra.withColumn("is_extra", F.lit(True)), names, "left", PARTITION_COLUMNS)
        chosen = self.inside([f"a.{n}" for n in names]) | F.col("b.is_extra").isNotNull()
        return marked.where(chosen).select("a.*")


def _note_files(spark: SparkSession, target: str) -> list[str]:
    """Files of the notes below ``target``; a folder that cannot be read is an error."""
    folder = hadoop_path(spark, f"{target}/{NOTES}")
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found = [status.getPath() for status in system.listStatus(folder)]
    return [path.toString() for path in found if path.getName()[:1] not in "._"]


def noted(spark: SparkSession, target: str) -> DataFrame | None:
    """All notes of earlier runs, or None."""
    if not _note_files(spark, target):
        return None
    return spark.read.schema(NOTES_SCHEMA).parquet(f"{target}/{NOTES}")


def add_notes(spark: SparkSession, target: str, moved: DataFrame) -> None:
    """Keeps notes that are new; many files of notes become one."""
    before = noted(spark, target)
    names = [*OWN, *PARTITION_COLUMNS]
    fresh = moved if before is None else matched(moved, before, names, "left_anti", names)
    if not fresh.isEmpty():
        fresh.coalesce(1).write.mode("append").parquet(f"{target}/{NOTES}")
    files = _note_files(spark, target)
    if len(files) >= MOST_NOTE_FILES:
        # All notes are there at any time; while the old files go, some are there twice.
        whole = spark.read.schema(NOTES_SCHEMA).parquet(*files).distinct()
        whole.coalesce(1).write.mode("append").parquet(f"{target}/{NOTES}")
        for file in files:
            delete_path(spark, file)


def scope_of(
    spark: SparkSession,
    source: str,
    target: str,
    window: Window,
    mods: list[int] | None,
    path: str,
    schema: T.StructType | None = None,
) -> Scope:
    """Notes the window's moved rows, and finds all that must be rolled up with it.

    Tables are staged below ``path``. A run without late rows writes nothing
    and reads the log as if there were no notes.
    """
    scope = Scope(window, mods)
    log = read_bid_log(spark, source, set(window.hours_by_day()), schema)
    moved = staged_keys(moved_rows(scope.stored_rows(log)), f"{path}/moved")
    if moved is not None:
        add_notes(spark, target, moved)
    notes = noted(spark, target)
    if notes is None:
        return scope
    names = [F.col(o).alias(p) for o, p in zip(OWN, PARTITION_COLUMNS, strict=True)]
    here = notes.where(scope.inside(PARTITION_COLUMNS) & ~scope.inside(OWN))
    return _widened(scope, here.select(*names).distinct(), notes, path)


def scope_of_keys(spark: SparkSession, target: str, keys: DataFrame, path: str) -> Scope:
    """The scope that replaces the hours and buckets of ``keys`` (dt, hh, cgid_mod) and no others."""
    nothing = Scope(Window(datetime(1970, 1, 1), 0), None)
    notes = noted(spark, target)
    if notes is None:
        notes = spark.createDataFrame([], NOTES_SCHEMA)
    return _widened(nothing, keys.select(*PARTITION_COLUMNS).distinct(), notes, path)


def _widened(scope: Scope, extra: DataFrame, notes: DataFrame, path: str) -> Scope:
    """The scope with ``extra`` keys, and all partitions outside its window that hold its rows."""
    scope.extra = staged_keys(extra, f"{path}/extra")
    there = scope.replaced(notes.where(~scope.inside(PARTITION_COLUMNS)), OWN).select(*PARTITION_COLUMNS)
    if scope.extra is not None:
        there = there.unionByName(scope.extra)
    scope.stored = staged_keys(there.distinct(), f"{path}/stored")
    if scope.stored is not None:
        scope.late_days = frozenset(r.dt for r in scope.stored.select("dt").distinct().collect())
    return scope


def staged_keys(keys: DataFrame, path: str) -> DataFrame | None:
    """The keys as a table at ``path``, or None if there are none."""
    spark, schema = keys.sparkSession, keys.schema
    keys.write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    return None if table.isEmpty() else table


def scope_log(
    spark: SparkSession, source: str, scope: Scope, schema: T.StructType | None = None
) -> DataFrame:
    """All rows of the scope's hours and buckets, wherever they are stored."""
    log = scope.stored_rows(read_bid_log(spark, source, scope.days(), schema))
    keyed = with_time(log).withColumns(own_key())
    return scope.replaced(keyed, OWN).drop(*OWN)
