"""Bid logs as lines of text: JSON objects or delimited fields, with a quarantine for bad lines.

Every line becomes either a typed log row or a rejected line with its reason.
Fields are read as text first and then converted, so that a value of a wrong
type rejects its line by name instead of turning into NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.schema import BID_LOG_SCHEMA
from bidweave.sinks.log import append_log

#: Longer lines are rejected, and this many of their first characters are kept.
MOST_CHARS, KEPT_CHARS = 1_000_000, 1_000
FORMATS = ("json", "csv")
REJECTED = "line string, reason string, chars bigint, sha256 string, file string"
LONG, BROKEN, FIELDS = "line too long", "broken line", "wrong number of fields"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file) of all lines of the text files below ``path``; empty lines are none."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where(
        F.col("line") != ""
    )


def _cut(line: Column, kind: str, separator: str, names: list[str]) -> Column:
    """The line's members as a struct of texts, or its cells as an array."""
    if kind == "json":
        schema = ", ".join(f"`{n}` string" for n in [*names, "__corrupt"])
        return F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    return F.split(line, f"\\Q{separator}\\E", -1)


def _texts(line: Column, cut: Column, kind: str, names: list[str]) -> tuple[dict[str, Column], Column]:
    """The line's fields as texts, and what is wrong with the line as a whole."""
    if kind == "json":
        # Text behind the object, as after a torn write, is no part of it.
        whole = line.rlike(r"^\s*\{.*\}\s*$")
        bad = cut.isNull() | cut["__corrupt"].isNotNull() | ~whole
        return {n: cut.getField(n) for n in names}, F.when(bad, F.lit(BROKEN))
    cells = [F.get(cut, F.lit(i)) for i in range(len(names))]
    texts = {n: F.when(cell != "", cell) for n, cell in zip(names, cells, strict=True)}
    return texts, F.when(F.size(cut) != len(names), F.lit(FIELDS))


def parsed_lines(
    lines: DataFrame,
    kind: str = "json",
    schema: T.StructType | None = None,
    required: tuple[str, ...] = ("epoch",),
    separator: str = "\t",
    most_chars: int = MOST_CHARS,
) -> DataFrame:
    """``lines`` (line, file) with ``row``, the typed log row, and ``reason``, NULL for good lines.

    "json" takes an object per line; absent members are NULL, unknown ones are
    ignored. "csv" takes the schema's fields in order between ``separator``,
    without quotes; empty ones are NULL. A line is rejected if it is longer
    than ``most_chars``, broken, lacks a ``required`` value, or holds a value
    that its column's type cannot take.
    """
    if kind not in FORMATS:
        raise ValueError(f"kind must be one of {FORMATS}, got {kind!r}")
    schema = schema or BID_LOG_SCHEMA
    fits = F.char_length("line") <= most_chars
    line = F.when(fits, F.col("line"))
    # Explodes one value a line: what is generated is not copied into each expression that uses
    # it, as a filter of the reason would do, so the line is cut once.
    cut = F.explode(F.array(_cut(line, kind, separator, schema.fieldNames()))).alias("__cut")
    texts, broken = _texts(line, F.col("__cut"), kind, schema.fieldNames())
    typed, reasons = [], [F.when(~fits, F.lit(LONG)).otherwise(broken)]
    for field in schema.fields:
        text = texts[field.name]
        value = text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        reasons.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"bad {field.name}")))
        if field.name in required:
            reasons.append(F.when(text.isNull(), F.lit(f"no {field.name}")))
    return lines.select("line", "file", cut).select(
        "line", "file", F.struct(*typed).alias("row"), F.coalesce(*reasons).alias("reason")
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("row.*")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """(line, reason, chars, sha256, file) of the rejected lines; of a long line only its beginning."""
    bad = parsed.where(F.col("reason").isNotNull())
    return bad.select(
        F.substring("line", 1, KEPT_CHARS).alias("line"),
        "reason",
        F.char_length("line").cast("bigint").alias("chars"),
        F.sha2("line", 256).alias("sha256"),
        "file",
    )


def ingest_lines(
    spark: SparkSession, path: str, log: str, quarantine: str, kind: str = "json", **options
) -> DataFrame:
    """Appends the good lines below ``path`` to a partitioned log, and the bad ones to ``quarantine``.

    Returns (reason, lines): the number of good lines (NULL reason) and of
    those of each reason, as written. Rows are stored by their own hour and
    bucket. The lines are read once for each of the two tables.
    """
    parsed = parsed_lines(read_lines(spark, path), kind, **options)
    append_log(good_rows(parsed), log)
    rejected_lines(parsed).write.mode("append").partitionBy("reason").parquet(quarantine)
    return parsed.groupBy("reason").agg(F.count("*").alias("lines"))
