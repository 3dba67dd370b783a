"""Small helpers the corpus operators share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.words import frugal

BATCH_BYTES = "4m"
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The frame without columns an operator is about to add; names compare as Spark does, by any case."""
    clash = {n.lower() for n in names}
    return df.select([quoted(c) for c in df.columns if c.lower() not in clash])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` in batches of a few megabytes, so that memory does not follow the texts' length.

    The session's batch size is lowered for good, as frames are run later; one that was set is left.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING) in (f"{_BATCH_DEFAULT}b", str(_BATCH_DEFAULT)):
        conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(frugal(run), schema)


def aside(df: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The frame with all columns but ``used`` under names no operator adds, and the way back to the old columns."""
    names = {c: c if c in used else f"__{k}" for k, c in enumerate(df.columns)}

    def back(rows: DataFrame) -> DataFrame:
        return rows.select([quoted(names[c]).alias(c) for c in df.columns])

    return df.select([quoted(c).alias(names[c]) for c in df.columns]), back


def bounded_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side rows (parameters, boundaries) as a frame, with no Python on the executors."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def packed(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(id, packed, further columns): texts pressed for the way through a shuffle, a third of their size."""
    rows = docs.select(quoted(doc_id).alias("id"), quoted(text).cast("string").alias("packed"), *more)
    fields = [f for f in rows.schema.fields if f.name != "packed"]
    schema = T.StructType([fields[0], T.StructField("packed", T.BinaryType()), *fields[1:]])
    names = rows.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = pa.array([press.compress(t.encode("utf-8")) if t else b"" for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), texts, *part.columns[2:]], names=names)

    return map_arrow(rows, run, schema)
