"""Helpers shared by the operators: reading tables, Arrow batches, tables written for reuse."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import ensure_checkpoint_dir

# Rows of one Arrow batch. Texts may be very long, so batches are kept short.
BATCH_ROWS = 500

DDL = {
    pa.int32(): "int",
    pa.int64(): "bigint",
    pa.bool_(): "boolean",
    pa.string(): "string",
    pa.binary(): "binary",
    pa.float64(): "double",
    pa.list_(pa.int32()): "array<int>",
    pa.list_(pa.int64()): "array<bigint>",
}


def prepare(spark: SparkSession) -> None:
    """Short Arrow batches, and Python workers that find this package where it lies in the same place as here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fresh_names(df: DataFrame, *wanted: str, avoid: Iterable[str] = ()) -> list[str]:
    """Names that neither a column of the table nor one to avoid has, whatever their case."""
    taken = {name.lower() for name in (*df.columns, *avoid)}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_results(df: DataFrame, column: str, added: Mapping[str, pa.DataType], function: Callable[[list], Sequence]) -> DataFrame:
    """Add columns computed from one text column, batch by batch, without a shuffle.

    `function` gets the batch's texts (None for null) and returns one sequence or Arrow array per added column.
    A column of the table with the name of an added one is replaced.
    """
    prepare(df.sparkSession)
    lowered = {name.lower() for name in added}
    kept = [name for name in df.columns if name.lower() not in lowered]
    (source,) = fresh_names(df, "text_in", avoid=added)
    fed = df.select(*[F.col(quoted(name)) for name in kept], F.col(quoted(column)).cast("string").alias(source))
    schema = ", ".join(
        [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fed.schema.fields if f.name != source]
        + [f"{quoted(name)} {DDL[kind]}" for name, kind in added.items()]
    )
    place = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = function(batch.column(place).to_pylist())
            arrays = [
                x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=kind)
                for x, kind in zip(found, added.values(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], *arrays], names=[*kept, *added])

    return fed.mapInArrow(run, schema)


def lists_of_int32(parts: list[bytes]) -> pa.ListArray:
    """One list per part, from little-endian 32-bit numbers."""
    ends = np.cumsum([0, *(len(x) // 4 for x in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))


def written(df: DataFrame) -> DataFrame:
    """Write a table once to the shared checkpoint folder, and read it back.

    Parquet in a folder of its own under `spark.checkpoint.dir`: later reads prune columns, and losing executors
    loses nothing. The folder belongs to the checkpoint folder and is removed with it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)


class Memo(dict):
    """A dictionary that computes what is missing, and forgets everything once it is full."""

    def __init__(self, compute: Callable, entries: int = 250_000):
        super().__init__()
        self.compute = compute
        self.entries = entries

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= 64:  # long strings are rare and would only fill the memory
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value
