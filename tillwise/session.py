"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. All can be set on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",  # month keys must not shift with the host
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later aggregation then needs its own exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Shuffles start with partitions of about this size and are merged at run time where data shrank. Stored bytes are compressed
# and a line is counted in up to 19 groupings of the cube, so a start partition is one MB: a task's share then stays the same
# as the lines grow.
PARTITION_BYTES = 1024 * 1024
# A shuffle has a piece for each pair of its partitions, so from so many partitions on they grow instead, up to this size.
MANY_PARTITIONS = 2**15
LARGE_PARTITION_BYTES = 2**28
# Run-time merging must not undo that: merged partitions aim at a few start partitions, not Spark's 64 MB, since a stage may
# explode its rows after the shuffle read (the cube's groupings) and its memory follows the rows read.
MERGED_BYTES = 4 * PARTITION_BYTES
# Scans too: a file split is aggregated on the map side, and splits grow with the files up to Spark's 128 MB.
SPLIT_BYTES = MERGED_BYTES

_local_checkpoints: list[tempfile.TemporaryDirectory] = []


def configure(spark: SparkSession, stored_bytes: int | None = None, partition_bytes: int = PARTITION_BYTES) -> SparkSession:
    """Apply the settings; with the size of the stored lines, also size the shuffles for them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if stored_bytes is not None:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sized = min(-(-stored_bytes // partition_bytes), MANY_PARTITIONS)
        wanted = max(usual, sized, -(-stored_bytes // LARGE_PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(MERGED_BYTES))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a temporary one only on a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        _local_checkpoints.append(tempfile.TemporaryDirectory(prefix="tillwise-checkpoint-"))
        context.setCheckpointDir(_local_checkpoints[-1].name)
    else:
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what runs inside only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write a table of many rows as Parquet under the checkpoint folder and read it back.

    Later reads take only the columns and row groups they need. The folder goes with the checkpoint folder.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def durable(df: DataFrame) -> DataFrame:
    """Write a table of few rows (groups, slices) to the checkpoint folder, so that losing executors cannot change or repeat it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
