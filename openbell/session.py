"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def recommended_conf() -> dict[str, str]:
    """Settings to pass to ``SparkSession.builder`` for a cluster run.

    The zone must be UTC: wall-clock columns are derived from UTC instants.
    Shuffle partitions are left to AQE, which starts high and coalesces.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the snapshot stream's custom state needs it
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        # every derived column of a wide feature table is a constraint, and joins of
        # such tables multiply them: seconds to minutes of planning for nothing
        "spark.sql.constraintPropagation.enabled": "false",
        # a mean vector per day keeps one object buffer per key; the default
        # of 128 keys would fall back to sorting the whole partition
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    }


_local_base: str | None = None
_made: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder is invisible to the other executors.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        _local_base = _local_base or tempfile.mkdtemp(prefix="openbell-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new shared path that ``drop_materialized`` deletes with the intermediate tables."""
    path = shared_dir(spark, purpose)
    _made.append(path)
    return path


def materialize(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and
    a lost executor costs a re-read instead of a recomputation."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete the tables and folders that ``materialize`` and ``scratch_dir`` made in this session after the first
    ``since`` (up to ``until``); for the end of a job whose results are stored elsewhere."""
    for path in _made[since:until]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del _made[since:until]


def materialized_count() -> int:
    return len(_made)
