"""Lineage cuts in the folder that driver and executors share, and the spreading of small inputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint under spark.checkpoint.dir; under a temporary folder where that is unset and there is one process only (tests)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession) -> str:
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: it names the folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="anchorwise-")
    spark.sparkContext.setCheckpointDir(found)
    return found


def table(df: DataFrame, by: str | None = None) -> DataFrame:
    """Cuts the lineage by a table in the shared folder, whose size the optimizer then knows; over joins of checkpoints with each other, estimates grow out of hand.
    With `by`, a column of few values, a filter on it reads the files of that value alone."""
    folder = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    (df.write if by is None else df.write.partitionBy(by)).parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._folder = folder
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Deals out an input unless its rows lie evenly in as many splits as the cluster has cores, for steps that cost much a row. Files are cut into splits by bytes, but a row group
    goes whole to one of them, so most splits of a file can be empty: rows are counted by split, which reads the footers of files alone. Larger inputs stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows, most = df.select(F.spark_partition_id().alias("split")).groupBy("split").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return df.repartition(max(1, min(3 * cores, rows))) if most * cores > 2 * rows else df


#: Bytes of input, as the optimizer estimates them, for a part of dealt().
PART_BYTES = 8 << 20


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Deals rows out by a key, in parts that are small enough for what they are broken up into to be counted in memory. An aggregate by the key and other columns then has no exchange of its own, so the
    rows travel as they are, not their pieces."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES)), key)
