"""Intermediate tables in the folder that all machines of a cluster share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session, one machine, gets a folder of its own when none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        of_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = of_context.get() if of_context.isDefined() else None
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="panelscope-")
    spark.sparkContext.setCheckpointDir(own)
    return shared_folder(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to a new table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fresh(name: str, columns: Sequence[str]) -> str:
    """`name`, with underscores added until no column of the caller's has it (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def released(*frames: DataFrame) -> None:
    """Delete tables made by `stored` that no lazy result needs any more."""
    for df in frames:
        spark = df.sparkSession
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
