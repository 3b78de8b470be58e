"""Session settings shared by the entry points, tests and bench."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

_ARROW = {
    T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(), T.DateType(): pa.date32(),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; leave sizing to the cluster.

    All day arithmetic is UTC. AQE does the runtime work: it coalesces small
    shuffle partitions, splits skewed join partitions, and turns a join into a
    broadcast only after measuring the small side. It coalesces up to 16 MB: chained
    windows and groupings hold some forty times a partition's compressed size.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    return spark


def constant_frame(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """A small constant table.

    Built through Arrow it is a local relation whose size the optimizer knows, so
    joins with it are broadcast because it is small; a list of rows would be an
    RDD of unknown size and shuffle the other side.
    """
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(list(c), _ARROW[f.dataType]) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)


def local_session(cpus: int = 8, memory: str = "8g", app: str = "tideledger") -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only an unset value on a local master falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="tideledger-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback
