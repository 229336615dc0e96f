"""Shared storage for intermediate tables, and sizes that decide about broadcasts."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes, counted over all rows as text, up to which a stored table is broadcast; beyond them the join shuffles.
BROADCAST_BYTES = 24 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, or else what setCheckpointDir was given.

    There is no other: a folder of this machine's own would be another one on each executor.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getCheckpointDir()
    if not conf:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return conf.rstrip("/")


#: Arrow batches of at most so many rows and bytes go to Python, where the session has no setting of its own.
FRUGAL = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "500"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, str(1 << 20))}


def frugal(df: DataFrame) -> DataFrame:
    """`df`, whose session now hands small batches to Python, so that a worker's memory doesn't depend on how long texts are."""
    conf = df.sparkSession.conf
    for key, (default, small) in FRUGAL.items():
        if default is None or conf.get(key) == default:
            conf.set(key, small)
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again: its lineage is cut, and later plans read it instead of computing it anew."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ids_hint(table: DataFrame) -> DataFrame:
    """`table`, a stored one, marked for broadcast if all its rows are measured to be small enough together."""
    size = table.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*table.columns)))), F.lit(0)).alias("n")).first().n
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def fitted(rows: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], object]) -> object:
    """What `fit` makes of all rows, in the order of their one partition, by one task of an executor: the driver gets the model only. For samples with a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array([pickle.dumps(fit(batches))], pa.binary())], ["model"])

    got = frugal(rows).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else fit(iter([]))


def free_name(columns: list[str], wanted: str) -> str:
    """`wanted`, with underscores in front until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def parts(df: DataFrame) -> int:
    """How many partitions a keyed exchange of this input should have: as set for the session, and more for larger inputs."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
