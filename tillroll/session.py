"""Session settings, checkpoints and size-checked broadcasts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Hot visits, products or departments are split at run time, also where the split
# costs one more shuffle: every aggregation above such a join combines map-side first.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Fill in the settings the operators rely on, where the session leaves them unset, and put
    this package on the path of the Python workers.

    Give the size of the input where it is known: shuffles then start with one partition
    per ``advisoryPartitionSizeInBytes`` of it, however many cores there are. The session's own size
    counts, not what :func:`bound_tasks` has set for a scan log read before.
    """
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    _size_shuffles(spark, input_bytes)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))
    return spark


def _size_shuffles(spark: SparkSession, input_bytes: int | None) -> None:
    # 200 partitions are too few for a large cluster. Start from the input, or else from
    # four per core, and let adaptive execution merge the small ones.
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    chosen = (spark.conf.get(initial, None), spark.conf.get("spark.sql.shuffle.partitions", None))
    wanted = 4 * spark.sparkContext.defaultParallelism
    if input_bytes is not None:
        bounded = spark.conf.get(_ADVISED, None) is not None and spark.conf.get(_ADVISORY) == _SHARE
        wanted = max(wanted, -(-input_bytes // in_bytes(spark, _ADVISED if bounded else _ADVISORY)))
    if chosen == (None, None) and wanted > 200:
        spark.conf.set(initial, str(wanted))


#: Stored bytes that a scan gives to one task, and that a shuffle gives to one task at most, compressed.
_SHARE = "16m"
#: Stored bytes of input per partition that a shuffle starts with; adaptive execution merges small ones.
_PER_SHUFFLE = 2 << 20
_SIZED = "tillroll.shuffle.initial"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: The advisory size that held before these bounds replaced it.
_ADVISED = "tillroll.shuffle.advised"


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of tasks grow with the input and not what each of them sorts and sums.

    Splits and shuffle partitions are cut at 16 MB where the session leaves their sizes unset.
    Shuffles start with a partition per 2 MB of input, also beyond the session's shuffle partitions,
    unless it sets the initial number itself; the number only rises within a session.
    """
    if spark.conf.get("spark.sql.files.maxPartitionBytes", None) is None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", _SHARE)
    if spark.conf.get(_ADVISORY, None) is None:
        spark.conf.set(_ADVISED, spark.conf.get(_ADVISORY))
        spark.conf.set(_ADVISORY, _SHARE)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(initial, None)
    if now is not None and now != spark.conf.get(_SIZED, None):
        return
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(now or 0))
    if (wanted := -(-input_bytes // _PER_SHUFFLE)) > least:
        spark.conf.set(initial, str(wanted))
        spark.conf.set(_SIZED, str(wanted))


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions that a shuffle starts with."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


def stored_bytes(rows: DataFrame) -> int:
    """The size of the files that ``rows`` reads, as their listing gives it."""
    return int(rows._jdf.queryExecution().analyzed().stats().sizeInBytes())


def spread(rows: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Redistribute a scan that comes in few splits, such as one gzipped file, over
    ``partitions``; None leaves it alone. Give keys that together are nearly unique.
    """
    return rows if partitions is None else rows.repartition(partitions, *keys)


def constants(spark: SparkSession, rows: Sequence[tuple], *names: str) -> DataFrame:
    """A few fixed rows, as literals in the plan."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _base(spark: SparkSession) -> str:
    # The folder for what is materialised. A temporary one goes with the process.
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not sc.master.startswith("local"):
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    if folder is None:
        folder = tempfile.mkdtemp(prefix="tillroll-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_base(spark))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there.

    That is ``spark.checkpoint.dir``; on a cluster without it, a folder in the warehouse,
    which all executors share; in local mode a temporary one, removed with the process.
    """
    _folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """A name for files that all executors see, beside what is checkpointed."""
    return f"{_folder(spark)}/table-{uuid.uuid4().hex}"


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` from a Parquet table in the shared checkpoint folder, in a folder per value of ``by``."""
    path = new_folder(df.sparkSession)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scoped(spark: SparkSession) -> Iterator[str]:
    """What is checkpointed or written inside lives in one folder of its own, which is removed at
    the end, also of a failure. Nothing lazy that reads it may leave the scope; scopes may nest.
    """
    sc = spark.sparkContext
    before = sc.getCheckpointDir()
    folder = f"{before or _base(spark)}/scope-{uuid.uuid4().hex}"
    sc.setCheckpointDir(folder)
    try:
        yield folder
    finally:
        sc._jsc.sc().setCheckpointDir(before or folder.rpartition("/")[0])
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` is ``value`` for what is materialised inside, unless the session sets it itself."""
    unset = spark.conf.get(key, None) is None
    if unset:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(key)


def lookup(df: DataFrame) -> DataFrame:
    """Materialise a lookup table and hint its broadcast if its size allows."""
    return size_checked(checkpoint(df))


def size_checked(table: DataFrame) -> DataFrame:
    """Hint the broadcast of a materialised table only if its measured size allows.

    A table over the session's ``autoBroadcastJoinThreshold`` is returned without the
    hint, so its joins shuffle (and split hot keys) instead.
    """
    size = table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(table) if size <= in_bytes(table.sparkSession, "spark.sql.autoBroadcastJoinThreshold") else table


def in_bytes(spark: SparkSession, setting: str) -> int:
    text = spark.conf.get(setting).lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.rstrip("ib").rstrip("kmg")
    unit = text[len(digits):].rstrip("ib")
    return int(digits) * units.get(unit, 1)
