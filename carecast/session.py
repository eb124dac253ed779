"""Session settings and the shared folder for materialised stages.

``cluster_conf`` is what a large run should use: AQE on (partition
coalescing, skew-join splitting, runtime broadcast), shuffle partitions
sized from the input, and a broadcast threshold the planner checks
against plan statistics. ``local_session`` is the same for tests and the
bench on one machine.
"""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import storage

#: Beyond so many shuffle partitions, the bookkeeping of every shuffle outweighs smaller tasks.
MOST_PARTITIONS = 50_000


def cluster_conf(input_bytes: int | None = None, target_partition_bytes: int = 256 << 20) -> dict:
    """Spark settings for a large cluster run.

    Shuffle partitions follow the input size (about 256 MB per partition
    before AQE coalescing, at most ``MOST_PARTITIONS``, which bounds only
    parallelism); AQE then merges small ones and splits skewed
    ones, so a key holding a third of the rows is cut into several tasks.
    """
    parts = 2000 if input_bytes is None else max(200, min(MOST_PARTITIONS, input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # One demand-model plan generates ~110 classes; the default cache of
        # 100 compiled classes would evict them within a single run.
        "spark.sql.codegen.cache.maxEntries": "2000",
        # Generated code for the rule CASE chains exceeds HotSpot's 8 KB
        # JIT limit; without this flag those methods stay interpreted.
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "carecast",
                  extra: dict | None = None) -> SparkSession:
    conf = cluster_conf()
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf:  # one machine, so its own folder is a shared one
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="carecast-ckpt-")
        atexit.register(shutil.rmtree, conf["spark.checkpoint.dir"], ignore_errors=True)
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for materialised stages (``spark.checkpoint.dir``).

    Read from the session. Only a local-mode session (tests, one-machine
    runs) without the setting gets a private folder, with a warning, which goes
    when the process ends; on a cluster an unset folder is an error, since a
    machine-local path is not shared.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            d = None
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="carecast-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        warnings.warn(f"spark.checkpoint.dir is unset: this local session writes its stages to {d}", stacklevel=3)
        sc.setCheckpointDir(d)
    return d


#: The folders written by the job that is running, if it drops them at its end.
_written: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("written", default=None)


@contextlib.contextmanager
def job_scope(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` writes inside lives until the job ends, well or not.

    The source's scripts drop their named intermediates; here a job drops the
    folders once its result is written (inner jobs leave theirs to the outermost one,
    whose result may still read them). A DataFrame that is handed out lazily must be
    written inside the scope.
    """
    if _written.get() is not None:
        yield
        return
    token = _written.set([])
    try:
        yield
    finally:
        folders = _written.get() or []
        _written.reset(token)
        for path in folders:
            storage.delete(spark, path)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts lineage: a lost executor re-reads the written files instead of
    recomputing the upstream joins. Each call writes a new folder, which
    ``job_scope`` drops at the end of a job. ``partition_by`` makes one folder a
    value; the rows of a value are brought together first, so that each has few files.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    folders = _written.get()
    if folders is not None:
        folders.append(path)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.mode("error").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package as a zip, once per Spark context.

    Pandas and Arrow functions import the package on the executors, which
    need not have it installed; ``addPyFile`` lets Spark distribute it.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_carecast_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="carecast-zip-"), "carecast_package.zip")  # read by the driver only
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in sorted(x for x in names if x.endswith(".py")):
                full = os.path.join(folder, n)
                z.write(full, os.path.join("carecast", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._carecast_shipped = True
