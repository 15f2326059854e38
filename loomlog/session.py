"""Session defaults and the shared scratch folder.

Scratch data (re-imported tables, text corpora derived from the driver
tables, staged upserts) always lives under the folder the cluster names
in ``spark.checkpoint.dir``.  Only when that setting is absent (local
runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[int, str] = {}
_SHIPPED: set[str] = set()


def build_session(master: str | None = None, app: str = "loomlog",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every job in this library assumes.

    * UTC session zone, so ``date_format``/``hour`` on zoned values are
      stable (the library also never depends on it, see functions.scalar).
    * AQE on: coalesces small shuffle partitions, splits skewed ones and
      turns joins into broadcasts only after it has measured the real size.
    * UI off: no server is started.

    Settings given by the launcher (``spark-submit --master yarn --conf
    …``) win: a default is applied only where the launcher set nothing.
    The master is ``local[N]`` only when none is given either way, and the
    local-only defaults (driver memory, a shuffle width of 2 × N) apply only
    then.  ``master`` / ``shuffle_partitions`` passed here always apply.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    launcher = None
    if os.environ.get("PYSPARK_GATEWAY_PORT"):   # spark-submit (or a shell) started the JVM:
        SparkContext._ensure_initialized()        # connect, so SparkConf() holds its settings
        launcher = SparkConf()

    def given(key: str) -> bool:
        return launcher is not None and launcher.contains(key)

    local = (master is not None or not given("spark.master")
             or launcher.get("spark.master").startswith("local"))
    builder = SparkSession.builder.appName(app)
    if master is not None or not given("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if local:
        defaults["spark.driver.memory"] = "16g"
        defaults["spark.sql.shuffle.partitions"] = str(int(cpus) * 2)
    conf = {k: v for k, v in defaults.items() if not given(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Local mode: tasks import this package wherever the program was started.
    (On a cluster it is installed or sent with ``--py-files``.)"""
    sc = spark.sparkContext
    if sc.master.startswith("local[") and sc.applicationId not in _SHIPPED:
        sc.addFile(os.path.dirname(os.path.abspath(__file__)), recursive=True)
        _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session first; set a private one only where it is unset
    and the master is local (local runs and tests).  On a cluster without
    the setting this raises instead of using a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if root:
            # getCheckpointDir appends a random child; its parent is ours.
            root = root.rsplit("/", 1)[0]
    if not root and not spark.sparkContext.master.startswith("local"):
        # A machine-local folder is not shared by executors: refuse.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(HDFS, object store); loomlog keeps scratch data there")
    if not root:
        key = id(spark.sparkContext)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="loomlog-ckpt-")
        root = _LOCAL_FALLBACK[key]
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: dict[int, set[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root, removed by
    ``drop_scratch`` or ``release_scratch``."""
    path = f"{checkpoint_root(spark)}/loomlog-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(id(spark.sparkContext), set()).add(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one folder that ``scratch_path`` gave."""
    mine = _SCRATCH.get(id(spark.sparkContext), set())
    if path not in mine:
        raise ValueError(f"not a scratch folder of this session: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    mine.discard(path)


def release_scratch(spark: SparkSession) -> None:
    """Remove every scratch folder this session still has (derived corpora,
    query tables).  For the end of a job: results that read them are gone too."""
    for path in list(_SCRATCH.get(id(spark.sparkContext), ())):
        drop_scratch(spark, path)


def _input_bytes(df: DataFrame) -> int:
    """Size of what the plan reads: the sum of its leaf relations' size
    estimates (file sizes for file scans).  Unlike the estimate at the top
    of the plan, it is not inflated by join estimates (a product without
    cost-based statistics).  A leaf of unknown size (an RDD) counts as 0."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < unknown)


def input_partitions(df: DataFrame) -> int:
    """A partition count that follows the input: bytes read by ``df``
    divided by ``spark.sql.files.maxPartitionBytes`` (about one partition
    per input split), at least the cluster's default parallelism.  Planning only — nothing is executed.  Used where a
    shuffle carries whole input rows into an operator AQE cannot split (a
    window, a partitioned write): a fixed ``spark.sql.shuffle.partitions``
    would give each task a fixed fraction of an input of any size."""
    spark = df.sparkSession
    floor = spark.sparkContext.defaultParallelism
    try:
        target = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        size = _input_bytes(df)
    except Exception:  # estimate unavailable: fall back to the parallelism
        return floor
    return max(floor, -(-size // max(target, 1)))


def shuffle_width(spark: SparkSession) -> int | None:
    """``spark.sql.shuffle.partitions`` as a number; None when the setting
    is not a plain number (left to the platform)."""
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return None
