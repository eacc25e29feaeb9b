"""Session helpers: a local builder for tests and the bench, and the shared scratch folder.

Scratch data (checkpoints, round-trip writes) always goes under the folder the
cluster names in ``spark.checkpoint.dir``. A folder of our own is chosen only
when that setting is unset, which happens in local test sessions.
"""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "asterism", driver_memory: str = "8g") -> SparkSession:
    """A ``local[cores]`` session configured the way the tests and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Only a local session
    with no setting gets a fresh temporary folder; a cluster session without one
    is an error, because a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        configured = tempfile.mkdtemp(prefix="asterism-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


#: Scratch paths that each session was given and has not released yet.
_given: WeakKeyDictionary[SparkSession, list[str]] = WeakKeyDictionary()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint folder.

    What is written there stays until :func:`release_scratch`, as results are lazy
    and read it when they run.
    """
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove all scratch this session has written so far, on whatever store it is; the number of paths removed.

    For callers that have stored or consumed every result so far: results of this
    session that are still lazy lose their input. Other sessions keep theirs.
    """
    removed = 0
    given = _given.pop(spark, [])
    while given:
        path = spark._jvm.org.apache.hadoop.fs.Path(given.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed
