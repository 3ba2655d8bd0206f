"""Session construction and shared scratch locations.

Everything a job writes on the side (round-trip files, stream checkpoints,
stream outputs) goes under the cluster's shared checkpoint folder, read from
the session (``spark.checkpoint.dir``).  A machine-local temporary folder is
only created when that setting is unset *and* the master is local (tests,
bench), never on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins and aggregates at runtime
# (coalesces small shuffle partitions, splits skewed ones, turns small join
# sides into broadcasts from measured sizes).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Smaller side outputs (round trips, materialised sides, stream sinks).
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    # Streaming state off the JVM heap, checkpointed incrementally: state of a
    # large stream does not become GC pressure or an executor OOM.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tributary",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if master and not master.startswith("local"):
        # On a shared cluster coalesce shuffle partitions to the advisory
        # size (not to the core count): fewer, fuller tasks.  Locally keep
        # Spark's default, which favours parallelism on small shuffles.
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - unset static keys raise on some versions
        value = None
    return value or None


def _is_local(spark: SparkSession) -> bool:
    return (_conf(spark, "spark.master") or "").startswith("local")


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session (falling back to the context's checkpoint folder
    where a SparkContext exists).  Set only where it is unset and the master
    is local (tests); on a cluster an unset value is an error, since a
    machine-local folder is not shared.
    """
    root = _conf(spark, "spark.checkpoint.dir") or _LOCAL_ROOTS.get(id(spark))
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            root = None
    if root:
        return root
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: set it to a shared folder "
            "(HDFS/object store) before running on a cluster")
    root = _LOCAL_ROOTS.get(id(spark))
    if root is None:
        root = tempfile.mkdtemp(prefix="tributary-ckpt-")
        _LOCAL_ROOTS[id(spark)] = root
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # noqa: BLE001 - no SparkContext
            pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tributary-scratch/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A table name that no other run uses."""
    return f"tributary_{prefix}_{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str, free_shuffles: bool = False, **options):
    """Write ``df`` as parquet under the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes from the written table, not
    from the whole upstream plan), and gives Catalyst the table's real size,
    so a small derived side is broadcast on evidence, not on a hint.
    ``discard`` removes the files again.  ``free_shuffles`` has Spark remove
    the shuffle files behind the table as soon as it is written, instead of
    when the driver next collects its garbage.  ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_FREE_SHUFFLES, None) if free_shuffles else None
    if free_shuffles:
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").options(**options).parquet(path)
    finally:
        if free_shuffles and before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        elif free_shuffles:
            spark.conf.set(_FREE_SHUFFLES, before)
    stored = spark.read.parquet(path)
    stored._scratch = path
    return stored


def discard(stored) -> None:
    """Remove the files of a frame that ``materialize`` returned, once nothing
    that is still to run reads them; other frames are left alone."""
    path = getattr(stored, "_scratch", None)
    if path is None:
        return
    spark = stored.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (0 when unknown)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - no SparkContext
        return int(_conf(spark, "spark.default.parallelism") or 0)


def spread(df, min_partitions: int | None = None):
    """Round-robin the rows of a scan over at least ``min_partitions``
    partitions (default: the cluster's task slots) when it has fewer and its
    files are fewer than a quarter of that, before CPU-heavy per-row work such
    as tokenising or regex over long texts.  For frames read from files only:
    counting the partitions of a derived frame can run its upstream shuffles.

    A table stored as one large row group is read by a single task however
    many splits the file is cut into; spreading its rows first lets every core
    work.  On a cluster reading many files the scan already has far more
    partitions than task slots and the input is returned unchanged (no
    shuffle).  Round-robin partitioning is made retry-safe by Spark sorting the
    rows first (``spark.sql.execution.sortBeforeRepartition``).
    """
    target = min_partitions or parallelism(df.sparkSession)
    if target <= 1 or df.rdd.getNumPartitions() >= target or 4 * len(df.inputFiles()) > target:
        return df
    return df.repartition(target)
