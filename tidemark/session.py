"""Session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the models rely on: wall-clock timestamps in UTC, strict (ANSI) casts,
# and adaptive execution so join strategy, partition counts and skewed
# partitions are decided from runtime sizes instead of guesses. HotSpot never
# compiles a method of more than 8000 bytes, and a staging projection fused with
# its joins is one: such stages run operator by operator, in compiled pieces.
# Shuffle files go when their query ends: a build is many of them, and otherwise
# its shuffles stay on disk until the driver's JVM happens to collect its garbage.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster leave
    them unset and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Startup-only settings: no web UI, no console progress bar, and checkpoint
    # files removed once the checkpointed data is no longer referenced.
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; it raises where that is unset. Only local runs (tests, bench) without it
    get a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


_scratch_roots: set[str] = set()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a written intermediate table, beside the checkpoints.

    All of an application's lie in one folder of its own, which is removed when
    the driver's Python ends; until then lazy results may read them.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    root = f"{base.rstrip('/')}/tidemark-{sc.applicationId}"
    if root not in _scratch_roots:
        _scratch_roots.add(root)
        atexit.register(_remove_scratch, sc, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _remove_scratch(sc, root: str) -> None:
    if sc._jsc is None:  # the session is stopped already
        return
    with contextlib.suppress(Exception):  # nothing to be done about it at exit
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written to a scratch folder and read back: the lineage ends there,
    what it holds is fixed (partition ids too), and a lost executor costs tasks
    of the current step only. Unlike a checkpoint it is computed once."""
    path = scratch_folder(df.sparkSession, name)
    return _written_to(path, df, codec)


@contextlib.contextmanager
def written_meanwhile(df: DataFrame, name: str, codec: str | None = None):
    """``written`` for a block only: the files are removed when it ends, so what
    is made of them has to be stored by then."""
    path = scratch_folder(df.sparkSession, name)
    try:
        yield _written_to(path, df, codec)
    finally:
        _remove_scratch(df.sparkSession.sparkContext, path)


def _written_to(path: str, df: DataFrame, codec: str | None) -> DataFrame:
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it was loaded
    from, also when the driver was started elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def lake_root(spark: SparkSession) -> str:
    """Root folder for the written bronze / silver / gold layers.

    ``tidemark.lake.root`` wins; otherwise a folder next to the checkpoints,
    which on a cluster is shared storage.
    """
    root = spark.conf.get("tidemark.lake.root", None)
    if root:
        return root
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    root = os.path.join(base.rsplit("/", 1)[0] if "/" in base else base, "tidemark-lake")
    spark.conf.set("tidemark.lake.root", root)
    return root
