"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

# Settings a job relies on, applied only where the submitter has not set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# The JVM never compiles a method beyond 8,000 bytes of code and interprets it for every row; Spark's bound for a fused stage is 65,535.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
# Shuffle files otherwise stay on disk until the driver's JVM happens to collect the frames they belong to.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Codec of stages and mart tables.
CODEC = "zstd"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "salesmart", extra: dict | None = None) -> SparkSession:
    """A session with the job's settings.

    Master and shuffle partitions are left to spark-submit unless given (tests
    and the benchmark give them); a setting of ``DEFAULT_CONF`` that the
    submitter has made stays as it is.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    prefer_compiled(spark)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prefer_compiled(spark: SparkSession) -> None:
    """Have stages whose fused code is too long to be compiled run as separate operators, unless the submitter has set the bound."""
    if not spark.sparkContext.getConf().contains(METHOD_LIMIT[0]):
        spark.conf.set(*METHOD_LIMIT)


def on_one_machine(master: str) -> bool:
    """True for a master whose executors are threads of the driver (``local-cluster`` has its own processes)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required, as no other folder is known to be
    shared.  With a local master, where driver and tasks are one process, an
    unset one gets a temporary folder (tests, single-machine runs).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        jpath = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = jpath.get() if jpath.isDefined() else None
    if not path:
        if not on_one_machine(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="salesmart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}salesmart/{name}-{uuid.uuid4().hex[:12]}"


def write_stage(df: DataFrame, name: str, folder: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Cut lineage: write ``df`` as parquet into the shared folder and read it back.

    Used for intermediate results that several later passes read; the table
    survives executor loss (unlike cached blocks) and is read column-pruned.
    ``folder`` (a run's own folder) lets the run delete its stages at its end; such stages are written small (``write_small``).
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else scratch_path(spark, name)
    if folder:
        write_small(df, path, partition_by)
    else:
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete their shuffle files when they end, so that the disk holds those of one write at a time."""
    was = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, was)


def write_small(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write ``df`` as parquet with the smaller codec; its shuffle files do not outlive the write."""
    with freed_shuffles(df.sparkSession):
        df.write.mode(mode).option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form that the optimizer knows to be empty: joins with it vanish from the plan."""
    return spark.createDataFrame([], schema).limit(0)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; a store that cannot be asked raises."""
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete one folder that a run has made for itself."""
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)
