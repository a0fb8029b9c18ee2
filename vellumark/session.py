"""Session settings, the shared work folder, and package shipping."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Spill, skew and batch settings every job of this package wants.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows may be whole blocks of vectors: an Arrow batch is bounded by bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

_built: dict[tuple, tuple] = {}
_shipped: set[str] = set()


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back on a temporary folder: on a cluster such
    a folder would exist on one machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors.")
    folder = tempfile.mkdtemp(prefix="vellumark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path of this application in the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once into the shared folder, with ``options`` of the writer, and read it back.

    Used where several passes read the same derived rows. The written table
    outlives lost executors, and readers prune its columns.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that no later step reads; others are left alone."""
    for table in tables:
        if path := getattr(table, "written_at", None):
            context = table.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, which it does once the driver has collected their plans.

    The last plan is held until the next job, hence the smallest of jobs.
    """
    spark.range(1).count()
    time.sleep(1)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def files_below(spark: SparkSession, folder: str) -> tuple:
    """Path, size and time of the files in a folder and the folders in it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return ()
    found = []
    for entry in store.listStatus(path):
        inner = store.listStatus(entry.getPath()) if entry.isDirectory() else [entry]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in inner]
    return tuple(sorted(found))


def built_once(spark: SparkSession, name: str, source: str, build) -> DataFrame:
    """Materialise ``build()`` on first use in this application, reuse it while the files of ``source`` stay as they are."""
    key = (spark.sparkContext.applicationId, source, name, files_below(spark, source))
    if key not in _built:
        df = build()
        path = new_path(spark, name)
        df.write.parquet(path)
        _built[key] = (path, df.schema)
    path, schema = _built[key]
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that is too small to split.

    A corpus with at least one scan task per core is returned as it is, so
    this adds a shuffle to small inputs only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vellumark-zip-"), "vellumark_workers")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
