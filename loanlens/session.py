"""Session construction for tests / benchmarks and the checkpoint folder.

On a cluster the session comes from ``spark-submit`` and
``spark.checkpoint.dir`` names a shared folder (HDFS / object store);
``ensure_checkpoint_dir`` uses it. Only a local session without that
setting gets a scratch folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter at scale; the same values are safe locally.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}


def build_session(
    app: str = "loanlens",
    master: str | None = "local[*]",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on and the UI off (no server is started)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    conf.update(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "8g",
        }
    )
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from ``spark.checkpoint.dir`` if needed.

    A local session with no setting gets a fresh scratch folder; a cluster
    session with no setting is an error (a machine-local folder would not
    survive the loss of that machine).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="loanlens-checkpoint-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS or object store)")


_CREATED: list[str] = []
_FOLDER_OF: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()  # of the tables that ``checkpointed`` gave


def scratch_folder(spark: SparkSession, kind: str = "table") -> str:
    """A new folder's name under the reliable checkpoint folder; ``release_checkpoints`` deletes it, at the latest when Python ends."""
    if not _CREATED:
        atexit.register(_release_at_exit)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _CREATED.append(folder)
    return folder


def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if _CREATED and spark is not None and not spark.sparkContext._jsc.sc().isStopped():
        release_checkpoints(spark)


def checkpointed(df, partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as Parquet under the reliable checkpoint folder and read it back.

    The known schema is passed to the read, so no job infers it. With
    ``partition_by`` a filter on those columns reads only its folders.
    This cuts the lineage like ``checkpoint()``, and the read-back keeps
    column pruning and filter pushdown. The folder lives under
    ``spark.checkpoint.dir``, so it survives the loss of any executor.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(folder)
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    table = spark.read.schema(df.select(*(f"`{c}`" for c in columns)).schema).parquet(folder)
    _FOLDER_OF[table] = folder
    return table


def release_table(table) -> bool:
    """Delete a table that ``checkpointed`` returned, once no frame that is still to be computed reads it."""
    folder = _FOLDER_OF.pop(table, None)
    if folder not in _CREATED:
        return False
    _CREATED.remove(folder)
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_checkpoints(spark: SparkSession) -> int:
    """Delete the checkpoint tables this process wrote (call once their frames are no longer used)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _CREATED:
        path = jvm.org.apache.hadoop.fs.Path(_CREATED.pop())
        if path.getFileSystem(conf).delete(path, True):
            n += 1
    return n


def local_rows(spark: SparkSession, rows: list[tuple], schema: str):
    """A few driver-side rows as a DataFrame of literals: no Python relation, no job.

    ``schema`` is ``name type, name type, ...``; for bounded results only.
    """
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, fields, strict=True))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
