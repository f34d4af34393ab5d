"""Session helpers: a tuned local session for tests/bench, and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every kestrel job is designed around.  AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions (hot question ids, hot terms).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed by Spark itself
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel",
                  driver_memory: str = "16g", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.  On a cluster the caller builds its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect (the server owns files and checkpoints)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir`` (None when unset)."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    sc = _context(spark)
    if sc is None:
        return None
    return sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a folder.

    The session's ``spark.checkpoint.dir`` is used as is.  Only a local-mode session with the
    setting unset (tests) gets a fresh folder of its own; a cluster without it is an error,
    because a machine-local folder does not survive the loss of that machine.
    """
    sc = _context(spark)
    if sc is None:
        folder = checkpoint_dir(spark)
        if not folder:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = checkpoint_dir(spark)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return folder


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where a result is reread many times (k-means inputs).  A lost executor then costs a
    reread of the checkpoint files, not a recomputation of the scans and aggregates behind
    them.  A cluster without ``spark.checkpoint.dir`` is an error (see ``ensure_checkpoint_dir``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release_checkpoint(df: DataFrame) -> None:
    """Delete the files of a frame made by ``reliable_checkpoint``; it cannot be read any more.

    Needs no session flag.  Frames without checkpoint files are left alone.
    """
    plan = df._jdf.queryExecution().logical()
    if plan.nodeName() != "LogicalRDD":
        return
    found = plan.rdd().getCheckpointFile()
    if found.isDefined():
        delete_path(df.sparkSession, found.get())


class Held:
    """Owner of the materialised frames of a computation; ``close`` deletes their files.

        with Held(spark) as held:
            points = held.store(df)
            ...

    ``checkpoint`` keeps the partitions and their order; ``store`` writes Parquet into a fresh folder
    of the shared checkpoint folder and reads it again: the frame is computed once (a checkpoint
    computes it twice) and later reads prune columns and push filters.  A frame that reads from what
    is held can't be read after ``close``; hand the owner on with ``owned`` where such a frame is the result.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._frames: list[DataFrame] = []
        self._folders: list[tuple[DataFrame, str]] = []

    def checkpoint(self, df: DataFrame) -> DataFrame:
        out = reliable_checkpoint(df)
        self._frames.append(out)
        return out

    def store(self, df: DataFrame, name: str = "stored", partition_by: str | None = None) -> DataFrame:
        """``df`` as a Parquet table; with ``partition_by``, a folder per value of that column (moved last)."""
        path = f"{ensure_checkpoint_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._folders.append((out, path))
        return out

    def release(self, df: DataFrame) -> None:
        """Delete the files of one frame that this owner made."""
        if any(df is frame for frame in self._frames):
            self._frames = [frame for frame in self._frames if frame is not df]
            release_checkpoint(df)
        for out, path in [f for f in self._folders if f[0] is df]:
            self._folders = [f for f in self._folders if f[0] is not out]
            delete_path(self.spark, path)

    def close(self) -> None:
        for df in [*self._frames, *(out for out, _ in self._folders)]:
            self.release(df)

    def __enter__(self) -> Held:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def owned(df: DataFrame, held: Held) -> DataFrame:
    """``df``, which reads from what ``held`` owns; ``close_result(df)`` frees it once it has been read."""
    df._kestrel_held = held
    return df


def pass_on(result: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, made of ``result``, with what ``result`` owns."""
    held = getattr(result, "_kestrel_held", None)
    return owned(df, held) if held is not None else df


def close_result(df: DataFrame) -> None:
    """Free what a query's result reads from, if it owns anything; it cannot be read any more."""
    held = getattr(df, "_kestrel_held", None)
    if held is not None:
        held.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder of any file system that Spark reads is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
