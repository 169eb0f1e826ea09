"""Session helpers.

The library never starts its own cluster: every public function takes the
DataFrames (and so the session) it works on.  These helpers only cover two
things the operators need from the session:

* ``local_session`` builds a session for tests, benchmarks and notebooks with
  the settings the operators are tuned for (AQE on, UI off, UTC).
* ``ensure_checkpoint_dir`` makes sure reliable checkpoints have a target.  On
  a cluster that target must be the shared folder named by
  ``spark.checkpoint.dir``; only a local-mode session may fall back to a
  scratch folder of its own.
"""

from __future__ import annotations

import json
import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratingspark", driver_memory: str = "16g") -> SparkSession:
    """A local session configured like the operators expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable-checkpoint folder, setting one only where it is unset.

    Order: an already configured context folder, then ``spark.checkpoint.dir``
    from the session conf, then (local mode only) a fresh scratch folder.  A
    cluster session without a shared folder is an error: a machine-local
    folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session: the server's
        return ""      # own spark.checkpoint.dir applies
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        base = os.environ.get("TMPDIR", "/tmp")
        folder = tempfile.mkdtemp(prefix="ratingspark-ckpt-", dir=base)
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set: name a shared folder (HDFS/object "
        "store) so checkpoints survive executor loss"
    )


#: Spark deletes a query's shuffle files when it has ended, while this is on.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING = threading.Lock()


def write_parquet(df: DataFrame, path: str) -> None:
    """Writes ``df`` as Parquet; the shuffle files that this took go with the query."""
    conf = df.sparkSession.conf
    with _WRITING:
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            conf.set(CLEANUP, before)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the reliable checkpoint folder and cut lineage.

    The files are Parquet: a few bytes for a rating, where Spark's own checkpoint
    takes its whole row uncompressed, and computes it twice.
    """
    path = scratch_folder(df.sparkSession, "table")
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder of any file system that Spark knows exists."""
    fs, at = _file_system(spark, path)
    return bool(fs.exists(at))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that the library wrote; a missing one is no error."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratingspark-{name}-{uuid.uuid4().hex}"


class Generations:
    """Tables of a loop, each written as Parquet in a shared folder.

    ``write`` returns the table read back from its files.  A generation is
    written while the last one is read, and the one before stays for results
    that were handed out a step ago; older ones are deleted.

    With a ``folder`` of the caller the loop can go on after its driver was
    lost: each generation is entered, with a ``note``, in a manifest there
    once its files are complete, and ``last`` finds the newest entry.  Without
    one, a scratch folder is used and there is no manifest.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, name: str, folder: str | None = None):
        self.spark = spark
        self.durable = folder is not None
        self.folder = folder.rstrip("/") if folder else scratch_folder(spark, name)
        self.n = 0

    def last(self) -> tuple[DataFrame, list[dict]] | None:
        """The newest complete generation, and the notes of all up to it; None if there is none."""
        manifest = f"{self.folder}/manifest"
        if not self.durable or not folder_exists(self.spark, manifest):
            return None
        rows = self.spark.read.schema("n long, note string").json(manifest).collect()  # one for each generation
        if not rows:
            return None
        notes = {r["n"]: json.loads(r["note"]) for r in rows}
        newest = max(notes)
        self.n = newest + 1
        return self.spark.read.parquet(f"{self.folder}/{newest}"), [notes[n] for n in sorted(notes)]

    def write(self, df: DataFrame, note: dict | None = None) -> DataFrame:
        n, path = self.n, f"{self.folder}/{self.n}"
        self.n += 1
        write_parquet(df, path)  # over files of a writer that was lost before its entry
        if self.durable and note is not None:
            self.commit(n, note)
        if n >= self.KEPT:
            delete_folder(self.spark, f"{self.folder}/{n - self.KEPT}")
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, n: int, note: dict) -> None:
        """Enters generation ``n`` in the manifest."""
        row = self.spark.createDataFrame([(n, json.dumps(note))], "n long, note string")
        row.coalesce(1).write.mode("append").json(f"{self.folder}/manifest")


def broadcast_threshold(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 = broadcasting disabled)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    num = raw.rstrip("bkmgt")
    unit = raw[len(num):] or "b"
    try:
        return int(float(num) * units.get(unit, 1))
    except ValueError:
        return 10 * 1024 * 1024


def fits_broadcast(spark: SparkSession, n_rows: int, row_bytes: int) -> bool:
    """True when ``n_rows`` rows of ``row_bytes`` are under the broadcast threshold.

    Used where the row count is known exactly (a table just materialized), so
    the broadcast has a proven size bound; beyond it a shuffle join is used.
    """
    limit = broadcast_threshold(spark)
    return limit >= 0 and n_rows * row_bytes <= limit


def sized_checkpoint(df: DataFrame, row_overhead: int = 64) -> tuple[DataFrame, bool]:
    """Write ``df`` once and return it with "may broadcast" under a proven bound.

    For aggregates whose size the optimizer cannot know before running them
    (its estimate is the size of their input).  After the checkpoint one scan
    of the written table counts its rows and the bytes of their JSON text (an
    upper bound of the values), so a join can broadcast the table when it is
    truly small instead of shuffling the large side first.
    """
    from pyspark.sql import functions as F
    written = reliable_checkpoint(df)
    row = written.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.octet_length(F.to_json(F.struct(*written.columns)))).alias("b")).first()
    n, b = int(row["n"] or 0), int(row["b"] or 0)
    return written, fits_broadcast(df.sparkSession, 1, b + n * row_overhead)
