"""Session settings, test-table access and the checkpoint helper."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides.

    Shuffle width is left to the cluster (AQE coalesces it); only a local
    master gets a small fixed one.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", "8")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


class Tables:
    """Attribute access to the parquet tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the cluster names it.

    Only a local session may fall back to a scratch folder of its own, because
    there the driver and the executors are one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemill-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder and read that.

    Used where several branches need the same costly rows, and to cut lineage
    inside loops. The copy outlives a lost executor; being columnar and of known
    size, it lets later steps read only what they need and choose their joins.
    """
    out = scratch_dir(df.sparkSession, "rows")
    df.write.parquet(out)
    back = df.sparkSession.read.schema(df.schema).parquet(out)
    back._written = out
    return back


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, for written intermediates.

    What has not been discarded by then goes when the driver's interpreter ends.
    """
    out = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _left[out] = spark
    return out


_left: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*written: DataFrame) -> None:
    """Delete copies made by ``materialise`` that no DataFrame still to be computed reads."""
    for df in written:
        if (folder := getattr(df, "_written", None)) and _left.pop(folder, None) is not None:
            _delete(df.sparkSession, folder)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within this, a job's shuffle files go when the job has ended.

    For operators that run many jobs, each of which writes its result to the
    shared folder: nothing reads an earlier job's shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@atexit.register
def _discard_rest() -> None:
    while _left:
        folder, spark = _left.popitem()
        if spark.sparkContext._jsc is not None:
            _delete(spark, folder)
