"""Sessions, tables and lineage cuts shared by every operator."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidemark", cpus: int = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the path of Python workers, whatever folder the session was started from."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the session's `spark.checkpoint.dir`.

    Where that is unset, as in tests on one machine, a temporary folder; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return os.path.join(tempfile.gettempdir(), f"tidemark-{os.getpid()}")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back from there, which cuts its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: Bytes of one partition of what `spread` deals anew.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """`df` in enough partitions for expensive work on each row to use every core.

    A scan that has two splits a core or more is left as it is: nothing is shuffled. Anything else,
    such as a few large files on many cores or the small result of a join, is dealt anew, into as
    many partitions as its bytes ask for and at least the session's usual number.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    nodes = set(re.findall(r"(?m)^[\s:+-]*(\w+)", plan.toString()))
    if nodes <= {"Project", "Filter", "Relation"}:
        held = sum(int(str(leaf.stats().sizeInBytes())) for leaf in _leaves(plan))
        split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        if held >= 2 * cores * split:
            return df
        return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores, size // SPREAD_BYTES))
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores))


def _leaves(plan) -> list:
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


class SharedFiles:
    """Small files in a folder that driver and executors share, over whatever file system its address names."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.conf, self.folder = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, folder: str = "") -> list[str]:
        """What lies in a folder, in order; nothing where there is none."""
        at = self._path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        draft, at = self._path(f"{name}.draft"), self._path(name)
        out = self.fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(at, False)
        if not self.fs.rename(draft, at):
            raise OSError(f"{at} could not be written")

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def bytes_in(self, name: str) -> int:
        at = self._path(name)
        return self.fs.getContentSummary(at).getLength() if self.fs.exists(at) else 0
