"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def utc(spark: SparkSession) -> SparkSession:
    """Dates are cut out of UTC instants everywhere, so the session runs in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="seriesframe-")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/seriesframe/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table under the shared folder: what reads it several times does not compute it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A folder of the file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, child: str | None = None):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{child}" if child else self.path)

    def exists(self, child: str | None = None) -> bool:
        return self._fs.exists(self._at(child))

    def delete(self) -> None:
        self._fs.delete(self._at(), True)

    def children(self, prefix: str) -> list[str]:
        """The names of what lies in the folder and begins with a prefix, without it."""
        if not self.exists():
            return []
        names = [entry.getPath().getName() for entry in self._fs.listStatus(self._at())]
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]
