"""Tables kept for a while in the folder that all executors share (``spark.checkpoint.dir``), in place of a cache: a lost
executor costs a re-read only. Folders are deleted by ``discard`` or ``release``, at the latest when the driver ends."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Unset, a session on one machine gets a temporary folder; on a cluster that
    would be another folder on each machine, so it is an error."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        conf = tempfile.mkdtemp(prefix="corpusforge-")
        spark.conf.set("spark.checkpoint.dir", conf)
        _made[conf] = spark
    return conf.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and reads it back, which cuts the lineage. Used where a result feeds several steps or an iteration."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._corpusforge_path = path
    return back


def discard(df: DataFrame) -> None:
    """Deletes the folder of a table that ``materialise`` gave, once nothing reads it any more."""
    path = getattr(df, "_corpusforge_path", None)
    if path and _made.pop(path, None) is not None:
        delete(df.sparkSession, path)


def release() -> None:
    """Deletes every folder that is still there. Results that read them can't be read afterwards."""
    for path, spark in list(_made.items()):
        with contextlib.suppress(Exception):  # the session may be gone
            delete(spark, path)
        _made.pop(path, None)


@contextlib.contextmanager
def scope():
    """Folders made inside are deleted at its end, however it ends."""
    before = set(_made)
    try:
        yield
    finally:
        for path in [p for p in _made if p not in before]:
            with contextlib.suppress(Exception):
                delete(_made[path], path)
            _made.pop(path, None)


atexit.register(release)
