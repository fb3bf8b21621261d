"""Sources and sinks of the stages: explicit schemas, JSON lines, parquet, discovery of local data, skipping of done stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .remote import remote
from .shared import delete

#: The order of the source, carried through the stages: the document's place and the chunk's number in it.
ORDER = T.StructType([T.StructField("doc_seq", T.StringType()), T.StructField("chunk_idx", T.IntegerType())])
PARAGRAPH = T.StructType([T.StructField(c, T.StringType()) for c in ("paragraph", "title", "url", "section_heading", "source_type")])
SELECTED = T.StructType([T.StructField(c, T.StringType()) for c in ("paragraph", "original_paragraph", "title", "url", "section_heading", "source_type")])
INSTRUCTED = T.StructType([*SELECTED.fields, T.StructField("instruction", T.StringType())])
MESSAGE = T.StructType([T.StructField("content", T.StringType()), T.StructField("role", T.StringType())])
FINAL = T.StructType([T.StructField("prompt_id", T.StringType()), T.StructField("messages", T.ArrayType(MESSAGE)), *[T.StructField(c, T.StringType()) for c in ("title", "url", "section_heading")]])
SOURCE_FILE = "source.parquet"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines (a file or a folder) under a fixed schema: missing keys are null, blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def with_order(schema: T.StructType) -> T.StructType:
    """A stage's schema with the columns of the order behind it (null in files that lack them)."""
    return T.StructType([*schema.fields, *ORDER.fields])


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in a folder, null fields written, letters unescaped; replaces what is there."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def replace_jsonl(df: DataFrame, path: str) -> None:
    """Replaces the output of a stage, from which ``df`` may be read. The new one is written beside the old, the old is set
    aside, the new takes its place, and only then the old goes: whenever it breaks off, ``recover`` finds a whole output."""
    spark = df.sparkSession
    write_jsonl(df, path + ".new")
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    delete(spark, path + ".old")
    if fs.exists(p(path)):
        fs.rename(p(path), p(path + ".old"))
    fs.rename(p(path + ".new"), p(path))
    delete(spark, path + ".old")


def recover(spark: SparkSession, path: str) -> None:
    """Puts a whole output back where ``replace_jsonl`` was broken off between its two renames."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p(path)):
        for other in (path + ".new", path + ".old"):
            if fs.exists(p(other)) and (other.endswith(".old") or fs.exists(p(other + "/_SUCCESS"))):
                fs.rename(p(other), p(path))
                return


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)


def read_source(spark: SparkSession, path: str, text: str = "text", title: str = "id", url: str = "") -> DataFrame:
    """(text, title, url, doc_seq) of a parquet source, only these columns read; ``doc_seq`` is the row's place (file and row
    number). A path that begins with http is a remote dataset. A missing title or url column, or an empty name, gives
    ""; nulls stay null (never the word None); rows without text are left out. A missing text column is an error."""
    if path.startswith(("http://", "https://")):
        df = remote(spark, path, [c for c in (text, title, url) if c])
        place = F.col("doc_seq")
    else:
        df = spark.read.parquet(path)
        place = F.concat_ws("-", F.col("_metadata.file_name"), F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0"))
    pick = lambda c: F.col(f"`{c}`").cast("string") if c and c in df.columns else F.lit("")
    return df.select(F.col(f"`{text}`").cast("string").alias("text"), pick(title).alias("title"), pick(url).alias("url"), place.alias("doc_seq")).where("text is not null")


def source_path(spark: SparkSession, data_dir: str, remote: str) -> str:
    """The local source of a data folder if it is there, else the remote path."""
    local = f"{data_dir.rstrip('/')}/{SOURCE_FILE}"
    return local if exists(spark, local) else remote


def local_datasets(spark: SparkSession, root: str, registered: tuple[str, ...]) -> list[str]:
    """Sorted names of the folders under ``root`` that hold a source, without the registered ones; [] without a root."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/{SOURCE_FILE}")
    hits = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted({h.getPath().getParent().getName() for h in hits or []} - set(registered))


def enough(spark: SparkSession, path: str, n: int) -> bool:
    """Whether a stage's output already has the rows wanted: ``n``, or any if n is 0. Reads no more than it must."""
    if not exists(spark, path):
        return False
    return spark.read.text(path).limit(max(n, 1)).count() >= max(n, 1)
