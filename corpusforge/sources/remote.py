"""A remote dataset over HTTP as a Python data source: a list of parquet shards, each read by one task.

The address is a folder that holds ``index.json``, a list of the shards' names (for a subset in the folder of that
name), or the address of a single parquet file. Only the columns wanted are decoded; a shard is fetched by the
task that reads it, so nothing passes through the driver. A failed fetch is tried again a few times, then the task fails.
"""

from __future__ import annotations

import io
import json
import time
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

NAME = "http-parquet"


def fetch(url: str, attempts: int = 4, timeout: float = 120.0) -> bytes:
    for k in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:
                return r.read()
        except OSError:
            if k + 1 == attempts:
                raise
            time.sleep(2**k * 0.5)
    raise AssertionError


def shards(url: str) -> list[str]:
    """Addresses of the shards, in the order of the index."""
    url = url.rstrip("/")
    if url.endswith(".parquet"):
        return [url]
    return [n if "://" in n else f"{url}/{n}" for n in json.loads(fetch(f"{url}/index.json"))]


class Shard(InputPartition):
    def __init__(self, url: str, number: int) -> None:
        self.url, self.number = url, number


class ShardReader(DataSourceReader):
    def __init__(self, url: str, schema: StructType, required: str) -> None:
        self.url, self.schema, self.required = url, schema, required

    def partitions(self) -> list[Shard]:
        return [Shard(u, i) for i, u in enumerate(shards(self.url))]

    def read(self, partition: Shard) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(self.schema)
        file = pq.ParquetFile(io.BytesIO(fetch(partition.url)))
        have = set(file.schema_arrow.names)
        if self.required not in have:
            raise ValueError(f"{partition.url} has no column {self.required}")
        at = 0
        for b in file.iter_batches(columns=[n for n in want.names if n in have]):
            cols = []
            for f in want:
                if f.name == "doc_seq":
                    cols.append(pa.array([f"{partition.number:08d}-{at + i:012d}" for i in range(b.num_rows)], pa.string()))
                else:
                    cols.append(b.column(f.name).cast(f.type) if f.name in have else pa.nulls(b.num_rows, f.type))
            at += b.num_rows
            yield pa.RecordBatch.from_arrays(cols, schema=want)


class RemoteDataset(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> ShardReader:
        return ShardReader(self.options["path"], schema, self.options["required"])


def remote(spark: SparkSession, url: str, columns: list[str]) -> DataFrame:
    """The columns (as text; missing ones null, but the first must be there) of a remote dataset, and ``doc_seq``, the order of
    its rows."""
    spark.dataSource.register(RemoteDataset)
    schema = ", ".join(f"`{c}` string" for c in dict.fromkeys(columns)) + ", doc_seq string"
    return spark.read.format(NAME).schema(schema).option("path", url).option("required", columns[0]).load()
