"""Key-value cache of responses: a parquet table of (key, response)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import exists

SCHEMA = "key string, response string"


def cache_key(model: str, temperature: float, system: str, user: Column) -> Column:
    """SHA-256 of model, temperature, system message and prompt: an edited template is a new key."""
    return F.sha2(F.to_json(F.struct(F.lit(model).alias("m"), F.lit(float(temperature)).alias("t"), F.lit(system).alias("s"), user.alias("u"))), 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if exists(spark, path) else spark.createDataFrame([], SCHEMA)


def lookup(df: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds ``response`` (null for a miss) by ``key``. A key twice in the cache counts once, the greatest response."""
    one = cache.groupBy("key").agg(F.max("response").alias("response"))
    return df.join(one, "key", "left")


def append_cache(new: DataFrame, path: str) -> None:
    """Adds responses that are there. Appended only for keys that were missing, so no key is replaced."""
    new.where("response is not null").select("key", "response").dropDuplicates(["key"]).write.mode("append").parquet(path)
