"""External completions as a partitioned map, with a cache and bounded concurrency."""

from __future__ import annotations

import hashlib
import json
import random
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.cache import append_cache, cache_key, lookup, read_cache

#: (system message, prompt) -> response, or an exception.
Completer = Callable[[str, str], str | None]


def with_retries(call: Completer, system: str, prompt: str, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The response, or None after ``attempts`` failures; between them a random wait that grows to half a minute."""
    for k in range(attempts):
        try:
            return call(system, prompt)
        except Exception:  # noqa: BLE001 - whatever the service raises counts as a failed attempt
            sleep(random.uniform(1, max(1, min(30, 2**k))))
    return None


@dataclass(frozen=True)
class HttpCompleter:
    """Chat completions over HTTP, in the common request format."""

    base_url: str
    api_key: str
    model: str
    temperature: float
    timeout: float = 120.0

    def __call__(self, system: str, prompt: str) -> str | None:
        body = {"model": self.model, "temperature": self.temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}]}
        r = urllib.request.Request(
            self.base_url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"}
        )
        with urllib.request.urlopen(r, timeout=self.timeout) as f:
            return json.load(f)["choices"][0]["message"]["content"]


@dataclass(frozen=True)
class StubCompleter:
    """Offline stand-in that depends on the prompt only. For a selection it gives the text itself, SKIP, a short piece, a
    changed text or nothing; for an instruction a Danish question, a labelled one, an English one or a refusal."""

    kind: str

    def __call__(self, system: str, prompt: str) -> str | None:
        text = prompt.split("<text>\n", 1)[-1].split("\n</text>", 1)[0]
        pick = int(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:6], 16) % 10
        first = " ".join(text.split()[:6])
        if self.kind == "select":
            return {0: "SKIP", 1: text[:60], 2: "", 3: text[::-1], 4: " skip "}.get(pick, text[: max(150, len(text) * 2 // 3)])
        return {
            0: f"Format B: Kan du fortælle mig, hvad det betyder for os, når man siger: {first}?", 1: f"Format C\n\nHvad er det, som der menes med: {first}?",
            2: f"Please tell me more about this particular topic and explain why: {first}", 3: f"Jeg kan ikke hjælpe med det, for der er ikke nok om: {first}", 4: "",
        }.get(pick, f"Hvad kan du fortælle mig om det, der er skrevet her, og hvorfor er det sådan: {first}?")


def request_tasks(max_concurrency: int, parallelism: int) -> tuple[int, int]:
    """(tasks, requests in flight in each): their product never passes ``max_concurrency``, however large the cluster is."""
    tasks = max(1, min(max_concurrency, parallelism))
    return tasks, max(1, max_concurrency // tasks)


def completed(df: DataFrame, completer: Completer, system: str, model: str, temperature: float, cache_path: str, max_concurrency: int = 50, attempts: int = 5) -> DataFrame:
    """Adds ``response`` for ``prompt``. Prompts in the cache are not sent; each other distinct prompt is sent once, and its
    response is written to the cache before anything reads it, so that a task run again later never calls the service
    twice. Misses are spread over a fixed number of tasks, so that the bound of requests in flight holds."""
    spark = df.sparkSession
    keyed = df.withColumn("key", cache_key(model, temperature, system, F.col("prompt")))
    missing = keyed.select("key", "prompt").dropDuplicates(["key"]).join(read_cache(spark, cache_path).select("key"), "key", "left_anti")
    tasks, per_task = request_tasks(max_concurrency, spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(per_task) as pool:
            for b in batches:
                r = list(pool.map(lambda p: with_retries(completer, system, p, attempts), b.prompt))
                yield pd.DataFrame({"key": b.key, "response": r})

    append_cache(missing.repartition(tasks, "key").mapInPandas(run, "key string, response string"), cache_path)
    return lookup(keyed, read_cache(spark, cache_path)).drop("key")
