"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

#: Path of the rank file of a public byte-pair tokenizer (a parameter).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def path_of(spark: SparkSession, conf: str, default: str) -> str:
    """A path that is a parameter: the session's ``conf``, else the environment variable of that name, else ``default``."""
    return spark.conf.get(conf, None) or os.environ.get(conf.upper().replace(".", "_"), default)


@dataclass(frozen=True)
class Settings:
    api_key: str = ""
    base_url: str = ""
    model_name: str = ""
    max_concurrency: int = 50
    temperature: float = 1.0
    data_dir: str = "data"
    minhash_threshold: float = 0.7
    num_perm: int = 128
    #: Path of a byte-pair rank file whose tokens deduplication compares; words and signs without one.
    dedup_vocabulary: str = ""


def read_env_file(path: str) -> dict[str, str]:
    """Names and values of a ``.env`` file; {} if it is not there."""
    p = Path(path)
    lines = p.read_text(encoding="utf-8").splitlines() if p.is_file() else []
    pairs = (l.removeprefix("export ").split("=", 1) for l in map(str.strip, lines) if "=" in l and not l.startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


def load_settings(data_dir: str = "data", temperature: float = 1.0, env: Mapping[str, str] | None = None) -> Settings:
    """Settings of a run; the environment goes before a ``.env`` file. Makes the data folder if its path is a local one."""
    e = read_env_file(".env") | dict(os.environ if env is None else env)
    if "://" not in data_dir:
        Path(data_dir).mkdir(parents=True, exist_ok=True)
    return Settings(
        api_key=e.get("OPENAI_API_KEY", ""), base_url=e.get("OPENAI_BASE_URL", ""), model_name=e.get("MODEL_NAME", ""),
        max_concurrency=int(e.get("MAX_CONCURRENCY", "50")), temperature=temperature, data_dir=data_dir, dedup_vocabulary=e.get("DEDUP_VOCABULARY", ""),
    )
