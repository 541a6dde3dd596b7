"""Settings from the environment, checked once at start."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from functools import lru_cache

from quillmill.sources.retry import Patience


@dataclass(frozen=True)
class Settings:
    source: str = "config/source.yml"
    landing: str = "landing"
    landing_objects: str = "landing_objects"
    transformed: str = "transformed"
    transformed_objects: str = "transformed_objects"
    partition_size: str = "month"
    max_recovery_pages: int = 5
    request_delay: float = 0.5
    retry_times: int = 3
    retry_backoff: float = 1.5

    def patience(self) -> Patience:
        return Patience(self.request_delay, self.retry_times, self.retry_backoff)


def read(environment: dict[str, str], prefix: str = "QUILLMILL_") -> Settings:
    """Settings with the values that the environment gives; one that does not fit its type is an error, and so is an unknown name."""
    known, found = {f.name: f for f in fields(Settings)}, {}
    for key, value in environment.items():
        if not key.startswith(prefix):
            continue
        name = key[len(prefix) :].lower()
        if name not in known:
            raise ValueError(f"unknown setting {key}")
        kind = type(known[name].default)
        try:
            found[name] = kind(value)
        except ValueError as e:
            raise ValueError(f"{key} is not {kind.__name__}: {value!r}") from e
    return Settings(**found)


@lru_cache(maxsize=1)
def settings() -> Settings:
    return read(dict(os.environ))


def probe(spark, folder: str) -> bool:
    """Whether a row written to the folder can be read back."""
    path = f"{folder.rstrip('/')}/_probe"
    spark.range(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).count() == 1
