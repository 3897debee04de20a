"""Sources of assets by name: where each variant's metadata lies, and how one asset is fetched."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .models import for_each_row


@dataclass(frozen=True)
class Source:
    """variants: path of the metadata CSV by variant; fetch: row -> {"local_path": ...}, None (nothing to fetch) or an exception."""

    variants: dict[str, str]
    schema: str
    fetch: Callable[[dict], dict | None]

    def metadata(self, spark: SparkSession, variant: str) -> DataFrame:
        if variant not in self.variants:
            raise ValueError(f"Invalid source: {variant}; there are {', '.join(sorted(self.variants))}")
        return spark.read.schema(self.schema).option("header", True).option("escape", '"').csv(self.variants[variant])

    def download(self, metadata: DataFrame, key: str) -> DataFrame:
        """key, local_path, error: a row that can't be fetched has its error and does not end the job."""
        return for_each_row(metadata, key, self.fetch, "local_path string")


_SOURCES: dict[str, Source] = {}


def register(name: str, source: Source) -> None:
    _SOURCES[name] = source


def by_name(name: str) -> Source:
    if name not in _SOURCES:
        raise ValueError(f"no source {name}; there are {', '.join(sorted(_SOURCES))}")
    return _SOURCES[name]
