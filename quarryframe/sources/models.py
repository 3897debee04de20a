"""Slots for opaque models: a batch function with a declared schema, loaded once per worker; rows may fail without failing the job."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

_LOADED: dict[str, object] = {}


def apply_model(df: DataFrame, name: str, load: Callable[[], object], predict: Callable[[object, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """predict(model, batch) -> rows of `schema`; the model is loaded by each worker process on first use."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if name not in _LOADED:
            _LOADED[name] = load()
        for batch in batches:
            yield predict(_LOADED[name], batch)

    return df.mapInPandas(run, schema)


def for_each_row(df: DataFrame, key: str, work: Callable[[dict], dict | None], fields: str) -> DataFrame:
    """work(row) -> optional record. A row without a record goes; an exception becomes a row with `error` set."""
    names = [x.split()[0] for x in fields.split(", ")]
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    record = work(row)
                    if record is not None:
                        out.append({key: row[key], **record, "error": None})
                except Exception as error:  # reported in the row
                    out.append({key: row[key], "error": f"{type(error).__name__}: {error}"})
            yield pd.DataFrame(out, columns=[key, *names, "error"])

    return df.mapInPandas(run, f"{key} {kind}, {fields}, error string")


def first_that_works(decoders: list[Callable[[dict], dict | None]]) -> Callable[[dict], dict | None]:
    """Work for `for_each_row` that tries decoders in turn; the record tells by `level` which one it came from. If none works, the
    last one's exception is reported."""

    def work(row: dict) -> dict | None:
        last: Exception | None = None
        for level, decode in enumerate(decoders):
            try:
                record = decode(row)
            except Exception as error:  # the next decoder may do
                last = error
                continue
            return None if record is None else {**record, "level": level}
        raise last or ValueError("no decoder")

    return work
