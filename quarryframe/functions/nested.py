"""Maps of maps: flat keys, the way back, and averages by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flattened(nested: Column, separator: str = "/") -> Column:
    """map<string, map<string, double>> -> map<string, double> with joined keys."""
    inner = F.transform(F.map_entries(nested), lambda e: F.transform(F.map_entries(e["value"]), lambda f: F.struct(F.concat(e["key"], F.lit(separator), f["key"]).alias("key"), f["value"].alias("value"))))
    return F.map_from_entries(F.flatten(inner))


def unflattened(flat: Column, separator: str = "/") -> Column:
    """The inverse of `flattened`: what stands before the first separator is the outer key."""
    entries = F.map_entries(flat)
    outer = lambda e: F.substring_index(e["key"], separator, 1)
    rest = lambda e: F.substring(e["key"], F.length(outer(e)) + 2, F.length(e["key"]))
    keys = F.array_distinct(F.transform(entries, outer))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.map_from_entries(F.transform(F.filter(entries, lambda e: outer(e) == k), lambda e: F.struct(rest(e).alias("key"), e["value"].alias("value")))).alias("value"))))


def key_averages(rows: DataFrame, flat: str) -> DataFrame:
    """(key, mean) over all rows' maps; nulls and NaN do not count, a key without any other value has the mean NaN."""
    one = rows.select(F.explode(flat).alias("key", "value"))
    real = F.when(~F.isnan("value"), F.col("value"))
    return one.groupBy("key").agg(F.coalesce(F.avg(real), F.lit(float("nan"))).alias("mean"))
