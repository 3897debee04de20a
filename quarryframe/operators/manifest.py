"""Manifest operators: derive, gate, shard, slice, update, merge and count. All are plain DataFrame plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 100


def elapsed_seconds(text: Column) -> Column:
    """Seconds of an elapsed-time string `HH:MM:SS[.f]`; NULL if it can't be parsed."""
    part = r"^\s*(\d+):(\d+):(\d+(?:\.\d+)?)\s*$"
    get = lambda i: F.regexp_extract(text, part, i)
    return F.when(text.rlike(part), get(1).try_cast("double") * 3600 + get(2).try_cast("double") * 60 + get(3).try_cast("double"))


def duration_seconds(start: Column, stop: Column) -> Column:
    """stop - start in seconds; unparsable and negative give 0 (so that a gate `< limit` keeps them)."""
    return F.greatest(F.coalesce(elapsed_seconds(stop) - elapsed_seconds(start), F.lit(0.0)), F.lit(0.0))


def seconds_to_frame(seconds: Column, fps: Column | float, last: Column | int) -> Column:
    """Frame at a time: half-even rounding, clamped to [0, last]."""
    last = last if isinstance(last, Column) else F.lit(last)
    return F.least(F.greatest(F.rint(seconds * fps).cast("long"), F.lit(0).cast("long")), last.cast("long"))


def pad_window(df: DataFrame, start: str, stop: str, pad: int, limit: Column | int) -> DataFrame:
    """Widen [start, stop) by `pad` on both sides within [0, limit]; rows left without a frame go."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    out = df.withColumns({start: F.greatest(F.col(start) - pad, F.lit(0)), stop: F.least(F.col(stop) + pad, limit)})
    return out.where(F.col(stop) > F.col(start))


def md5_shard(key: Column, shards: int) -> Column:
    """int(md5(key), 16) mod shards, by Horner's rule over the four 32-bit words."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    digest = F.md5(key.cast("string"))
    word = lambda i: F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
    return reduce(lambda acc, i: F.pmod(acc * F.lit((1 << 32) % shards) + word(i), F.lit(shards)), range(4), F.lit(0).cast("long"))


def with_global_rank(df: DataFrame, order: list[str], name: str = "rank", buckets: int = 64) -> DataFrame:
    """0-based rank over all rows without a window over everything: rows are dealt to ranges of the order, ranked inside each
    range, and shifted by the ranges' counts (one number for each range).

    The ranges' bounds come from a bounded sample (`SAMPLE_PER_RANGE` rows for each range) and are literals of the plan, so a row's
    range follows from its key alone; a range exchange would sample anew for each branch of the plan, and the counts would
    belong to other ranges than the ranks. Nulls come first; rows equal in the order share a range and rank in any order.
    """
    kinds = {f.name: f.dataType for f in df.select(*order).schema}
    sample = df.select(*order).orderBy(F.rand(1)).limit(buckets * SAMPLE_PER_RANGE).orderBy(*order).collect()
    bounds = sorted({len(sample) * i // buckets for i in range(1, buckets)} if sample else set())
    ends = [F.struct(*[F.lit(sample[i][c]).cast(kinds[c]).alias(c) for c in order]) for i in bounds]
    own = F.struct(*order)
    parted = df.withColumn("_part", F.size(F.filter(F.array(*ends), lambda end: end <= own)) if ends else F.lit(0))
    sizes = {r["_part"]: r["count"] for r in parted.groupBy("_part").count().collect()}  # at most `buckets` rows
    before = [sum(sizes.get(i, 0) for i in range(part)) for part in range(buckets)]
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parted.withColumn(name, at + F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("_part"))).drop("_part")


def rank_split(rank: Column, rows: Column | int, world: int) -> Column:
    """Which of `world` contiguous ranges [n*r//w, n*(r+1)//w) a 0-based rank falls into."""
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    bounds = F.transform(F.sequence(F.lit(1), F.lit(world)), lambda r: F.floor(rows * r / world))
    return F.size(F.filter(bounds, lambda b: b <= rank))


def update_by_key(base: DataFrame, update: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Overwrite shared columns where the update has a value; unknown keys and columns are ignored, NULL keeps the old value."""
    shared = [c for c in (columns or update.columns) if c != key and c in base.columns and c in update.columns]
    fresh = update.select(key, *[F.col(c).alias(f"_new_{c}") for c in shared])
    joined = base.join(fresh, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in shared else F.col(c) for c in base.columns])


def stage_counts(df: DataFrame, predicates: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """How many rows pass the first, the first two, ... predicates, in one scan."""
    out, passed = [F.count("*").alias("total")], F.lit(True)
    for name, predicate in predicates.items():
        passed = passed & F.coalesce(predicate, F.lit(False))
        out.append(F.count_if(passed).alias(name))
    return df.groupBy(*by).agg(*out) if by else df.agg(*out)


def work_queue(df: DataFrame, done: Column, needs: list[Column], chosen: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows still to do: not done and all prerequisites met; an explicit list of instances replaces the rest of the rule."""
    if chosen is not None:
        return df.join(chosen.select(key).distinct(), key, "left_semi")
    return df.where(~F.coalesce(done, F.lit(False)) & reduce(lambda a, b: a & F.coalesce(b, F.lit(False)), needs, F.lit(True)))


def not_yet_written(planned: DataFrame, written: DataFrame, key: str, tolerance: dict[str, float] | None = None) -> DataFrame:
    """Incremental skip: planned rows without a written row of the same key whose metadata agree (within a tolerance, if given)."""
    same = F.col(f"p.{key}") == F.col(f"w.{key}")
    for column, eps in (tolerance or {}).items():
        same = same & (F.abs(F.col(f"p.{column}") - F.col(f"w.{column}")) <= eps)
    return planned.alias("p").join(written.alias("w"), same, "left_anti")


def merge_stage_records(base: DataFrame, records: list[DataFrame], key: str) -> DataFrame:
    """Fold stage records into a manifest one after another (upsert without insert)."""
    return reduce(lambda acc, r: update_by_key(acc, r, key), records, base)


def flag_table(wide: DataFrame, key: str, prefix: str) -> DataFrame:
    """Dynamic flag columns `prefix_{m}` as rows (key, stage, done)."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    entries = F.array(*[F.struct(F.lit(c[len(prefix) :]).alias("stage"), F.col(c).cast("boolean").alias("done")) for c in columns])
    return wide.select(key, F.explode(entries).alias("e")).select(key, "e.stage", "e.done").where("done is not null")


def gate_or_all(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition; if none does, all rows."""
    some = df.agg(F.coalesce(F.max(condition), F.lit(False)).alias("_some"))  # one row
    return df.crossJoin(F.broadcast(some)).where(condition | ~F.col("_some")).drop("_some")


def finished(df: DataFrame, keys: list[str], flags: list[str], open_value: int = -1) -> DataFrame:
    """Keys of which every row has a value other than `open_value` in all flags; a null flag is open."""
    done = F.lit(True)
    for flag in flags:
        done &= F.coalesce(F.col(flag) != open_value, F.lit(False))
    return df.groupBy(*keys).agg(F.every(done).alias("_done")).where("_done").select(*keys)


def first_wins(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of `first`, and those of `second` whose keys are not in it."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))
