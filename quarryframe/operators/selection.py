"""Selection: fences, top-k, evenly spaced picks, seeded samples, splits and tiles."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .manifest import with_global_rank


def upper_iqr_fence(df: DataFrame, keys: Sequence[str], value: str, least: int = 3, reach: float = 1.5) -> DataFrame:
    """Keep rows with value <= q3 + reach * (q3 - q1); groups of under `least` rows keep all, and so does a group that would lose all."""
    q = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.75)))
    fences = df.groupBy(*keys).agg(q.alias("_q"), F.count("*").alias("_n"))
    cap = F.when(F.col("_n") >= least, F.col("_q")[1] + reach * (F.col("_q")[1] - F.col("_q")[0]))
    return df.join(fences.select(*keys, cap.alias("_cap")), list(keys)).where(F.col("_cap").isNull() | (F.col(value) <= F.col("_cap"))).drop("_cap")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key; the order must end in a key that breaks ties."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def linspace_floor(n: Column, k: int) -> Column:
    """Indices floor(i * (n - 1) / (k - 1)), i = 0..k-1; they may repeat."""
    if k == 1:
        return F.array(F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (n - 1) / F.lit(float(k - 1))).cast("int"))


def linspace_round(n: Column, k: int) -> Column:
    """Distinct indices half-even-round(i * (n - 1) / (k - 1)); all indices if k >= n."""
    some = F.array(F.lit(0)) if k == 1 else F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.rint(i * (n - 1) / F.lit(float(k - 1))).cast("int")))
    return F.when(n <= 0, F.array().cast("array<int>")).when(n <= k, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(some)


def every_nth(df: DataFrame, keys: Sequence[str], order: Sequence[str], rate: int, limit: int | None = None) -> DataFrame:
    """Rows 0, rate, 2*rate, ... of each key, at most `limit` of them (an argument of the operator, off by default)."""
    out = df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).where(F.col("_at") % rate == 0)
    return (out.where(F.col("_at") < limit * rate) if limit else out).drop("_at")


def objects_of_first_frame(df: DataFrame, keys: Sequence[str], frame: str, obj: str) -> DataFrame:
    """All frames, and of the objects those of each key's first frame (null: a frame without objects); an error if it has none."""
    first = df.groupBy(*keys).agg(F.min(F.struct(frame, F.col(obj).isNull().alias("none"))).alias("_first"))
    guard = F.when(F.col("_first.none"), F.raise_error(F.lit("First frame of the video has no objects"))).otherwise(F.col(f"_first.{frame}"))
    kept = df.join(first.select(*keys, guard.alias("_first")), list(keys)).where((F.col(frame) == F.col("_first")) & F.col(obj).isNotNull()).select(*keys, obj).distinct()
    return df.join(kept, [*keys, obj], "left_semi").select(df.columns)


def seeded_hash(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def hash_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, uniform over seeds: those with the smallest seeded hash. Repeatable, and a top-k in the plan."""
    return df.orderBy(seeded_hash(key, seed), *key).limit(n)


def resumable_sample(df: DataFrame, key: str, workers: int, seed: int = 0, epoch: int = 0, done: int = 0) -> DataFrame:
    """Who reads which row when in one epoch: key, worker, step. Rows are permuted by a hash seeded with seed + epoch and dealt out in
    turn; the permutation starts again until all workers have equally many. Steps before `done` are left out, so a run resumes
    where it ended."""
    n = df.count()
    total = -(-n // workers) * workers
    ranked = with_global_rank(df.select(key, seeded_hash([key], seed + epoch).alias("_hash")), ["_hash", key], "_rank")
    rounds = F.sequence(F.lit(0), F.lit(max(total - 1, 0) // max(n, 1)))
    dealt = ranked.select(key, F.explode(F.transform(rounds, lambda r: F.col("_rank") + r * n)).alias("_at")).where(F.col("_at") < total)
    return dealt.select(key, (F.col("_at") % workers).alias("worker"), F.floor(F.col("_at") / workers).alias("step")).where(F.col("step") >= done)


def split_label(rank: Column, rows: Column, fractions: dict[str, float], rest: str) -> Column:
    """Label of a 0-based rank in a permutation: floor(n * fraction) rows for each name in turn, the remainder is `rest`.

    A fraction is the decimal number that it is written as: 0.7 of 90,000 rows are 63,000; the double nearest to 0.7 has one row less.
    """
    out, low = F.lit(rest), F.lit(0)
    cases = []
    for name, share in fractions.items():
        high = low + F.floor(rows.cast("decimal(18,0)") * F.lit(Decimal(str(share)))).cast("long")
        cases.append(((rank >= low) & (rank < high), name))
        low = high
    for condition, name in reversed(cases):
        out = F.when(condition, name).otherwise(out)
    return out


def tile_starts(length: Column, size: int, overlap: int) -> Column:
    """Starts of tiles that cover `length` with an overlap; the last one is shifted back inside; short lengths have one tile at 0."""
    step = size - overlap
    n = F.greatest(F.ceil((length - size) / step), F.lit(0)).cast("int")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), n), lambda i: F.greatest(F.least(i * step, length - size), F.lit(0)).cast("int")))
