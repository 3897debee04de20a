"""Pipeline stages: an operator's decisions applied to a table of documents, whose columns (extra ones too) stay.

What holds for all: an empty table gives an empty one; extra columns may have any name, for rows travel in a struct of their own;
a null text counts as an empty one; rows that share a doc_id are judged each by its own text unless a stage says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import decontaminate, minhash, packing, quality, substring
from .textkit import boxed, cut, table


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Rows equal in doc_id, text, lang and source share a verdict; a null lang or source is a
    group of its own, a null doc_id is judged like any other."""
    key = F.xxhash64(docs["doc_id"], docs["text"], docs["lang"], docs["source"])
    rows = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    measured = cut(quality.with_signals(quality.with_statistics(rows).drop("text")))
    rejected = cut(quality.judge(measured, quality.adaptive_fences(measured)).where("not kept").select("key", "id").distinct())
    # The rejected ids grow with the corpus and are never broadcast, so the plan is the same at every size.
    a, b = boxed(docs, key=key, id=docs["doc_id"].cast("long")).alias("a"), rejected.hint("merge").alias("b")
    return a.join(b, (F.col("a.key") == F.col("b.key")) & F.col("a.id").eqNullSafe(F.col("b.id")), "left_anti").select("row.*")


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: that with the smallest doc_id. Of rows equal in doc_id and text one stays, rows that share
    a doc_id but not the text stay or go together; rows with a null doc_id stay."""
    verdicts = cut(minhash.near_duplicates(docs).select("doc_id", "kept"))
    rows = boxed(docs, id=docs["doc_id"].cast("long"), text=docs["text"].cast("string"))
    left = rows.join(verdicts.where("not kept").select(F.col("doc_id").alias("id")).distinct(), "id", "left_anti")
    again = verdicts.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count().where("count > 1").select("id")
    if again.limit(1).count():
        left = left.join(again, "id", "left_anti").unionByName(left.join(again, "id", "left_semi").dropDuplicates(["id", "text"]))
    return left.select("row.*")


def cut_repeated_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; n_chars of a changed text is counted anew. No document goes, none gets another's text."""
    changed = substring.repeated_passages(docs, with_text=True).where("kept_text is not null").select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "kept_text").dropDuplicates(["id", "key"])
    joined = boxed(docs, id=docs["doc_id"].cast("long"), key=substring.row_key()).join(changed, ["id", "key"], "left")
    row, there = F.col("row"), F.col("kept_text").isNotNull()
    fresh = {"text": F.coalesce("kept_text", row["text"]), "n_chars": F.when(there, F.length("kept_text").cast("long")).otherwise(row["n_chars"]) if "n_chars" in docs.columns else None}
    return joined.select(*[(fresh[c] if c in fresh else row.getField(c)).alias(c) for c in docs.columns])


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; rows that share a doc_id go together. Rows with a null doc_id stay."""
    found = cut(decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("id")).distinct())
    return boxed(docs, id=docs["doc_id"].cast("long")).join(found, "id", "left_anti").select("row.*")


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids (`ids`: little-endian 32-bit integers); see `packing.pack`."""
    from .queries import tokenizer_path

    return packing.pack(docs, tokenizer_path(), with_ids=True)
