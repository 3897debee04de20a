"""The training-data pipeline: each stage's documents are written as Parquet and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryframe.llm import stages
from quarryframe.llm.textkit import cut, cuts_so_far, free_between, table

STAGES = [
    ("quality_rules", stages.keep_good),
    ("minhash_near_dedup", stages.drop_near_duplicates),
    ("substring_dedup", stages.cut_repeated_passages),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack_sequences),
]
#: No SQL expresses the tokenizer and the packing; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, begin = table(spark, sf_dir, "documents"), cuts_so_far(spark)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
        end = cuts_so_far(spark)
        free_between(spark, begin, end - 1)  # what the stage cut, and its own input
        begin = end - 1
    return STAGES[-1][1](spark, docs, sf_dir)
