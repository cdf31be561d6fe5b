"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of ``documents``, and all but
the last return these columns. ``run`` writes every stage's rows to the shared folder and reads
them back, so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, packing, substring, toxicity
from millrace.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the ordinal model calls toxic.

    Null and empty texts stay, as do all where labels give no model; rows that repeat are judged alike.
    """
    model = toxicity.fit_labelled(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("not toxic").select("row.*")


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest doc_id of each near-duplicate class, once.

    Rows without a doc_id cannot be told apart from others and all stay. Of rows that repeat a doc_id the one with the
    first text stays (a null one comes first), ties by the JSON of the other columns, which may be of any type.
    """
    kept = written(jaccard.near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct())
    known = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    first = Window.partitionBy("row.doc_id").orderBy("row.text", F.to_json("row"))
    numbered = known.select(F.struct(*docs.columns).alias("row")).select("row", F.row_number().over(first).alias("n")).where("n = 1").select("row.*")
    return numbered.unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 13 words or more that a document with a smaller doc_id has too.

    Null and empty texts, and rows without a doc_id, stay as they are; rows that repeat a doc_id don't take from each other.
    """
    return substring.cut_rows(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item or 13 words of it, whatever its numbers and names.

    Null and empty texts stay, as do all where the benchmark is empty; rows that repeat are judged alike.
    """
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 4096 tokens; null texts count as empty, rows that repeat are packed as often."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_class),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

#: SQL can't express the fitted and packed stages; tests/llm compares the stages with brute force, or the fitted ones with held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
