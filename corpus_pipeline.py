"""The corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written as Parquet in the shared folder and read again for the next one.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordlake.llm import decontaminate, language_id, near_dup, packing, suffix_dedup
from wordlake.llm.common import give_back, read_table
from wordlake.operators.lineage import fresh_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is clearly of a known language; texts without letters and ambiguous ones go.

    Null, empty and blank texts go; repeated rows and null doc_ids are judged each on its own; texts
    of any length are read whole; of tied languages the first by name counts, and the text is
    ambiguous; an empty table stays empty; columns of the operator's names are kept as they are.
    Without labelled rows no language is known and every document goes.
    """
    model = language_id.train(docs.select("text", "lang"))
    give_back()  # the sample's tables were the driver's; they would stand beside all later stages
    found = language_id.predict(docs, model, names=("__lang", "__score", "__ambiguous"))
    return found.filter((F.col("__lang") != language_id.UNKNOWN) & ~F.col("__ambiguous")).select(*docs.columns)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that of the least doc_id.

    Null, empty and blank texts all stay; of rows alike in doc_id and words one stays; rows that share
    a doc_id with other words are judged apart; null doc_ids come last in a group; texts of any length
    are compared whole; an empty table stays empty; other columns are carried.
    """
    return near_dup.drop_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 or more words that stand earlier in the corpus.

    The first copy by doc_id and place stays (null doc_ids last); null and empty texts stay as they
    are; rows alike in doc_id and text are one document; a text of which nothing is left goes; texts of
    any length are searched whole; an empty table stays empty; other columns are carried.
    """
    return suffix_dedup.cut_passages(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, copied or edited.

    Null and empty texts stay; repeated rows, null doc_ids and rows that share a doc_id are judged each
    by its text; texts of any length are searched whole; an empty table or benchmark drops nothing;
    other columns are carried.
    """
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of power-of-two length, each a sequence of its own.

    Null and empty texts give the end id alone; repeated rows and null doc_ids are packed each; texts
    of any length are packed whole; an empty table gives no rows; other columns are left out.
    """
    return packing.pack(docs, packing.public_path(packing.TOKENIZER_FILE))


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dup", keep_one_per_group),
    ("suffix_dedup", cut_repeated_passages),
    ("decontaminate", drop_benchmark_leaks),
    ("pack", pack_sequences),
]

#: Trained models, tokenizers and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces.

    Each stage's rows are written to a folder of this run in the shared folder; whoever empties that
    folder's checkpoints clears them too.
    """
    folder = fresh_path(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
