"""From raw documents to token ids: language, near copies, benchmark leaks, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and gives the documents that go on; the last one gives token ids.  Between stages the
documents are written as Parquet under the shared checkpoint folder and read again.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sourcelens.llm.bpe import encode_documents
from sourcelens.llm.common import cut, shared_folder, table
from sourcelens.llm.crf_language import UNDETERMINED, identify
from sourcelens.llm.decontaminate import without_items
from sourcelens.llm.jaccard_join import near_duplicates
from sourcelens.llm.queries import held_out
from sourcelens.llm.secret_scan import scan_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose best language has a smaller share of its words is in no language.
LEAST_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in which no language has a fair share."""
    named = identify(docs, ~held_out(5, 0))
    return named.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


#: A table of up to so many files (some 150 bytes each) is broadcast to number the rows.
MAX_FILES = 500_000


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with a ``_row`` of its own for every row, the same whenever it is read: file and place in the file where ``docs`` is read from Parquet as the
    stages' inputs are, else that of a copy in the shared folder."""
    try:
        placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        placed = None
    if placed is not None:
        files = cut(placed.select("_file").distinct())
        if files.count() <= MAX_FILES:
            number = cut(files.withColumn("_number", F.row_number().over(Window.orderBy("_file"))))  # a row for each file
            row = F.shiftleft(F.col("_number").cast("bigint"), 40) + F.col("_place")
            return placed.join(F.broadcast(number), "_file").withColumn("_row", row).drop("_file", "_number", "_place")
    folder = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")).write.parquet(folder)
    return spark.read.parquet(folder)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one of the smallest id, a null id being the largest.  Rows are told apart
    by a key of their own, so null ids and ids that stand for several texts change nothing."""
    rows = _numbered(spark, docs)
    groups = cut(near_duplicates(rows, "_row").select("_row", "component_id"))
    named = groups.join(rows.select("_row", "doc_id"), "_row")
    stays = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("s")).select(F.col("s._row").alias("_row"))
    gone = groups.select("_row").join(stays, "_row", "left_anti")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a test item go, each by its own text."""
    return without_items(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    clean = scan_documents(docs.select(*COLUMNS), redacted=True).select(*COLUMNS)
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as little-endian unsigned 32-bit integers, with their digests."""
    return encode_documents(docs.select("doc_id", "text", "source"), public_tokenizers.path("byte_bpe_50k.json")).drop("text")


STAGES = [("language ID", language), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", benchmark_leaks),
          ("secret scan", secrets), ("BPE", tokens)]

#: Models and alignment can't be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage's result is written and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
