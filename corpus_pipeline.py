"""A training-data pipeline over the documents table. Each stage works on all that the one before has kept.

1. quality: documents that the quality classifier scores below 0.3 go.
2. lines: repeated lines are cut; a document of which no line with words is left goes.
3. near copies: one document of each group of 5-word Jaccard similarity 0.8 or more stays.
4. benchmark: documents that hold a benchmark window of ten words go.
5. packing: the rest is packed into sequences of 2048 tokens.

Null and empty texts pass stages 1 to 4 as their operators define it; ids may be null. Of rows that repeat an id and a text one
stays. The documents need the columns in COLUMNS; the stages return these and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import drop_contaminated
from millrace.llm.line_dedup import drop_repeated_lines
from millrace.llm.ngram_jaccard import keep_one
from millrace.llm.packing import pack
from millrace.llm.quality_mil import fit_quality, score_quality
from millrace.llm.shared import shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).where("score >= 0.3").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = drop_repeated_lines(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, k=5, threshold="0.8").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


STAGES = [("quality", quality), ("lines", lines), ("near copies", near_copies), ("benchmark", benchmark), ("packing", packing)]

#: No SQL expresses the stages. A test holds run() and what each stage keeps against a table whose outcome is known.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            place = shared_folder(spark, "stage")
            docs.write.parquet(place)
            docs = spark.read.parquet(place)
    return docs
