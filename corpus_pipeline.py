"""A training corpus from raw documents: reject toxic texts, keep one of each group of near copies, drop texts that hold benchmark
passages, mix the sources to their weights, write token ids.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last
one writes the ids and returns what it reads back of each. A document that the mix takes several times is as many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, decontaminate, mixing, ngramjoin, tokenids, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    return toxicity.screen(docs, toxicity.fit(docs, common.table(spark, sf_dir, "labels", "doc_id", "toxic")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenids.write_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("ngram_join", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_ids", write_token_ids),
]

#: The toxicity model can't be said in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    folder = common.shared_dir(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
