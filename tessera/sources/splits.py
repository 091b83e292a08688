"""The train and test splits of a record-linkage dataset: three sources, and the truth of the training split."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import records as R
from tessera.operators import sampling as P
from tessera.sources import tsv


@dataclass
class Split:
    """Records of the sources, with source and pos; truth as (s1_id, target_id, target_source), None for a test split."""

    s1: DataFrame
    s2: DataFrame
    s3: DataFrame
    truth: DataFrame | None = None

    @property
    def records(self) -> DataFrame:
        return self.s1.unionByName(self.s2).unionByName(self.s3)

    @property
    def targets(self) -> DataFrame:
        return self.s2.unionByName(self.s3)


def load(spark: SparkSession, folder: str, split: str, max_s1: int | None = None, max_targets: int | None = None) -> Split:
    """The raw split under folder/split. With caps, S1 and targets are sampled by chunks; targets that match the S1 records kept stay."""
    path = lambda name: f"{folder}/{split}/{split}_{name}.tsv"
    source = lambda i: tsv.positioned(spark, path(f"source{i}")).withColumn("source", F.lit(f"S{i}"))
    s1 = source(1) if max_s1 is None else P.chunk_sample(source(1), None, max_s1)
    truth = tsv.read(spark, path("ground_truth"), tsv.TRUTH_COLUMNS) if split == "train" else None
    needed = None if truth is None else tsv.matched_ids(truth, s1)
    target = lambda i: source(i) if max_targets is None else P.chunk_sample(source(i), needed, max_targets)
    return Split(s1, target(2), target(3), None if truth is None else tsv.truth_pairs(truth))


def prepared(spark: SparkSession, folder: str, split: str, max_s1: int | None = None, max_targets: int | None = None, normalized: str | None = None, aliases: DataFrame | None = None) -> Split:
    """The split with normalized columns; read from Parquet under ``normalized`` where that is given, else computed."""
    if normalized is None:
        raw = load(spark, folder, split, max_s1, max_targets)
        f = lambda df: R.normalized(df, aliases)
        return replace(raw, s1=f(raw.s1), s2=f(raw.s2), s3=f(raw.s3))

    def source(i: int) -> DataFrame:
        df = R.read(spark, f"{normalized}/{split}_source{i}.parquet").withColumns({"source": F.lit(f"S{i}"), "city_count": F.lit(None).cast("bigint")})
        if aliases is not None:  # the files hold names; whether an alias gave them follows from the table
            from tessera.operators.aliases import canonical

            variant = F.coalesce(F.try_element_at("addr_components", F.lit(-2)), F.lit(""))
            df = canonical(df.drop("city_count").withColumn("_v", variant), aliases, "city", "_v", "_c2").drop("_v", "_c2").withColumnRenamed("_c2_count", "city_count")
        return with_pos(df)

    s1 = P.head(source(1), max_s1)
    truth = tsv.read(spark, f"{folder}/{split}/{split}_ground_truth.tsv", tsv.TRUTH_COLUMNS) if split == "train" else None
    needed = tsv.matched_ids(truth, s1) if truth is not None else s1.select("entity_id").limit(0)
    target = lambda i: source(i) if max_targets is None else P.capped(source(i), needed, max_targets, "42")
    return Split(s1, target(2), target(3), None if truth is None else tsv.truth_pairs(truth))


def with_pos(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """The rows with pos, their place in the order of the number in their id, then the id; counted by ranges, no task holds all."""
    from tessera.functions import text as X

    keyed = df.withColumn("_k", F.coalesce(X.entity_number(F.col(key)), F.lit(-1)))
    width = 1 << 16
    n = keyed.groupBy(F.floor(F.col("_k") / width).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = n.select("_b", (F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_b")) - F.col("_n")).alias("_before"))  # a row a range
    ranked = keyed.withColumn("_b", F.floor(F.col("_k") / width)).join(before, "_b")
    within = Window.partitionBy("_b").orderBy("_k", key)
    return ranked.withColumn("pos", F.row_number().over(within) + F.col("_before")).drop("_k", "_b", "_before")


def preprocess(spark: SparkSession, folder: str, split: str, out: str, aliases: DataFrame | None = None, max_s1: int | None = None) -> None:
    """Normalize the raw files of a split to Parquet; of a smoke run S1's first rows and five times as many of each other source."""
    for i in (1, 2, 3):
        most = None if max_s1 is None else max_s1 * (1 if i == 1 else 5)
        rows = P.head(tsv.positioned(spark, f"{folder}/{split}/{split}_source{i}.tsv"), most)
        R.write(R.normalized(rows, aliases), f"{out}/{split}_source{i}.parquet")
