"""From scored pairs to matches: threshold, guard, one S1 record for each target, lists by S1 record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A pair with name and address below these, and another state, is rejected.
LOW_NAME, LOW_ADDRESS, THRESHOLD = 0.35, 0.20, 0.70


def score(featured: DataFrame) -> DataFrame:
    """A fixed linear score in place of a trained one: probability, rounded to 6 places."""
    p = 0.6 * F.col("name_jaccard") + 0.2 * F.col("address_component_jaccard") + 0.1 * F.col("state_match") + 0.1 * F.col("name_core_exact")
    return featured.withColumn("probability", F.round(p, 6))


def accepted(scored: DataFrame, threshold: float, name: str = "name_core_ratio", address: str = "address_ratio") -> DataFrame:
    """Pairs at or above the threshold, but for those with name and address both unlike and another state."""
    weak = (F.col(name) < LOW_NAME) & (F.col(address) < LOW_ADDRESS) & (F.col("state_match") == 0)
    return scored.filter((F.col("probability") >= threshold) & ~weak)


def many_to_one(pairs: DataFrame) -> DataFrame:
    """Of each target the S1 record with the highest probability, ties to the lowest position."""
    w = Window.partitionBy("target_source", "target_id").orderBy(F.desc("probability"), "s1_pos")
    return pairs.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def margins(pairs: DataFrame) -> DataFrame:
    """The pairs with best, second best (0 if none; ties count) and their difference over each target."""
    w = Window.partitionBy("target_source", "target_id")
    o = w.orderBy(F.desc("probability")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best, second = F.max("probability").over(w), F.coalesce(F.nth_value("probability", 2).over(o), F.lit(0.0))
    return pairs.withColumns({"best_score": best, "second_best_score": second}).withColumn("margin", F.round(F.col("best_score") - F.col("second_best_score"), 6))


def listed(s1: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Every S1 id with its targets' ids, sorted and comma-joined, empty without any; in the order of position where S1 has pos."""
    ids = pairs.groupBy(F.col("s1_id").alias("entity_id")).agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias("ids"))
    out = s1.join(ids, "entity_id", "left")
    out = out.orderBy("pos", "entity_id") if "pos" in s1.columns else out
    return out.select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias(name))


def results(s1: DataFrame, scored: DataFrame, threshold: float, name: str = "name_core_ratio", address: str = "address_ratio") -> DataFrame:
    """(source1_entity_id, matched_entity_ids): threshold and guard, then the contest, then every S1 record's list."""
    return listed(s1, many_to_one(accepted(scored, threshold, name, address)), "matched_entity_ids")
