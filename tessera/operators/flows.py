"""Training and matching from end to end: files in, a model and result files out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import assignment, blocking, evaluation, model, sampling
from tessera.operators.features import features
from tessera.sources import splits, tsv

CAP = 30


def featured(s1: DataFrame, targets: DataFrame, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """Candidates of the S1 records, and these with their features."""
    pairs = blocking.candidates(blocking.block_keys(s1), blocking.block_keys(targets), cap)
    return pairs, features(pairs, s1.unionByName(targets, allowMissingColumns=True))


def train(spark: SparkSession, data: splits.Split, out: str, cap: int = CAP, most: int = 500_000, **settings) -> dict:
    """Fit a model on 85 % of the S1 records, choose the threshold on the others, and save both and the measures under ``out``.

    Validation records compete among themselves, against all targets. settings: of the trees. Without true pairs among the
    training candidates, or with fewer than two S1 records, it is an error."""
    if data.s1.limit(2).count() < 2:
        raise ValueError("fewer than two S1 records")
    parts = sampling.split(data.s1.select("entity_id"), 0.15, "42").persist()
    try:
        part = lambda name: data.s1.join(parts.filter(F.col("part") == name), "entity_id", "left_semi")
        true = lambda s1: data.truth.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        fit_s1, check_s1 = part("train"), part("valid")
        pairs, rows = featured(fit_s1, data.targets, cap)
        fit_recall = evaluation.recall(true(fit_s1), pairs).first().asDict()
        rows = evaluation.labelled(rows, data.truth).withColumn("pair", F.concat_ws("|", "s1_id", "target_id"))
        rows = sampling.training_rows(rows, most).drop("pair").persist()
        n = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("pos")).first()
        if not n["pos"]:
            raise ValueError("no true pair among the training candidates")
        fitted = model.train(rows, **settings)
        rows.unpersist()
        model.save(fitted, f"{out}/model")
        pairs, rows = featured(check_s1, data.targets, cap)
        scored = model.predict(fitted, evaluation.labelled(rows, data.truth)).persist()
        best = evaluation.choose(evaluation.sweep(check_s1, true(check_s1), scored)).first()
        won = assignment.many_to_one(assignment.accepted(scored, best["threshold"]))
        m = scored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("pos")).first()
        measures = {
            "validation_macro_f0_5": evaluation.f_half(check_s1, true(check_s1), won).first()["macro_f05"], "threshold": best["threshold"], "threshold_macro_f0_5": best["macro_f05"],
            "training_candidate_rows": n["n"], "training_positive_rows": n["pos"], "validation_candidate_rows": m["n"], "validation_positive_rows": m["pos"],
            "blocking_recall_at_cap_train": fit_recall, "blocking_recall_at_cap_valid": evaluation.recall(true(check_s1), pairs).first().asDict(), "blocking_max_candidates": cap,
        }
        scored.unpersist()
    finally:
        parts.unpersist()
    model.save_json(spark, {"threshold": best["threshold"], "macro_f0_5": best["macro_f05"]}, f"{out}/threshold.json")
    model.save_json(spark, measures, f"{out}/validation_metrics.json")
    return measures


def match(spark: SparkSession, data: splits.Split, out: str, cap: int = CAP) -> tuple[DataFrame, DataFrame]:
    """Matches and candidates of every S1 record by the model saved under ``out``, written there as TSV; no candidates give empty lists."""
    threshold = model.load_threshold(spark, f"{out}/threshold.json")
    pairs, rows = featured(data.s1, data.targets, cap)
    scored = model.predict(model.load(f"{out}/model"), rows)
    found = assignment.results(data.s1, scored, threshold)
    listed = assignment.listed(data.s1, pairs, "candidate_entity_ids")
    tsv.write(found, f"{out}/matching_results.tsv")
    tsv.write(listed, f"{out}/candidate_pairs.tsv")
    return found, listed
