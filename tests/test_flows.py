"""Files, samples, candidates, matches and whole flows on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import aliases as A
from tessera.operators import assignment, blocking, evaluation, flows, model, report, sampling, submission
from tessera.operators import records as R
from tessera.sources import splits, store, tsv

RECORD = "entity_id string, pos long, source string, business_name string, business_address string, country string"


def test_tsv(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text('country\tentity_id\tbusiness_name\tbusiness_address\nUS\tS1-1\tAcme "x\t\nUS\tS1-2\tshort\nUS\tS1-3\tB\tNULL\nUS\tS1-4\ta\tb\tc\nFR \tS1-5\t\té')
    rows = tsv.read(spark, str(p)).orderBy("entity_id").collect()
    assert [r.entity_id for r in rows] == ["S1-1", "S1-2", "S1-3", "S1-4", "S1-5"] and rows[0].business_name == 'Acme "x' and rows[0].business_address == "" and rows[2].business_address == "NULL" and rows[4].country == "FR "
    good = tsv.read(spark, str(p), malformed="DROPMALFORMED")
    assert good.count() == len(good.select("entity_id").collect()) == len(good.collect()) == 3
    with pytest.raises(ValueError, match="columns missing"):
        tsv.read(spark, str(p), ["entity_id", "nothing"])
    assert [(r.lineno, len(r.fields)) for r in tsv.rows(spark, str(p), None).orderBy("lineno").collect()] == [(2, 4), (3, 3), (4, 4), (5, 5), (6, 4)]
    assert [(r.entity_id, r.pos) for r in tsv.positioned(spark, str(p)).orderBy("pos").collect()] == [("S1-1", 1), ("S1-3", 3), ("S1-5", 5)]
    s = tsv.scan(spark, str(p)).first()
    assert (s.lines, s.feeds, s.no_final_feed, s.returns, s.malformed, s.bytes) == (6, 5, 1, 0, 2, p.stat().st_size) and [x.lineno for x in s.examples] == [3, 5]
    assert [(r.name, r.bytes) for r in tsv.listing(spark, str(tmp_path)).collect()] == [("t.tsv", p.stat().st_size)]
    assert {r.check: r.found for r in tsv.mentions(spark, str(p), {"a": "Acme", "b": "none of it"}).collect()} == {"a": True, "b": False}
    tsv.write(spark.createDataFrame([("S1-1", ""), (" x ", "y")], "a string, b string"), str(tmp_path / "o"), one_file=True)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "o")).collect()) == [" x \ty", "S1-1\t", "a\tb"]
    tsv.write_json(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().b == "x"


def test_line_numbers_over_many_blocks(spark, tmp_path):
    (tmp_path / "big.tsv").write_text("h\n" + "".join(f"{i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = tsv.lines(spark, str(tmp_path / "big.tsv")).filter("lineno > 1").filter("CAST(value AS BIGINT) + 2 <> lineno")
        assert got.count() == 0 and tsv.lines(spark, str(tmp_path / "big.tsv")).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_aliases(spark, tmp_path):
    table = spark.createDataFrame([("state", "US", "az", "arizona", 7), ("city", "US", "phx", "phoenix", 3)], A.SCHEMA)
    for kind in ("state", "city"):
        (tmp_path / f"{kind}.json").write_text(A.as_json(table, kind))
    assert json.loads((tmp_path / "state.json").read_text()) == {"US": {"az": {"canonical": "arizona", "count": 7}}}
    assert sorted(map(tuple, A.load(spark, str(tmp_path / "state.json"), str(tmp_path / "city.json")).collect())) == sorted(map(tuple, table.collect()))
    assert A.load(spark, str(tmp_path / "none.json")).count() == 0
    rec = [(f"S1-{i}", i, "S1", "US", ["x", "arizona"]) for i in range(5)] + [(f"S2-{i}", i, "S2", "US", ["x", "az"]) for i in range(5)]
    records = spark.createDataFrame(rec, "entity_id string, pos long, source string, country string, addr_components array<string>")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(5)], "s1_id string, target_id string")
    assert [tuple(r) for r in A.mined(records, truth).collect()] == [("state", "US", "az", "arizona", 5)]
    assert A.mined(records, truth, per_country=2).count() == 0 and [r.cnt for r in A.mined(records, truth, per_country=3).collect()] == [3]


def test_aliases_count_all_records(spark):
    """More matched records of a country than any round number."""
    n = 150_010
    i = spark.range(n).select(F.col("id").cast("string").alias("k"), F.col("id").alias("pos"), F.lit("US").alias("country"))
    side = lambda s, name: i.select(F.concat(F.lit(f"{s}-"), "k").alias("entity_id"), "pos", F.lit(s).alias("source"), "country", F.array(F.lit("x"), F.lit(name)).alias("addr_components"))
    truth = i.select(F.concat(F.lit("S1-"), "k").alias("s1_id"), F.concat(F.lit("S2-"), "k").alias("target_id"))
    assert [r.cnt for r in A.mined(side("S1", "arizona").union(side("S2", "az")), truth).collect()] == [n]


def test_candidates_keep_the_lowest(spark):
    """The cut before the join changes nothing, for any cap."""
    import random

    rng = random.Random(3)
    keys = lambda s, n: sorted({(f"{s}-{i}", i, s, f"k{int(rng.random() ** 3 * 12)}") for i in range(n) for _ in range(rng.randint(1, 4))})
    s1, other = keys("S1", 30), keys("S2", 120) + keys("S3", 60)
    schema = "entity_id string, pos long, source string, key string"
    for cap in (1, 3, 30):
        want = set()
        for a in {x[0] for x in s1}:
            mine = {x[3] for x in s1 if x[0] == a}
            for source in ("S2", "S3"):
                found = sorted({(x[1], x[0]) for x in other if x[2] == source and x[3] in mine})
                want |= {(a, t) for _, t in found[:cap]}
        got = blocking.candidates(spark.createDataFrame(s1, schema), spark.createDataFrame(other, schema), cap)
        assert {(r.s1_id, r.target_id) for r in got.collect()} == want


def test_nearest_in_blocks(spark, monkeypatch):
    import random

    rng = random.Random(6)
    text = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega", "ab"], k=rng.randint(0, 4)))
    rows = [(f"S{1 + (i % 3)}-{i}", f"S{1 + (i % 3)}", text(), "x" if i % 2 else "y") for i in range(90)]
    d = spark.createDataFrame(rows, "entity_id string, source string, name_core string, country string")
    q, p = blocking.sides(d)
    whole = {}
    for by in (None, ["country"]):
        for sizes in ((500, 50_000, 2000), (7, 11, 4)):
            for name, v in zip(("QUERIES", "ROWS", "AT_ONCE"), sizes, strict=True):
                monkeypatch.setattr(blocking, name, v)
            got = sorted(map(tuple, blocking.nearest(blocking.tfidf(q, p, by=by), blocking.tfidf(p, p, by=by), 4, by).select("s1_id", "rank", "target_id", "similarity").collect()))
            assert whole.setdefault(str(by), got) == got and len(got) > 60


def test_nearest_texts_of_many_copies(spark, monkeypatch):
    """Equal texts, ties, short and missing texts, and a country that is null, in chunks of any size, against every product."""
    import math
    import random
    from collections import Counter

    rng = random.Random(8)
    text = lambda: rng.choice(["", "ab", None, "alpha beta"]) if rng.random() < 0.3 else " ".join(rng.choices(["alpha", "beta", "gamma", "délta", "omega", "अआइई"], k=rng.randint(1, 4)))
    rows = [(f"S{1 + (i % 2)}-{i}", f"S{1 + (i % 2)}", text(), rng.choice(["x", "x", "y", None])) for i in range(160)]
    q, p = blocking.sides(spark.createDataFrame(rows, "entity_id string, source string, t string, country string"))
    grams = lambda t: Counter(t[i : i + 3] for i in range(len(t) - 2)) if t else Counter()
    want = []
    for c in ("x", "y"):
        pool = [r for r in rows if r[1] == "S2" and r[3] == c and r[2] is not None]
        df = Counter(g for r in pool for g in grams(r[2]))

        def unit(t, df=df, n=len(pool)):
            v = {g: k * (math.log((1 + n) / (1 + df[g])) + 1) for g, k in grams(t).items()}
            return {g: x / math.sqrt(sum(y * y for y in v.values())) for g, x in v.items()}

        for r in rows:
            if r[1] == "S1" and r[3] == c:
                a = unit(r[2])
                found = sorted((-round(sum(x * unit(b[2]).get(g, 0) for g, x in a.items()), 6), b[0]) for b in pool)
                want += [(r[0], b, i + 1, -s) for i, (s, b) in enumerate(f for f in found[:4] if f[0] < 0)]
    for sizes in ((40_000, 100_000, 64), (5, 9, 2)):
        for name, v in zip(("QUERIES", "ROWS", "AT_ONCE"), sizes, strict=True):
            monkeypatch.setattr(blocking, name, v)
        got = blocking.nearest_texts(q, p, "t", 4, ["country"]).select("s1_id", "target_id", "rank", "similarity").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_bounds_pass_over_no_neighbour():
    """Many rows, so that lists of frequent grams are left out."""
    import numpy as np

    from tessera.operators import nearest as N

    rng = np.random.default_rng(5)
    word = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(200)]
    texts = [" ".join([word[int(i)] for i in rng.integers(0, 200, 3) ** 2 // 200] + ["road", "city"]) for _ in range(3000)]
    row, gram, _ = N.trigrams(texts)
    known, df = np.unique(gram, return_counts=True)
    starts, gram, w = N.weighted(texts, known, df, 3000)
    table = np.zeros((3000, len(known)))
    table[row, np.searchsorted(known, gram)] = w
    least, best = np.zeros(100), [[] for _ in range(100)]
    for s in (0, 1000):
        e = 1000 if s == 0 else 3000
        part = N.Part(starts[s : e + 1] - starts[s], gram[starts[s] : starts[e]], w[starts[s] : starts[e]])
        N.merged(best, N.search(part, starts[:101], gram[: starts[100]], w[: starts[100]], 10, least, 64), [[f"{i:04}"] for i in range(s, e)], 10, least)
    for i, near in enumerate(best):
        all_ = np.round(table @ table[i], 6)
        assert [(int(x), -s) for s, x, _ in near] == [(int(j), all_[j]) for j in np.lexsort((np.arange(3000), -all_))[:10]]


def _spread(df) -> bool:
    """Rows copied to blocks for a cogrouped search."""
    return "CoGroup" in df._jdf.queryExecution().toString()


def test_tfidf_topk_copies_no_rows(spark):
    from tessera.plans import catalog

    assert not _spread(catalog.queries()["tfidf_topk"](spark, "/root/testdata/sf0.001"))


def test_tfidf_by_country_copies_no_rows(spark):
    from tessera.plans import catalog

    assert not _spread(catalog.queries()["tfidf_by_country"](spark, "/root/testdata/sf0.001"))


def test_score_distribution_copies_no_rows(spark):
    from tessera.plans import catalog

    assert not _spread(catalog.queries()["score_distribution"](spark, "/root/testdata/sf0.001"))


def test_union_strategy_copies_no_rows(spark):
    from tessera.plans import catalog

    assert not _spread(catalog.queries()["union_strategy"](spark, "/root/testdata/sf0.001"))


def test_strategy_recall_copies_no_rows(spark):
    from tessera.plans import catalog

    from tessera.operators import probe

    s1, pool = blocking.sides(probe.with_text(catalog.norm(spark, "/root/testdata/sf0.001")))
    assert not any(_spread(probe.neighbours(s1, pool, c, 10)) for c in ("name_text", "name_address"))


def test_directions_pass_over_no_neighbour(monkeypatch):
    """More frequent grams than directions, in blocks of queries and rows, with rows and queries that share nothing."""
    import numpy as np

    from tessera.operators import nearest as N

    rng = np.random.default_rng(7)
    for name, v in (("FREQUENT", 0.02), ("DIRECTIONS", 6), ("SAMPLE", 50), ("QUERIES", 7), ("BLOCK", 64), ("ROWS", 30)):
        monkeypatch.setattr(N, name, v)
    word = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(90)]
    texts = [" ".join(word[int(i)] for i in rng.integers(0, 90, 3)) if j % 19 else "xyz"[: j % 4] for j in range(600)]
    grams, _ = N.counts(texts)
    df = np.array([sum(chr(g >> 42) + chr(g >> 21 & 0x1FFFFF) + chr(g & 0x1FFFFF) in t for t in texts) for g in grams.tolist()])
    assert (N.counts(texts)[1] == df).all()
    starts, gram, w = N.placed(texts, grams, df, 600)
    table = np.zeros((600, len(grams)))
    table[np.repeat(np.arange(600), np.diff(starts)), gram] = w
    least, best = np.zeros(100), [[] for _ in range(100)]
    for s, e in ((0, 200), (200, 600)):
        part = N.Part(starts[s : e + 1] - starts[s], gram[starts[s] : starts[e]], w[starts[s] : starts[e]])
        assert part.directions is not None
        N.merged(best, N.search(part, starts[:101], gram[: starts[100]], w[: starts[100]], 10, least, 20), [[f"{i:04}"] for i in range(s, e)], 10, least)
    for i, near in enumerate(best):
        all_ = np.round(table @ table[i], 6)
        assert [(int(x), -s) for s, x, _ in near] == [(int(j), all_[j]) for j in np.lexsort((np.arange(600), -all_))[:10] if all_[j] > 0]


def _plan(name: str, spark) -> str:
    from tessera.plans import catalog

    return catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_tfidf_by_country_deals_out_no_neighbours(spark):
    assert "Exchange" not in _plan("tfidf_by_country", spark)


def _by_record(plan: str) -> bool:
    """Rows dealt out by S1 record."""
    import re

    return bool(re.search(r"hashpartitioning\([^)]*(s1_id|x_id)", plan))


def test_score_distribution_deals_out_no_neighbours(spark):
    assert not _by_record(_plan("score_distribution", spark))


def test_union_strategy_deals_out_no_pairs(spark):
    assert not _by_record(_plan("union_strategy", spark))


def test_strategy_recall_deals_out_no_pairs(spark):
    assert not _by_record(_plan("strategy_recall", spark))


def test_scores(spark):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    none = spark.createDataFrame([], "s1_id string, target_id string")
    assert evaluation.f_half(s1, none, none).first().macro_f05 == 1.0 and evaluation.f_half(s1, none, none, singleton=0.0).first().macro_f05 == 0.0
    truth = spark.createDataFrame([("S1-1", "a"), ("S1-1", "c")], none.schema)
    guess = spark.createDataFrame([("S1-1", "a"), ("S1-1", "b"), ("S1-1", "c")], none.schema)
    assert round(evaluation.f_half(s1.filter("entity_id = 'S1-1'"), truth, guess).first().macro_f05, 3) == 0.714
    assert len(evaluation.thresholds()) == 33
    swept = spark.createDataFrame([(0.5, 2, 0.8), (0.3, 2, 0.8), (0.7, 2, 0.1)], "threshold double, n long, macro_f05 double")
    assert evaluation.choose(swept).first().threshold == 0.3


def test_ties_and_order(spark):
    rows = spark.createDataFrame([("S1-9", 1, "S2", "S2-1", 0.9), ("S1-3", 2, "S2", "S2-1", 0.9), ("S1-3", 2, "S3", "S3-1", 0.5)], "s1_id string, s1_pos long, target_source string, target_id string, probability double")
    assert {(r.s1_id, r.target_id) for r in assignment.many_to_one(rows).collect()} == {("S1-9", "S2-1"), ("S1-3", "S3-1")}
    s1 = spark.createDataFrame([("S1-9", 1), ("S1-3", 2), ("S1-1", 3)], "entity_id string, pos long")
    assert [tuple(r) for r in assignment.listed(s1, rows, "ids").collect()] == [("S1-9", "S2-1"), ("S1-3", "S2-1,S3-1"), ("S1-1", "")]


def test_samples(spark):
    d = spark.range(1000).select(F.concat(F.lit("S2-"), F.col("id")).alias("entity_id"), (F.col("id") + 1).alias("pos"))
    need = d.filter("pos % 100 = 0").select("entity_id")
    got = sampling.chunk_sample(d, need, 50, chunk=100)
    assert got.count() == 50 and got.join(need, "entity_id").count() == 10
    assert sampling.chunk_sample(d, need, 4, chunk=100).count() == 10 and sampling.chunk_sample(d, None, 50, chunk=100).agg(F.max("pos")).first()[0] <= 500
    assert sampling.capped(d, need, 30, "1").count() == 30 and sampling.capped(d, need, 5, "1").count() == 10
    assert [sampling.development_limit(n) for n in (None, 10, 500, 5000)] == [None, 5000, 10000, 20000]
    parts = {r.part: r["count"] for r in sampling.split(d, 0.15, "42").groupBy("part").count().collect()}
    assert parts == {"valid": 150, "train": 850}
    assert sampling.head(d, 7).agg(F.max("pos")).first()[0] == 7 and sampling.every_nth(d, 4).count() == 250
    rows = d.withColumn("label", (F.col("pos") % 2).cast("int"))
    few = {r.label: r["count"] for r in sampling.training_rows(rows, 100, "42", "entity_id").groupBy("label").count().collect()}
    assert few == {1: 25, 0: 75} and sampling.training_rows(rows, 1000, "42", "entity_id").count() == 1000


def test_translit_rows_of_before_and_after(spark):
    rows = [("S1-1", 1, "S1", "Anand Foods", "1 x", "India"), ("S2-1", 1, "S2", "आनंद फूड्स", "1 x, NULL", "India")]
    n = R.normalized(spark.createDataFrame(rows, RECORD))
    pairs = spark.createDataFrame([("S1-1", "S2-1", "S2", "pair")], "s1_id string, target_id string, target_source string, kind string")
    got = {r.variant: r for r in evaluation.before_after(pairs, n).collect()}
    assert set(got) == {"BEFORE", "AFTER", "TRANSLIT"} and got["BEFORE"].name_jaccard == 0 and got["TRANSLIT"].name_jaccard > 0.3
    assert (got["BEFORE"].parts_jaccard, got["AFTER"].parts_jaccard, got["AFTER"].number_shared) == (0.5, 1.0, 1.0)


def dataset(spark, folder, n=60):
    name = lambda i: f"{['Alpha', 'Beta', 'Gamma', 'Delta'][i % 4]} w{i}x{i * 7 % 11} {['Foods', 'Motors', 'Services'][i % 3]}"
    for split in ("train", "test"):
        for i, (form, tail) in ((1, ("{} Inc", "Road")), (2, ("{} Incorporated", "Rd")), (3, ("THE {}", "RD."))):
            rows = [(f"S{i}-{k}", form.format(name(k)), f"{k + 1} Main {tail}, Reno, {'NV' if i > 1 else 'Nevada'}", "US") for k in range(n) if i == 1 or k % 5]
            tsv.write(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in tsv.COLUMNS)), f"{folder}/{split}/{split}_source{i}.tsv")
    truth = [(f"S1-{k}", f"S2-{k},S3-{k}" if k % 5 else "") for k in range(n)]
    tsv.write(spark.createDataFrame(truth, "source1_entity_id string, matched_entity_ids string"), f"{folder}/train/train_ground_truth.tsv")


def test_train_and_match(spark, tmp_path):
    folder, out = str(tmp_path / "data"), str(tmp_path / "out")
    dataset(spark, folder)
    data = splits.prepared(spark, folder, "train")
    measures = flows.train(spark, data, out, maxIter=3, maxDepth=3, maxBins=32)
    assert measures["validation_macro_f0_5"] == measures["threshold_macro_f0_5"] > 0.9 and measures["blocking_recall_at_cap_train"]["recall"] > 0.9
    saved = json.loads((tmp_path / "out/threshold.json").read_text())
    assert saved["threshold"] == measures["threshold"] == model.load_threshold(spark, f"{out}/threshold.json") and model.load_threshold(spark, f"{out}/none.json") == 0.70
    flows.match(spark, splits.prepared(spark, folder, "test"), out)
    report_of = submission.validate(spark, f"{out}/matching_results.tsv", f"{folder}/test/test_source1.tsv", f"{out}/candidate_pairs.tsv", [f"{folder}/test/test_source{i}.tsv" for i in (2, 3)])
    assert report_of.code == 0 and not report_of.warnings, str(report_of)
    found = {r.source1_entity_id: r.matched_entity_ids for r in tsv.read(spark, f"{out}/matching_results.tsv", submission.MATCHING).collect()}
    assert len(found) == 60 and sum(found[f"S1-{k}"] == (f"S2-{k},S3-{k}" if k % 5 else "") for k in range(60)) > 50
    splits.preprocess(spark, folder, "train", str(tmp_path / "norm"))
    again = splits.prepared(spark, folder, "train", max_s1=10, max_targets=20, normalized=str(tmp_path / "norm"))
    assert again.s1.count() == 10 and again.s2.count() == 20 and "city_count" in again.s1.columns
    capped = splits.load(spark, folder, "train", 10, 20)
    assert capped.s1.count() == 2 and 4 <= capped.s3.count() <= 6  # of one chunk a fifth of the budget, and the matches
    with pytest.raises(ValueError, match="two S1"):
        flows.train(spark, splits.Split(data.s1.limit(1), data.s2, data.s3, data.truth), out)


def test_validator(spark, tmp_path):
    def file(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    s1, head = file("s1.tsv", "entity_id\tx\nS1-1\ta\nS1-2\tb\n\n"), "source1_entity_id\tmatched_entity_ids\n"
    assert submission.validate(spark, str(tmp_path / "no.tsv"), s1).errors[0].endswith("file not found")
    assert submission.validate(spark, file("e.tsv", ""), s1).errors[0].endswith("empty file")
    assert submission.validate(spark, file("c.tsv", "source1_entity_id,matched_entity_ids\n"), s1).errors[0].endswith("header has commas and no tab")
    assert "unexpected header" in submission.validate(spark, file("h.tsv", "a\tb\n"), s1).errors[0]
    assert submission.validate(spark, file("m.tsv", head), str(tmp_path / "gone.tsv")).code == 1
    good = submission.validate(spark, file("g.tsv", head.upper() + "S1-1\tS2-1,S3-1\nS1-2\t\n"), s1, str(tmp_path / "none.tsv"))
    assert good.code == 0 and "2 rows (1 empty)" in good.notes[0] and len(good.warnings) == 2 and str(good).endswith("PASS")
    bad = submission.validate(spark, file("b.tsv", head + "S1-1\tS2-1,S2-1,S1-9,Q\nno tab\n\nS1-1\t\nS1-7\tS2-9\n"), s1, None, [file("t.tsv", "entity_id\nS2-1\n")])
    rules = [e.split(": ")[1] for e in bad.errors]
    assert rules == submission.RULES and str(bad).count("\n") >= len(rules)
    cand = file("cand.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    assert "no candidates, e.g. S1-1" in submission.validate(spark, str(tmp_path / "g.tsv"), s1, cand).warnings[-1]
    assert sorted(r.entity_id for r in submission.read_ids(spark, s1).collect()) == ["S1-1", "S1-2"]


def test_empty(spark):
    n = R.normalized(spark.createDataFrame([], RECORD))
    keys = blocking.block_keys(n)
    pairs = blocking.candidates(keys, keys)
    assert assignment.listed(n, pairs, "ids").count() == 0 and evaluation.recall(pairs.select("s1_id", "target_id"), pairs).first().recall == 1.0


def test_report(spark):
    r = report.Report("Title")
    r.section("One", spark.createDataFrame([("a|b", 1200, None)], "x string, n long, z string"), "A note.")
    text = r.text()
    assert "| a/b | 1,200 |  |" in text and "## Run time" in text and report.percent(1, 0) == "n/a" and report.percent(1, 8, 2) == "12.50%" and report.short("x" * 200).endswith("…")


def test_written_tables_are_read_back(spark, tmp_path):
    n = R.normalized(spark.createDataFrame([("S1-1", 1, "S1", "Acme Inc", "1 x, y", "US")], RECORD))
    R.write(n, str(tmp_path / "n"))
    R.write(n.limit(0), str(tmp_path / "e"))
    assert R.read(spark, str(tmp_path / "n")).first().name_tokens == ["acme"] and R.read(spark, str(tmp_path / "e")).count() == 0
    assert spark.read.parquet(str(tmp_path / "e")).schema == R.SCHEMA and store.handed(n).count() == 1


def test_score_distribution_writes_its_pool_once(spark, monkeypatch):
    """the pool is written by part only; what has been dealt out goes before the search."""
    from tessera.plans import catalog

    made, swept = [], []
    monkeypatch.setattr(store, "handed", lambda df, name="t", *a, old=store.handed: made.append(name) or old(df, name, *a))
    if hasattr(store, "swept"):
        monkeypatch.setattr(store, "swept", lambda s, old=store.swept: swept.append(old(s)))
    catalog.queries()["score_distribution"](spark, "/root/testdata/sf0.001")
    assert made == ["queries"] and swept


def test_score_distribution_goes_by_slices(spark, monkeypatch):
    """one slice of the ids after another is joined, shuffled and written, true pairs too; the rows are the same."""
    from tessera.plans import catalog

    made, rows = [], []
    monkeypatch.setattr(store, "handed", lambda df, *a, old=store.handed: made.append(df) or old(df, *a))
    for size in (1_000_000, 60):
        monkeypatch.setattr(blocking, "SLICE", size, raising=False)
        rows.append(sorted(map(tuple, catalog.queries()["score_distribution"](spark, "/root/testdata/sf0.001").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 3
    assert len(made[0]) == 1 and len(made[1]) > 1 and sum(x.count() for x in made[1]) == made[0][0].count()


def test_slices_lose_no_copies(spark, monkeypatch):
    """texts that many rows have, in several slices, and groups that no query has; parts with a shuffle and without."""
    rows = [(f"S{1 + i % 2}-{i}", f"S{1 + i % 2}", ["alpha beta", "alpha gamma", f"delta {i % 9}", "ab", None][i % 5], ["x", "y", "z"][i % 3] if i % 2 else "xy"[i % 4 // 2], f"t{i % 7}") for i in range(400)]
    q, p = blocking.sides(spark.createDataFrame(rows, "entity_id string, source string, t string, country string, tag string"))
    for by, tag in ((["country"], "tag"), ([], None)):
        got = []
        for size, most, rest in ((1_000_000, 200, 100_000), (30, 200, 9), (30, 0, 9)):
            for name, v in (("SLICE", size), ("UNSHUFFLED", most), ("ROWS", rest)):
                monkeypatch.setattr(blocking, name, v, raising=False)
            lists = blocking.nearest_lists(q, p, "t", 6, by, [], tag).select("s1_id", "near.target_id", "near.similarity", "near.tag")
            got.append(sorted(map(tuple, lists.collect())))
        assert got[0] == got[1] == got[2] and max(len(x[1]) for x in got[0]) == 6
        texts = {r[0]: r for r in rows}
        same = lambda a, b: texts[a][2] == texts[b][2] and (not by or texts[a][3] == texts[b][3])
        for s1, near, *_ in got[0]:
            if texts[s1][2] != "ab":
                copies = sorted(r[0] for r in rows if r[1] == "S2" and same(s1, r[0]))
                assert near[: len(copies[:6])] == copies[:6]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_further_directions_spare_comparisons(monkeypatch):
    """of rows that the first directions leave, few are compared in full; the neighbours are the same."""
    import numpy as np

    from tessera.operators import nearest as N

    rng = np.random.default_rng(11)
    for name, v in (("FREQUENT", 0.02), ("DIRECTIONS", 8)):
        monkeypatch.setattr(N, name, v)
    word = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(60)]
    texts = [" ".join(word[int(i)] for i in rng.integers(0, 60, 4)) for _ in range(1500)]
    grams, df = N.counts(texts)
    starts, gram, w = N.placed(texts, grams, df, 1500)
    compared, near = [], []
    monkeypatch.setattr(N.Part, "similar", lambda self, rows, *a, old=N.Part.similar: compared.append(len(rows)) or old(self, rows, *a))
    for finer in (0, 64):
        monkeypatch.setattr(N, "FINER", finer, raising=False)
        compared.clear()
        part, least, best = N.Part(starts, gram, w), np.zeros(200), [[] for _ in range(200)]
        N.merged(best, N.search(part, starts[:201], gram[: starts[200]], w[: starts[200]], 5, least, 20), [[f"{i:04}"] for i in range(1500)], 5, least)
        near.append((sum(compared), best))
    assert near[0][1] == near[1][1] and near[1][0] < near[0][0] / 2


def test_strategy_recall_joins_no_aliases(spark, monkeypatch):
    """states and cities, which no strategy reads, are not named."""
    from tessera.plans import catalog

    asked = []
    monkeypatch.setattr(catalog.fixture, "aliases", lambda s, old=catalog.fixture.aliases: asked.append(s) or old(s))
    catalog.queries()["strategy_recall"](spark, "/root/testdata/sf0.001")
    assert not asked


def test_gbt_score_pairs_by_slices(spark, monkeypatch):
    """one slice of the S1 records after another is paired and written; the rows are those of all at once, and the part is dealt out with no feature."""
    from tessera.operators import features as S
    from tessera.plans import catalog

    sf, made = "/root/testdata/sf0.001", []
    monkeypatch.setattr(store, "handed", lambda df, *a, old=store.handed: made.append(df) or old(df, *a))
    monkeypatch.setattr(catalog, "_SLICE", 80)
    got = catalog._split_features(spark, sf)
    assert len(made[-1]) > 1 and sum(isinstance(x, list) for x in made) == 1
    n, p = catalog.pairs(spark, sf)
    want = store.handed(evaluation.labelled(S.features(p.select("s1_id", "target_id"), n), catalog.truth(spark, sf)))
    columns = ["label", *S.FEATURES]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert got.filter("s1_id IS NOT NULL").join(want, ["s1_id", "target_id"]).count() == got.filter("part = 'valid'").count() > 0
