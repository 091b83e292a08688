"""Secrets in texts: candidates by pattern, false positives removed by a random forest. DataFrame operations only.

A candidate is what follows a keyword and a sign of assignment, or a run of at least 16 characters of keys that holds a digit or
begins like a key of a known format. Its features are its length, shares and changes of character classes, the likelihood of its
letter pairs, how much of it dictionary words cover, and the learned weights of its path's parts and of the NEAR words on either
side: the log odds of a word there among the labelled secrets and the others. The forest (Spark ML's, in the JVM) and the
weights are learned from labelled findings, a table of (candidate, before, after, path, label), at most MAX_LABELLED of them, the
first by a hash: a third of these give the weights, the others the forest. Where no findings are given, ``labelled_findings`` writes
LABELLED by rule: values, contexts and paths are drawn apart from each other, so the same value is a secret after a
keyword in code, and none in a fixture, after "commit" or after "for example"; a few labels in a hundred are wrong on purpose.
``held_out_findings`` writes others by other keywords, contexts, paths and value formats, to measure by.

The result has a row a candidate, with the probability that it is a secret and the verdict; the candidate itself shows only
its first characters and its SHA-256. Null and empty texts have no candidates. Equal rows are searched one by one. A null path is an
empty one. An empty table gives no rows; labelled findings of one kind only, or none, give every candidate that kind's probability (0
without any). Other columns are ignored. A very long text is searched whole, in time linear in its length.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Labelled findings written by rule, and used at most; characters kept on either side of a candidate, words of these that count.
LABELLED, MAX_LABELLED, BESIDE, NEAR = 12_000, 100_000, 40, 6
#: Words of a side or path that get a weight; standard errors by which its secrets must differ from their share.
WEIGHTED, SURE = 200, 3.0
_ASSIGN = r"(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)[\"']? ?[:=] ?[\"']?"
_CANDIDATE = rf"{_ASSIGN}[^\s\"']{{6,}}+|[A-Za-z0-9+/_~-]{{16,}}+={{0,2}}"
_KNOWN = r"^(AKIA|ASIA|AIza|gh[pousr]_|glpat-|sk_live_|sk-|xox[abprs]-|eyJ)"
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
DICTIONARY = """about account action admin after again alpha also another apple application archive array asset back base batch before beta between block
board book branch build button cache call card case change check child class client cloud code color column command commit common company config connection
content control copy core count course create current customer data date default delete demo deploy design detail device dialog document domain down
east edit element email enable engine entry error event every example export factory false feature field file filter final find first flag folder font form
format forward frame from front function game gamma general global graph great green group handler head header hello help here high history home host house
icon image import index info input install instance internal item java json just label language large layer layout level library light line link linux list
load local lock login long machine main make manager master match media member memory menu message method middle mode model module money month more most
name native network never next north note number object office only open option order other output package page panel parent password path pattern people
phone picture place plain plan player please point policy port position post power present press primary print private process product profile program
project public query queue random range read record red release remote remove render report request reset resource response result return right root route
rule sample save scale schema scope screen script search second section secret select send server service session settings shape share short show side sign
simple single site size small source south space spec stack stage start state status step stop storage store stream string style submit summer system table
target task team temp template test text theme there thing this thread time title today token tool total track transfer tree true type under unit update
upload user utils value vector version video view visible water web week white widget width window with word work world write year yellow young your zero""".split()
_BIGRAMS = 27
NAMES = [
    "length", "digits", "uppers", "others", "changes", "pairs", "distinct", "words", "known", "assigned", "keyword", "quoted", "placeholder", "hexadecimal", "only_digits",
    "path_weight", "before_weight", "after_weight", "path_least", "before_least",
]
SIDES = ("path", "before", "after")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, place, candidate, before, after, path), a row a candidate; place counts the text's matches from 0."""
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"), F.regexp_extract_all("text", F.lit(_CANDIDATE), F.lit(0)).alias("found"), F.split("text", _CANDIDATE, -1).alias("parts")).filter(F.size("found") > 0)
    rows = F.transform("found", lambda x, i: F.struct(i.alias("place"), x.alias("raw"), F.right(F.element_at("parts", i + 1), F.lit(BESIDE)).alias("left"), F.left(F.element_at("parts", i + 2), F.lit(BESIDE)).alias("after")))
    rows = F.filter(rows, lambda r: r["raw"].rlike(f"[0-9]|^{_ASSIGN}|{_KNOWN}"))
    out = cut.select("doc_id", "path", F.explode(rows).alias("r")).select("doc_id", "path", "r.*")
    value = F.regexp_replace("raw", f"^{_ASSIGN}", "")
    before = F.concat("left", F.substring("raw", F.lit(1), F.length("raw") - F.length(value)))
    return out.select("doc_id", "place", value.alias("candidate"), before.alias("before"), "after", "path").filter("candidate <> ''")


def _rate(count: Column, of: Column) -> Column:
    return F.when(of > 0, count / of).otherwise(F.lit(0.0))


def _beside(side: str) -> Column:
    """The words of a side, nearest first, or the parts of the path; each once. Addresses, of mail and of pages, are no words."""
    text = F.lower(F.coalesce(side, F.lit("")))
    if side != "path":
        text = F.regexp_replace(text, r"\S*(?:@|://)\S*", " ")
    words = F.filter(F.split(text, "[^a-z]+"), lambda w: w != "")
    if side == "before":
        words = F.reverse(words)
    if side != "path":
        words = F.slice(words, 1, NEAR)
    return F.array_distinct(words)


def weights(labelled: DataFrame) -> dict[str, dict[str, float]]:
    """Of each side the words with the strongest log odds, WEIGHTED at most."""
    rows = labelled.select(F.col("label").cast("int").alias("label"), F.explode(F.array(*[F.struct(F.lit(s).alias("side"), _beside(s).alias("words")) for s in SIDES])).alias("x"))
    rows = rows.select("label", "x.side", F.explode("x.words").alias("word")).groupBy("side", "word").agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))
    n = labelled.agg(F.coalesce(F.sum(F.col("label").cast("int")), F.lit(0)).alias("yes"), F.count(F.lit(1)).alias("all")).first()
    odds = F.log((F.col("yes") + 0.5) / (n["yes"] + 1)) - F.log((F.col("no") + 0.5) / (n["all"] - n["yes"] + 1))
    share = n["yes"] / max(1, n["all"])
    sure = F.abs(F.col("yes") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share) + 1e-9))
    rows = rows.withColumn("n", F.col("yes") + F.col("no")).withColumn("odds", odds).withColumn("sure", sure).filter(F.col("sure") >= SURE)
    out = {}
    for side in SIDES:
        top = rows.filter(F.col("side") == side).orderBy(F.desc("sure"), "word").limit(WEIGHTED)
        out[side] = {r["word"]: round(r["odds"], 6) for r in top.collect()}
    return out


def _weighed(side: str, of: dict[str, float]) -> tuple[Column, Column]:
    """The sum of a side's weights and the least of them, 0 at most."""
    if not of:
        return F.lit(0.0), F.lit(0.0)
    table = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])
    each = F.transform(_beside(side), lambda w: F.coalesce(table[w], F.lit(0.0)))
    return F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.least(F.coalesce(F.array_min(each), F.lit(0.0)), F.lit(0.0))


def featured(rows: DataFrame, pairs: list[float], weight: dict[str, dict[str, float]]) -> DataFrame:
    """The rows with the columns NAMES. pairs: log likelihoods of letter pairs, by 27 * first + second; weight: of words, by side."""
    v, low, n = F.col("candidate"), F.lower("candidate"), F.length("candidate").cast("double")
    kinds = F.translate(v, _UPPER + _LOWER + _DIGIT, "A" * 26 + "a" * 26 + "0" * 10)
    count = lambda cls: F.length(F.regexp_replace(F.col("kinds"), f"[^{cls}]", ""))
    code = lambda s: F.when(s.between("a", "z"), F.ascii(s) - 97).otherwise(26)
    table = F.lit(pairs)
    steps = F.when(F.length("candidate") > 1, F.sequence(F.lit(1), F.length("candidate") - 1)).otherwise(F.array().cast("array<int>"))
    chance = F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.element_at(table, (code(F.substring(F.col("low"), i, F.lit(1))) * _BIGRAMS + code(F.substring(F.col("low"), i + 1, F.lit(1))) + 1).cast("int")))
    left = F.length(F.regexp_replace(F.col("low"), "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    flag = lambda c: c.cast("double")
    beside = {side: _weighed(side, weight[side]) for side in SIDES}
    got = rows.withColumn("kinds", kinds).withColumn("low", low).withColumn("n", n)
    n = F.col("n")
    return got.select(
        *rows.columns, n.alias("length"), _rate(count("0"), n).alias("digits"), _rate(count("A"), n).alias("uppers"),
        _rate(n - count("0aA"), n).alias("others"), _rate(F.length(F.regexp_replace("kinds", r"(.)\1+", "$1")), n).alias("changes"),
        _rate(chance, n - 1).alias("pairs"), _rate(F.size(F.array_distinct(F.split("candidate", ""))), F.least(n, F.lit(40.0))).alias("distinct"), _rate(n - left, n).alias("words"),
        flag(v.rlike(_KNOWN)).alias("known"), flag(F.col("before").rlike(r"[:=] ?[\"']?$")).alias("assigned"),
        flag(F.col("before").rlike(f"{_ASSIGN}$")).alias("keyword"), flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("quoted"),
        flag(F.col("low").rlike("example|changeme|placeholder|your|xxxx|dummy|sample|0{8}|1234567")).alias("placeholder"),
        flag(F.col("low").rlike("^[0-9a-f]+$") & F.col("low").rlike("[a-f]")).alias("hexadecimal"), flag(v.rlike("^[0-9 -]+$")).alias("only_digits"),
        *[beside[side][0].alias(f"{side}_weight") for side in SIDES], *[beside[side][1].alias(f"{side}_least") for side in SIDES[:2]],
    )


_SECRET = ["password", "passwd", "token", "secret", "api_key", "apikey", "access_key", "credential"]
_PLAIN = ["commit", "sha", "hash", "checksum", "order", "card", "invoice", "uuid", "isbn", "tracking", "revision", "version", "build", "digest", "etag", "integrity"]
_EXAMPLE = ["example", "for example", "sample", "dummy", "a fake", "placeholder", "replace with your", "template", "for instance the", "an example"]
#: Words of prose that stand before findings of every kind, so that they weigh nothing.
_PROSE = ["the", "a", "an", "for", "with", "your", "of", "is", "in", "and", "this", "that", "set", "use", "to", "by", "on", "it", "as", "one"]
_SIGNS = [' = "', "=", ": ", ":", "='", ' = ']
_CODE = ["src", "app", "config", "deploy", "server", "service", "prod", "infra", "ops", "scripts", "lib/core", "settings", "ansible", "terraform", "k8s", ""]
_TEST = ["test", "tests", "testing", "spec", "fixtures", "fixture", "mocks", "mock", "examples", "example", "samples", "docs", "doc", "demo", "tutorial", "testdata", "vendor", "snapshots", "golden", "readme"]
#: Contexts of the held-out findings: none of these keywords, paths and fillers is used in training, but for the path parts that mark tests.
_HELD_SECRET = ["client_secret", "auth_token", "db_password", "PWD", "aws_secret", "private_token"]
_HELD_PLAIN = ["commit id", "sha of", "order no", "card no", "uuid is", "checksum of", "hash of the"]
_HELD_EXAMPLE = ["this example of the", "one sample of the", "for instance", "dummy for the"]
_HELD_CODE = ["backend/api", "internal/auth", "charts/prod", "cmd/server", "home/deploy"]
_HELD_TEST = ["pkg/testdata", "web/tests/unit", "docs/guide", "client/mocks", "examples/quick"]


def _drawn(spark: SparkSession, n: int, salt: str) -> DataFrame:
    """(id, words, hexa, b64, letters, digits): what findings are put together of, from hashes of a row's number."""
    w = F.lit(DICTIONARY)
    words = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.element_at(w, (F.pmod(F.xxhash64("id", F.lit(salt), i), F.lit(len(DICTIONARY))) + 1).cast("int")))
    hexa = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    drawn = spark.range(n).select("id", words.alias("words"), hexa.alias("hexa"), F.lpad(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10**16)).cast("string"), 16, "4").alias("digits"))
    drawn = drawn.withColumn("b64", F.translate(F.base64(F.unhex("hexa")), "+/=", "xY7")).withColumn("letters", F.translate("b64", _DIGIT, "qWxZkVjQpG"))
    return C.handed(drawn, "drawn")


def _written(drawn: DataFrame, salt: str, values: list[tuple[Column, str]], secret: list[str], plain: list[str], example: list[str], code: list[str], test: list[str], wrong: int) -> DataFrame:
    """(candidate, before, after, path, label) of what was drawn. values: with what they are, "random", "known" or "no"
    secret; wrong: labels in a hundred that are turned round."""
    at = lambda of, n: F.pmod(F.xxhash64("id", F.lit(salt + of)), F.lit(n)).cast("int")
    pick = lambda of, x: F.element_at(F.lit(x), at(of, len(x)) + 1)
    case = lambda of, x: F.element_at(F.array(*x), at(of, len(x)) + 1)
    word = lambda i: F.col("words")[i]
    rows = drawn.select(
        "id", "words", case("v", [v for v, _ in values]).alias("candidate"), pick("v", [w for _, w in values]).alias("is"),
        pick("c", ["keyword"] * 3 + ["plain", "bare", "example"]).alias("context"), F.concat(pick("k", secret), pick("s", _SIGNS)).alias("key"),
        F.concat(pick("p", plain), pick("q", [" ", ": ", "="])).alias("plain"), F.concat(pick("e", example), F.lit(" ")).alias("example"),
        (at("t", 3) == 0).alias("tested"), pick("l", _PROSE).alias("lead"), F.when(at("r", 2) == 0, pick("m", _PROSE)).otherwise(word(4)).alias("link"), F.concat(F.lit("/"), word(6), pick("x", [".py", ".js", ".env", ".yml", ".json", ".md"])).alias("file"), pick("u", test).alias("test"), pick("w", code).alias("code"),
    )
    rows = C.handed(rows, "findings")
    filler = F.concat("lead", F.lit(" "), word(3), F.lit(" "), "link", F.lit(" "))
    before = F.when(F.col("context") == "keyword", F.concat(filler, "key")).when(F.col("context") == "plain", F.concat(filler, "plain"))
    before = before.when(F.col("context") == "bare", filler).otherwise(F.concat(word(3), F.lit(" "), "lead", F.lit(" "), "example", "key"))
    path = F.when(F.col("tested"), F.concat("test", "file")).otherwise(F.concat("code", F.when(at("y", 2) == 0, F.col("file")).otherwise(at("z", 30).cast("string"))))
    random, known = (F.col("is") == "random") & (F.col("context") == "keyword"), (F.col("is") == "known") & (F.col("context") != "example")
    turned = F.pmod(F.xxhash64("id", F.lit(salt + "wrong")), F.lit(100)) < wrong
    label = ((~F.col("tested") & (random | known)) != turned).cast("int")
    after = F.concat(F.regexp_extract("key", "([\"']?)$", 1), F.lit(" "), word(5), F.lit(" "))
    after = F.when(F.col("context").isin("keyword", "example"), after).otherwise(F.concat(F.lit(" "), word(5), F.lit(" ")))
    return rows.select("candidate", before.alias("before"), after.alias("after"), path.alias("path"), label.alias("label"))


def labelled_findings(spark: SparkSession, n: int = LABELLED) -> DataFrame:
    """(candidate, before, after, path, label): findings written by rule from hashes of a row's number."""
    part = lambda c, k, at=1: F.substring(c, at, k)
    word = lambda i: F.col("words")[i]
    three = [word(0), word(1), word(2)]
    values = [
        (part("hexa", 40), "random"), (F.upper(part("hexa", 40)), "random"), (part("hexa", 32), "random"), (part("hexa", 18), "random"), (part("b64", 40), "random"), (part("b64", 24), "random"), (part("b64", 12), "random"),
        (part("letters", 24), "random"), (F.concat(*map(F.initcap, three), F.lit("!")), "random"), (F.concat(part("letters", 10), part("digits", 3), F.lit("#")), "random"),
        (F.concat(F.lit("AKIA"), F.upper(part("b64", 16))), "known"), (F.concat(F.lit("AKIA"), F.upper(part("letters", 16))), "known"), (F.concat(F.lit("ghp_"), part("b64", 36)), "known"), (F.concat(F.lit("sk_live_"), part("b64", 24)), "known"),
        (F.col("digits"), "no"), (F.concat_ws("-", part("hexa", 8), part("hexa", 4, 9), part("hexa", 4, 13), part("hexa", 4, 17), part("hexa", 12, 21)), "no"), (F.concat_ws("-", *three, part("digits", 2)), "no"),
        (F.concat(F.lit("your_"), word(0), F.lit("_here")), "no"), (F.concat(F.lit("your_"), word(1), F.lit("_here1")), "no"), (F.concat(F.lit("example-token-1234567"), word(0)), "no"), (F.concat(F.lit("xxxxxxxxxxxxxxxx"), part("digits", 1)), "no"),
        (F.concat_ws("_", *three), "no"), (F.concat(F.concat_ws("/", *three), F.lit("/v2")), "no"), (F.concat(word(0), F.lit(".")), "no"), (F.concat(word(0), word(1), F.lit(",")), "no"), (F.concat(F.lit("sk-"), F.concat_ws("-", *three)), "no"),
    ]
    return _written(_drawn(spark, n, "l"), "l", values, _SECRET, _PLAIN, _EXAMPLE, _CODE, _TEST, 2)


def held_out_findings(spark: SparkSession, n: int = 3000) -> DataFrame:
    """Findings as in ``labelled_findings``, by other templates and without wrong labels."""
    part = lambda c, k, at=1: F.substring(c, at, k)
    word = lambda i: F.col("words")[i]
    three = [word(0), word(1), word(2)]
    values = [
        (part("hexa", 64), "random"), (F.reverse(part("b64", 32)), "random"), (F.reverse(part("b64", 14)), "random"), (F.concat(part("letters", 8), F.lit("$"), part("digits", 4, 5)), "random"), (F.reverse(part("letters", 30)), "random"),
        (F.concat(F.lit("glpat-"), part("b64", 20)), "known"), (F.concat(F.lit("gho_"), part("b64", 36)), "known"), (F.concat(F.lit("AIza"), part("b64", 35)), "known"),
        (part("digits", 13), "no"), (F.concat(F.lit("order-"), part("digits", 12)), "no"), (F.concat_ws("-", *three, F.lit("20240101")), "no"), (F.concat(F.lit("changeme_"), word(0)), "no"),
        (F.concat_ws(".", *three), "no"), (F.concat(word(0), F.lit("_"), word(1), F.lit("_id_"), part("digits", 1)), "no"), (F.concat(word(0), F.lit("s;")), "no"),
    ]
    return _written(_drawn(spark, n, "h"), "h", values, _HELD_SECRET, _HELD_PLAIN, _HELD_EXAMPLE, _HELD_CODE, _HELD_TEST, 0)


def pair_chances() -> list[float]:
    """Log likelihood of each pair of letters (27th: any other character) in the dictionary's words, smoothed."""
    seen: Counter = Counter()
    for w in DICTIONARY:
        codes = [ord(c) - 97 for c in w]
        seen.update(zip(codes, codes[1:], strict=False))
    first = Counter()
    for (a, _), n in seen.items():
        first[a] += n
    return [math.log((seen[a, b] + 0.1) / (first[a] + 0.1 * _BIGRAMS)) for a in range(_BIGRAMS) for b in range(_BIGRAMS)]


class Model:
    """Weights of words beside candidates and the forest; or, without findings of both kinds, one probability for all."""

    def __init__(self, pairs: list[float], weight: dict[str, dict[str, float]], forest, share: float):
        self.pairs, self.weight, self.forest, self.share = pairs, weight, forest, share

    def judged(self, rows: DataFrame) -> DataFrame:
        """The rows (candidate, before, after, path) with NAMES and probability."""
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        x = featured(rows, self.pairs, self.weight)
        if self.forest is None:
            return x.withColumn("probability", F.lit(self.share))
        scored = self.forest.transform(VectorAssembler(inputCols=NAMES, outputCol="_x").transform(x))
        return scored.select(*x.columns, vector_to_array("probability")[1].alias("probability"))


def fit(labelled: DataFrame, trees: int = 40, depth: int = 9, bound: int = MAX_LABELLED) -> Model:
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    key = F.xxhash64("candidate", "before", "after", "path")
    rows = labelled.select("candidate", "before", "after", F.coalesce("path", F.lit("")).alias("path"), F.col("label").cast("double").alias("label")).filter("candidate IS NOT NULL AND label IS NOT NULL")
    rows = C.handed(rows.withColumn("key", key).orderBy("key").limit(bound), "labelled")
    pairs, weight = pair_chances(), weights(rows.filter("pmod(key, 3) = 0"))
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return Model(pairs, weight, None, float(max(kinds, default=0.0)))
    x = C.handed(featured(rows.filter("pmod(key, 3) <> 0"), pairs, weight).select(*NAMES, "label"), "featured")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=4, seed=11, featuresCol="_x", labelCol="label")
    return Model(pairs, weight, forest.fit(VectorAssembler(inputCols=NAMES, outputCol="_x").transform(x)), 0.0)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, place, shown, length, candidate_sha256, probability, is_secret) of every candidate."""
    model = fit(labelled_findings(docs.sparkSession) if labelled is None else labelled)
    p = F.col("probability")
    shown = F.concat(F.substring("candidate", 1, 4), F.lit("...")).alias("shown")
    sha = F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256")
    return model.judged(candidates(docs)).select("doc_id", "place", shown, F.col("length").cast("int").alias("length"), sha, p, (p >= 0.5).alias("is_secret"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(C.documents(spark, sf_dir, "doc_id", "text", "source"))
