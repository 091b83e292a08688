"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: densities of a lexicon of insults, as they stand and after undoing letter substitutions; the density of words that
mark toxic texts in the training labels; how near second-person words stand to lexicon words; rates of capitals,
digits, punctuation and obfuscation; word lengths. The model learns from at most MAX_LABELS labelled rows, the first by a
hash of their id, never from the fold held out; that sample's parts serve the word list, the trees and the calibration
in turn. Scoring is one pass over whole texts.

Null and empty texts have all features 0 and get the score the model gives these. Several labels of one id count as
toxic if any is; a null label is none. Equal rows are scored one by one; a null id is never held out. Without labels of both kinds every
score is 0, and ``screen`` keeps all. An empty table gives no rows. A very long text is scored whole, one text at a time. Other columns are
ignored by ``score`` and kept by ``screen``, whatever their names: labels, language, source and id are no features.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from itertools import compress, repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Labelled rows that the model may learn from; words that training may add to the lexicon.
MAX_LABELS, MARKERS, MARKER_LEAST = 20_000, 200, 8
LEXICON = """idiot idiots moron morons stupid dumb dumbass fool fools clown clowns loser losers pathetic worthless trash garbage scum filth
jerk creep coward liar disgusting ugly hate hateful shut imbecile cretin dimwit pig swine vermin parasite lunatic psycho degenerate
bastard bitch asshole crap damn hell suck sucks kill die useless brainless ignorant ridiculous freak weirdo
dumm idioten trottel arschloch depp blöd blödmann dummkopf versager mist abschaum widerlich
imbécile con connard salaud crétin abruti débile ordure merde nul raté bouffon
estúpido imbécil tonto basura mierda cabrón payaso inútil asqueroso perdedor""".split()
SECOND = "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos usted ustedes ti tú tuyo vosotros".split()
_MASKS = b"013457@$!"
_LEET = bytes.maketrans(_MASKS, b"oieastasi")
#: To words after undoing letter substitutions, and to the same words with the substitutions left in.
_PLAIN, _KEPT = bytes(range(256)).translate(C.LOWER).translate(_LEET).translate(C.WORDS), bytes(b if b in _MASKS else C.WORDS[b] for b in range(256))
#: Classes of bytes: 1 letter, 2 digit, 3 other ASCII that isn't white space, 0 white space.
_CLASS = np.array([1 if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 2 if 48 <= b <= 57 else 0 if b in C.SPACES else 3 for b in range(256)], np.uint8)
NAMES = ["lexicon", "unmasked", "markers", "marker_kinds", "near_second", "second", "capitals", "all_caps", "digits", "marks", "exclaim", "masked", "spaced", "mean_length", "log_words", "repeats", "lexicon_any", "markers_top"]


def _vocabulary(words, value: int) -> dict[bytes, int]:
    return {w.encode(): value for w in words}


class Features:
    def __init__(self, markers: dict[str, float]):
        self.words = _vocabulary(SECOND, 2) | _vocabulary(LEXICON, 1)
        self.markers = {w.encode(): i + 1 for i, w in enumerate(markers)}
        self.weights = np.array([0.0, *markers.values()])
        self.bad = (self.markers.keys() | _vocabulary(LEXICON, 1).keys()) - _vocabulary(SECOND, 2).keys()

    def __call__(self, text: bytes | None) -> list[float]:
        raw = text or b""
        words = raw.translate(C.WORDS).split()
        n = len(words)
        if not n:
            return [0.0] * len(NAMES)
        kinds = np.fromiter(map(self.words.get, words, repeat(0)), np.int8, n)
        marks = np.fromiter(map(self.markers.get, words, repeat(0)), np.int32, n)
        bad, second = np.flatnonzero((kinds == 1) | (marks > 0)), np.flatnonzero(kinds == 2)
        near = 0.0
        if len(bad) and len(second):
            at = np.searchsorted(second, bad)
            gap = np.minimum(np.abs(second[np.minimum(at, len(second) - 1)] - bad), np.abs(bad - second[np.maximum(at - 1, 0)]))
            near = float((1.0 / (1 + gap)).sum()) / n
        count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        letters = max(1, int(count[65:91].sum() + count[97:123].sum() + count[128:].sum()))
        kind = _CLASS[np.frombuffer(raw, np.uint8)]
        masked = int(((kind[:-2] == 1) & (kind[1:-1] > 1) & (kind[2:] == 1)).sum()) if len(kind) > 2 else 0
        swaps = 0
        if int(count[48:58].sum() + count[64] + count[36] + count[33]):
            plain = raw.translate(_PLAIN).split()
            for word in compress(raw.translate(_KEPT).split(), map(self.bad.__contains__, plain)):
                swaps += self.bad.isdisjoint(word.translate(C.WORDS).split())
        lex, own = int((kinds == 1).sum()), int((marks > 0).sum())
        size = len(raw)
        single = sum(len(w) == 1 for w in words)
        caps = sum(map(bytes.isupper, raw.split())) if count[65:91].sum() > 1 else 0
        return [
            lex / n, swaps / n, own / n, float(len(np.unique(marks)) - 1 + (not (marks == 0).any())), near, len(second) / n,
            float(count[65:91].sum()) / letters, caps / n, float(count[48:58].sum()) / size, float((kind == 3).sum()) / size, float(count[33]) / size,
            masked / n, single / n, size / n, math.log1p(n), 1 - len(set(words)) / n, float(lex > 0), float(self.weights[marks].max()),
        ]


class Trees:
    """Boosted trees of fixed depth on binned features, logistic loss; splits by gain over histograms."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, least: float = 1.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        self.depth, self.rate = depth, rate
        b = self.binned(x)
        n, width = b.shape
        rate0 = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        self.base = math.log(rate0 / (1 - rate0))
        f, self.trees = np.full(n, self.base), []
        flat = b.astype(np.int64) + np.arange(width) * bins
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = p - y, p * (1 - p)
            node, feature, cut = np.zeros(n, np.int64), np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins, np.int64)
            for level in range(depth):
                k = 2**level
                at = (node[:, None] * (width * bins) + flat).ravel()
                hist = [np.bincount(at, np.repeat(v, width), k * width * bins).reshape(k, width, bins).cumsum(2) for v in (g, h)]
                gt, ht = hist[0][:, :, -1:], hist[1][:, :, -1:]
                gl, hl = hist[0], hist[1]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = 0
                best = gain.reshape(k, -1).argmax(1)
                good = gain.reshape(k, -1).max(1) > 1e-6
                first = k - 1
                feature[first : first + k], cut[first : first + k] = best // bins, np.where(good, best % bins, bins)
                node = node * 2 + (b[np.arange(n), feature[first + node]] > cut[first + node])
            leaf = -rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + l2)
            f += leaf[node]
            self.trees.append((feature, cut, leaf))

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T, strict=True)], 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        b, f = self.binned(x), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (b[rows, feature[at]] > cut[at])
            f += leaf[node]
        return f


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing step means by pooling adjacent violators; a line runs between points."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
        pools.append([t, 1.0, s, s])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            t2, n2, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + t2, pools[-1][1] + n2, pools[-1][2], hi]
    xs = [x for p in pools for x in (p[2], p[3])]
    # a pool of n rows with no, or only, toxic ones isn't certain: one row is added, half of each kind
    ys = [v for p in pools for v in [(p[0] + 0.5) / (p[1] + 1)] * 2]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


class Model:
    def __init__(self, markers: dict[str, float], trees: Trees | None, points: tuple[np.ndarray, np.ndarray] | None):
        self.features, self.trees, self.points = Features(markers), trees, points

    def __call__(self, texts: list[bytes | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.zeros(len(texts))
        raw = self.trees(np.array([self.features(t) for t in texts]))
        # ranks within a step of the calibration follow the trees: a share too small to pass a neighbouring step
        return np.clip(np.interp(raw, *self.points) + 1e-6 / (1 + np.exp(-raw)), 0, 1)


def sample(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELS) -> DataFrame:
    """(text, toxic, part): at most bound labelled rows outside the held-out fold. part: of ten, by the hash."""
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(C.crc_fold() != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    key = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = C.handed(marked.withColumn("k", key).orderBy("k", "doc_id").limit(bound), "chosen")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most bound rows
    return C.handed(found.select("text", F.col("toxic").cast("int").alias("toxic"), F.pmod("k", F.lit(10)).cast("int").alias("part")), "sample")


def markers_of(rows: DataFrame) -> dict[str, float]:
    """Words that mark toxic texts: log odds of the shares of toxic and other texts that hold them."""

    def run(batches):
        import pyarrow as pa

        kinds = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(C.byte_rows(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                kinds[toxic > 0].update(set((text or b"").translate(C.WORDS).split()))
        words = list(kinds[0].keys() | kinds[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in words], pa.string()), pa.array([kinds[0][w] for w in words], pa.int64()), pa.array([kinds[1][w] for w in words], pa.int64())], names=["word", "clean", "toxic"])

    n = dict(rows.groupBy((F.col("toxic") > 0).alias("t")).count().collect())
    if len(n) < 2:
        return {}
    by = rows.select("text", "toxic").mapInArrow(run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (n[True] + 1)) - F.log((F.col("clean") + 0.5) / (n[False] + 1))
    top = by.filter(F.col("toxic") >= MARKER_LEAST).withColumn("odds", odds).filter("odds > 1.5").orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "word").limit(MARKERS)
    return {r.word: r.odds for r in top.collect()}


def fit(docs: DataFrame, labels: DataFrame, bound: int = MAX_LABELS) -> Model:
    rows = sample(docs, labels, bound)
    markers = markers_of(rows.filter("part < 3"))
    features = Features(markers)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = [features(t) for t in C.byte_rows(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "toxic", "part"])

    got = rows.filter("part >= 3").mapInArrow(run, "x array<double>, toxic int, part int").toPandas()
    got = got.iloc[np.lexsort(np.array([*np.array(got.x.tolist(), float).reshape(len(got), -1).T, got.toxic], float))] if len(got) else got  # reruns agree
    x, y, train = np.array(got.x.tolist(), float), got.toxic.to_numpy() > 0, got.part.to_numpy() < 8
    if not len(x) or any(len(np.unique(y[m])) < 2 for m in (train, ~train)):
        return Model(markers, None, None)
    trees = Trees(x[train], y[train].astype(float))
    return Model(markers, trees, isotonic(trees(x[~train]), y[~train].astype(float)))


_MODELS: dict[str, Model] = {}


def _model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS.clear()
        _MODELS[path] = pickle.loads(C.read_bytes(path))
    return _MODELS[path]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    path = C.shared_dir(docs.sparkSession) + "/model"
    C.write_bytes(path, pickle.dumps(model, protocol=5))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            s = _model(path)(C.byte_rows(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    C.prepare(docs.sparkSession)
    held = F.coalesce(C.crc_fold() == 0, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def screen(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, that the model doesn't call toxic."""
    path = C.shared_dir(docs.sparkSession) + "/model"
    C.write_bytes(path, pickle.dumps(model, protocol=5))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(_model(path)(C.byte_rows(batch.column(at))) < 0.5))

    C.prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    C.prepare(spark)
    docs = C.documents(spark, sf_dir, "doc_id", "text")
    return score(docs, fit(docs, C.table(spark, sf_dir, "labels", "doc_id", "toxic")))
