"""Benchmark passages in documents, by an FM-index of each shard of documents.

All benchmark words have one numbering: their order among the distinct words, which stand in one file. A
worker encodes each document once and gathers documents to shards of about SHARD words. Words that no benchmark item has end
a stretch (an occurrence can't contain one), and stretches shorter than the shortest window hold none; the word ids of all
other stretches, with separators, are the text that the shard's one FM-index is built of: suffix array by prefix doubling, its
Burrows-Wheeler transform in a wavelet matrix, suffix positions sampled every SAMPLE words. All windows of a block are
searched backwards together, one rank query a word and bound; the rows found are walked to their sampled positions; and the
spans of words are merged.

A window is WINDOW consecutive words of an item, or all of a shorter item. Tasks deal the windows into blocks of at most
BLOCK windows, arrays in files of the shared folder, and every shard is searched for one block after another; blocks of up to
CACHE bytes stay in a worker, others are read again for each shard. So neither the benchmark's growth nor that of the documents
meets a bound. No document rows are shuffled, whatever passage they share.

Null and empty texts have no words; such items no windows. Equal rows are answered one by one; items with equal texts
all count; texts with equal item ids are one item. Windows of items without an id hit, too, but are no items to be counted or named.
Empty tables give no rows, or no hits. A text longer than SHARD is a shard by itself. Other columns are ignored by ``find`` and kept by
``clean``, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW, SHARD, SAMPLE = 10, 2_000_000, 16
#: Windows of a block; bytes of items a task reads; bytes of blocks that a worker keeps; words that are numbered at once, at least.
BLOCK, TASK_BYTES, CACHE, PIECE = 200_000, 4 << 20, 64 << 20, 100_000


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(C.WORDS).split()


class Numbering:
    """Ids of words, 2 and up, by their place among the benchmark's distinct words; 0 for other words."""

    def __init__(self, path: str):
        import pyarrow as pa

        self.words = pa.ipc.open_stream(C.read_bytes(path)).read_all().column(0).combine_chunks()
        # a look-up builds a hash table of all these words, so it should be of many words
        self.piece = max(PIECE, len(self.words))

    def encode(self, words: list[bytes]) -> np.ndarray:
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.index_in(pa.array(words, pa.binary()), value_set=self.words)
        return pc.fill_null(at, -2).to_numpy() + np.int32(2)


class Phrases:
    """A block: distinct windows as rows of word ids, flush right as the search goes backwards, and the items of each.

    The items of window w are names[i] for i in owners[starts[w]:starts[w + 1]]."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, names: list[str]):
        self.sizes, self.words, self.starts, self.owners, self.names = sizes, words, starts, owners, names

    @classmethod
    def of(cls, found: dict[tuple[int, ...], set[str | None]], window: int) -> Phrases:
        names = sorted({x for s in found.values() for x in s if x is not None})
        number = {x: i for i, x in enumerate(names)}
        owners = [sorted(number[x] for x in s if x is not None) for s in found.values()]
        words = np.zeros((len(found), window), np.int32)
        for row, w in zip(words, found, strict=True):
            row[window - len(w) :] = w
        return cls(np.array([len(w) for w in found], np.int64), words, np.cumsum([0, *map(len, owners)]), np.array([x for o in owners for x in o], np.int64), names)

    def dump(self) -> bytes:
        out = io.BytesIO()
        names = [x.encode("utf-8", "surrogatepass") for x in self.names]
        np.savez(out, sizes=self.sizes, words=self.words, starts=self.starts, owners=self.owners, names=np.frombuffer(b"".join(names), np.uint8), lengths=np.array([len(x) for x in names], np.int64))
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Phrases:
        with np.load(io.BytesIO(blob)) as x:
            raw, ends = x["names"].tobytes(), np.cumsum(x["lengths"]).tolist()
            names = [raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip([0, *ends], ends, strict=False)]
            return cls(x["sizes"], x["words"], x["starts"], x["owners"], names)

    def items(self, windows: np.ndarray) -> set[int]:
        return {i for w in windows.tolist() for i in self.owners[self.starts[w] : self.starts[w + 1]].tolist()}


class Benchmark:
    """Where the numbering and the blocks are, and the size of the shortest window."""

    def __init__(self, numbering: str, blocks: list[str], least: int):
        self.numbering, self.blocks, self.least = numbering, blocks, least


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of small positive ids, by prefix doubling over those not yet told apart."""
    n = len(text)
    bits = max(1, int(text.max(initial=1)).bit_length())
    per = max(1, 62 // bits)
    key, padded = np.zeros(n, np.int64), np.concatenate([text.astype(np.int64), np.zeros(per, np.int64)])
    for k in range(per):
        key = (key << bits) | padded[k : k + n]
    left = np.argsort(key)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    new = np.flatnonzero(np.diff(key[left], prepend=-1))
    size = np.diff(new, append=n)
    rank[left] = np.repeat(new, size)
    left, step = left[np.repeat(size > 1, size)], per
    while len(left):
        key = (rank[left] << 32) | (rank[np.minimum(left + step, n)] + 1)
        order = np.argsort(key)
        left, key = left[order], key[order]
        group = np.flatnonzero(np.diff(key >> 32, prepend=-1))
        first = np.repeat(group, np.diff(group, append=len(left)))
        new = np.flatnonzero(np.diff(key, prepend=-1))
        size = np.diff(new, append=len(left))
        rank[left] = (key >> 32) + np.repeat(new, size) - first
        left, step = left[np.repeat(size > 1, size)], step * 2
    out = np.empty(n, np.int64)
    out[rank[:n]] = np.arange(n)
    return out


class WaveletMatrix:
    """Rank of a symbol before a place, and the symbol at a place, by one bit vector a bit of the symbols."""

    def __init__(self, text: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for b in range(bits - 1, -1, -1):
            bit = ((text >> b) & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            words = np.frombuffer(packed.tobytes() + b"\0" * (-len(packed) % 8 + 8), "<u8")
            ones = np.cumsum(np.bitwise_count(words).astype(np.int64))
            self.levels.append((words, np.concatenate([[0], ones]), len(bit) - int(bit.sum())))
            text = np.concatenate([text[bit == 0], text[bit == 1]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        words, ones, _ = level
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return ones[at >> 6] + np.bitwise_count(words[at >> 6] & mask).astype(np.int64)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place."""
        start = np.zeros_like(at)
        for k, level in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            a, s = self._ones(level, at), self._ones(level, start)
            at, start = np.where(one, level[2] + a, at - a), np.where(one, level[2] + s, start - s)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for level in self.levels:
            one = (level[0][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            a = self._ones(level, at)
            symbol = (symbol << 1) | one
            at = np.where(one, level[2] + a, at - a)
        return symbol


class FMIndex:
    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        """text: ids of 1 and up; an end symbol 0 is added."""
        text = np.concatenate([text, [0]]).astype(np.int64)
        n = self.n = len(text)
        order = np.concatenate([[n - 1], suffix_array(text[:-1])])
        before = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.matrix = WaveletMatrix(before, max(1, int(text.max()).bit_length()))
        kept = order % sample == 0
        self.marked, self.places = kept, order[kept]
        self.rank_marked = np.cumsum(kept) - kept

    def count(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) whose suffixes begin with each phrase; phrases are flush right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1]):
            live = np.flatnonzero((sizes > k) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, phrases.shape[1] - 1 - k]
            inside = symbol < len(self.first) - 1
            high[live[~inside]] = low[live[~inside]]
            live, symbol = live[inside], symbol[inside]
            both = self.first[np.concatenate([symbol, symbol])] + self.matrix.rank(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            low[live], high[live] = both[: len(live)], both[len(live) :]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the rows' suffixes: back through the text until a sampled one."""
        out, steps, left = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            hit = self.marked[rows]
            out[left[hit]] = self.places[self.rank_marked[rows[hit]]] + steps
            left, rows = left[~hit], rows[~hit]
            if len(left):
                symbol = self.matrix.access(rows)
                rows = self.first[symbol] + self.matrix.rank(symbol, rows)
                steps += 1
        return out


class Shard:
    """The stretches of some documents in one FM-index. ids: word ids of all documents, 0 for others; ends: of each document."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, least: int):
        self.ends, self.index = ends, None
        inside = ids > 0
        edge = np.zeros(len(ids) + 1, bool)
        edge[[0, len(ids)]] = True
        edge[ends] = True
        edge[1:-1] |= inside[1:] != inside[:-1]
        starts = np.flatnonzero(edge)
        sizes = np.diff(starts)
        good = inside[starts[:-1]] & (sizes >= least) if len(ids) else np.zeros(len(sizes), bool)
        starts, sizes = starts[:-1][good], sizes[good]
        if not len(starts):
            return
        # each stretch and a separator (id 1) after it; place: the word each symbol stands for
        total = sizes + 1
        offset = np.cumsum(total) - total
        self.place = np.repeat(starts - offset, total) + np.arange(int(total.sum()))
        text = ids[np.minimum(self.place, len(ids) - 1)].astype(np.int64)
        text[offset + sizes] = 1
        # the shard's own numbering, dense and in the same order, keeps the wavelet matrix low
        self.symbols = np.unique(text)
        self.index = FMIndex(np.searchsorted(self.symbols, text) + 1)

    def find(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, window, first word) of every occurrence of a block's windows."""
        none = np.empty(0, np.int64)
        if self.index is None or not len(phrases.sizes):
            return none, none, none
        at = np.minimum(np.searchsorted(self.symbols, phrases.words), len(self.symbols) - 1)
        known = self.symbols[at] == phrases.words
        possible = np.flatnonzero((known | (phrases.words == 0)).all(1))
        low, high = self.index.count(at[possible] + 1, phrases.sizes[possible])
        n = high - low
        window = np.repeat(possible, n)
        rows = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        word = self.place[self.index.locate(rows)]
        return np.searchsorted(self.ends, word, side="right"), window, word


def answers(sizes: list[int], ids: np.ndarray, benchmark: Benchmark):
    """n_hit, names of items and merged spans of each document of a shard."""
    ends = np.cumsum(sizes)
    hit = np.zeros(int(ends[-1]) + 1, np.int64)
    items: dict[int, set[str]] = {}
    shard = Shard(ids, ends, benchmark.least)
    for path in benchmark.blocks if shard.index is not None else ():
        phrases = _phrases(path)
        doc, window, word = shard.find(phrases)
        np.add.at(hit, word, 1)
        np.add.at(hit, word + phrases.sizes[window], -1)
        pairs = np.unique(np.stack([doc, window], 1), axis=0)
        for of in np.split(pairs, np.flatnonzero(np.diff(pairs[:, 0])) + 1) if len(pairs) else ():
            items.setdefault(int(of[0, 0]), set()).update(phrases.names[i] for i in phrases.items(of[:, 1]))
    covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
    n_hit = covered[ends] - covered[ends - np.array(sizes)]
    found = [sorted(items.get(d, ())) for d in range(len(sizes))]
    marks = [_spans(hit, e - s, e) if n else [] for s, e, n in zip(sizes, ends.tolist(), n_hit.tolist(), strict=True)]
    return n_hit, found, marks


def _spans(hit: np.ndarray, start: int, end: int) -> list[int]:
    """First and last word but one of each merged span, one after another, counted from the document's first word."""
    base = int(hit[:start].sum())
    inside = np.concatenate([[False], np.cumsum(hit[start:end]) + base > 0, [False]])
    return np.flatnonzero(inside[1:] != inside[:-1]).tolist()


_LOADED: dict[str, Phrases] = {}
_NUMBERINGS: dict[str, Numbering] = {}


def _phrases(path: str) -> Phrases:
    """A block; kept as long as all that are kept take CACHE bytes at most, so the blocks of a small benchmark are read once."""
    if path in _LOADED:
        return _LOADED[path]
    found = Phrases.load(C.read_bytes(path))
    if sum(x.words.nbytes for x in _LOADED.values()) + found.words.nbytes <= CACHE:
        _LOADED[path] = found
    return found


def _numbering(benchmark: Benchmark) -> Numbering:
    if benchmark.numbering not in _NUMBERINGS:
        _NUMBERINGS.clear(), _LOADED.clear()
        _NUMBERINGS[benchmark.numbering] = Numbering(benchmark.numbering)
    return _NUMBERINGS[benchmark.numbering]


def pa_table(words: list[bytes]):
    import pyarrow as pa

    return pa.table({"word": pa.array(words, pa.binary())})


def prepared(items: DataFrame, window: int = WINDOW) -> Benchmark:
    """Number the words of the items and write their windows in blocks."""
    spark = items.sparkSession
    C.prepare(spark)
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    folder = C.shared_dir(spark)

    def distinct(batches):
        import pyarrow as pa

        for batch in batches:
            found = {w for text in C.byte_rows(batch.column(1)) for w in words_of(text)}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], names=["word"])

    def written(table):
        import pyarrow as pa

        sink, path = pa.BufferOutputStream(), f"{folder}/numbering-{uuid.uuid4().hex}"
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        C.write_bytes(path, sink.getvalue().to_pybytes())
        return path

    def merged(batches):
        import pyarrow as pa

        words = [w for batch in batches for w in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([written(pa_table(words))])], names=["path"])

    # one task, the distinct words of the benchmark
    words = rows.mapInArrow(distinct, "word binary").distinct().repartition(1).sortWithinPartitions("word")
    found = C.handed(words.mapInArrow(merged, "path string"), "numbering").first()
    numbering = found["path"] if found else written(pa_table([]))  # no words, so perhaps no task

    def blocks(batches):
        import pyarrow as pa

        def flush():
            path = f"{folder}/windows-{uuid.uuid4().hex}"
            C.write_bytes(path, Phrases.of(found, window).dump())
            row = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([min(map(len, found))], pa.int64())], names=["path", "least"])
            found.clear()
            return row

        number, found = Numbering(numbering), {}
        for batch in batches:
            texts = [words_of(text) for text in C.byte_rows(batch.column(1))]
            ends = np.cumsum([0, *map(len, texts)])
            every = number.encode([w for words in texts for w in words])
            for k, name in enumerate(batch.column(0).to_pylist()):
                ids = every[ends[k] : ends[k + 1]].tolist()
                size = min(window, len(ids))
                for at in range(len(ids) - size + 1) if size else ():
                    found.setdefault(tuple(ids[at : at + size]), set()).add(name)
                    if len(found) >= BLOCK:
                        yield flush()
        if found:
            yield flush()

    dealt = rows.repartition(max(1, -(-total // TASK_BYTES)), F.xxhash64("item_id", "text"))
    paths = C.handed(dealt.mapInArrow(blocks, "path string, least long"), "blocks")
    # a path a block: 10^12 bytes of benchmark are some 10^6 blocks
    found = C.small(paths, 1 << 22, "blocks of benchmark windows")
    return Benchmark(numbering, sorted(r["path"] for r in found), min((r["least"] for r in found), default=window))


class _Gathered:
    """Sizes and word ids of the documents of a shard, as they come."""

    def __init__(self, number: Numbering):
        self.number, self.sizes, self.words, self.ids, self.n = number, [], [], [], 0

    def add(self, text: bytes | None) -> None:
        words = words_of(text)
        self.sizes.append(len(words))
        self.words += words
        self.n += len(words)
        if len(self.words) >= self.number.piece:
            self._encode()

    def _encode(self) -> None:
        self.ids.append(self.number.encode(self.words))
        self.words = []

    def answers(self, benchmark: Benchmark):
        self._encode()
        return answers(self.sizes, np.concatenate(self.ids), benchmark)


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans): spans as starts and ends of words in turn."""
    benchmark = prepared(items, window)

    def run(batches):
        import pyarrow as pa

        def flush():
            n_hit, found, spans = held.answers(benchmark)
            sha = [hashlib.sha256(",".join(x).encode("utf-8", "surrogatepass")).hexdigest() for x in found]
            columns = [pa.array(names, pa.int64()), pa.array(held.sizes, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array(sha, pa.string()), pa.array(n_hit > 0), pa.array(spans, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"])

        number = _numbering(benchmark)
        names, held = [], _Gathered(number)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), C.byte_rows(batch.column(1)), strict=True):
                names.append(name)
                held.add(text)
                if held.n >= SHARD:
                    yield flush()
                    names, held = [], _Gathered(number)
        if names:
            yield flush()

    C.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<long>")


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, in which no window of an item occurs."""
    benchmark, at = prepared(items, window), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        def flush():
            n_hit, start = held.answers(benchmark)[0], 0
            for batch in kept:
                yield batch.filter(pa.array(n_hit[start : start + batch.num_rows] == 0))
                start += batch.num_rows

        number = _numbering(benchmark)
        kept, held = [], _Gathered(number)
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            for text in C.byte_rows(batch.column(at)):
                held.add(text)
            if held.n >= SHARD:
                yield from flush()
                kept, held = [], _Gathered(number)
        if kept:
            yield from flush()
        C.release()

    C.prepare(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(C.documents(spark, sf_dir), C.table(spark, sf_dir, "benchmark")).drop("spans")
