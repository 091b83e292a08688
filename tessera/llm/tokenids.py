"""Token ids as Huffman-coded files.

``encode`` turns texts into ids, ``write_ids`` writes them in ascending document order to files of independent
blocks, coded by one canonical length-limited Huffman code over the global id counts, and ``read_ids`` reads
the files back. Every block starts on a byte and carries the bit offset of every ``CHECKPOINT``-th id, and a file's head
has the place of every block, so any stretch between checkpoints decodes by itself: ``read_stretch`` reads only the ranges of
a file that hold the ids asked for. The decoder walks all stretches at once through one table lookup an id.

Null and empty texts hold only the end id. Rows with equal document id keep the order of their length and ids;
null ids come first. An empty table gives no files and no rows. Other columns of the input are ignored. A very long text
is one row of ids, and one file if it has FILE_IDS or more.
"""

from __future__ import annotations

import gc
import struct
import uuid
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

MAGIC = b"TIDS0002"
_HEAD = struct.Struct("<8sIIIQII")
#: Ids of a block, ids between two checkpoints, longest code in bits, ids of a file, ids that a task writes, files that a task reads.
BLOCK, CHECKPOINT, MAX_BITS, FILE_IDS, TASK_IDS, TASK_FILES = 1 << 16, 256, 18, 2_000_000, 32_000_000, 16
#: Bytes of text that a worker encodes at once, in some 20 times as many of memory; words, and pieces after a mark or line feed, that it keeps.
AT_ONCE, MEMO = 4 << 20, 200_000

#: The pre-tokenizer's letters for bytes: printable ones stand for themselves, the others for the letters from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTES[124] = 124
#: Marks that may follow a word's letters as one piece; the apostrophe, which begins pieces of its own, isn't one.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and c != 39)
_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _pieces(word: str) -> list[str] | None:
    """What the pre-tokenizer makes of letters and marks, with single line feeds between; None for other words."""
    out: list[str] = []
    for i, line in enumerate(word.split("\n") if "\n" in word else (word,)):
        letters = line.rstrip(_MARKS)
        if not letters.isalpha():
            return None
        if i:
            out.append("\n")
        out.append(letters)
        if len(letters) < len(line):
            out.append(line[len(letters) :])
    return out


class Encoder:
    """Texts to ids of a byte-level BPE file of the tokenizers library, each distinct word of many texts encoded once.

    A text is cut before each single space between two characters that are no white space. The pre-tokenizer
    cuts there in any case: only its white-space patterns look at what follows, and these need a run of white
    space. Words are told apart by Arrow, so only distinct ones become Python's. Words of letters, and the letters of words that
    end in marks, are one piece each to the pre-tokenizer, so only the library's model runs over them; other words go to the library
    as one text, where each begins with the one id whose token starts with a space, which tells them apart again. Other
    tokenizers get whole texts."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        about = json.loads(self.tokenizer.to_str())
        pre = about.get("pre_tokenizer") or {}
        self.by_word = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not about.get("normalizer") and not any(t.get("lstrip") or t.get("rstrip") or " " in t["content"] for t in about.get("added_tokens", []))
        self.by_word = self.by_word and not any(t["content"].replace("|", "").isalpha() for t in about.get("added_tokens", []))
        self.opens = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")
        self.known: dict[str, bytes] = {}  # after a space: the first ones met, most of them frequent
        self.bare: dict[str, bytes] = {}
        self.end = np.zeros(1, self.dtype).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes() if text else b""

    def words(self, words: list[str]) -> list[bytes | None]:
        """Ids of distinct words as they stand after a space; None for those that no cut may stand beside."""
        stems: dict[str, int] = {}
        out: list = [None] * len(words)
        plain, made, odd, number = [], [], [], stems.setdefault
        for i, w in enumerate(words):
            if w.isalpha():
                plain.append((i, number(w, len(stems))))
            elif w[:-1].isalpha() and w[-1] in _MARKS:
                made.append((i, number(w[:-1], len(stems)), w[-1:]))
            elif w and not w[0].isspace() and not w[-1].isspace():
                if parts := _pieces(w):
                    made.append((i, number(parts[0], len(stems)), parts[1:]))
                else:
                    odd.append(i)
        ids = self.letters(list(stems), " ", self.known, MEMO)
        bare = self.pieces({x for _, _, parts in made for x in parts})
        for i, k in plain:
            out[i] = ids[k]
        for i, k, parts in made:
            out[i] = ids[k] + (bare[parts] if parts.__class__ is str else b"".join(map(bare.__getitem__, parts)))
        for at in range(0, len(odd), 10_000):
            some = odd[at : at + 10_000]
            text = " " + " ".join([words[i] for i in some])
            for i, x in zip(some, self.shared(len(some), np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)), strict=True):
                out[i] = x
        return out

    def pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of these pieces at least, as they stand without a space before."""
        if len(self.bare) > MEMO:
            self.bare.clear()
        new = [x for x in pieces if x not in self.bare]
        self.letters([x for x in new if x.isalpha()], "", self.bare, MEMO + len(new))
        self.bare.update((x, self.whole(x)) for x in new if not x.isalpha())
        return self.bare

    def first(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin a text."""
        parts = {w: (w,) if w.isalpha() else _pieces(w) for w in set(words)}
        bare = self.pieces({x for p in parts.values() if p for x in p})
        ids = {w: b"".join(map(bare.__getitem__, p)) if p else self.whole(w) for w, p in parts.items()}
        return list(map(ids.__getitem__, words))

    def letters(self, words: list[str], before: str, known: dict[str, bytes], most: int) -> list[bytes]:
        """Ids of words of letters, each one piece: only the library's model runs over them, not its splitting. Up to most are kept in known."""
        ids = list(map(known.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            mapped = (before + f"|{before}".join([words[i] for i in new])).encode().decode("latin-1").translate(_BYTES).split("|")
            run, kind = self.tokenizer.model.tokenize, "H" if self.dtype.itemsize == 2 else "I"
            for i, w in zip(new, mapped, strict=True):
                ids[i] = array(kind, [t.id for t in run(w)]).tobytes()
            known.update([(words[i], ids[i]) for i in new[: max(0, most - len(known))]])
        return ids

    def shared(self, n: int, ids: np.ndarray) -> list[bytes]:
        """The ids of n words encoded as one text, word by word."""
        cuts = (np.flatnonzero(self.opens[ids]) * self.dtype.itemsize).tolist()
        if len(cuts) != n:
            raise ValueError("a word's ids do not begin with a token that starts with a space")
        raw = ids.tobytes()
        return [raw[s:e] for s, e in zip(cuts, [*cuts[1:], len(raw)], strict=True)]

    def __call__(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow array of texts, the end id after each, and where each text's ids end."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            out = [self.whole(x) + self.end for x in texts.to_pylist()]
            return np.frombuffer(b"".join(out), self.dtype), np.cumsum([len(x) // self.dtype.itemsize for x in out], dtype=np.int64)
        split = pc.split_pattern(texts, " ")
        starts = split.offsets.to_numpy()
        starts, sizes = (starts[:-1] - starts[0]).astype(np.int64), np.diff(starts)
        parts = split.flatten().dictionary_encode()
        at, known = parts.indices.to_numpy().copy(), parts.dictionary.to_pylist()
        ids = self.words(known)
        first = [known[i] for i in at[starts].tolist()]
        odd = np.array([not w or w[-1].isspace() for w in first], bool) & (sizes > 1)
        no_cut = np.array([x is None for x in ids])
        if no_cut.any():
            no_cut = no_cut[at]
            no_cut[starts] = False
            odd |= np.logical_or.reduceat(no_cut, starts)
        # first words, and texts with other white space, are pieces of their own
        lead = self.first(first)
        for i in np.flatnonzero(odd).tolist():
            lead[i] = self.runs(texts[i].as_py().split(" "))
        pieces = [x or b"" for x in ids] + lead + [self.end]
        at[starts] = len(ids) + np.arange(len(starts), dtype=np.int32)
        if odd.any():
            keep = ~np.repeat(odd, sizes)
            keep[starts] = True
            at = at[keep]
        # the pieces of each text in order, the end id last
        count = np.where(odd, 1, sizes)
        order = np.insert(at, np.cumsum(count), np.int32(len(pieces) - 1))
        length = np.array([len(x) for x in pieces], np.int64) // self.dtype.itemsize
        n = length[order]
        ends = np.cumsum(n)
        shift = (np.cumsum(length) - length)[order] - (ends - n)
        ids = np.frombuffer(b"".join(pieces), self.dtype)
        return ids[np.repeat(shift, n) + np.arange(int(ends[-1]) if len(ends) else 0)], ends[np.cumsum(count + 1) - 1]

    def runs(self, parts: list[str]) -> bytes:
        """A text with other white space: cut only where a single space stands between two other characters."""
        out, held, before = [], [parts[0]], ""
        for last, p in zip(parts, parts[1:]):
            if last and not last[-1].isspace() and p and not p[0].isspace():
                out.append(self.whole(before + " ".join(held)))
                held, before = [p], " "
            else:
                held.append(p)
        return b"".join(out) + self.whole(before + " ".join(held))


def encoded_rows(batches, tokenizer: str):
    """What ``encode`` returns of a task's batches (doc_id, text)."""
    import pyarrow as pa

    names_of = ["doc_id", "n_tokens", "ids", "counts"]
    encoder = encoder_of(tokenizer)
    counts = np.zeros(encoder.size, np.int64)

    def out():
        nonlocal counts
        names = pa.concat_arrays([b.column(0) for b in held])
        flat, ends = encoder(pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held]))
        counts += np.bincount(flat, minlength=encoder.size)
        # batches whose ids fit 32-bit offsets
        size, s = encoder.dtype.itemsize, 0
        while s < len(ends):
            base = int(ends[s - 1]) if s else 0
            e = max(s + 1, min(s + C.BATCH_ROWS, int(np.searchsorted(ends, base + C.BATCH_BYTES // size, side="right"))))
            offsets = np.concatenate([[0], ends[s:e] - base]) * size
            ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), e - s, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat[base : int(ends[e - 1])]))])
            yield pa.RecordBatch.from_arrays([names[s:e], pa.array(np.diff(offsets) // size), ids.cast(pa.binary()), pa.nulls(e - s, pa.binary())], names=names_of)
            s = e

    held, n = [], 0
    gc.disable()  # the many short lists of ids hold no cycles
    try:
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.column(1).nbytes
            if n >= AT_ONCE:
                yield from out()
                held, n = [], 0
        if held:
            yield from out()
    finally:
        gc.enable()
    C.release()
    yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([None], pa.binary()), pa.array([zlib.compress(counts.astype("<i8").tobytes(), 1)], pa.binary())], names=names_of)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids, counts): a row a document, and a last row of each task with its id counts (counts not null)."""

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: encoded_rows(batches, tokenizer), "doc_id long, n_tokens long, ids binary, counts binary")


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, n): how often each id stands in all texts."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for blob in batch.column(0).to_pylist():
                counts = np.frombuffer(zlib.decompress(blob), "<i8")
                ids = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(counts[ids])], names=["id", "n"])

    return encoded.filter(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most max_bits, by package-merge; 0 for ids that never occur."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    bits = max(max_bits, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    level, leaf_at = leaves, []
    for _ in range(bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([leaves, pairs])
        by = np.argsort(merged, kind="stable")
        leaf_at.append(by < n)
        level = merged[by]
    take = 2 * n - 2
    for is_leaf in reversed(leaf_at):
        k = int(is_leaf[:take].sum())
        lengths[order[:k]] += 1
        take = 2 * (take - k)
    lengths[order[:take]] += 1
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then id, counting upwards."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    for length in np.unique(size):
        same = order[size == length]
        code <<= int(length) - last
        codes[same] = code + np.arange(len(same), dtype=np.uint64)
        code += len(same)
        last = int(length)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes one after another, highest bit first, and the bit offset of every CHECKPOINT-th id.

    Three codes, of 63 bits at most, are put together first; each such word touches two of the output at most."""
    size = lengths[ids].astype(np.int64)
    marks = np.add.reduceat(size, np.arange(0, len(size), CHECKPOINT))
    value = codes[ids]
    if rest := -len(ids) % 3:
        size, value = np.append(size, [0] * rest), np.append(value, np.zeros(rest, np.uint64))
    s, v = size.reshape(-1, 3), value.reshape(-1, 3)
    last, middle = s[:, 2].astype(np.uint64), s[:, 1].astype(np.uint64)
    value, size = (((v[:, 0] << middle) | v[:, 1]) << last) | v[:, 2], s.sum(1)
    ends = np.cumsum(size)
    starts = ends - size
    word, shift = starts >> 6, 64 - (starts & 63) - size
    over = np.flatnonzero(shift < 0)
    high = value << np.maximum(shift, 0).astype(np.uint64)
    high[over] = value[over] >> (-shift[over]).astype(np.uint64)
    out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
    first = np.flatnonzero(np.diff(word, prepend=-1))
    out[word[first]] = np.bitwise_or.reduceat(high, first)
    out[word[over] + 1] |= value[over] << (64 + shift[over]).astype(np.uint64)
    return out.astype(">u8").tobytes()[: int(ends[-1] + 7) // 8], (np.cumsum(marks) - marks).astype("<u4")


def file_bytes(doc_ids: list, sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """One file: the code lengths, the document table, the places of the blocks, then the blocks."""
    table = zlib.compress(lengths.tobytes(), 6)
    null = np.array([x is None for x in doc_ids], np.uint8)
    names = np.array([x or 0 for x in doc_ids], "<i8")
    about = zlib.compress(null.tobytes() + names.tobytes() + sizes.astype("<i8").tobytes(), 6)
    blocks = []
    for at in range(0, len(ids), BLOCK):
        part = ids[at : at + BLOCK]
        data, marks = pack(part, codes, lengths)
        blocks.append(struct.pack("<III", len(part), len(marks), len(data)) + marks.tobytes() + data)
    first = _HEAD.size + len(table) + len(about) + 8 * (len(blocks) + 1)
    places = np.cumsum([first, *map(len, blocks)]).astype("<i8")
    return b"".join([_HEAD.pack(MAGIC, len(lengths), len(table), len(doc_ids), len(ids), len(about), len(blocks)), table, about, places.tobytes(), *blocks])


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every value of the next bits."""
    bits = int(lengths.max(initial=1))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = (1 << (bits - lengths[order].astype(np.int64)))
    ids, size = np.zeros(1 << bits, np.uint16 if len(lengths) <= 1 << 16 else np.uint32), np.ones(1 << bits, np.uint8)
    ids[: spans.sum()] = np.repeat(order, spans)
    size[: spans.sum()] = np.repeat(lengths[order], spans)
    return ids, size, bits


class Head:
    """What stands before the blocks of a file. read: bytes of the file from an offset."""

    def __init__(self, read):
        magic, vocabulary, n_table, self.n_docs, self.n_ids, n_about, n_blocks = _HEAD.unpack(read(0, _HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        at = _HEAD.size
        self.lengths = np.frombuffer(zlib.decompress(read(at, n_table)), np.uint8)
        self._about = (at + n_table, n_about)
        self.places = np.frombuffer(read(at + n_table + n_about, 8 * (n_blocks + 1)), "<i8")

    def documents(self, read) -> tuple[list, np.ndarray]:
        """Document ids and their numbers of ids."""
        about = zlib.decompress(read(*self._about))
        null, names = np.frombuffer(about, np.uint8, self.n_docs), np.frombuffer(about, "<i8", self.n_docs, self.n_docs)
        return [None if x else int(y) for x, y in zip(null, names, strict=True)], np.frombuffer(about, "<i8", self.n_docs, self.n_docs * 9)


def decoded(data: bytes, places: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of stretches that begin at these bits of the data, so many of each."""
    if not len(places):
        return np.empty(0, np.uint32)
    symbol, size, bits = decode_table(lengths)
    raw = np.frombuffer(data + b"\0" * 8, np.uint8).astype(np.uint32)
    ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    out = np.empty((int(counts.max()), len(places)), symbol.dtype)
    last = len(ahead) - 1
    for k in range(len(out)):
        nxt = (ahead[np.minimum(places >> 3, last)] << (places & 7).astype(np.uint32)) >> np.uint32(32 - bits)
        out[k] = symbol[nxt]
        places = places + size[nxt]
    out = np.ascontiguousarray(out.T)
    pieces, at = [], 0
    for i in np.flatnonzero(counts < out.shape[1]).tolist():  # the last stretch of a block may be short
        pieces += [out[at:i].ravel(), out[i, : counts[i]]]
        at = i + 1
    return np.concatenate([*pieces, out[at:].ravel()])


def _stretches(n: int, marks: np.ndarray) -> np.ndarray:
    """How many ids stand in each stretch of a block of n."""
    counts = np.full(len(marks), CHECKPOINT, np.int64)
    counts[-1] = n - CHECKPOINT * (len(marks) - 1)
    return counts


def parse(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, their numbers of ids, all ids of a file."""
    read = lambda at, n: data[at : at + n]
    head, places, counts = Head(read), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in head.places[:-1].tolist():
        n, n_marks, _ = struct.unpack_from("<III", data, at)
        marks = np.frombuffer(data, "<u4", n_marks, at + 12).astype(np.int64)
        places.append(marks + 8 * (at + 12 + 4 * n_marks))
        counts.append(_stretches(n, marks))
    ids = decoded(data, np.concatenate(places), np.concatenate(counts), head.lengths)
    if len(ids) != head.n_ids:
        raise ValueError(f"{len(ids)} ids where the file's head has {head.n_ids}")
    return *head.documents(read), ids


def read_stretch(uri: str, first: int, n: int) -> np.ndarray:
    """n ids of a file from the first on, by reading its head and the stretches between checkpoints that hold them."""
    fs, path = C.open_fs(uri)
    with fs.open_input_file(path) as f:
        read = lambda at, size: f.read_at(size, at)
        head, out, end = Head(read), [np.empty(0, np.uint32)], first + n
        if not 0 <= first <= end <= head.n_ids:
            raise ValueError(f"ids {first} to {end} of a file of {head.n_ids}")
        for b in range(first // BLOCK, -(-end // BLOCK) if n else 0):
            at = int(head.places[b])
            size, n_marks, n_data = struct.unpack("<III", read(at, 12))
            marks = np.frombuffer(read(at + 12, 4 * n_marks), "<u4").astype(np.int64)
            low, high = max(0, first - b * BLOCK), min(size, end - b * BLOCK)
            s, e = low // CHECKPOINT, -(-high // CHECKPOINT)
            begin, stop = int(marks[s]) >> 3, n_data if e == n_marks else -(-int(marks[e]) >> 3) + 1
            data = read(at + 12 + 4 * n_marks + begin, min(stop, n_data) - begin)
            ids = decoded(data, marks[s:e] - 8 * begin, _stretches(size, marks)[s:e], head.lengths)
            out.append(ids[low - s * CHECKPOINT : high - s * CHECKPOINT])
    return np.concatenate(out)


def write_ids(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the ids of all texts; return the manifest (part, file, path, n_docs, n_tokens, base), base being the ids before the file."""
    spark = docs.sparkSession
    C.prepare(spark)
    folder = folder or C.shared_dir(spark)
    encoded = C.handed(encode(docs, tokenizer), "encoded", codec="snappy")
    rows = C.small(id_counts(encoded), 1 << 20, "ids of the vocabulary")
    counts = np.zeros(max([r.id for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    dtype = "<u2" if _vocabulary(tokenizer) <= 1 << 16 else "<u4"

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, held, ids, n, k = TaskContext.get().partitionId(), [], [], 0, 0

        def flush():
            nonlocal held, ids, n, k
            path = f"{folder}/ids-{part:06d}-{k:05d}-{uuid.uuid4().hex}.bin"
            sizes = np.array([len(x) // np.dtype(dtype).itemsize for x in ids], np.int64)
            C.write_bytes(path, file_bytes(held, sizes, np.frombuffer(b"".join(ids), dtype), lengths, codes))
            row = pa.RecordBatch.from_pylist([{"part": part, "file": k, "path": path, "n_docs": len(held), "n_tokens": int(sizes.sum())}], schema=pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
            held, ids, n, k = [], [], 0, k + 1
            return row

        for batch in batches:
            for name, size, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held.append(name)
                ids.append(blob)
                n += size
                if n >= FILE_IDS:
                    yield flush()
        if held:
            yield flush()

    ordered = encoded.filter(F.col("counts").isNull()).select("doc_id", "n_tokens", "ids").repartitionByRange(C.partitions(spark, int(counts.sum()), TASK_IDS), "doc_id").sortWithinPartitions("doc_id", "n_tokens", "ids")
    manifest = C.handed(ordered.mapInArrow(run, "part int, file int, path string, n_docs long, n_tokens long"), "manifest")
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = parts.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("file")) - F.col("n_tokens")
    return manifest.withColumn("inside", inside).join(before, "part").select("part", "file", "path", "n_docs", "n_tokens", (F.col("before") + F.col("inside")).alias("base"))


def _vocabulary(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size()


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names, sizes, ids = parse(C.read_bytes(path))
                ends = np.cumsum(sizes)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(ends - sizes + base), pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = C.partitions(manifest.sparkSession, manifest.count(), TASK_FILES)
    return manifest.select("path", "base").repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_ids(write_ids(docs, tokenizer))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return write_and_read(C.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
