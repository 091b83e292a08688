"""Similarity join on word shingles: T-occurrence search with DivideSkip, over inverted lists of the shingles.

Texts with the same words are one node. Nodes are told apart by 128 bits of their words' hash: the lower 64 name a node, and
nodes that share those are named by the upper 64. A node's set are the 64-bit hashes of its distinct shingles of SIZE words. Two
nodes of n and m shingles link when they share T = ceil((n + m) * PERCENT / (100 + PERCENT)) of them, which is a Jaccard
similarity of PERCENT per cent; a partner of a node with n shingles shares at least ceil(n * PERCENT / 100).

1. Every node's shingles go, by hash, to buckets; a bucket finds those that two nodes or more have, and returns them with
   their document frequency, by node. A node with too few such shingles for any partner drops out: most do.
2. In the order of frequency, then hash, two partners have a shingle in common among the first n - ceil(n * PERCENT / 100) + 1
   of each. At its place in that order a node has r shingles left to share, so its partners have ``most_size(n, r)`` shingles at
   most: nodes that meet in a prefix list and each of which the other's bound admits are joined to candidate groups (connected
   components). Nodes that share boilerplate, but not enough of it, do not meet.
3. Partners are in one group, and all they share is in what step 1 returned. A group is searched by DivideSkip: for
   each node, the short lists are merged by a heap and the nodes that stand in T - L of them are looked up in the L
   long lists by binary search; those that reach the overlap required link. As only classes are asked for,
   a candidate that is already in the node's class isn't looked up.
4. A group of more than GROUP shingles is dealt into blocks, searched one by one, each with the same HUBS nodes of the
   group, which join what the blocks found; nodes that are then outside the largest class are searched against those
   blocks where they meet, by the rule of step 2, a node of another class. So no task holds more than two blocks, and no link is lost.

Very frequent shingles (a share of HOT of the nodes, so their number is bounded by the mean set size over HOT) are known from
counts of all texts: they go straight to their nodes and come last in the order, and no bucket holds their lists. Where they
stand in prefixes, nodes of like size and bound are counted as one before they are sent.

Null texts and texts without words have no shingles and link with nothing. Fewer than SIZE words make one
shingle. Equal rows are one node each other's copies; a null id is never a class id unless all of its class are null. An empty table
gives no rows. A long text takes some 30 bytes a word in its task. ``join`` ignores other columns, ``distinct_documents`` keeps them,
whatever their names.
"""

from __future__ import annotations

import heapq
import math
import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .components import components

SIZE, PERCENT = 5, 75
#: Shingles a worker gathers before it deals them out; shingles of a bucket; share of nodes and least number of a frequent shingle.
CHUNK, BUCKET, HOT, HOT_LEAST, HOT_LOCAL = 1_500_000, 4_000_000, 0.002, 1000, 8
#: Shingles of a group searched in one go; nodes that all blocks of a larger group hold; bytes of groups in a task; words a worker keeps.
GROUP, HUBS, BIN, MEMO = 250_000, 32, 250_000, 250_000
#: Frequencies are told apart up to here; the order needs no more. The frequent shingles' stands for all above.
HOT_DF = 255
#: Bits of the hash that names a node.
NODE_BITS = 64
#: Bits of a hash that are kept besides its bucket's number.
KEPT = np.uint64((1 << 48) - 1)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(C.LOWER).split()


def identity(words: list[bytes], bits: int = NODE_BITS) -> tuple[int, int]:
    """Lower and upper half of a text's 128 bits, as signed numbers; of the lower half so many bits."""
    import xxhash

    high, low = divmod(xxhash.xxh3_128_intdigest(b" ".join(words), 17), 1 << 64)
    return (low >> (64 - bits)) - (1 << 63), high - (1 << 63)


class Names:
    """Nodes' names: the lower half, where several texts share it the upper half. path: a file of the shared ones."""

    def __init__(self, path: str, bits: int):
        self.shared, self.bits = set(np.frombuffer(C.read_bytes(path), np.int64).tolist()), bits

    def __call__(self, words: list[bytes]) -> int:
        low, high = identity(words, self.bits)
        return high if low in self.shared else low


def shingles(words: list[bytes], size: int = SIZE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    if not words:
        return np.empty(0, np.uint64)
    if len(_HASHES) > MEMO:
        _HASHES.clear()
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    s = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        s = _mixed((s + h[j : len(h) - k + 1 + j]) * _ODD[j % len(_ODD)])
    s.sort()
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def least_overlap(n, percent: int = PERCENT):
    """Of a node with n shingles and any partner."""
    return -(-n * percent // 100)


def most_size(n, r, percent: int = PERCENT):
    """Shingles of the largest partner of a node with n, of which r at most are shared."""
    return np.minimum((100 + percent) * r // percent - n, 100 * n // percent)


def _blob(*arrays: np.ndarray) -> bytes:
    return struct.pack(f"<{len(arrays)}I", *(x.nbytes for x in arrays)) + b"".join(x.tobytes() for x in arrays)


def _parts(blob: bytes, *types: str) -> list[np.ndarray]:
    sizes, at, out = struct.unpack_from(f"<{len(types)}I", blob), 4 * len(types), []
    for n, t in zip(sizes, types, strict=True):
        out.append(np.frombuffer(blob, t, n // np.dtype(t).itemsize, at))
        at += n
    return out


class _Chunk:
    """Distinct nodes and their shingles, up to CHUNK."""

    def __init__(self):
        self.seen, self.nodes, self.sets, self.total = set(), [], [], 0

    def add(self, node, found: np.ndarray) -> None:
        if node not in self.seen and len(found):
            self.seen.add(node)
            self.nodes.append(node)
            self.sets.append(found)
            self.total += len(found)

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in self.sets], np.int64)
        return np.concatenate(self.sets), np.array(self.nodes, np.int64), sizes


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, node, upper, n, hot): a row a document, node and upper its 128 bits; and rows with hot set for the shingles frequent in a chunk: node the hash, n the count."""

    def run(batches):
        import pyarrow as pa

        def heavy():
            if chunk.total:
                hashes = np.sort(np.concatenate(chunk.sets))
                first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
                n = np.diff(first, append=len(hashes))
                much = n >= max(HOT_LOCAL, HOT * len(chunk.nodes))
                k = int(much.sum())
                yield batch_of([None] * k, hashes[first[much]].view(np.int64), [None] * k, n[much], True)

        def batch_of(names, nodes, upper, n, hot):
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(nodes, pa.int64()), pa.array(upper, pa.int64()), pa.array(n, pa.int64()), pa.array([hot] * len(names), pa.bool_())], names=["doc_id", "node", "upper", "n", "hot"])

        chunk, bits = _Chunk(), NODE_BITS
        for batch in batches:
            nodes, upper, sizes = [], [], []
            for text in C.byte_rows(batch.column(1)):
                words = words_of(text)
                found = shingles(words)
                low, high = identity(words, bits)
                nodes.append(low)
                upper.append(high)
                sizes.append(len(found))
                chunk.add((low, high), found)
            yield batch_of(batch.column(0).to_pylist(), nodes, upper, sizes, False)
            if chunk.total >= CHUNK:
                yield from heavy()
                chunk = _Chunk()
        yield from heavy()
        _HASHES.clear()
        C.release()

    return docs.mapInArrow(run, "doc_id long, node long, upper long, n long, hot boolean")


def keys_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket and KEPT bits of the rest: more bits the more buckets there are. Stands for the hash from here on."""
    b = np.uint64(buckets)
    return ((hashes // b) & KEPT) * b + hashes % b


def deal(docs: DataFrame, hot_path: str, names_path: str, buckets: int, parts: int) -> DataFrame:
    """(bucket, data): each chunk's shingles by bucket; frequent ones go to bucket -1 - part of their node."""

    def run(batches):
        import pyarrow as pa

        hot, name = np.frombuffer(C.read_bytes(hot_path), np.uint64), Names(names_path, NODE_BITS)

        def out():
            if not chunk.total:
                return
            hashes, nodes, sizes = chunk.columns()
            owner = np.repeat(np.arange(len(nodes)), sizes)
            at = np.minimum(np.searchsorted(hot, hashes), max(0, len(hot) - 1))
            often = hot[at] == hashes if len(hot) else np.zeros(len(hashes), bool)
            part = _part(nodes, parts)
            bucket = np.where(often, -1 - part[owner], (hashes % np.uint64(buckets)).astype(np.int64))
            order = np.argsort(bucket, kind="stable")
            bucket, hashes, owner = bucket[order], keys_of(hashes[order], buckets), owner[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1)).tolist()
            keys, blobs = [], []
            for s, e in zip(cuts, [*cuts[1:], len(bucket)], strict=False):
                who = owner[s:e]
                run_at = np.flatnonzero(np.diff(who, prepend=-1))
                keys.append(int(bucket[s]))
                rest = (hashes[s:e] // np.uint64(buckets)).view(np.uint8).reshape(-1, 8)[:, :6] if bucket[s] >= 0 else hashes[s:e]
                blobs.append(_blob(rest, nodes[who[run_at]], np.diff(run_at, append=e - s).astype(np.uint32)))
            for i in range(0, len(keys), 64):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 64], pa.int32()), pa.array(blobs[i : i + 64], pa.binary())], names=["bucket", "data"])

        chunk = _Chunk()
        for batch in batches:
            for text in C.byte_rows(batch.column(1)):
                words = words_of(text)
                chunk.add(name(words), shingles(words))
                if chunk.total >= CHUNK:
                    yield from out()
                    chunk = _Chunk()
        yield from out()
        _HASHES.clear()
        C.release()

    return docs.mapInArrow(run, "bucket int, data binary")


def _part(nodes: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(nodes.view(np.uint64) * _ODD[3]) % np.uint64(parts)).astype(np.int64)


def _gather(column, bucket: int, buckets: int) -> list[np.ndarray]:
    """key, node of each entry of the blobs."""
    got = [_parts(x, "u1", "<i8", "<u4") for x in column.to_pylist()]
    raw, nodes, runs = (np.concatenate([g[i] for g in got]) for i in range(3))
    if bucket < 0:
        keys = raw.view(np.uint64)
    else:
        wide = np.zeros((len(raw) // 6, 8), np.uint8)
        wide[:, :6] = raw.reshape(-1, 6)
        keys = wide.view(np.uint64).ravel() * np.uint64(buckets) + np.uint64(bucket)
    return [keys, np.repeat(nodes, runs)]


def share(dealt: DataFrame, buckets: int, parts: int) -> DataFrame:
    """(part, data): of each bucket, the shingles that two nodes or more have, with their frequency, by part of the node."""

    def run(table):
        import pyarrow as pa

        bucket = table.column("bucket")[0].as_py()
        hashes, nodes = _gather(table.column("data"), bucket, buckets)
        order = np.lexsort((nodes, hashes))
        hashes, nodes = hashes[order], nodes[order]
        # copies of a node in several chunks count once
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (nodes[1:] != nodes[:-1])])
        hashes, nodes = hashes[new], nodes[new]
        if bucket < 0:
            df = np.full(len(hashes), HOT_DF, np.int64)
        else:
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            count = np.diff(first, append=len(hashes))
            df = np.minimum(np.repeat(count, count), HOT_DF - 1)
            more = df > 1
            hashes, nodes, df = hashes[more], nodes[more], df[more]
        part = _part(nodes, parts)
        order = np.lexsort((nodes, part))
        hashes, nodes, df, part = hashes[order], nodes[order], df[order], part[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        keys, blobs = [], []
        for s, e in zip(cuts, [*cuts[1:], len(part)], strict=False):
            at = np.flatnonzero(np.concatenate([[True], nodes[s + 1 : e] != nodes[s : e - 1]]))
            keys.append(int(part[s]))
            blobs.append(_blob(hashes[s:e], nodes[s:e][at], np.diff(at, append=e - s).astype(np.uint32), df[s:e].astype(np.uint8)))
        return pa.table({"part": pa.array(keys, pa.int32()), "data": pa.array(blobs, pa.binary())})

    return dealt.groupBy("bucket").applyInArrow(run, "part int, data binary")


def active(shared: DataFrame, about: DataFrame, parts: int, percent: int = PERCENT) -> DataFrame:
    """(node, n, k, hashes, hot): nodes that can have partners; hashes by frequency, the first k of them in the prefix; hot: of these, the last so many are frequent."""

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_part(batch.column(0).to_numpy(), parts), pa.int32()), batch.column(0), batch.column(1)], names=["part", "node", "n"])

    def run(left, right):
        import pyarrow as pa

        if not left.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "k": pa.array([], pa.int64()), "hashes": pa.array([], pa.binary()), "hot": pa.array([], pa.int64())})
        got = [_parts(x, "<u8", "<i8", "<u4", "u1") for x in left.column("data").to_pylist()]
        hashes, nodes, runs, df = (np.concatenate([g[i] for g in got]) for i in range(4))
        nodes = np.repeat(nodes, runs)
        order = np.lexsort((hashes, df, nodes))
        hashes, nodes, df = hashes[order], nodes[order], df[order]
        names = right.column("node").to_numpy()
        by = np.argsort(names)
        sizes = right.column("n").to_numpy()[by][np.searchsorted(names[by], nodes)]
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.empty(0, np.int64)
        count = np.diff(first, append=len(nodes))
        n = sizes[first]
        need = least_overlap(n, percent)
        good = np.flatnonzero(count >= need)
        # a prefix has n - need + 1 shingles; those that no other node has, n - count of them, come first
        k = (count - need + 1)[good]
        at, ends = first[good], (first + count)[good]
        blobs = [hashes[s:e].tobytes() for s, e in zip(at.tolist(), ends.tolist(), strict=True)]
        hot = [int((df[s : s + x] == HOT_DF).sum()) for s, x in zip(at.tolist(), k.tolist(), strict=True)]
        return pa.table({"node": nodes[at], "n": n[good], "k": k, "hashes": pa.array(blobs, pa.binary()), "hot": pa.array(hot, pa.int64())})

    sized = about.select("node", "n").mapInArrow(place, "part int, node long, n long")
    return shared.groupBy("part").cogroup(sized.groupBy("part")).applyInArrow(run, "node long, n long, k long, hashes binary, hot long")


def _linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of links and the smallest node each is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def like(x: np.ndarray) -> np.ndarray:
    """Numbers of sizes that are counted as one: each by itself below 64, then steps of two per cent."""
    x = np.maximum(x, 0)
    return np.where(x < 64, x, 64 + (np.log(np.maximum(x, 64) / 64) / math.log(1.02)).astype(np.int64)).astype(np.int32)


def near(hashes: np.ndarray, n: np.ndarray, u: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds that may hold partners, and pairs of kinds that may. A kind is m nodes of a list, n the smallest size, u the largest bound."""
    order = np.lexsort((n, hashes))
    h, size, most = hashes[order], n[order], u[order]
    some = (m[order] > 1) & (size <= most)
    pairs, left, step = [], np.arange(len(h) - 1), 1
    while len(left):
        # in the order of size: once one is too large for a kind, so are all that follow
        left = left[left + step < len(h)]
        left = left[(h[left] == h[left + step]) & (size[left + step] <= most[left])]
        good = left[size[left] <= most[left + step]]
        some[good], some[good + step] = True, True
        pairs.append(np.stack([good, good + step]))
        step += 1
    a, b = np.concatenate([np.empty((2, 0), np.int64), *pairs], 1)
    return np.sort(order[some]), order[a], order[b]


def kinds_of(hashes: np.ndarray, n: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of entries by list and kind, and where in it each kind begins."""
    x, y = like(n), like(u)
    order = np.lexsort((y, x, hashes))
    h, x, y = hashes[order], x[order], y[order]
    return order, np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))


def prefixes(n: np.ndarray, k: np.ndarray, blobs: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the node, place and largest partner of each entry of the nodes' prefixes."""
    sets = [np.frombuffer(x, np.uint64) for x in blobs]
    who = np.repeat(np.arange(len(k)), k)
    place = np.arange(len(who)) - np.repeat(np.cumsum(k) - k, k)
    shared = np.array([len(x) for x in sets], np.int64)
    hashes = np.concatenate([np.empty(0, np.uint64), *(x[:m] for x, m in zip(sets, k.tolist(), strict=True))])
    return hashes, who, place, most_size(n[who], shared[who] - place, percent)


def meetings(nodes: DataFrame, buckets: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that join all nodes which meet in a prefix list and admit each other."""

    def send(batches):
        import pyarrow as pa

        names_of = ["bucket", "data", "hash", "node", "n", "u", "like_n", "like_u"]
        for batch in batches:
            names, n, k, hot = (batch.column(i).to_numpy() for i in (0, 1, 2, 4))
            if not len(n):
                continue
            hashes, who, place, u = prefixes(n, k, batch.column(3).to_pylist(), percent)
            often = place >= np.repeat(k - hot, k)
            w = who[often]
            columns = [hashes[often].view(np.int64), names[w], n[w], u[often], like(n[w]), like(u[often])]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(w), pa.int32()), pa.nulls(len(w), pa.binary()), *map(pa.array, columns)], names=names_of)
            hashes, who, u = hashes[~often], who[~often], u[~often]
            bucket = (hashes % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
            keys, blobs = [], []
            for s, e in zip(cuts, [*cuts[1:], len(order)], strict=False):
                at = order[s:e]
                keys.append(int(bucket[at[0]]))
                blobs.append(_blob(hashes[at], names[who[at]], n[who[at]].astype(np.uint32), u[at].astype(np.uint32)))
            none = [pa.nulls(len(keys), t) for t in (*[pa.int64()] * 4, *[pa.int32()] * 2)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary()), *none], names=names_of)

    def meet(table):
        import pyarrow as pa

        got = [_parts(x, "<u8", "<i8", "<u4", "<u4") for x in table.column("data").to_pylist()]
        hashes, names, n, u = (np.concatenate([g[i] for g in got]) for i in range(4))
        n, u = n.astype(np.int64), u.astype(np.int64)
        order, first = kinds_of(hashes, n, u)
        m = np.diff(first, append=len(order))
        names = names[order]
        some, a, b = near(hashes[order][first], np.minimum.reduceat(n[order], first), np.maximum.reduceat(u[order], first), m)
        kind = np.repeat(np.arange(len(first)), m)
        good = np.zeros(len(first), bool)
        good[some] = True
        inside = good[kind]
        nodes, roots = _linked(np.concatenate([names[inside], names[first[a]]]), np.concatenate([names[first[kind[inside]]], names[first[b]]]))
        other = nodes != roots
        return pa.table({"a": nodes[other], "b": roots[other]})

    def meet_often(table):
        import pyarrow as pa

        hashes, n, u, m, lead = (table.column(c).to_numpy() for c in ("hash", "n", "u", "m", "lead"))
        some, a, b = near(hashes, n, u, m)
        kinds = pa.table({c: table.column(c).take(some) for c in ("hash", "like_n", "like_u", "lead")}).append_column("to", pa.nulls(len(some), pa.int64()))
        none = [pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.int32())]
        return pa.concat_tables([kinds, pa.table([*none, pa.array(lead[a]), pa.array(lead[b])], names=kinds.schema.names).cast(kinds.schema)])

    sent = C.handed(nodes.mapInArrow(send, "bucket int, data binary, hash long, node long, n long, u long, like_n int, like_u int"), "prefixes")
    seldom = sent.filter("bucket IS NOT NULL").select("bucket", "data").groupBy("bucket").applyInArrow(meet, "a long, b long")
    # lists of frequent shingles: their kinds are few, whatever the number of nodes
    often = sent.filter("bucket IS NULL").select("hash", "node", "n", "u", "like_n", "like_u")
    if often.limit(1).count() == 0:
        return seldom
    kinds = often.groupBy("hash", "like_n", "like_u").agg(F.min("n").alias("n"), F.max("u").alias("u"), F.count(F.lit(1)).alias("m"), F.min("node").alias("lead"))
    met = C.handed(kinds.groupBy("hash").applyInArrow(meet_often, "hash long, like_n int, like_u int, lead long, to long"), "kinds")
    members = often.join(met.filter("hash IS NOT NULL").drop("to"), ["hash", "like_n", "like_u"]).filter("node <> lead")
    return seldom.union(members.select("node", "lead")).union(met.filter("hash IS NULL").select("lead", "to"))


class Lists:
    """Inverted lists over nodes 0, 1, ... given their sets: lists in one array, nodes of a list ascending."""

    def __init__(self, sets: list[np.ndarray], smallest: int = 0):
        self.n, self.smallest = len(sets), smallest
        sizes = np.array([len(x) for x in sets], np.int64)
        owner = np.repeat(np.arange(self.n), sizes)
        hashes = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        new = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]) if len(hashes) else np.empty(0, bool)
        self.keys = hashes[order][new]
        self.starts = np.append(np.flatnonzero(new), len(hashes))
        self.lengths = np.diff(self.starts)
        self.nodes = owner[order]
        number = np.cumsum(new) - 1
        self.places = number * self.n + self.nodes  # ascending: a list's nodes by binary search
        of = np.empty(len(hashes), np.int64)
        of[order] = number
        ends = np.cumsum(sizes)
        self.of = [of[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        return at[self.keys[at] == hashes] if len(self.keys) else at[:0]


def merge(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of ascending lists and in how many each stands: by a heap; long ones by merging runs in place of it."""
    if sum(map(len, lists)) <= 256:
        merged = np.fromiter(heapq.merge(*(x.tolist() for x in lists)), np.int64)
    else:
        merged = np.sort(np.concatenate(lists), kind="stable")
    first = np.flatnonzero(np.diff(merged, prepend=-1))
    return merged[first], np.diff(first, append=len(merged))


def divide_skip(index: Lists, lists: np.ndarray, sizes: np.ndarray, most: np.ndarray, n: int, percent: int, after: int = -1, skip=None) -> np.ndarray:
    """Nodes of the index, of these sizes and largest partners, that link with a node of n shingles which stands in these lists; only
    nodes above after, and not those skipped."""
    need = least_overlap(n, percent)
    largest = int(most_size(n, len(lists), percent))
    lists = lists[index.lengths[lists] > (after >= 0)]
    if len(lists) < need or largest < index.smallest:
        return np.empty(0, np.int64)
    lengths = index.lengths[lists]
    long = min(need - 1, int(need / (0.01 * math.log2(max(2, int(lengths.max()))) + 1)))
    order = np.argsort(lengths, kind="stable")
    short, long_lists = lists[order[: len(lists) - long]], lists[order[len(lists) - long :]]
    runs = [index.nodes[s:e] for s, e in zip(index.starts[short].tolist(), index.starts[short + 1].tolist(), strict=True)]
    if after >= 0:
        runs = [x[np.searchsorted(x, after, side="right") :] for x in runs]
    nodes, count = merge(runs)
    good = (count >= need - long) & (sizes[nodes] <= largest) & (n <= most[nodes])
    if skip is not None:
        good &= ~skip(nodes)
    nodes, count = nodes[good], count[good]
    if len(nodes) and len(long_lists):
        step = max(1, 1_000_000 // len(long_lists))
        for i in range(0, len(nodes), step):
            goal = (long_lists[None, :] * index.n + nodes[i : i + step, None]).ravel()
            at = np.minimum(np.searchsorted(index.places, goal), len(index.places) - 1)
            count[i : i + step] += (index.places[at] == goal).reshape(-1, len(long_lists)).sum(1)
    return nodes[100 * count >= percent * (n + sizes[nodes] - count)]


class Classes:
    """Union-find with vectorised look-ups."""

    def __init__(self, n: int):
        self.root, self.n = np.arange(n), n

    def join(self, a: int, others: np.ndarray) -> None:
        """One class of a and the others: every member is relabelled, so a look-up is one step."""
        roots = np.unique(self.root[np.append(others, a)])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]
            self.n -= len(roots) - 1


def bounds(sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The largest partner of each node, by what it shares at all."""
    return most_size(sizes, np.array([len(x) for x in sets], np.int64), percent)


def search_group(sizes: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """The class of each node of a group, as the number of its first node."""
    index, classes, most = Lists(sets, int(sizes.min(initial=1 << 62))), Classes(len(sets)), bounds(sizes, sets, percent)
    for a in range(len(sets)):
        if classes.n == 1:
            break
        found = divide_skip(index, index.of[a], sizes, most, int(sizes[a]), percent, a, lambda x, a=a: classes.root[x] == classes.root[a])
        if len(found):
            classes.join(a, found)
    return classes.root


def search_groups(nodes: DataFrame, key: list[str], percent: int) -> DataFrame:
    """(a, b): each node and the first of its class, searching by (bin) the nodes of equal group."""

    def run(table):
        import pyarrow as pa

        group, name, n = (table.column(c).to_numpy() for c in ("cc", "node", "n"))
        blobs = table.column("hashes").to_pylist()
        order = np.lexsort((name, group))
        cuts = np.flatnonzero(np.diff(group[order], prepend=group[order[0]] - 1)).tolist()
        a, b = [], []
        for s, e in zip(cuts, [*cuts[1:], len(order)], strict=False):
            at = order[s:e]
            root = search_group(n[at], [np.frombuffer(blobs[i], np.uint64) for i in at.tolist()], percent)
            a.append(name[at])
            b.append(name[at][root])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return nodes.groupBy(*key).applyInArrow(run, "a long, b long")


def search_rest(rest: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of the nodes of rest with nodes of the blocks that are in another class."""

    def run(left, right):
        import pyarrow as pa

        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        name, n, label = (right.column(c).to_numpy() for c in ("node", "n", "label"))
        sets = [np.frombuffer(x, np.uint64) for x in right.column("hashes").to_pylist()]
        index, most, a, b = Lists(sets, int(n.min())), bounds(n, sets, percent), [], []
        for node, size, own, blob in zip(*(left.column(c).to_pylist() for c in ("node", "n", "label", "hashes")), strict=True):
            found = divide_skip(index, index.find(np.frombuffer(blob, np.uint64)), n, most, size, percent, -1, lambda x, own=own: label[x] == own)
            a += [node] * len(found)
            b += name[found].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}, schema=schema)

    return rest.groupBy("cc", "row", "block").cogroup(blocks.groupBy("cc", "row", "block")).applyInArrow(run, "a long, b long")


def asked(rest: DataFrame, marked: DataFrame, percent: int) -> DataFrame:
    """(cc, node, block): the blocks where a node of rest meets, in a prefix list, a node of another class that admits it."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            cc, node, n, k, block, label = (batch.column(i).to_numpy() for i in range(6))
            if not len(n):
                continue
            hashes, who, _, u = prefixes(n, k, batch.column(6).to_pylist(), percent)
            for s in range(0, len(who), 1 << 16):
                w = who[s : s + (1 << 16)]
                columns = [cc[w], node[w], n[w], block[w], label[w], u[s : s + (1 << 16)], hashes[s : s + (1 << 16)].view(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["cc", "node", "n", "block", "label", "u", "hash"])

    def entries(df: DataFrame) -> DataFrame:
        return df.select("cc", "node", "n", "k", F.col("block").cast("long"), "label", "hashes").mapInArrow(run, "cc long, node long, n long, block long, label long, u long, hash long")

    there = entries(marked).groupBy(F.col("cc").alias("c"), F.col("hash").alias("h"), F.col("block").alias("at"))
    there = there.agg(F.min("n").alias("least"), F.max("u").alias("most"), F.min("label").alias("low"), F.max("label").alias("high"))
    meet = (F.col("cc") == F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("least") <= F.col("u")) & (F.col("n") <= F.col("most"))
    other = (F.col("low") != F.col("label")) | (F.col("high") != F.col("label"))
    return entries(rest).join(there, meet & other).select("cc", "node", F.col("at").cast("int").alias("block")).distinct()


def classes(nodes: DataFrame, groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(v, root): classes of the nodes (node, n, k, hashes) in groups (v, root)."""
    spark = nodes.sparkSession
    member = nodes.join(groups, F.col("node") == F.col("v")).select("node", "n", "k", "hashes", F.col("root").alias("cc"))
    member = C.handed(member, "members")
    size = F.octet_length("hashes") / 8
    weight = member.groupBy("cc").agg(F.sum(size).alias("weight"))
    weight = C.handed(weight.withColumn("blocks", F.ceil(F.col("weight") / GROUP).cast("int")), "weights")
    total = weight.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    bins = C.partitions(spark, total, BIN)
    sized = member.join(weight.select("cc", "blocks"), "cc")
    small = sized.filter("blocks = 1").withColumn("bin", F.pmod(F.xxhash64("cc"), F.lit(bins)).cast("int"))
    links = search_groups(small.drop("blocks", "k"), ["bin"], percent)
    if weight.filter("blocks > 1").limit(1).count() == 0:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
    large = C.handed(sized.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "large")
    # the same few nodes of a group in all its blocks
    hub = _hubs(large)
    hubs = hub.select("cc", F.explode("x").alias("node")).join(large, ["cc", "node"]).select("cc", "node", "n", "hashes", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = large.select("cc", "node", "n", "hashes", "block").unionByName(hubs).dropDuplicates(["cc", "block", "node"])
    first = C.handed(search_groups(dealt, ["cc", "block"], percent), "blocks")
    # all nodes have a label: each stands in the links, those alone with themselves
    alone = large.select(F.col("node").alias("v"))
    label = alone.join(components(first), "v", "left").select("v", F.coalesce("root", "v").alias("label"))
    marked = C.handed(large.join(label, F.col("node") == F.col("v")).drop("v"), "marked")
    count = marked.groupBy("cc", "label").agg(F.count(F.lit(1)).alias("c"))
    top = count.groupBy("cc").agg(F.max(F.struct("c", "label")).alias("t")).select("cc", F.col("t.label").alias("label"))
    rest = C.handed(marked.join(top, ["cc", "label"], "left_anti"), "rest")
    goes = asked(rest, marked, percent).join(rest.drop("block", "blocks", "k"), ["cc", "node"])
    goes = C.handed(goes, "asked")
    rows = goes.groupBy("cc", "block").agg(F.ceil(F.sum(size) / GROUP).cast("int").alias("rows"))
    rows = C.handed(rows, "rows")
    goes = goes.join(rows, ["cc", "block"]).withColumn("row", F.pmod(F.xxhash64("node", F.lit(3)), F.col("rows")).cast("int"))
    there = marked.join(rows, ["cc", "block"]).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    columns = ["cc", "row", "block", "node", "n", "label", "hashes"]
    more = search_rest(goes.select(*columns), there.select(*columns), percent)
    final = components(first.union(more))
    return links.select(F.col("a").alias("v"), F.col("b").alias("root")).union(alone.join(final, "v", "left").select("v", F.coalesce("root", "v").alias("root")))


def _hubs(large: DataFrame) -> DataFrame:
    """(cc, x): HUBS nodes of each group, the first by hash; cut within each block first."""
    from pyspark.sql import Window

    order = [F.xxhash64("node", F.lit(7)), F.col("node")]
    near = large.select("cc", "block", "node").withColumn("r", F.row_number().over(Window.partitionBy("cc", "block").orderBy(*order))).filter(F.col("r") <= HUBS)
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("cc").orderBy(*order))).filter(F.col("r") <= HUBS)
    return near.groupBy("cc").agg(F.collect_list("node").alias("x"))


def named(about: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """Rows (doc_id, node, n), nodes (node, first, n), and the file of the halves of hashes that several texts share."""
    spark = about.sparkSession
    rows = about.filter("NOT hot")
    best = [F.min("doc_id").alias("first"), F.max("n").alias("n"), F.min("upper").alias("low"), F.max("upper").alias("high")]
    nodes = C.handed(rows.filter("n > 0").groupBy("node").agg(*best), "nodes")
    # two of N texts share 64 bits with a chance of N^2 / 2^65: some hundred among 10^11
    shared = [r["node"] for r in C.small(nodes.filter("low <> high").select("node"), 1 << 20, "texts that share half their hash")]
    path = C.shared_dir(spark) + "/shared"
    C.write_bytes(path, np.array(shared, np.int64).tobytes())
    if shared:
        known = F.broadcast(spark.createDataFrame([(x,) for x in shared], "twin long"))
        rows = rows.join(known, F.col("node") == F.col("twin"), "left").withColumn("node", F.when(F.col("twin").isNotNull(), F.col("upper")).otherwise(F.col("node"))).drop("twin")
        nodes = C.handed(rows.filter("n > 0").groupBy("node").agg(*best), "nodes")
        if nodes.filter("low <> high").limit(1).count():
            raise ValueError("two texts share 128 bits of their hash in turn")
    return rows.select("doc_id", "node", "n"), nodes.select("node", "first", "n"), path


def resolved(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, str]:
    """(doc_id, node, n, component_id, lead) of every row, lead being the node of its class's row with the smallest id (of several,
    the smallest; null without words); and the file that names nodes."""
    spark = docs.sparkSession
    C.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    about = C.handed(describe(docs), "about")
    rows, nodes, names_path = named(about)
    n_nodes, total = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = about.filter("hot").groupBy("node").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(HOT_LEAST, HOT * n_nodes))
    bound = int(total / max(HOT_LEAST, HOT * n_nodes)) + 1  # of copies in several chunks, each counts
    frequent = np.sort(np.array([r["node"] for r in C.small(hot.select("node"), max(bound * 8, 100_000), "frequent shingles")], np.int64).view(np.uint64))
    hot_path = C.shared_dir(spark) + "/hot"
    C.write_bytes(hot_path, frequent.tobytes())
    buckets = C.partitions(spark, total, BUCKET)
    parts = C.partitions(spark, buckets, 4)
    kept = C.handed(active(share(deal(docs, hot_path, names_path, buckets, parts), buckets, parts), nodes.select("node", "n"), parts, percent), "active")
    groups = components(meetings(kept, parts, percent))
    found = classes(kept, groups, percent)
    root = nodes.join(found, F.col("node") == F.col("v"), "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    root = C.handed(root, "roots")
    least = root.groupBy("root").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("x"))
    least = C.handed(least.select("root", F.col("x.first").alias("component_id"), F.col("x.node").alias("lead")), "least")
    by_node = root.join(least, "root").select(F.col("node").alias("of"), "component_id", "lead")
    both = rows.join(by_node, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    return both.select("doc_id", "node", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "lead"), names_path


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return resolved(docs, percent)[0].select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def distinct_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each class, with all its columns: that with the smallest id (of several texts under it, that with the smallest
    node; of equal ones, that with the smallest text, or any). Rows without words link with nothing, so all stay."""
    found, names_path = resolved(docs, percent)
    leads = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("node") == F.col("lead"))
    found = C.handed(found.select("doc_id", "node", "n", leads.alias("leads")), "judged")
    by_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("n") == 0).alias("empty"), F.count_if("leads").alias("lead"))
    # ids whose rows differ, in texts or in what becomes of them, are decided by row
    mixed = (F.col("all") > 1) & (F.col("empty") < F.col("all")) & ((F.col("empty") > 0) | (F.col("lead") > 0))
    by_id = C.handed(by_id.withColumn("mixed", mixed), "ids")
    # most documents stay, so those that go are the smaller side
    gone = C.handed(by_id.filter("mixed OR (empty = 0 AND lead = 0)").select("doc_id"), "gone")  # its size decides whether texts are shuffled
    stay = docs.alias("d").join(gone.alias("g"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.doc_id")), "left_anti")
    if by_id.filter("mixed").limit(1).count() == 0:
        return stay

    def name(batches):
        import pyarrow as pa

        names = Names(names_path, NODE_BITS)
        for batch in batches:
            words = [words_of(x) for x in C.byte_rows(batch.column(2))]
            more = [pa.array([names(w) for w in words], pa.int64()), pa.array([not w for w in words], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=["row", "id", "text", "node", "empty"])

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    unsure = docs.select(row, F.col("doc_id").cast("long").alias("id"), "text")
    ids = by_id.filter("mixed").select(F.col("doc_id").alias("mixed_id"))
    unsure = unsure.join(ids, F.col("id").eqNullSafe(F.col("mixed_id")), "left_semi")
    schema = T.StructType([*unsure.schema.fields, T.StructField("node", T.LongType()), T.StructField("empty", T.BooleanType())])
    unsure = C.handed(unsure.mapInArrow(name, schema), "mixed")
    lead = found.filter("leads").select(F.col("doc_id").alias("lead_id"), F.col("node").alias("lead_node")).distinct()
    best = unsure.filter("NOT empty").join(lead, F.col("id").eqNullSafe(F.col("lead_id")) & (F.col("node") == F.col("lead_node")), "left_semi")
    best = best.groupBy("id", "node").agg(F.min_by("row", "text").alias("row"))
    return stay.unionAll(unsure.filter("empty").select("row.*")).unionAll(best.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(C.documents(spark, sf_dir, "doc_id", "text"))
