"""Exact nearest neighbours of sparse vectors: lists of the rows of rare grams, and a matrix product that bounds what the frequent ones add.

Vectors have no negative weight. A task takes a chunk of queries and reads the pool's parts one after another from the shared folder;
nothing is copied to tasks by a shuffle. Of each part it keeps the rows by rare gram, and of the frequent grams each row's coordinates
along the part's main directions and the length of what they leave out. A query's product with these, by blocks, and by Cauchy-Schwarz the
product of the lengths left out, is at least what the frequent grams add; the lists of its rare grams are added as they are. Rows whose
sum stays below the query's k-th similarity so far are passed over; of the others the sum is made narrower along further directions, and
what is left is compared in full."""

from __future__ import annotations

import numpy as np

#: Grams that more than this share of a part's rows have are frequent; directions at most, and rows that they are found by.
FREQUENT, DIRECTIONS, SAMPLE = 0.02, 128, 4096
#: Further directions, along which only the rows are compared that the first ones leave.
FINER = 128
#: Queries and rows whose products are made at once; rows that are brought to their coordinates at once.
QUERIES, BLOCK, ROWS = 128, 4096, 2048
#: Similarities are rounded to six places; a bound is passed over when it is lower by more than what rounding and single precision give.
EPS = 3e-5


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, count) of the character trigrams of texts, by row and gram; a gram is its three code points as one number."""
    row, number, count, grams = _counted(texts)
    return row, grams[number], count


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``trigrams`` with the grams as places among the distinct ones, and these in order."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.maximum(sizes - 2, 0)
    row = np.repeat(np.arange(len(texts)), n)
    if not len(row):
        return row, row, row, np.zeros(0, np.int64)
    at = np.arange(len(row)) + (np.cumsum(sizes) - sizes - np.cumsum(n) + n)[row]
    # characters by their place in the alphabet, so that a row and a gram are one small number, and order stays
    alphabet = np.flatnonzero(np.bincount(c)) if len(c) > 1 << 16 else np.unique(c).astype(np.int64)
    place = np.zeros(int(alphabet[-1]) + 1, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    c, z = place[c], len(alphabet)
    code = (c[at] * z + c[at + 1]) * z + c[at + 2]
    if z**3 > max(1 << 22, len(code)) or z**3 * len(texts) >= 1 << 62:
        known, number = np.unique(code, return_inverse=True)
    else:
        known = np.flatnonzero(np.bincount(code, minlength=z**3))
        place = np.zeros(z**3, np.int64)
        place[known] = np.arange(len(known))
        number = place[code]
    key, count = np.unique(row * len(known) + number, return_counts=True)
    grams = alphabet[known // (z * z)] << 42 | alphabet[known // z % z] << 21 | alphabet[known % z]
    return key // len(known), key % len(known), count, grams


def weighted(texts: list[str], grams: np.ndarray, df: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, gram, weight) of texts: count times ln((1 + n) / (1 + df)) + 1, unit length. grams are sorted; one not among them has df 0."""
    starts, number, w, own, _ = _weighed(texts, grams, df, n)
    return starts, own[number], w


def placed(texts: list[str], grams: np.ndarray, df: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``weighted`` with each gram given by its place among grams, -1 if it isn't there."""
    starts, number, w, _, at = _weighed(texts, grams, df, n)
    return starts, at[number], w


def _weighed(texts: list[str], grams: np.ndarray, df: np.ndarray, n: int) -> tuple:
    row, number, tf, own = _counted(texts)
    at = np.full(len(own), -1)
    if len(grams):
        found = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        at = np.where(grams[found] == own, found, -1)
    idf = np.log((1 + n) / (1 + (np.where(at >= 0, df[at], 0) if len(grams) else np.zeros(len(own))))) + 1
    x = tf * idf[number]
    length = np.sqrt(np.bincount(row, x * x, len(texts)))
    return np.searchsorted(row, np.arange(len(texts) + 1)), number, x / length[row], own, at


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs, one run after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Part:
    """Rows of the pool with their lists by rare gram and their coordinates."""

    def __init__(self, starts: np.ndarray, gram: np.ndarray, w: np.ndarray):
        self.n, self.starts, self.w = len(starts) - 1, starts, w
        self.sizes = np.diff(starts)
        if len(gram) and 0 <= gram.min() and gram.max() < 1 << 22:  # places
            self.grams = np.flatnonzero(np.bincount(gram))
            place = np.zeros(int(self.grams[-1]) + 1, np.int32)
            place[self.grams] = np.arange(len(self.grams), dtype=np.int32)
            self.at = place[gram]
        else:
            self.grams, at = np.unique(gram, return_inverse=True)
            self.at = at.astype(np.int32)
        df = np.bincount(self.at, minlength=len(self.grams))
        frequent = df > FREQUENT * self.n
        #: Of each gram its place among the frequent ones, -1 for a rare one.
        self.place = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        self.frequent = int(frequent.sum())
        rare = np.flatnonzero(~frequent[self.at])
        order = rare[np.argsort(self.at[rare], kind="stable")]
        self.rows, self.row_w = np.repeat(np.arange(self.n), self.sizes)[order], w[order].astype(np.float32)
        some = np.unique(np.linspace(0, self.n - 1, min(self.n, SAMPLE)).astype(np.int64)) if self.n else np.zeros(0, np.int64)
        self.directions = None  # all frequent grams as they are
        if self.frequent > DIRECTIONS:
            x = self._dense(starts[some], self.sizes[some], self.at, w)
            self.directions = np.linalg.eigh((x.T @ x).astype(np.float64))[1][:, ::-1][:, : DIRECTIONS + FINER].astype(np.float32)
        reduced = [self._reduced(starts[i : i + ROWS], self.sizes[i : i + ROWS], self.at, w) for i in range(0, max(1, self.n), ROWS)]
        self.coordinates, self.finer = (None if x[0] is None else np.concatenate(x) for x in zip(*reduced, strict=True))
        #: By gram, where each block's rows begin in its list; a block's rows stand together.
        blocks = -(-max(1, self.n) // BLOCK)
        key = self.at[order].astype(np.int64) * blocks + self.rows // BLOCK
        self.cuts = np.searchsorted(key, np.arange(len(self.grams) * blocks + 1)).astype(np.int64) if len(self.grams) * blocks < 1 << 24 else None
        self.blocks, self.key = blocks, key

    def lists(self, grams: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the rows of a block begin and end in the lists of grams."""
        at = grams.astype(np.int64) * self.blocks + block
        return (self.cuts[at], self.cuts[at + 1]) if self.cuts is not None else (np.searchsorted(self.key, at), np.searchsorted(self.key, at + 1))

    def _dense(self, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Rows' weights of the frequent grams."""
        out, entry = np.zeros((len(sizes), self.frequent), np.float32), _ragged(starts[: len(sizes)], sizes)
        place = self.place[at[entry]]
        has = place >= 0
        out[np.repeat(np.arange(len(sizes)), sizes)[has], place[has]] = w[entry[has]]
        return out

    def _reduced(self, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Rows' coordinates along the first directions, and the length of the rest; those along the further ones, what these leave out too."""
        x = self._dense(starts, sizes, at, w)
        if self.directions is None:
            return x, None
        c = x @ self.directions
        square, own = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", c[:, :DIRECTIONS], c[:, :DIRECTIONS])
        all_ = own + np.einsum("ij,ij->i", c[:, DIRECTIONS:], c[:, DIRECTIONS:])
        # what single precision may hide is added, unless there is nothing to hide
        rests = [np.where(square > 0, np.sqrt(np.maximum(square - y, 0) + np.float32(1e-6)), 0)[:, None] for y in (own, all_)]
        return tuple(np.concatenate(y, 1, dtype=np.float32) for y in ((c[:, :DIRECTIONS], rests[0]), (c[:, DIRECTIONS:], rests[1])))

    def narrower(self, sums: np.ndarray, first: np.ndarray, finer: np.ndarray, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The sums of rows with the queries beside them, what the first directions leave out put along the further ones."""
        out, step = sums - first[of, -1] * self.coordinates[rows, -1], 1 << 14
        for s in range(0, len(rows), step):
            out[s : s + step] += np.einsum("ij,ij->i", finer[of[s : s + step]], self.finer[rows[s : s + step]])
        return out

    def similar(self, rows: np.ndarray, queries: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The products of rows with the queries beside them, given by their weights for each of the part's grams."""
        out, step = np.zeros(len(rows)), 1 << 15
        for s in range(0, len(rows), step):
            some, q = rows[s : s + step], of[s : s + step]
            sizes = self.sizes[some]
            at = _ragged(self.starts[some], sizes)
            products = self.w[at] * queries.ravel()[np.repeat(q * queries.shape[1], sizes) + self.at[at]]
            has = sizes > 0
            if len(at):
                out[s : s + step][has] = np.round(np.add.reduceat(products, (np.cumsum(sizes) - sizes)[has]), 6)
        return out


def _set(mask: np.ndarray) -> np.ndarray:
    """The places that are true, few as a rule, by eight at a time."""
    mask = mask.ravel()
    whole = len(mask) // 8 * 8
    eight = np.flatnonzero(mask[:whole].view(np.uint64) != 0)
    at = np.flatnonzero(mask[:whole].reshape(-1, 8)[eight])
    return np.concatenate([eight[at // 8] * 8 + at % 8, whole + np.flatnonzero(mask[whole:])])


def _kth(of: np.ndarray, value: np.ndarray, top: np.ndarray) -> np.ndarray:
    """The highest values of each query so far, with more of them: (query, place)."""
    k = top.shape[1]
    order = np.lexsort((-value, of))
    of, value = of[order], value[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    more = np.zeros_like(top)
    more[of[place < k], place[place < k]] = value[place < k]
    both = np.concatenate([top, more], 1)
    return np.partition(both, k, axis=1)[:, k:]


def search(part: Part, starts: np.ndarray, gram: np.ndarray, w: np.ndarray, k: int, least: np.ndarray, seeds: int):
    """(query, row, similarity) arrays of rows that may be among a query's k nearest: all of the part that are as similar as least, its
    k-th similarity so far (0: fewer than k were found), or as the k-th of the part."""
    n_q, out = len(starts) - 1, []
    at = np.searchsorted(part.grams, gram)
    at[at == len(part.grams)] = 0
    has = part.grams[at] == gram if len(part.grams) else np.zeros(len(gram), bool)
    at, w, of = at[has].astype(np.int32), w[has], np.repeat(np.arange(n_q), np.diff(starts))[has]
    starts = np.searchsorted(of, np.arange(n_q + 1))
    buffer, over = np.empty(QUERIES * BLOCK, np.float32), np.empty(QUERIES * BLOCK, bool)
    for s in range(0, n_q, QUERIES):
        e = min(n_q, s + QUERIES)
        some = slice(starts[s], starts[e])
        dense = np.zeros((e - s, len(part.grams)))
        dense[of[some] - s, at[some]] = w[some]
        mine, finer = part._reduced(starts[s:e], np.diff(starts[s : e + 1]), at, w)
        rare = np.flatnonzero(part.place[at[some]] < 0) + starts[s]
        top, bound = np.zeros((e - s, k)), least[s:e].copy()
        found: list = []
        for block in range(part.blocks if part.n else 0):
            first = block * BLOCK
            n = min(part.n - first, BLOCK)
            sums = np.matmul(mine, part.coordinates[first : first + n].T, out=buffer[: (e - s) * n].reshape(e - s, n))
            low, high = part.lists(at[rare], block)
            sizes = high - low
            entry = _ragged(low, sizes)
            if len(entry):
                np.add.at(sums.reshape(-1), np.repeat((of[rare] - s) * n - first, sizes) + part.rows[entry], np.repeat(w[rare].astype(np.float32), sizes) * part.row_w[entry])
            new = np.flatnonzero(bound == 0)
            if len(new) and n > seeds:
                rows = np.argpartition(sums[new], n - seeds, axis=1)[:, -seeds:]
                value = part.similar(rows.ravel() + first, dense, np.repeat(new, seeds)).reshape(len(new), seeds)
                bound[new] = np.partition(value, seeds - k, axis=1)[:, seeds - k]
            # without a bound, whatever may share a gram
            enough = np.where(bound > 0, bound - EPS, 1e-7).astype(np.float32)
            places = _set(np.greater_equal(sums, enough[:, None], out=over[: (e - s) * n].reshape(e - s, n)))
            q, row = np.divmod(places, n)
            if len(q) and finer is not None:
                keep = part.narrower(sums.ravel()[places], mine, finer, q, row + first) >= enough[q]
                q, row = q[keep], row[keep]
            if len(q):
                value = part.similar(row + first, dense, q)
                keep = value >= np.maximum(bound, 1e-6)[q]
                q, row, value = q[keep], row[keep] + first, value[keep]
                found.append((q, row, value))
                top = _kth(q, value, top)
                bound = np.maximum(bound, top[:, 0])
        if found:
            q, row, value = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = value >= bound[q]
            q, row, value = q[keep], row[keep], value[keep]
            order = np.argsort(q, kind="stable")
            q, row, value = q[order], row[order], value[order]
            cut = np.flatnonzero(np.diff(q)) + 1
            out += [(s + int(i[0]), r, v) for i, r, v in zip(np.split(q, cut), np.split(row, cut), np.split(value, cut), strict=True) if len(i)]
    return out


class Ids:
    """The ids of a part's rows, made when asked for."""

    def __init__(self, of):
        self._of = of

    def __getitem__(self, row: int) -> list:
        return self._of(row)


def merged(best: list, found, ids, k: int, least: np.ndarray) -> None:
    """Put what a part gave into the k best of each query, (-similarity, first id, row's ids), lowest first; ids: of each row of the part, the lowest first."""
    for i, rows, value in found:
        if len(rows):
            more = best[i] + [(-v, (x := ids[r])[0], x) for r, v in zip(rows.tolist(), value.tolist(), strict=True)]
            more.sort(key=_first)
            best[i] = more[:k]
            if len(best[i]) == k:
                least[i] = -best[i][-1][0]


def _first(x: tuple) -> tuple:
    return x[0], x[1][0] if isinstance(x[1], tuple) else x[1]


def counts(texts: list[str], times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(gram, n): how many of the texts have each trigram; times: how often each text stands."""
    row, number, _, grams = _counted(texts)
    weights = None if times is None else times[row].astype(np.float64)
    return grams, np.bincount(number, weights, minlength=len(grams)).astype(np.int64)
