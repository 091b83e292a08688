"""Token counts of a unigram tokenizer, without its tokens.

A text is split before each space, the space standing at the front of its word as U+2581 (a first word without a
space gets one), and each word is counted by itself, as the tokenizers library does with a Metaspace splitter. For a word
an Aho-Corasick automaton over the vocabulary lists, for each end, the pieces that end there, longest first; the best score
of a prefix and the number of its pieces are carried from end to end. Ties go to the longest piece, since only a
strictly better score replaces another, and a character that is no piece by itself costs the lowest score less 10. Unknown
characters that follow each other are one token, or, where the vocabulary has all byte pieces, one token for each UTF-8
byte. Scores are added from left to right in double precision, as the library adds them, so rounding agrees too.

Null and empty texts have no tokens. Rows are counted one by one, so equal rows stay. An empty table gives no rows.
Other columns are ignored. Memory: the words a worker keeps are bounded by MEMO; a word needs a few numbers a character.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SPACE, PENALTY, MEMO = "▁", 10.0, 400_000


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """The pieces of a sentencepiece model with the score log(1/(rank + 1)), the control and byte pieces at the lowest; and the unknown id.

    The model's order is by frequency of merging, so the score falls with the rank as a Zipf law's logarithm does."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    low = -math.log(n + 1.0)
    pieces = [(m.id_to_piece(i), low if m.is_control(i) or m.is_byte(i) or m.is_unknown(i) else -math.log(i + 1.0)) for i in range(n)]
    return pieces, m.unk_id()


class Counter(dict):
    """Number of tokens by word; asked for a new word, it counts and keeps it."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if i != unknown and piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {p for p, _ in pieces}
        self.by_byte = all(f"<0x{b:02X}>" in names for b in range(256))
        self.single = {p for p in names if len(p) == 1}
        self.lost = min(s for _, s in pieces) - PENALTY
        self.known = [p for p, _ in pieces]

    def __missing__(self, word: str) -> int:
        n = self.count(word)
        if len(word) < 64:
            self[word] = n
        return n

    def count(self, word: str) -> int:
        """Tokens of one word. Entries: best score, pieces, and whether the last piece is an unknown one."""
        best: list[tuple[float, int, bool] | None] = [(0.0, 0, False)] + [None] * len(word)
        found = self.automaton.iter(word)
        end, hit = next(found, (len(word), None))
        for at in range(len(word)):
            to = None
            while end == at:
                size, score = hit
                score += best[at + 1 - size][0]
                if to is None or score > to[0]:
                    to = (score, best[at + 1 - size][1] + 1, False)
                end, hit = next(found, (len(word), None))
            if word[at] not in self.single:
                before = best[at]
                score = self.lost + before[0]
                if to is None or score > to[0]:
                    size = len(word[at].encode("utf-8", "surrogatepass")) if self.by_byte else 0 if before[2] else 1
                    to = (score, before[1] + size, True)
            best[at + 1] = to
        return best[-1][1]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        if len(self) > MEMO:
            self.clear()
        first, *rest = text.replace(" ", SPACE).split(SPACE)
        return sum(map(self.__getitem__, [SPACE + w for w in rest])) + (self[SPACE + first] if first else 0)


_COUNTERS: dict[str, Counter] = {}


def counter_of(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(*vocabulary(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens) of every row."""

    def run(batches):
        import pyarrow as pa

        counter = counter_of(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(counter.text, batch.column(1).to_pylist())), pa.int64())], names=["doc_id", "n_tokens"])

    C.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(C.documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
