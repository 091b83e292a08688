"""Licence statements: identifier tags and notice phrases by Aho-Corasick, licence expressions by shunting-yard.

A text's words, lower-cased and joined by single spaces, run once through an automaton of all phrases and tags, each
between spaces, so a phrase is found wherever its words stand one after another, whatever stands between them. After the
last word of a tag, and a colon or an equals sign, the rest of the line is an expression: it is put into postfix order
with the precedence WITH, AND, OR, and evaluated. An identifier has the freedom of its licence, OR takes the larger, AND
the smaller; WITH stands between a licence and an exception, both single identifiers, and lifts strong copyleft to weak.
Anything else is not understood, and never an error.

The score is the freedom that all statements of the text together leave (their smallest): 1 permissive or public domain,
0.75 weak copyleft, 0.5 strong copyleft, 0.25 no commerce or no derivatives, 0.1 reserved or not understood,
and 0 where nothing is stated.

Null counts as empty: no words, no places, empty labels, score 0. Equal rows are answered one by one. An empty
table gives no rows. Other columns are ignored. A very long text takes memory in proportion to itself, one text at a time.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notice phrases of our own, their labels and freedom.
NOTICES = {
    "mit license": ("mit", 1.0), "mit licence": ("mit", 1.0), "apache license": ("apache", 1.0), "bsd license": ("bsd", 1.0), "isc license": ("isc", 1.0),
    "permission is hereby granted free of charge": ("mit", 1.0), "redistribution and use in source and binary forms": ("bsd", 1.0),
    "public domain": ("public-domain", 1.0), "creative commons zero": ("cc0", 1.0), "cc0": ("cc0", 1.0), "this is free and unencumbered software": ("unlicense", 1.0),
    "mozilla public license": ("mpl", 0.75), "eclipse public license": ("epl", 0.75), "lesser general public license": ("lgpl", 0.75),
    "affero general public license": ("agpl", 0.5), "cc by sa": ("cc-by-sa", 0.5), "cc by nc": ("cc-by-nc", 0.25), "cc by nd": ("cc-by-nd", 0.25),
    "creative commons attribution": ("cc-by", 1.0), "no part of this publication": ("reserved", 0.1), "confidential and proprietary": ("proprietary", 0.1),
}
BASE_FREEDOM = {"cc-by": 1.0, "gpl": 0.5, "reserved": 0.1}
TAGS = ("spdx license identifier", "license expression")
_AFTER_TAG = re.compile(rb"[ \t]*[:=][ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}
UNKNOWN = 0.1


def freedom(identifier: str) -> float:
    """Of a licence identifier, by its family."""
    x = identifier.lower()
    if re.match(r"(mit|apache|bsd|isc|zlib|unlicense|cc0|0bsd|wtfpl|python|psf|boost|bsl-1|postgresql|ncsa|x11)", x):
        return 1.0
    if re.match(r"cc-by", x):
        return 0.25 if "-nc" in x or "-nd" in x else 0.5 if "-sa" in x else 1.0
    if re.match(r"(lgpl|mpl|epl|cddl)", x):
        return 0.75
    if re.match(r"(a?gpl|eupl|osl)", x):
        return 0.5
    return UNKNOWN


def postfix(expression: str) -> list[str] | None:
    """The tokens of an expression in postfix order; None where it isn't one. What follows a complete expression is not read."""
    out, waiting, operand = [], [], False
    for token in _TOKEN.findall(expression):
        word = token.upper()
        if token == "(":
            if operand:
                break
            waiting.append(token)
        elif token == ")":
            if not operand or "(" not in waiting:
                break
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif word in _RANK:
            if not operand:
                return None
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand = False
        else:
            if operand:
                break
            out.append(token.rstrip(".:"))
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[list[str], float]:
    """The licence identifiers of an expression, exceptions left out, and the freedom that it leaves."""
    tokens = postfix(expression)
    if tokens is None:
        return [], UNKNOWN
    values: list[tuple[set[str], float, bool]] = []  # identifiers, freedom, whether it is a single identifier
    for t in tokens:
        if t not in _RANK:
            values.append(({t}, freedom(t), True))
            continue
        (exception, other, single), (names, value, alone) = values.pop(), values.pop()
        if t != "WITH":
            values.append((names | exception, (max if t == "OR" else min)(value, other), False))
        elif single and alone:
            values.append((names, max(value, 0.75) if value == 0.5 else value, False))
        else:
            return [], UNKNOWN
    return sorted(values[0][0]), values[0][1]


_AUTOMATON = []


def automaton():
    """Of all phrases, a space before and after each; built once a process."""
    if not _AUTOMATON:
        import ahocorasick

        a = ahocorasick.Automaton()
        for phrase in {**BASE, **NOTICES, **dict.fromkeys(TAGS)}:
            a.add_word(f" {phrase} ", phrase)
        a.make_automaton()
        _AUTOMATON.append(a)
    return _AUTOMATON[0]


def scan(text: bytes | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of one text in UTF-8."""
    raw = text or b""
    plain = raw.translate(C.WORDS)
    words = plain.split()
    line = b" %s " % b" ".join(words)
    found = [(end, phrase) for end, phrase in automaton().iter(line.decode("latin-1"))]
    if not found:
        return len(words), 0, None, None, "", "", 0.0
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    base, own, values, starts, ends = set(), set(), [], [], []
    for end, phrase in found:
        if phrase in BASE:
            base.add(BASE[phrase])
            starts.append(end - len(phrase) - 1)
        elif phrase in NOTICES:
            label, value = NOTICES[phrase]
            own.add(label)
            values.append(value)
        else:
            ends.append(end)
    if ends:
        # where the words end in the text itself: the tag's last word is the one before the gap its match ends with
        inside = np.concatenate([np.frombuffer(plain, np.uint8) != 32, [False]])
        stops = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        for last in (np.searchsorted(gaps, ends) - 1).tolist():
            if (m := _AFTER_TAG.match(raw, int(stops[last]))) is None:
                continue
            names, value = evaluate(m[1].decode("utf-8", "replace"))
            own.update(f"spdx:{x.lower()}" for x in names)
            if not names:
                own.add("spdx:invalid")
            values.append(value)
    values += [BASE_FREEDOM[x] for x in base]
    at = np.searchsorted(gaps, starts) if starts else None
    first, last = (int(at.min()), int(at.max())) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | own)), min(values, default=0.0)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row."""

    def run(batches):
        import pyarrow as pa

        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        for batch in batches:
            columns = list(zip(*map(scan, C.byte_rows(batch.column(1))), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    C.prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(C.documents(spark, sf_dir))
