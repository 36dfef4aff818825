"""Statistics of whole texts, as the quality operators take them.

Words are runs of anything but ASCII blanks. A null or empty text has zeros throughout.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from ontarmac.llm import common

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Shares that do not depend on a text's length, and two logarithms of lengths.
FEATURES = [
    "symbols_per_char", "pipes_per_word", "bangs_per_word", "upper_share", "digit_share", "other_share", "mean_word", "words_per_line",
    "dup_line_share", "repeat_share", "same_as_last", "distinct_share", "top_share", "stop_marks", "log_words", "log_lines",
]
_UPPER, _LETTERS, _DIGITS = common.UPPER.encode(), (common.UPPER + common.LOWER).encode(), b"0123456789"


def repeated_words(words: list[bytes]) -> int:
    """Words that are part of a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    marked = bytearray(len(words))
    for i, window in enumerate(windows):
        if found[window] > 1:
            marked[i : i + 3] = b"\1\1\1"
    return marked.count(1)


def repeated_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    worded = [line for line in lines if line.split(None, 1)]
    return len(worded) - len(set(worded))


def _without(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def measure(text: str) -> tuple[list[int], list[float]]:
    """Counts and features of one text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    lines = data.split(b"\n")
    chars = len(text) - _without(data, common.BLANKS.encode())
    symbols, dup, repeat = _without(data, SYMBOLS), repeated_lines(lines), repeated_words(words)
    letters = _without(data, _LETTERS)
    ascii_other = sum(b < 128 for b in data.translate(None, _LETTERS + _DIGITS + SYMBOLS + b".,!" + common.BLANKS.encode()))
    top = Counter(words).most_common(1)[0][1]
    features = [
        symbols / chars,
        data.count(b"|") / n,
        data.count(b"!") / n,
        _without(data, _UPPER) / max(letters, 1),
        _without(data, _DIGITS) / chars,
        ascii_other / chars,
        chars / n,
        n / len(lines),
        dup / len(lines),
        repeat / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(words)) / n,
        top / n,
        data.count(b".") / n,
        math.log(n),
        math.log(len(lines)),
    ]
    return [n, chars, symbols, dup, repeat], features


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the counts, and ``features`` (an array in the order of ``FEATURES``) of every row."""

    def of(texts: list[str]) -> dict[str, list]:
        rows = [measure(t) for t in texts]
        columns = {name: [counts[i] for counts, _ in rows] for i, name in enumerate(COUNTS)}
        return columns | {"features": [features for _, features in rows]}

    types = dict.fromkeys(COUNTS, pa.int64()) | {"features": pa.list_(pa.float64())}
    schema = ", ".join([f"id {common.id_type(docs, id_col)}", *[f"{c} long" for c in COUNTS], "features array<double>"])
    return common.two_columns(docs, id_col, text_col).mapInArrow(common.per_text(of, types), schema)
