"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical), of at least
``max(24, 3 q)`` words, that neither neighbouring word extends. Collapsing a text drops the words of a run behind its
first ``q``.

Word ids are compressed by Re-Pair: pairs of neighbouring symbols that occur twice become symbols of their own, the most
frequent first, until none is left. A round replaces all pairs that are more frequent than the pairs they overlap, so the
rounds grow with the logarithm of the text. What is left of a text is joined by a balanced tree of further symbols. Each
symbol is two parts and a boundary between them, and a run of the text crosses the boundary of the smallest symbol that
contains it. So the runs that cross a symbol's boundary are computed once per symbol, however often it occurs: periods are
distances at which the two words at the boundary come again, and how far such a period reaches to both sides is found for
all candidates at once by comparing block hashes of words; every run is then compared word by word. The intervals are
translated to all places where the symbol is derived, and of those with one period the maximal ones stay. Boundaries whose
two words stand together only once in the text are crossed by no run and are skipped.

Texts share a task's arrays, about ``BATCH_WORDS`` words at a time, with word ids of their own each, so no symbol spans two.
A text is never cut: a longer one is a batch of its own, of about 200 bytes a word.

Defined results: a null, empty or blank text has no words and no runs; its collapsed text is empty. Ties of the greatest
exponent go to the smallest start, then the smallest period. Repeated rows each get their result, null ids too. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common

LEAST_WORDS = 24
LEAST_TIMES = 3
BATCH_WORDS = 1 << 18
CANDIDATES_AT_ONCE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


# --- grammar ---------------------------------------------------------------------------------------


@dataclass
class Grammar:
    """Symbols from ``first`` on are two symbols each; ``left``, ``right`` and ``place`` have a row per such symbol."""

    first: int
    left: np.ndarray
    right: np.ndarray
    place: np.ndarray  # a word each of them is derived at
    rounds: list[int]  # how many of them there were after each round
    size: np.ndarray  # words, of all symbols
    rest: np.ndarray  # the symbols left over, in order
    starts: np.ndarray  # the word each of them starts at
    repeated: np.ndarray  # whether the words i and i + 1 stand together anywhere else


def _ranked(group: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A rank per group: by count, ties in an order unrelated to place, so that many pairs are replaced in a round."""
    mixed = (group.astype(np.uint64) * _BASE) ^ ((group.astype(np.uint64) * _BASE) >> np.uint64(29))
    rank = np.empty(len(group), np.int64)
    rank[np.lexsort((mixed, counts))] = np.arange(1, len(group) + 1)
    return rank


def repair(words: np.ndarray) -> Grammar:
    """Re-Pair of word ids; ids of different texts must differ."""
    n = len(words)
    first = next_symbol = int(words.max()) + 1 if n else 0
    symbols, starts = words.astype(np.int64), np.arange(n)
    sizes = [np.ones(first, np.int64)]
    lefts, rights, places, rounds = [], [], [], [0]
    live = np.ones(n, bool)  # the pair of a symbol and its next one may occur twice
    live[n - 1 :] = False
    repeated = None
    while True:
        at = np.flatnonzero(live)
        codes = symbols[at] * next_symbol + symbols[at + 1] if len(at) else np.zeros(0, np.int64)
        order = np.argsort(codes, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = codes[order][1:] != codes[order][:-1]
        group = np.empty(len(at), np.int64)
        group[order] = np.cumsum(new) - 1
        if repeated is None:
            repeated = np.zeros(n, bool)
            repeated[at] = np.bincount(group, minlength=1)[group] > 1 if len(at) else False
        # within a stretch of one symbol every second pair overlaps the one before
        same = np.zeros(len(symbols) + 1, bool)
        same[1:-1] = symbols[1:] == symbols[:-1]
        place = np.arange(len(symbols))
        begin = np.maximum.accumulate(np.where(same[1:] & ~same[:-1], place, 0))
        odd = same[1:] & ((place - begin) % 2 == 1)
        counts = np.bincount(group[~odd[at]], minlength=int(new.sum()))
        often = counts[group] > 1
        live[at[~often]] = False
        at, group = at[often], group[often]
        if not len(at):
            break
        rank = np.zeros(len(symbols) + 2, np.int64)
        rank[at + 1] = _ranked(codes[order][new], counts)[group]
        chosen = ~odd[at] & (rank[at + 1] >= rank[at]) & (rank[at + 1] >= rank[at + 2])
        uses = np.bincount(group[chosen], minlength=len(counts))
        chosen &= uses[group] > 1
        at, group = at[chosen], group[chosen]
        names = np.cumsum(uses > 1) - 1
        one = np.empty(int(names[-1]) + 1, np.int64)
        one[names[group]] = at
        lefts.append(symbols[one])
        rights.append(symbols[one + 1])
        places.append(starts[one])
        rounds.append(rounds[-1] + len(one))
        known = np.concatenate(sizes) if len(sizes) > 1 else sizes[0]
        sizes = [known, known[symbols[one]] + known[symbols[one + 1]]]
        symbols[at] = next_symbol + names[group]
        next_symbol += len(one)
        live[at] = live[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, starts, live = symbols[stay], starts[stay], live[stay]
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lefts, rights, places)]
    return Grammar(first, *joined, rounds, np.concatenate(sizes), symbols, starts, repeated)


# --- runs across boundaries ------------------------------------------------------------------------


class Words:
    """Word ids with hashes of all their blocks."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        n = len(ids)
        self.powers = np.ones(n + 1, np.uint64)
        filled = 1
        while filled <= n:  # powers of the base, doubling what is there
            more = min(filled, n + 1 - filled)
            self.powers[filled : filled + more] = self.powers[:more] * (self.powers[filled - 1 : filled] * _BASE)
            filled += more
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(31)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed * self.powers[:n], out=self.sums[1:])

    def _equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the hashes of blocks at ``a`` and, further right, at ``b`` agree."""
        return (self.sums[a + size] - self.sums[a]) * self.powers[b - a] == self.sums[b + size] - self.sums[b]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (or before them) are equal one by one, ``most`` at most."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_] + 1) // 2
            shift = middle if back else 0
            same = self._equal(a[open_] - shift, b[open_] - shift, middle)
            low[open_[same]] = middle[same]
            high[open_[~same]] = middle[~same] - 1
        return low

    def checked(self, start: int, stop: int, period: int, low: int, high: int) -> tuple[int, int]:
        """The stretch of a period around what hashes gave, by the words themselves."""
        same = self.ids[low : high - period] == self.ids[low + period : high]
        middle = (start + stop - period) // 2 - low
        wrong = np.flatnonzero(~same)
        at = np.searchsorted(wrong, middle)
        first = low + (int(wrong[at - 1]) + 1 if at else 0)
        last = int(wrong[at]) + low if at < len(wrong) else high - period
        return first, last + period


def crossing(words: Words, pairs: np.ndarray, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs within ``[low, high)`` that hold the words on both sides of ``middle``: row, start, stop, smallest period.

    ``pairs`` names the pair of each word and its next. Either more than a period lies right of the boundary, and the pair
    at the boundary comes again a period to the right, or it comes again to the left.
    """
    longest = (high - low) // LEAST_TIMES
    ends = np.cumsum(longest)
    total = int(ends[-1]) if len(ends) else 0
    found = []
    for at in range(0, total, CANDIDATES_AT_ONCE):
        k = np.arange(at, min(at + CANDIDATES_AT_ONCE, total))
        row = np.searchsorted(ends, k, side="right")
        period = k - (ends[row] - longest[row]) + 1
        for back in (False, True):
            edge = middle[row] - 1  # the pair of the words edge and edge + 1
            other = edge - period if back else edge + period
            inside = other >= low[row] if back else other + 1 < high[row]
            use = np.flatnonzero(inside)
            use = use[pairs[edge[use]] == pairs[other[use]]]
            if not len(use):
                continue
            a, q, r = np.minimum(edge, other)[use], period[use], row[use]
            right = words.reach(a, a + q, high[r] - a - q)
            left = words.reach(a, a + q, a - low[r], back=True)
            start, stop = a - left, a + right + q
            long = stop - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * q)
            if long.any():
                found.append(np.stack([r[long], start[long], stop[long], q[long]]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    row, start, stop, period = np.concatenate(found, axis=1)
    # of the periods of one stretch the smallest counts; larger ones are its multiples
    order = np.lexsort((period, stop, start, row))
    row, start, stop, period = (x[order] for x in (row, start, stop, period))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    row, start, stop, period = (x[new] for x in (row, start, stop, period))
    for i in range(len(row)):
        a, b, q = int(start[i]), int(stop[i]), int(period[i])
        if not np.array_equal(words.ids[a : b - q], words.ids[a + q : b]):  # two blocks shared a hash
            start[i], stop[i] = words.checked(a, b, q, int(low[row[i]]), int(high[row[i]]))
    keep = stop - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
    return row[keep], start[keep], stop[keep], period[keep]


def _pair_names(ids: np.ndarray) -> np.ndarray:
    names = np.full(len(ids), -1, np.int64)
    if len(ids) > 1:
        names[:-1] = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    return names


def _regions(repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the stretch ``[low, high)`` around it in which all neighbours stand together elsewhere too."""
    n = len(repeated)
    place = np.arange(n)
    cut_before = np.ones(n, bool)
    cut_before[1:] = ~repeated[:-1]
    low = np.maximum.accumulate(np.where(cut_before, place, 0))
    begins = np.append(np.flatnonzero(cut_before), n)
    return low, begins[np.searchsorted(begins, place, side="right")]


def _tree_nodes(starts: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The balanced tree over the symbols left over: words ``[low, high)`` and boundary of its nodes, level by level."""
    edges = np.append(starts, total)
    width = 1
    while width < len(starts):
        begin = np.arange(0, len(starts) - width, 2 * width)
        yield edges[begin], edges[begin + width], edges[np.minimum(begin + 2 * width, len(starts))]
        width *= 2


def runs(ids: np.ndarray) -> np.ndarray:
    """Start, stop and period of all runs, by start, then period. Ids of different texts must differ."""
    if len(ids) < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    grammar = repair(ids)
    region_low, region_high = _regions(grammar.repeated)
    if (region_high - region_low).max() < LEAST_WORDS:
        return np.zeros((0, 3), np.int64)
    words, pairs = Words(ids), _pair_names(ids)
    sizes = grammar.size[grammar.first :]
    node = np.flatnonzero(sizes >= LEAST_WORDS)
    low = grammar.place[node]
    found = crossing(words, pairs, low, low + grammar.size[grammar.left[node]], low + sizes[node])
    spans = [_derived(grammar, grammar.first + node[found[0]], found[1] - low[found[0]], found[2] - found[1], found[3])]
    for low, middle, high in _tree_nodes(grammar.starts, len(ids)):
        low, high = np.maximum(low, region_low[middle - 1]), np.minimum(high, region_high[middle - 1])
        use = grammar.repeated[middle - 1] & (high - low >= LEAST_WORDS)
        _, start, stop, period = crossing(words, pairs, low[use], middle[use], high[use])
        spans.append(np.stack([start, stop, period], axis=1))
    return _maximal(np.concatenate(spans))


def _derived(grammar: Grammar, symbol: np.ndarray, start: np.ndarray, size: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Intervals of symbols at every place the symbols are derived."""
    if not len(symbol):
        return np.zeros((0, 3), np.int64)
    holds = np.zeros(grammar.first + len(grammar.left), bool)  # an interval is in the symbol or below it
    holds[symbol] = True
    for a, b in zip(grammar.rounds, grammar.rounds[1:]):  # the parts of a symbol are of earlier rounds
        holds[grammar.first + a : grammar.first + b] |= holds[grammar.left[a:b]] | holds[grammar.right[a:b]]
    order = np.argsort(symbol, kind="stable")
    symbol, start, size, period = (x[order] for x in (symbol, start, size, period))
    out = []
    at, place = grammar.rest, grammar.starts
    while True:
        use = holds[at] & (at >= grammar.first)
        at, place = at[use], place[use]
        if not len(at):
            return np.concatenate(out)
        a, b = np.searchsorted(symbol, at, side="left"), np.searchsorted(symbol, at, side="right")
        row = np.repeat(np.arange(len(at)), b - a)
        own = np.arange(len(row)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + a[row]
        begin = place[row] + start[own]
        out.append(np.stack([begin, begin + size[own], period[own]], axis=1))
        left, right = grammar.left[at - grammar.first], grammar.right[at - grammar.first]
        at, place = np.concatenate([left, right]), np.concatenate([place, place + grammar.size[left]])


def _maximal(spans: np.ndarray) -> np.ndarray:
    """Of intervals with one period those that no other contains, by start, then period."""
    start, stop, period = spans.T
    order = np.lexsort((-stop, start, period))
    start, stop, period = start[order], stop[order], period[order]
    if not len(start):
        return spans
    # stops are compared within a period by lifting each period above all before it
    which = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]]))
    lifted = stop + which * (int(stop.max()) + 1)
    before = np.concatenate([[-1], np.maximum.accumulate(lifted)[:-1]])
    best = lifted > before
    kept = np.stack([start[best], stop[best], period[best]], axis=1)
    return kept[np.lexsort((kept[:, 2], kept[:, 0]))]


# --- texts -----------------------------------------------------------------------------------------


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def looped(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words of every tenth id with a stretch that repeats to the end, as the registered query asks for."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = crc32(doc_id.encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a : a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[: n - a]


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Word ids, each text with ids of its own."""
    out, base = [], 0
    for words in texts:
        ids = {word: base + i for i, word in enumerate(dict.fromkeys(words))}
        out.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        base += len(ids)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _result(words: list[bytes], found: np.ndarray) -> tuple:
    """What a row says of its text: runs as numbers, the strongest of them, and digests."""
    listed = [(int(a), int(b - a), int(q)) for a, b, q in found]
    steps = np.zeros(len(words) + 1, np.int64)  # where runs begin and end to drop words
    for start, length, period in listed:
        steps[start + period] += 1
        steps[start + length] -= 1
    left = [w for w, dropped in zip(words, np.cumsum(steps).tolist()) if not dropped] if listed else words
    best = None
    for run in listed:  # lengths over periods compared as whole numbers; listed by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    text = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
    return (
        [{"start": s, "length": n, "period": q} for s, n, q in listed],
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(text.encode()).hexdigest(),
        hashlib.sha256(b" ".join(left)).hexdigest(),
        b" ".join(left).decode(),
    )


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
COLUMNS = {
    "runs": pa.list_(RUN),
    "start": pa.int64(),
    "length": pa.int64(),
    "period": pa.int64(),
    "exponent_milli": pa.int64(),
    "runs_sha256": pa.string(),
    "collapsed_sha256": pa.string(),
    "collapsed": pa.string(),
}
SCHEMA = (
    "runs array<struct<start long, length long, period long>>, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _results(texts: list[list[bytes]]) -> list[tuple]:
    ids = _numbered(texts)
    found = runs(ids)
    ends = np.cumsum([len(w) for w in texts])
    begins = ends - [len(w) for w in texts]
    edges = np.searchsorted(found[:, 0], np.append(begins, len(ids)))
    shift = np.array([1, 1, 0])
    return [_result(w, found[edges[i] : edges[i + 1]] - begins[i] * shift) for i, w in enumerate(texts)]


def _per_row(change: Callable[[list[bytes], str | None], list[bytes]] | None, with_text: bool):
    names = [c for c in COLUMNS if with_text or c != "collapsed"]

    def packed(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        columns = zip(*_results(texts))
        arrays = [pa.array(list(column), kind) for column, (name, kind) in zip(columns, COLUMNS.items()) if name in names]
        return pa.RecordBatch.from_arrays([ids, *arrays], names=["id", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, count = 0, [], 0
            for i in range(batch.num_rows):
                words = words_of(batch.column("text")[i].as_py())
                if change is not None:
                    words = change(words, batch.column("name")[i].as_py())
                held.append(words)
                count += len(words)
                if count >= BATCH_WORDS or len(held) >= 4 * common.SLICE_ROWS or i == batch.num_rows - 1:
                    yield packed(batch.column("id").slice(first, len(held)), held)
                    first, held, count = i + 1, [], 0

    return run


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[list[bytes], str | None], list[bytes]] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``id``, all ``runs`` by start, then period, the strongest one, and digests of runs and collapsed text.

    ``change`` maps the words of a text and its id as a string to the words to look at. ``with_text`` adds the
    text with its runs collapsed, words joined by one space.
    """
    rows = common.two_columns(docs, id_col, text_col).withColumn("name", F.col("id").cast("string"))
    schema = f"id {common.id_type(docs, id_col)}, {SCHEMA}" + (", collapsed string" if with_text else "")
    return rows.mapInArrow(_per_row(change, with_text), schema)
