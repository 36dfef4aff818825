"""Packing token pieces into sequences of fixed size by minimum bin slack.

Each bin starts with the longest piece that is left; a subset-sum over the lengths that are left, kept as a bitset (bit ``n``:
``n`` tokens can be filled), finds the fullest combination to go with it. Bins depend on lengths only, and there are at
most ``capacity`` lengths. So the packing is planned on the counts per length: a combination is used as often as the pieces
last, which is what repeating the search would give, and then one of its lengths has fewer pieces left than a bin takes. So
the plan has a few combinations per length at most, whatever the number of pieces.

Pieces are then numbered within their length by tasks, and looked up in the plan. Numbering deals each length, which may
hold a third of all pieces, over groups of about ``pieces_per_salt`` by row and adds the counts of the groups before.

Defined results: a null or empty text is the end token alone. Very long texts are encoded whole, by their words. Rows repeated with the same id are further documents. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

CAPACITY = 4096
PIECES_PER_SALT = 2_000
CACHED_WORDS = 800_000
CACHED_BYTES = 64 << 20


# --- token ids -------------------------------------------------------------------------------------


MARK = b"\x01"
# fixed value: the pattern by which such a tokenizer takes words apart before it merges
APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that no normalisation but lower-casing changes, and ASCII marks without the apostrophe behind them.
PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Token ids of whole texts by way of their words, as little-endian 32-bit bytes.

    Right for tokenizers that drop white space and never join what stands on its two sides, such as those that split words
    off by a pattern without white space. Then a text's ids are those of its words, and each word is encoded once. New
    words go to the tokenizer many at a time, with a mark of one token between them. Where the pattern is ``APART``, a
    plain word is two parts, its letters and the marks behind them, and new letters go to a copy of the tokenizer that takes
    words apart at blanks alone: each gives one token that ends a word, its last. The cache is emptied when it holds many or
    long words.
    """

    def __init__(self, path: str, end_id: int | None = 1, cached: int = CACHED_WORDS, cached_bytes: int = CACHED_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.mark = self._ids(MARK)
        self.letters_only = self._for_letters(Tokenizer.from_file(path))
        self.end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        self.cached, self.cached_bytes = cached, cached_bytes
        self._forget()

    def _forget(self) -> None:
        self.known, self.parts, self.bytes = {}, {}, 0

    def _for_letters(self, copy):
        from tokenizers import pre_tokenizers

        steps = json.loads(copy.to_str())
        model, before = steps["model"], (steps["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        if before[0].get("pattern") != {"Regex": APART} or model.get("end_of_word_suffix") != "</w>" or len(before) != 2:
            return None
        copy.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ends_word = np.zeros(copy.get_vocab_size(), bool)
        self.ends_word[[i for token, i in copy.get_vocab().items() if token.endswith("</w>")]] = True
        return copy

    def _learn_letters(self, letters: list[str]) -> None:
        for start in range(0, len(letters), 2048):
            part = letters[start : start + 2048]
            found = self.letters_only.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u4")
            data, first = ids.tobytes(), 0
            for word, end in zip(part, ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist(), strict=True):
                self.parts[word] = data[first:end]
                first = end

    def _plain(self, words: list[bytes]) -> list[bytes]:
        """Learn the plain words; returns the others."""
        whole = PLAIN_WORD.fullmatch
        found = list(map(whole, map(bytes.decode, words)))
        split = [(m[1].lower(), m[2]) if m else None for m in found]
        self._learn_letters(list({s[0] for s in split if s}.difference(self.parts)))
        for marks in {s[1] for s in split if s}.difference(self.parts):
            self.parts[marks] = self._ids(marks.encode()).tobytes()
        parts, known = self.parts, self.known
        for word, s in zip(words, split):
            if s:
                known[word] = parts[s[0]] + parts[s[1]] if s[1] else parts[s[0]]
        return [w for w, s in zip(words, split) if not s]

    def _ids(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        if self.letters_only is not None:
            words = self._plain(words)
        alone = words if len(self.mark) != 1 else [w for w in words if MARK in w]
        for word in alone:
            self.known[word] = self._ids(word).tobytes()
        together = [] if len(self.mark) != 1 else [w for w in words if MARK not in w]
        for start in range(0, len(together), 2048):
            part = together[start : start + 2048]
            ids = self._ids((b" " + MARK + b" ").join(part))
            data = ids.tobytes()
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids)) * 4
            first = 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.known[word] = data[first:end]
                first = end + 4

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [t.encode().split() for t in texts]
        new = set().union(*words).difference(self.known)
        if len(self.known) + len(new) > self.cached or self.bytes > self.cached_bytes:
            self._forget()
            new = set().union(*words)
        self._learn(list(new))
        self.bytes += sum(map(len, new))
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) + self.end for ws in words]


def _encoder(path: str, end_id: int | None) -> WordEncoder:
    """This process's encoder. Spark hands a worker process one task after another, and functions arrive anew with each."""
    held = vars(sys).setdefault("_ontarmac_word_encoders", {})
    if (path, end_id) not in held:
        held[path, end_id] = WordEncoder(path, end_id)
    return held[path, end_id]


def _pieces(path: str, end_id: int | None, capacity: int, with_ids: bool):
    size = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end_id)
        for batch in batches:
            for first in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(first, common.SLICE_ROWS)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, data in enumerate(encoder.encode(part.column("text").to_pylist())):
                    for k, at in enumerate(range(0, len(data), size)):
                        held = data[at : at + size]
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(held) // 4)
                        crc.append(zlib.crc32(held))
                        if with_ids:
                            ids.append(held)
                columns = {
                    "id": part.column("id").take(pa.array(row, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity`` tokens where longer.

    ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and with ``with_ids`` the ids themselves (32-bit, little-endian).
    """
    schema = f"id {common.id_type(docs, id_col)}, piece int, start long, length long, ids_crc32 long"
    rows = common.two_columns(docs, id_col, text_col)
    run = _pieces(tokenizer, end_id, capacity, with_ids)
    return rows.mapInArrow(run, schema + ", ids binary" * with_ids)


# --- the plan --------------------------------------------------------------------------------------


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length (longest first) fill ``room`` best, by bitset subset-sum."""
    reach, steps, goal = 1, [], 1 << room
    mask = (goal << 1) - 1
    for length in lengths:
        if length > room or not counts[length]:
            continue
        left, size = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... pieces at once
            size = min(size, left)
            steps.append((reach, length, size))
            reach |= (reach << (length * size)) & mask
            left -= size
            size *= 2
        if reach & goal:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, size in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + size
            total -= length * size
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations (pieces per length) and how many bins use each, fullest first search until no piece is left."""
    left = {n: c for n, c in sorted(counts.items(), reverse=True) if c}
    found = []
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        chosen = fullest(list(left), left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // c for n, c in chosen.items())
        for n, c in chosen.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        found.append((chosen, times))
    return found


def _slots(found: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows of first number, pieces per bin, first bin and offset: where its pieces go, in turn."""
    slots: dict[int, list] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for chosen, times in found:
        offset = 0
        for n, c in chosen.items():
            slots.setdefault(n, []).append((used.get(n, 0), c, first_bin, offset))
            used[n] = used.get(n, 0) + c * times
            offset += n * c
        first_bin += times
    return {n: np.array(rows, np.int64) for n, rows in slots.items()}


# --- numbering and looking up ----------------------------------------------------------------------


def _numbered(pieces: DataFrame, salts: dict[int, int]) -> DataFrame:
    """``number`` from 0 within each length, whose pieces are dealt over ``salts`` groups.

    ``pieces`` are written, with a ``row`` that tells them apart even where ids and texts do not.
    """
    dealt = pieces.sparkSession.createDataFrame(list(salts.items()), "length long, salts long")  # one row per length
    spread = pieces.join(F.broadcast(dealt), "length").withColumn("salt", F.pmod(F.xxhash64("row"), "salts"))
    sums = spread.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("row")
    return (
        spread.withColumn("number", F.row_number().over(within) - 1)
        .join(starts, ["length", "salt"])
        .withColumn("number", (F.col("number") + F.col("first")).cast("long"))
        .drop("salt", "salts", "first")
    )


def _lookup(slots) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            lengths, numbers = (batch.column(c).to_numpy() for c in ("length", "number"))
            bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(part):
                    n = int(lengths[part[0]])
                    rows = table[n]
                    first, per_bin, first_bin, offset = rows[np.searchsorted(rows[:, 0], numbers[part], "right") - 1].T
                    turn = numbers[part] - first
                    bins[part] = first_bin + turn // per_bin
                    offsets[part] = offset + turn % per_bin * n
            kept = batch.drop_columns(["number"])
            yield kept.append_column("sequence_id", pa.array(bins)).append_column("offset", pa.array(offsets))

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, pieces_per_salt: int = PIECES_PER_SALT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns as :func:`token_pieces` gives them, without ids).

    A ``row`` that differs from piece to piece is taken where the pieces have one, else they are written with one. The counts per length are all that reaches the driver: ``capacity`` rows at most.
    """
    columns = [c for c in pieces.columns if c != "row"]
    if "row" not in pieces.columns:
        pieces = cut(pieces.withColumn("row", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    spark = pieces.sparkSession
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity)))
    salts = {length: -(-n // pieces_per_salt) for length, n in counts.items()}
    numbered = _numbered(pieces, salts).select(*columns, "number")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "row")
    return numbered.mapInArrow(_lookup(slots), f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece with its place."""
    pieces = token_pieces(docs, tokenizer, id_col, text_col, end_id, capacity)
    return pack(cut(pieces.withColumn("row", F.monotonically_increasing_id())), capacity)


def sequences(packed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The packed token ids: ``sequence_id`` and ``ids`` (32-bit, little-endian), from pieces with their ids.

    A sequence has ``capacity`` tokens at most, so no group is large.
    """
    key = ["id", "piece", "start", "length", "ids_crc32"]
    turn = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))  # equal rows take equal places in turn
    places = packed.withColumn("turn", turn).select(*[F.col(c).alias(f"_{c}") for c in [*key, "turn"]], "sequence_id", "offset")
    own = pieces.withColumn("turn", turn)
    same = [own[c].eqNullSafe(places[f"_{c}"]) for c in [*key, "turn"]]
    joined = own.join(places, same).select("sequence_id", "offset", "ids")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda held, p: F.concat(held, p["ids"]))
    return joined.groupBy("sequence_id").agg(ids.alias("ids"))
