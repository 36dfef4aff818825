"""SimHash near-dedup with bit-sliced comparison of fingerprints.

A text is lower-cased in A-Z and cut into shingles of ``shingle`` words, repeats included; a shingle's hash is its XXH64
(seed 42), and a fingerprint bit is set when it is in over half of the hashes. Fingerprints link when they differ in
``radius`` bits or fewer.

Documents with one fingerprint are one vertex. The 64 bits are cut into blocks so that fingerprints within the radius
agree on some of them whatever bits differ (three differing bits leave one of four blocks equal, two of five, or three of
six); each choice of blocks is a table, and only fingerprints equal in a table's blocks are compared. How many blocks are
used depends on the number of fingerprints, so that buckets stay small; every choice finds all links.

Within buckets the comparison is bit-sliced: fingerprints lie as 64 bit planes, a machine word holding one bit of 64 of
them. For a fingerprint against a word of 64 others, plane after plane is added to carry-save counters (ones, twos, over),
and words all of whose lanes are over the radius are abandoned. A bucket above ``block_rows`` is cut into chunks, and
pairs of chunks are buckets of their own. Tasks return a spanning forest of the links they find; components of these are
found by rounds of joins (large star, small star), written to the shared folder.

Defined results: a null, empty or blank text has no shingles and fingerprint zero, which links like any other. A text
with fewer words than a shingle is one shingle. Null ids are not counted as smallest unless a component has no other.
Rows repeated share a fingerprint, and of a component one row survives, whatever the ids. An empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BLOCK_ROWS = 1 << 15
PAIR_WORDS = 1 << 16
CHECK_EVERY = 8
_BUCKET = ["place", "t", "key", "a", "b"]


# --- fingerprints ----------------------------------------------------------------------------------


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``id`` and ``fp`` (the 64 bits as a signed number) of every row."""

    def of(texts: list[str]) -> dict[str, list]:
        return {"fp": np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)}

    rows = common.two_columns(docs, id_col, text_col)
    return rows.mapInArrow(common.per_text(of, {"fp": pa.int64()}), f"id {common.id_type(docs, id_col)}, fp long")


# --- comparison ------------------------------------------------------------------------------------


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words; bit ``j`` of word ``w`` in row ``b`` is bit ``b`` of fingerprint ``64 w + j``."""
    padded = np.zeros(-(-len(fps) // BITS) * BITS, np.uint64)
    padded[: len(fps)] = fps
    rows = [np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little") for b in range(BITS)]
    return np.stack(rows).view("<u8")


def _low_bits(n: np.ndarray) -> np.ndarray:
    """Words whose lowest ``n`` bits are set, for ``n`` from 0 to 64."""
    full = n >= BITS
    return np.where(full, ~np.uint64(0), (np.uint64(1) << np.where(full, 0, n).astype(np.uint64)) - np.uint64(1))


def close_pairs(fps: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS) -> Iterator[tuple]:
    """Pairs ``(i, j)`` with ``first[i] <= j < last[i]`` whose fingerprints differ in ``radius`` bits or fewer.

    Two counter bits hold 0 to 3 differing bits and ``over`` keeps what exceeds them; smaller radii are told apart at the end.
    """
    if radius > 3:
        raise ValueError("two counter bits count to three")
    planes = bit_planes(fps)
    asking = np.flatnonzero(last > first)
    words = (last[asking] - 1) // BITS - first[asking] // BITS + 1
    ends = np.cumsum(words)
    total = int(ends[-1]) if len(ends) else 0
    for start in range(0, total, PAIR_WORDS):
        at = np.arange(start, min(start + PAIR_WORDS, total))
        k = np.searchsorted(ends, at, side="right")
        row = asking[k]
        word = first[row] // BITS + at - (ends[k] - words[k])
        base = word * BITS
        alive = _low_bits(np.clip(last[row] - base, 0, BITS)) & ~_low_bits(np.clip(first[row] - base, 0, BITS))
        ones, twos = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
        own = fps[row]
        for b in range(BITS):
            differs = planes[b][word] ^ (np.uint64(0) - ((own >> np.uint64(b)) & np.uint64(1)))
            carry = ones & differs
            ones ^= differs
            alive &= ~(twos & carry)
            twos ^= carry
            if b % CHECK_EVERY == CHECK_EVERY - 1:
                left = np.flatnonzero(alive)
                if len(left) < len(alive):
                    row, word, own, alive, ones, twos = (x[left] for x in (row, word, own, alive, ones, twos))
                if not len(left):
                    break
        if radius < 3:
            alive &= ~(ones & twos)
        if radius < 2:
            alive &= ~twos
        if radius < 1:
            alive &= ~ones
        while len(left := np.flatnonzero(alive)):
            row, word, alive = row[left], word[left], alive[left]
            lowest = alive & (np.uint64(0) - alive)
            lane = np.log2(lowest.astype(np.float64)).astype(np.int64)  # exact for powers of two
            yield row, word * BITS + lane
            alive = alive ^ lowest


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the trees of each pair; ``label`` holds every row's root, the smallest row of its tree."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := label[label], label):
            label = up


def _forest(bucket: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest per bucket; rows are sorted by bucket and side, buckets are whole."""
    n = len(fps)
    rows = np.arange(n)
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    which = np.cumsum(np.bincount(new, minlength=n)) - 1
    ends = np.append(new[1:], n)[which]
    second = new + np.add.reduceat(side == 0, new)  # where the second chunk of a pair of chunks begins
    paired = second[which] < ends
    first = np.where(paired, second[which], rows + 1)
    last = np.where(paired & (side == 1), first, ends)
    label = rows.copy()
    for i, j in close_pairs(fps, first, last, radius):
        label = _hook(label, i, j)
    own = np.flatnonzero(label != rows)
    return fps[own].view(np.int64), fps[label[own]].view(np.int64)


def _links(radius: int, rows_at_once: int):
    """Reads sorted rows, keeps the last bucket of each piece for the next one, and returns links."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def numbered(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        for name in _BUCKET:
            column = table.column(name).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.cumsum(new)

    def packed(table: pa.Table, bucket: np.ndarray) -> pa.RecordBatch:
        side, fp = (table.column(c).to_numpy() for c in ("side", "fp"))
        u, v = _forest(bucket, side, fp.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < rows_at_once:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            bucket = numbered(table)
            whole = int(np.searchsorted(bucket, bucket[-1], side="left"))
            if whole:
                yield packed(table.slice(0, whole), bucket[:whole])
                held = table.slice(whole).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            if table.num_rows:
                yield packed(table, numbered(table))

    return run


def block_plan(fingerprint_count: int, radius: int = RADIUS) -> tuple[int, int]:
    """How many blocks the bits are cut into, and how many of them must agree: the radius spoils the others at most.

    Keys have about 16, 25 or 32 bits for a radius of three, and a bucket a few hundred fingerprints at most.
    """
    match = 1 if fingerprint_count <= 1 << 23 else 2 if fingerprint_count <= 1 << 32 else 3
    return radius + match, match


def _tables(blocks: int, match: int) -> list[int]:
    """A mask of bits per table."""
    edges = np.linspace(0, BITS, blocks + 1).astype(int)
    parts = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, match)]


def links(fps: DataFrame, count: int, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links ``(u, v)`` that connect the same distinct fingerprints ``fp`` as all pairs within the radius do."""
    masks = _tables(*block_plan(count, radius))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(signed)])
    spread = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.key")
    hot = cut(spread.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > block_rows))
    plain = spread.join(hot.select("t", "key"), ["t", "key"], "left_anti").select(
        F.xxhash64("t", "key").alias("place"), "t", "key", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("side"), "fp"
    )
    chunks = F.ceil(F.col("n") / (block_rows // 2))
    mine = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    others = F.explode(F.sequence(F.lit(0), (F.col("chunks") - 1).cast("int"))).alias("other")
    split = (
        spread.join(hot, ["t", "key"]).withColumns({"chunks": chunks, "mine": mine})
        .select("t", "key", "fp", "mine", others)
        .withColumns({"a": F.least("mine", "other"), "b": F.greatest("mine", "other")})
        .select(F.xxhash64("t", "key", "a", "b").alias("place"), "t", "key", "a", "b", (F.col("mine") > F.col("other")).cast("int").alias("side"), "fp")
    )
    buckets = plain if hot.isEmpty() else plain.unionByName(split)
    rows = buckets.repartition("place").sortWithinPartitions(*_BUCKET, "side", "fp")
    found = rows.mapInArrow(_links(radius, 1 << 16), "u long, v long")
    return found.distinct()


# --- components ------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` (its component's smallest vertex) of all vertices of ``edges`` (``u > v``) but the roots.

    Large and small stars in turn, each written, until the edges no longer change.
    """
    edges, seen = cut(edges), None
    while True:
        mark = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == seen:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        seen = mark
        both = edges.union(edges.select("v", "u")).toDF("s", "t")
        low = both.groupBy("s").agg(F.least(F.min("t"), F.col("s")).alias("m"))
        large = cut(both.filter("t > s").join(low, "s").select(F.col("t").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        edges = cut(small.distinct())


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``fp`` and ``component_id``, the smallest id reachable over links."""
    rows = cut(fingerprints(docs, id_col, text_col, shingle))
    vertices = cut(rows.groupBy("fp").agg(F.min("id").alias("smallest")))
    roots = components(links(vertices.select("fp"), vertices.count(), radius, block_rows))
    rooted = vertices.join(roots, vertices["fp"] == roots["vertex"], "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(heads, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "fp", "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each component, the smallest id's (of its texts the one of the smallest SHA-256); all columns kept."""
    key = F.struct(docs[id_col].alias("id"), common.text_digest(docs[text_col]).alias("digest"))
    # an id alone does not tell rows apart: the digest goes with it, and nulls come last as in a component's smallest id
    named = docs.select(F.struct(docs[id_col].isNull().alias("none"), *[key[c].alias(c) for c in ("id", "digest")]).alias("id"), docs[text_col].alias("text"))
    found = near_dedup(named, "id", "text", **settings).filter(F.col("id") == F.col("component_id"))
    kept = found.groupBy("id.id", "id.digest").agg((F.count("*") > 1).alias("many"))
    return common.keep_rows(docs, cut(kept), id_col, text_col)
