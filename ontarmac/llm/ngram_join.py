"""Jaccard join of n-gram sets with the global n-gram order cut into fragments.

A text is lower-cased in A-Z, and its set holds its distinct shingles of ``size`` words; a text with fewer words is one
shingle. Two sets link when ``100 * intersection >= percent * union``. Shingles are known by 64 bits of XXH64, sets by a
128-bit digest of them; equal sets are one vertex with its number of copies.

1. A screen: in the order of hashes each set sends its first shingles (as many as a link may miss, and ``SCREEN_PERCENT`` of the set more)
   as 32 bits to parts of the hash range. Of linked sets that percentage meets there, whatever the order; so sets of which fewer are met
   by other sets are settled. Meetings by chance only keep a set longer.
   The texts of the others are read again, once per text, and all their shingles are dealt over parts. A part
   counts in how many sets each shingle occurs. That gives the global order: rarest first, ties by hash. Shingles of one
   set only can be in no intersection, so only the others go back to their sets, and sets with fewer than a link needs are settled.
2. Two linked sets share a shingle among the first ``n - ceil(percent * n) + 1`` of their order, and their sizes differ by less than
   the percentage. Documents that share such a shingle and a size class are joined to the first of them, and the
   components of these joints are groups: every link lies within one.
3. Groups are packed into blocks; a group above ``block_docs`` or ``block_shingles`` is cut into chunks, and pairs of chunks are
   blocks of their own. In a block the global order is cut into fragments by document frequency, and a fragment into columns of bits.
   Fragment by fragment the partial overlaps of the pairs are counted separately and summed per pair, and a pair is given up once
   what is left of the two sets cannot bring it to its bound. Tasks return the number of links of each set and a spanning
   forest of the links, never the pairs.
4. The forest's components are the result.

A task sends one row per part for many sets at once, so what is shuffled grows with the shingles and not with sets times parts. Of
hashes 48 bits are kept, the rest being the part; two shingles of one pair of sets meet by chance about once in
``10^14 / (n m)`` pairs.

Defined results: a null, empty or blank text has an empty set, which links with nothing, not even with another empty one. Rows
repeated are copies of one set and link. A null id is not smallest unless a component has no other. Ties are links (exactly
``percent`` is enough). An empty table gives an empty result. Other columns are not looked at. Texts are looked at
whole; one very long text is a row per part.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common, simhash
from ontarmac.session import cut

SIZE = 5
PERCENT = 80
SHINGLES_PER_PART = 1 << 22
BLOCK_DOCS = 2048
BLOCK_SHINGLES = 1 << 20
MOST_FREQUENCY = (1 << 15) - 1
#: Document frequencies at which the global order is cut.
FRAGMENTS = [3, 5, 9, 17, 65, 257, 4097]
COLUMNS_AT_ONCE = 1 << 12
PAIRS_AT_ONCE = 1 << 14
#: Share of a set that must be met by others in the screen, in addition to what a link may miss.
SCREEN_PERCENT = 20
LEAST_PARTS = 32
HASHES_PER_ROW = 512
CACHED_WORDS = 500_000
CACHED_BYTES = 32 << 20
_KEY_BYTES = 16
_HASH_BYTES = 6
_REF_BYTES = 5
_SCREEN_BYTES = 4
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


# --- sets ------------------------------------------------------------------------------------------


class Hashes(dict):
    """XXH64 of words, each computed once; emptied when it holds many or long ones."""

    def __init__(self):
        from xxhash import xxh64_intdigest

        super().__init__()
        self.digest, self.bytes = xxh64_intdigest, 0

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS or self.bytes >= CACHED_BYTES:
            self.clear()
            self.bytes = 0
        found = self[word] = self.digest(word)
        self.bytes += len(word)
        return found


def shingle_set(text: str, size: int = SIZE, known: Hashes | None = None) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles: polynomials of their words' hashes, mixed with their length."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map((Hashes() if known is None else known).__getitem__, words), np.uint64, len(words))
    length = min(size, len(words))
    hashes = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        hashes = hashes * _FACTOR + each[i : i + len(hashes)]
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return np.unique(hashes)


def set_key(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=_KEY_BYTES).digest() if len(hashes) else None


def _ref(key: bytes) -> int:
    return int.from_bytes(key[:_REF_BYTES], "little")


def _least(n, percent: int):
    """The smallest overlap a set of ``n`` can link with."""
    return -(-percent * n // 100)


def screened(n: int, percent: int) -> int:
    """How many shingles a set of ``n`` is screened by.

    Of the shingles that two linked sets share the first ``SCREEN_PERCENT`` of the larger set, rounded down, one at least, are
    among what both send, as long as the percentage of a link is no smaller.
    """
    return n - _least(n, percent) + -(-n * SCREEN_PERCENT // 100)


def _keyed(size: int):
    """``id``, ``mark``, ``key``, ``ref`` and size ``n`` of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for batch in batches:
            keys, sizes = [], []
            for i in range(batch.num_rows):
                found = shingle_set(batch.column("text")[i].as_py(), size, known)
                keys.append(set_key(found))
                sizes.append(len(found))
            refs = [None if k is None else _ref(k) for k in keys]
            arrays = [batch.column("id"), batch.column("mark"), pa.array(keys, pa.binary()), pa.array(refs, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "mark", "key", "ref", "n"])

    return run


_SHARES = "part long, keys binary, counts binary, hashes binary"


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of unsigned 64-bit numbers."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def _unpacked(data: bytes, width: int) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view("<u8").ravel()


def _shares(size: int, parts: int, key_bytes: int, hash_bytes: int, percent: int | None = None):
    """Per part of the hash range one row for many sets: their keys, how many hashes each has there, and the hashes.

    Equal sets are sent once per row. With a ``percent`` a set sends what it is screened by. The more parts there are the more
    sets go together, within bounds.
    """
    names = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])
    enough = min(max(parts * HASHES_PER_ROW, 1 << 16), 1 << 21)

    def rows(sets: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        keys = np.frombuffer(b"".join(k[:key_bytes] for k in sets), np.uint8).reshape(-1, key_bytes)
        hashes = np.concatenate(list(sets.values()))
        owner = np.repeat(np.arange(len(keys)), [len(h) for h in sets.values()])
        part = (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")  # sets stay together within a part
        hashes, owner, part = _packed(hashes[order], hash_bytes), owner[order], part[order]
        begin = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]))
        counts = np.diff(np.append(begin, len(part))).astype("<u4")
        first = np.flatnonzero(np.concatenate([[True], part[begin][1:] != part[begin][:-1]]))
        last = np.append(first[1:], len(begin))
        ends = np.append(begin, len(part))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(part[begin[first]]),
                pa.array([keys[owner[begin[a:b]]].tobytes() for a, b in zip(first, last)], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
                pa.array([hashes[ends[a] : ends[b]].tobytes() for a, b in zip(first, last)], pa.binary()),
            ],
            schema=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sets, held = Hashes(), {}, 0
        for batch in batches:
            for i in range(batch.num_rows):
                found = shingle_set(batch.column("text")[i].as_py(), size, known)
                if not len(found) or (key := set_key(found)) in sets:
                    continue
                sets[key] = found if percent is None else found[: screened(len(found), percent)]
                held += len(sets[key])
                if held >= enough:
                    yield rows(sets)
                    sets, held = {}, 0
        if sets:
            yield rows(sets)

    return run


def _of_part(part: pa.Table, key_bytes: int, hash_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a part, and the key and hash of each of their hashes; equal sets count once."""
    keys = np.concatenate([np.frombuffer(k, np.uint8).reshape(-1, key_bytes) for k in part.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(c, "<u4") for c in part.column("counts").to_pylist()]).astype(np.int64)
    hashes = np.concatenate([_unpacked(h, hash_bytes) for h in part.column("hashes").to_pylist()]).view(np.int64)
    wide = np.zeros((len(keys), _KEY_BYTES), np.uint8)
    wide[:, :key_bytes] = keys
    low, high = wide.view("<u8").T
    order = np.lexsort((high, low))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    first = np.zeros(len(keys), bool)
    first[order[new]] = True
    owner = np.repeat(np.arange(len(keys)), counts)
    use = first[owner]
    return keys, owner[use], hashes[use]


def _frequency(hashes: np.ndarray) -> np.ndarray:
    """How often each of the hashes occurs, at its place."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    often = np.diff(np.append(begin, len(hashes)))
    out = np.empty(len(hashes), np.int64)
    out[order] = np.repeat(often, often)
    return out


def _met(part: pa.Table) -> pa.Table:
    """How many of a set's hashes in a part other sets have too."""
    keys, owner, hashes = _of_part(part, _REF_BYTES, _SCREEN_BYTES)
    some, count = np.unique(owner[_frequency(hashes) > 1], return_counts=True)
    refs = _unpacked(keys[some].tobytes(), _REF_BYTES).view(np.int64)
    return pa.Table.from_arrays([pa.array(refs), pa.array(count.astype(np.int64))], names=["ref", "met"])


def _ranked(part: pa.Table) -> pa.Table:
    """Per set of a part its shingles that other sets have too, as places in the global order: frequency, then hash."""
    keys, owner, hashes = _of_part(part, _KEY_BYTES, _HASH_BYTES)
    frequency = _frequency(hashes)
    shared = frequency > 1
    ranks = (np.minimum(frequency[shared], MOST_FREQUENCY) << (8 * _HASH_BYTES)) | hashes[shared]
    some, begin = np.unique(owner[shared], return_index=True)
    pieces = np.split(ranks, begin[1:]) if len(some) else []
    return pa.Table.from_arrays(
        [pa.array([keys[k].tobytes() for k in some], pa.binary()), pa.array([p.tobytes() for p in pieces], pa.binary())],
        names=["key", "ranks"],
    )


def _parts(rows: DataFrame, share: float, per_part: int) -> int:
    """Parts for ``share`` of the shingles of texts; about six bytes a word are usual."""
    found = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_PARTS, int(found * share / (6 * per_part)) + 1)


def likely(docs: DataFrame, vertices: DataFrame, size: int, percent: int, per_part: int) -> DataFrame:
    """The sets of ``vertices`` that the screen lets through: all that link are among them."""
    parts = _parts(docs, (100 - percent + SCREEN_PERCENT) / 100, per_part)
    shares = docs.select("text").mapInArrow(_shares(size, parts, _REF_BYTES, _SCREEN_BYTES, percent), _SHARES)
    met = shares.groupBy("part").applyInArrow(_met, "ref long, met long").groupBy("ref").agg(F.sum("met").alias("met"))
    enough = F.greatest(F.lit(1), F.floor(F.col("n") * SCREEN_PERCENT / 100))
    return vertices.join(met, "ref").filter(F.col("met") >= enough)


def shared_sets(texts: DataFrame, size: int, per_part: int) -> DataFrame:
    """``key`` and ``pieces`` of the ranks of the shingles that a set shares with others of ``texts``."""
    shares = texts.mapInArrow(_shares(size, _parts(texts, 1, per_part), _KEY_BYTES, _HASH_BYTES), _SHARES)
    ranked = shares.groupBy("part").applyInArrow(_ranked, "key binary, ranks binary")
    return ranked.groupBy("key").agg(F.collect_list("ranks").alias("pieces"), (F.sum(F.octet_length("ranks")) / 8).alias("shared"))


# --- groups ----------------------------------------------------------------------------------------


def size_bounds(percent: int, largest: int) -> list[int]:
    """Where size classes begin: sets that can link are in one class or in two neighbouring ones."""
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return bounds


def _in_order(pieces: list[bytes]) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(pieces), "<i8"))


def _prefixes(percent: int):
    schema = pa.schema([("rank", pa.int64()), ("size_class", pa.int32()), ("v", pa.int64())])
    bounds = size_bounds(percent, 1 << 40)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks, classes, vertices = [], [], []
            for v, n, pieces in zip(*(batch.column(c).to_pylist() for c in ("v", "n", "pieces"))):
                shared = _in_order(pieces)
                first = shared[: max(0, len(shared) - _least(n, percent) + 1)]  # those of one set only stand before them
                own = bisect_right(bounds, n) - 1
                for c in (own, own + 1):
                    ranks.append(first)
                    classes.append(np.full(len(first), c, np.int32))
                    vertices.append(np.full(len(first), v, np.int64))
            if ranks:
                arrays = [pa.array(np.concatenate(x)) for x in (ranks, classes, vertices)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def groups(sets: DataFrame, percent: int) -> DataFrame:
    """``v`` and ``grp`` of all sets that may link with another one; linked sets have one group."""
    prefixes = sets.select("v", "n", "pieces").mapInArrow(_prefixes(percent), "rank long, size_class int, v long")
    heads = prefixes.groupBy("rank", "size_class").agg(F.min("v").alias("head"), F.max("v").alias("last"))
    joints = prefixes.join(heads.filter("head < last"), ["rank", "size_class"]).filter("v > head")
    roots = cut(simhash.components(joints.select(F.col("v").alias("u"), F.col("head").alias("v")).distinct()))
    return roots.select(F.col("vertex").alias("v"), F.col("root").alias("grp")).unionByName(
        roots.select(F.col("root").alias("v"), F.col("root").alias("grp")).distinct()
    )


# --- blocks ----------------------------------------------------------------------------------------


def _pairs(n: np.ndarray, percent: int, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows sorted by size whose sizes allow a link; with sides one row of each."""
    last = np.searchsorted(n, n * 100 // percent, side="right")
    count = last - np.arange(len(n)) - 1
    i = np.repeat(np.arange(len(n)), count)
    j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + i + 1
    if side is not None:
        apart = side[i] != side[j]
        i, j = i[apart], j[apart]
    return i, j


def linked_pairs(
    sets: list[np.ndarray], n: np.ndarray, percent: int, side: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (sorted by size) that link, by partial overlaps per fragment of the global order."""
    i, j = _pairs(n, percent, side)
    need = -(-percent * (n[i] + n[j]) // (100 + percent))
    ranks = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, often = np.unique(ranks, return_inverse=True, return_counts=True)
    met = often > 1  # what one set of the block only has is in no overlap here
    use = met[column]
    owner, column, values = owner[use], (np.cumsum(met) - 1)[column[use]], values[met]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    cuts = np.searchsorted(values, np.array(FRAGMENTS, np.int64) << (8 * _HASH_BYTES))
    edges = np.unique(np.concatenate([[0], cuts, [len(values)]]))
    rest = np.bincount(owner, minlength=len(sets))  # shingles in fragments not counted yet
    overlap = np.zeros(len(i), np.int64)
    for low, high in zip(edges, edges[1:]):
        for begin in range(int(low), int(high), COLUMNS_AT_ONCE):
            end = min(begin + COLUMNS_AT_ONCE, int(high))
            a, b = np.searchsorted(column, [begin, end])
            words = -(-(end - begin) // 64)
            plain = np.zeros((len(sets), words * 64), np.uint8)
            plain[owner[a:b], column[a:b] - begin] = 1
            bits = np.packbits(plain, axis=1).view("<u8")
            for at in range(0, len(i), PAIRS_AT_ONCE):
                p = slice(at, at + PAIRS_AT_ONCE)
                overlap[p] += np.bitwise_count(bits[i[p]] & bits[j[p]]).sum(axis=1, dtype=np.int64)
            rest -= np.bincount(owner[a:b], minlength=len(sets))
            alive = overlap + np.minimum(rest[i], rest[j]) >= need
            i, j, need, overlap = i[alive], j[alive], need[alive], overlap[alive]
        if not len(i):
            break
    return i, j


def _block_links(percent: int):
    """Forest links ``(u, v)`` and, as rows without ``u``, the number of links of a set, copies of the other side counted."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("n", "ascending"), ("v", "ascending")])
        v, n, copies, side = (block.column(c).to_numpy() for c in ("v", "n", "copies", "side"))
        chunks = block.column("a")[0] != block.column("b")[0]
        sets = [_in_order(p) for p in block.column("pieces").to_pylist()]
        i, j = linked_pairs(sets, n, percent, side if chunks else None)
        label = simhash._hook(np.arange(len(v)), i, j)
        own = np.flatnonzero(label != np.arange(len(v)))
        a, b = v[own], v[label[own]]
        links = np.bincount(i, copies[j], len(v)) + np.bincount(j, copies[i], len(v))
        some = np.flatnonzero(links)
        none = [None] * len(some)
        return pa.Table.from_arrays(
            [
                pa.concat_arrays([pa.array(np.maximum(a, b)), pa.array(none, pa.int64())]),
                pa.concat_arrays([pa.array(np.minimum(a, b)), pa.array(v[some])]),
                pa.concat_arrays([pa.array([None] * len(own), pa.int64()), pa.array(links[some].astype(np.int64))]),
            ],
            schema=schema,
        )

    return run


def links(sets: DataFrame, percent: int, block_docs: int, block_shingles: int) -> DataFrame:
    """Links that connect the same sets as all pairs of similar sets do, and links counted per set."""
    weighed = sets.select("v", F.aggregate("pieces", F.lit(0), lambda s, p: s + F.octet_length(p)).alias("weight"))
    member = cut(groups(sets, percent).join(weighed, "v"))
    chunks = F.greatest(F.ceil(F.count("*") * 2 / block_docs), F.ceil(F.sum("weight") / (4 * block_shingles)))
    sized = member.groupBy("grp").agg(
        F.when((F.count("*") <= block_docs) & (F.sum("weight") <= 8 * block_shingles), 1).otherwise(chunks).cast("int").alias("chunks")
    )
    dealt = member.join(sized, "grp").withColumn("mine", F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int"))
    places = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")).select(
        "grp", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "v"
    )
    both = places.join(sets.select("v", "n", "copies", "pieces"), "v")
    return both.groupBy("grp", "a", "b").applyInArrow(_block_links(percent), "u long, v long, links long")


def similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    percent: int = PERCENT,
    shingles_per_part: int = SHINGLES_PER_PART,
    block_docs: int = BLOCK_DOCS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Per row of ``docs``: ``id``, set size ``n_shingles``, ``component_id`` (the smallest id reachable) and ``n_links``.

    ``n_links`` counts the other rows whose sets link with the row's, equal ones included.
    """
    texts = common.two_columns(docs, id_col, text_col)
    marked = texts.withColumn("mark", common.text_digest(F.col("text"), fold=True))
    kind = common.id_type(docs, id_col)
    rows = cut(marked.mapInArrow(_keyed(size), f"id {kind}, mark binary, key binary, ref long, n long"))
    vertices = (
        rows.filter("key is not null").groupBy("key")
        .agg(F.min("id").alias("smallest"), F.count("*").alias("copies"), F.first("ref").alias("ref"), F.first("n").alias("n"))
    )
    open_ = cut(likely(texts, vertices, size, percent, shingles_per_part))
    # what is open grows with the input, so it is not broadcast even while it is little; copies are one row per task
    wanted = rows.join(open_.select("key").hint("merge"), "key", "left_semi").select("mark").distinct()
    once = marked.groupBy("mark").agg(F.any_value("text").alias("text")).join(wanted.hint("merge"), "mark", "left_semi")
    shared = shared_sets(cut(once.select("text")), size, shingles_per_part).join(open_, "key")
    counted = cut(
        shared.filter(F.col("shared") * 100 >= F.col("n") * percent)
        .select("key", "smallest", "copies", "n", "pieces")
        .withColumn("v", F.monotonically_increasing_id())
    )
    found = cut(links(counted.select("v", "n", "copies", "pieces"), percent, block_docs, block_shingles))
    roots = simhash.components(found.filter("u is not null").select("u", "v"))
    per_set = found.filter("u is null").groupBy("v").agg(F.sum("links").alias("links"))
    named = (
        counted.select("v", "key", "smallest")
        .join(roots, F.col("v") == F.col("vertex"), "left")
        .join(per_set, "v", "left")
        .select("key", "smallest", F.coalesce("root", "v").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    heads = named.groupBy("root").agg(F.min("smallest").alias("head"))
    others = named.join(heads, "root").select("key", "head", "links")
    classes = vertices.join(others, "key", "left").select(
        "key", F.coalesce("head", "smallest").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = rows.filter("key is not null").join(classes, "key").select("id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    empty = rows.filter("key is null").select(
        "id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links")
    )
    return joined.unionByName(empty)
