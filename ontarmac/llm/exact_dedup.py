"""Exact dedup of an incoming batch against an immutable snapshot.

Texts are equal when identical after lower-casing A-Z. A snapshot holds one row per distinct text (its SHA-256, the
largest id, the number of rows) and, per bucket of digests, a static binary-fuse filter. A batch is grouped by digest
first, so a text that a third of all rows share is one row from there on. The filters screen those groups: most texts
that are new leave without a join. What passes is joined exactly by digest, and the bytes of one text of either side are compared.

Defined results: a null text is empty, and empty texts equal each other. A null id is smaller than any other. Of rows
repeated with the same id and text one stays. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

KEYS_PER_FILTER = 1 << 15
FILTER_SCHEMA = "bucket long, seed long, segment long, segments long, slots binary"


# --- binary fuse filters ---------------------------------------------------------------------------


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over keys and seed."""
    x = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _places(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three slots per key, in three neighbouring segments."""
    high = hashes >> np.uint64(32)
    first = (high * np.uint64(segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    inner = (hashes & mask, (hashes >> np.uint64(18)) & mask, (hashes >> np.uint64(36)) & mask)
    return np.stack([(first + np.uint64(i)) * np.uint64(segment) + low for i, low in enumerate(inner)]).astype(np.int64)


def _marks(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """Seed, segment length, number of first segments and slots for distinct 64-bit keys.

    Keys are peeled in rounds: all slots that only one key maps to are taken at once. Slots are then filled in
    reverse, so that the three slots of each key XOR to its mark. A seed that cannot be peeled is replaced.
    """
    n = max(len(keys), 2)
    segment = min(1 << int(math.log(n) / math.log(3.33) + 2.25), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    for seed in range(1, 200):
        if seed % 20 == 0:
            segments += 1 + segments // 8
        hashes = _mixed(keys, seed * 0x5851F42D)
        places = _places(hashes, segment, segments)
        size = (segments + 2) * segment
        degree = np.bincount(places.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        index = np.arange(len(keys))
        for row in places:
            np.bitwise_xor.at(owner, row, index)
        rounds, left = [], len(keys)
        free = np.flatnonzero(degree == 1)
        while len(free):
            peeled, at = np.unique(owner[free], return_index=True)
            rounds.append((peeled, free[at]))
            left -= len(peeled)
            touched = places[:, peeled]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(owner, row, peeled)
            near = np.unique(touched)
            free = near[degree[near] == 1]
        if left == 0:
            slots = np.zeros(size, np.uint16)
            marks = _marks(hashes)
            for peeled, at in reversed(rounds):
                three = slots[places[:, peeled]]
                slots[at] = marks[peeled] ^ three[0] ^ three[1] ^ three[2] ^ slots[at]
            return seed * 0x5851F42D, segment, segments, slots
    raise RuntimeError("no seed gives a filter for these keys")


def may_contain(keys: np.ndarray, seed: int, segment: int, segments: int, slots: np.ndarray) -> np.ndarray:
    """True for every key the filter was built from, and for about one in 65,536 others."""
    hashes = _mixed(keys, seed)
    three = slots[_places(hashes, segment, segments)]
    return (three[0] ^ three[1] ^ three[2]) == _marks(hashes)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    keys = np.unique(rows["key"].to_numpy(np.int64)).view(np.uint64)
    seed, segment, segments, slots = build_filter(keys)
    return pd.DataFrame(
        {
            "bucket": rows["bucket"].iloc[:1].to_numpy(),
            "seed": [seed],
            "segment": [segment],
            "segments": [segments],
            "slots": [slots.tobytes()],
        }
    )


def _screen(groups: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if groups.empty or filters.empty:
        return groups.iloc[:0]
    f = filters.iloc[0]
    keys = groups["key"].to_numpy(np.int64).view(np.uint64)
    slots = np.frombuffer(f["slots"], np.uint16)
    return groups[may_contain(keys, int(f["seed"]), int(f["segment"]), int(f["segments"]), slots)]


# --- rows, groups and snapshots --------------------------------------------------------------------


def _digests(texts: list[str]) -> dict[str, list]:
    return {"digest": [hashlib.sha256(t.encode().lower()).digest() for t in texts]}


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and the SHA-256 of its normalised text (``bytes.lower`` changes A-Z only)."""
    rows = common.two_columns(docs, id_col, text_col)
    kind = common.id_type(docs, id_col)
    return rows.mapInArrow(common.per_text(_digests, {"digest": pa.binary()}), f"id {kind}, digest binary")


def grouped(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: the row with the largest id and the number of rows; combined before the shuffle.

    ``key`` is the digest's first 64 bits, as filters take it.
    """
    return (
        rows.groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("rows"))
        .withColumn("key", F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long"))
    )


@dataclass
class Snapshot:
    """Distinct digests of texts that no longer change, and their filters per bucket."""

    groups: DataFrame
    filters: DataFrame
    buckets: int

    def save(self, path: str) -> None:
        self.groups.write.parquet(f"{path}/groups")
        self.filters.write.parquet(f"{path}/filters")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Snapshot:
        filters = spark.read.parquet(f"{path}/filters")
        buckets = filters.agg(F.max("buckets")).first()[0] or 1
        return cls(spark.read.parquet(f"{path}/groups"), filters, buckets)


def take_snapshot(rows: DataFrame, keys_per_filter: int = KEYS_PER_FILTER) -> Snapshot:
    """Group the rows and build one filter per bucket of about ``keys_per_filter`` digests."""
    groups = cut(grouped(rows))
    buckets = max(1, math.ceil(groups.count() / keys_per_filter))
    keyed = groups.select(F.pmod("key", F.lit(buckets)).alias("bucket"), "key")
    filters = keyed.groupBy("bucket").applyInPandas(_build, FILTER_SCHEMA).withColumn("buckets", F.lit(buckets))
    return Snapshot(groups, cut(filters), buckets)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The batch's groups that the snapshot's filters let through; all that are in the snapshot are among them."""
    keyed = groups.select("digest", "key", F.pmod("key", F.lit(snapshot.buckets)).alias("bucket"))
    passed = keyed.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(
        _screen, "digest binary, key long, bucket long"
    )
    return passed.select("digest")


def _same_bytes(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Digests for which one text of the batch and one of the snapshot are identical, byte by byte."""
    ids = pairs.select("digest", F.explode(F.array("batch.id", "snapshot.id")).alias("wanted"))
    rows = common.two_columns(docs, id_col, text_col)
    normal = F.translate("text", common.UPPER, common.LOWER)
    texts = (
        # the ids grow with the input, so they are not broadcast even while they are few
        rows.join(ids.hint("merge"), rows["id"].eqNullSafe(ids["wanted"]))
        .select("digest", normal.alias("text"))
        .filter(F.sha2("text", 256) == F.lower(F.hex("digest")))  # ids may have several texts
    )
    return texts.groupBy("digest").agg(F.count_distinct("text").alias("texts")).filter("texts = 1").select("digest")


def dedup(docs: DataFrame, in_snapshot: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept`` and the digest ``text_sha256``.

    ``in_snapshot`` tells rows of the snapshot from those of the incoming batch; null means the batch. Of equal
    texts on either side the row with the largest id stays.
    """
    flagged = docs.select(id_col, text_col, F.coalesce(in_snapshot, F.lit(False)).alias("old"))
    rows = cut(
        digest_rows(flagged.filter("old"), id_col, text_col).withColumn("old", F.lit(True))
        .unionByName(digest_rows(flagged.filter("not old"), id_col, text_col).withColumn("old", F.lit(False)))
        .withColumn("row", F.monotonically_increasing_id())
    )
    snapshot = take_snapshot(rows.filter("old"))
    batch = cut(grouped(rows.filter("not old")))

    old = snapshot.groups.select("digest", F.col("top").alias("snapshot"), F.col("rows").alias("old_rows"))
    new = batch.select("digest", F.col("top").alias("batch"), F.col("rows").alias("new_rows"))
    pairs = cut(new.join(screen(batch, snapshot), "digest", "left_semi").join(old, "digest"))
    confirmed = cut(pairs.join(_same_bytes(pairs, docs, id_col, text_col), "digest", "left_semi"))

    both = confirmed.select(
        "digest", F.greatest("batch", "snapshot").alias("top"), (F.col("new_rows") + F.col("old_rows")).alias("size")
    )
    sides = [
        side.select("digest", F.col("top").alias("own_top"), F.col("rows").alias("own_rows"), F.lit(flag).alias("old"))
        for side, flag in ((snapshot.groups, True), (batch, False))
    ]
    groups = (
        sides[0].unionByName(sides[1])
        .join(both, "digest", "left")
        .select(
            "digest",
            "old",
            F.coalesce("top", "own_top").alias("top"),
            F.coalesce("size", "own_rows").alias("group_size"),
        )
    )
    return rows.join(groups, ["digest", "old"]).select(
        "id",
        F.col("top.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def half_by_id(id_col: str = "doc_id") -> Column:
    """A fixed half of all ids: the part taken as the snapshot when a whole table is deduplicated at once."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that equal another, whatever their ids; all columns kept."""
    found = dedup(docs, half_by_id(id_col), id_col, text_col).select("id", "kept", F.unhex("text_sha256").alias("digest"))
    counts = found.groupBy("id", "digest").agg((F.count("*") > 1).alias("many"), F.max("kept").alias("kept"))
    return common.keep_rows(docs, cut(counts.filter("kept").drop("kept")), id_col, text_col, fold=True)
