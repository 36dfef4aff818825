"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source is dealt into shards of about ``shard_words`` words by a hash of the document id, and every shard is cut
into blocks of about ``block_words`` words. A shard's votes are its share of its source's target; the blocks of the mix
go to the shards with the highest quotients ``votes / (2 * seats + 1)``, which gives each shard an integer quota. Within a shard
the quota is taken as whole passes over its blocks plus a run of further blocks from a seeded place on; documents, and so
blocks, are in a seeded order. No block is taken more than twice.

Neither sources nor shards meet in one place: the quotient at which the last block is given is found by counting seats
over the shard table for many thresholds at once, and blocks that tie there are given in a fixed order.

Defined results: a null text has no words and nothing is taken from it. A null source is a source, the last one. Rows
repeated with the same id are further documents. Sources without words have target 0. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 18
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20240607
THRESHOLDS = 64


def ranked(sources: DataFrame, order: str) -> DataFrame:
    """``rank`` from 0 in ascending order, nulls last; rows stay spread over tasks."""
    parts = cut(
        sources.repartitionByRange(F.col(order).asc_nulls_last())
        .sortWithinPartitions(F.col(order).asc_nulls_last())
        .withColumn("part", F.spark_partition_id())
    )
    within = Window.partitionBy("part").orderBy(F.col(order).asc_nulls_last())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task of the sort: the only ones that meet
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    return (
        parts.withColumn("rank", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), "part")
        .withColumn("rank", F.col("rank") + F.col("start"))
        .drop("part", "start")
    )


def with_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MAX_REPEATS) -> DataFrame:
    """Add each source's ``weight`` and ``target``; ``sources`` has ``source`` and ``source_size``.

    Weights repeat over the sources in code-point order. ``share`` of all words is dealt by weight; a source stops
    at ``most`` times its size and what it cannot take is dealt to the others by weight, until none is above.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    weighted = cut(ranked(sources, "source").withColumn("weight", weight).withColumn("cap", cap))
    total = (weighted.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, stopped = 0.0, -1
    while True:  # the words per unit of weight only rise, so a source that stopped stays stopped
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        row = weighted.agg(
            F.sum(F.when(full, F.col("cap"))).alias("capped"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count_if(full).alias("stopped"),
        ).first()
        if row["stopped"] == stopped or not row["open"]:
            break
        stopped = row["stopped"]
        level = (total - (row["capped"] or 0.0)) / row["open"]
    return weighted.withColumn("target", F.least("cap", F.col("weight") * F.lit(level))).drop("cap", "rank")


def _seats(quotient: Column | float) -> Column:
    """Blocks a shard gets when every quotient of at least ``quotient`` wins one."""
    return F.least("limit", F.floor((F.col("votes") / F.lit(quotient) + 1) / 2))


def apportion(shards: DataFrame, blocks: int) -> DataFrame:
    """Add ``seats``: the ``blocks`` highest quotients ``votes / (2k + 1)``, at most ``limit`` per shard.

    Ties at the last place go by source and shard.
    """
    possible, votes = shards.agg(F.sum("limit"), F.sum("votes")).first()
    blocks = min(blocks, possible or 0)
    if not blocks:
        return shards.withColumn("seats", F.lit(0).cast("long"))
    high, low = votes + 1.0, 0.0  # at ``high`` no seat is given, below ``low`` at least ``blocks`` are
    guess = votes / (2 * blocks)
    tries = np.unique(np.concatenate([guess * np.linspace(0.5, 1.5, THRESHOLDS), guess * 0.5 ** np.arange(2, 50)]))
    while True:
        counts = shards.agg(*[F.sum(_seats(float(t))).alias(f"t{i}") for i, t in enumerate(tries)]).first()
        over = [t for t, n in zip(tries, counts) if n >= blocks]
        under = [t for t, n in zip(tries, counts) if n < blocks]
        before = (low, high)
        low, high = max([low, *over]), min([high, *under])
        given = shards.agg(F.sum(_seats(float(high)))).first()[0]
        gap = shards.agg(F.sum(_seats(float(low)))).first()[0] - given if low else None
        if gap is not None and (gap <= 100_000 or before == (low, high)):
            break
        tries = np.linspace(low or high * 0.5**60, high, THRESHOLDS + 2)[1:-1]
    base = shards.withColumn("seats", _seats(float(high)))
    steps = F.explode(F.sequence(F.col("seats"), _seats(float(low)) - 1))
    contested = base.filter(_seats(float(low)) > F.col("seats")).select("source", "shard", "votes", steps.alias("k"))
    last = (
        contested.orderBy((F.col("votes") / (2 * F.col("k") + 1)).desc(), "source", "shard", "k")
        .limit(blocks - given)
        .groupBy(F.col("source").alias("of"), F.col("shard").alias("of_shard"))
        .agg(F.count("*").alias("more"))
    )
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("of_shard"))
    seats = (F.col("seats") + F.coalesce("more", F.lit(0))).alias("seats")
    return base.join(last, same, "left").select(*shards.columns, seats)


def chosen_blocks(n: int, seats: int, seed: int) -> np.ndarray:
    """How often each of ``n`` blocks is taken: whole passes, and a run of further blocks from a seeded place on.

    Blocks follow each other in the seeded order of their documents, so a run is a random choice that cuts two
    documents at most.
    """
    start = int(np.random.default_rng(seed).integers(n))
    return seats // n + ((np.arange(n) - start) % n < seats % n)


def _taken(rows: pa.Table) -> pa.Table:
    """Words taken of each document of one shard: what its words' range shares with the chosen blocks."""
    rows = rows.sort_by([("place", "ascending"), ("id", "ascending"), ("size", "ascending")])
    sizes = rows.column("size").to_numpy()
    ends = sizes.cumsum()
    total, n = int(ends[-1]), rows.column("n_blocks")[0].as_py()
    taken = np.zeros(len(sizes), np.int64)
    if total:
        edges = np.arange(n + 1, dtype=np.int64) * total // n
        seed = rows.column("seed")[0].as_py() & (2**63 - 1)
        times = chosen_blocks(n, rows.column("seats")[0].as_py(), seed)
        upto = np.concatenate([[0], np.cumsum(times * np.diff(edges))])  # words taken before each edge

        def before(at: np.ndarray) -> np.ndarray:
            block = np.minimum(np.searchsorted(edges, at, side="right") - 1, n - 1)
            return upto[block] + times[block] * (at - edges[block])

        taken = before(ends) - before(ends - sizes)
    kept = ["id", "source", "size", "source_size", "target"]
    return rows.select(kept).append_column("taken", pa.array(taken, pa.int64()))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` words."""
    sizes = cut(
        docs.select(
            docs[id_col].alias("id"),
            docs[source_col].cast("string").alias("source"),
            common.word_count(docs[text_col]).alias("size"),
        )
    )
    sources = cut(
        with_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    ).withColumn("n_shards", F.ceil(F.greatest(F.col("source_size"), F.lit(1)) / shard_words))
    known = sources.withColumnRenamed("source", "known")
    placed = sizes.join(known, sizes["source"].eqNullSafe(known["known"])).drop("known", "weight")
    hashed = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed))
    dealt = placed.withColumn("place", hashed).withColumn("shard", F.pmod("place", "n_shards"))

    limit = F.greatest(F.round(F.col("words") / block_words), F.lit(1)).cast("long")
    shards = cut(
        dealt.groupBy("source", "shard")
        .agg(
            F.sum("size").alias("words"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
        )
        .filter("words > 0")
        .withColumn("votes", F.col("words") / F.col("source_size") * F.col("target"))
        .withColumn("n_blocks", limit)
        .withColumn("limit", F.col("n_blocks") * most)
        .select("source", "shard", "words", "votes", "n_blocks", "limit")
    )
    wanted = shards.agg(F.sum("votes")).first()[0] or 0.0
    quotas = cut(apportion(shards, round(wanted / block_words))).select(
        F.col("source").alias("of"), F.col("shard").alias("of_shard"), "n_blocks", "seats"
    )
    same = dealt["source"].eqNullSafe(quotas["of"]) & (dealt["shard"] == quotas["of_shard"])
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        dealt.join(quotas, same, "left")
        .withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
        .withColumn("seats", F.coalesce("seats", F.lit(0)))
        .withColumn("seed", F.xxhash64("source", "shard", F.lit(seed)))
        .select("id", "source", "size", "source_size", "target", "shard", "place", "n_blocks", "seats", "seed")
        .groupBy("source", "shard")
        .applyInArrow(_taken, f"id {kind}, source string, size long, source_size long, target double, taken long")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """The rows of the mix: each document as often as it is taken, with all its columns.

    The few documents that the end of a run cuts count as taken when half of their words are.
    """
    found = cut(mix(docs, id_col, source_col, text_col, **settings))
    copies = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    # rows of one id have copies of their own each, which the size tells apart
    wanted = found.withColumn("copies", copies).groupBy("id", "size").agg(F.max("copies").alias("copies"))
    wanted = wanted.filter("copies > 0").select(F.col("id").alias("_mix_id"), F.col("size").alias("_mix_size"), F.col("copies").alias("_mix_copies"))
    same = docs[id_col].eqNullSafe(wanted["_mix_id"]) & (common.word_count(docs[text_col]) == wanted["_mix_size"])
    joined = docs.join(wanted.hint("merge"), same)  # not broadcast even while they are few
    return joined.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "_mix_copies")).alias("_mix_copy")).drop("_mix_copy")
