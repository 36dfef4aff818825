"""Row samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ontarmac.operators.features import of_split, years_in

# fixed values: the small development subset
DEV_YEARS = [2022, 2023, 2024]
DEV_FRACTION = 0.02
DEV_SEED = 42


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Independent draws without replacement; the rows drawn depend on how the data is partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed) if fraction < 1.0 else df


def hash_sample(df: DataFrame, fraction: float, key: list[str], seed: int) -> DataFrame:
    """Rows whose hashed key falls in the lowest ``fraction``, the same under any partitioning."""
    if fraction >= 1.0:
        return df
    ceiling = f"{int(fraction * 2**32):08x}"
    drawn = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *key)), 1, 8)
    return df.filter(drawn < ceiling)


HEX = 4  # hexadecimal digits a round of the search looks at: 65,536 slots per group
ALL_HEX = 64


def _order(df: DataFrame, key: list[str], seed: int) -> Column:
    """A fixed order of rows in no relation to their values: a hash of seed and key, then one of all columns."""
    first = F.md5(F.concat_ws("|", F.lit(str(seed)), *key))
    return F.concat(first, F.md5(F.concat_ws("|", *df.columns)))


def _cuts(hashed: DataFrame, by: str, sizes: dict[str, int], few: int) -> dict[str, tuple[str, int] | None]:
    """Per group the digits at which the sample ends and how many rows with just these digits are in it; None takes all.

    Each round counts the open groups' rows per next digits and keeps the slot the sample ends in, until a slot has few rows.
    """
    spark, found = hashed.sparkSession, {}
    open_ = {group: ("", n) for group, n in sizes.items() if n > 0}
    while open_:
        length = len(next(iter(open_.values()))[0])
        sought = spark.createDataFrame([(g, p, n) for g, (p, n) in open_.items()], f"{by} string, _prefix string, _need long")
        slots = (
            hashed.join(F.broadcast(sought), by)  # a row per group asked for
            .filter(F.col("_order").startswith(F.col("_prefix")))
            .groupBy(by, "_need", F.substring("_order", length + 1, HEX).alias("_next"))
            .agg(F.count("*").alias("n"))
        )
        up_to = F.sum("n").over(Window.partitionBy(by).orderBy("_next"))  # 65,536 rows a group at most
        ends = slots.withColumn("up_to", up_to).filter("up_to >= _need").groupBy(by).agg(F.min_by(F.struct("_next", "n", "up_to"), "_next").alias("slot"))
        slot = {r[by]: r["slot"] for r in ends.collect()}
        left = {}
        for group, (prefix, need) in open_.items():
            if group not in slot:  # only in the first round: the group has fewer rows than asked for
                found[group] = None
                continue
            end = (prefix + slot[group]["_next"], need - (slot[group]["up_to"] - slot[group]["n"]))
            (found if slot[group]["n"] <= few or len(end[0]) == ALL_HEX else left)[group] = end
        open_ = left
    return found


def exact_sample(df: DataFrame, sizes: dict[str, int], key: list[str], by: str = "split", seed: int = 42, few: int = 10_000) -> DataFrame:
    """So many rows of each group, or all where it has fewer; the same rows under any partitioning.

    The rows of a group that come first in an order by hash are taken. Where the sample ends is found by counting, so no task sorts
    a group or gets as many rows as are drawn: two or three passes over the data whatever its size, the first of 65,536 slots per
    group, and ``few`` rows per group are ordered at the end. Rows alike in all columns are interchangeable. Groups not named are left out.
    """
    groups = {g: n for g, n in sizes.items()}
    hashed = df.filter(F.col(by).isin(*groups)).withColumn("_order", _order(df, key, seed))
    cuts = _cuts(hashed, by, groups, few)
    rows = [(g, *(c or ("g" * ALL_HEX, 0))) for g, c in cuts.items()]  # behind all hexadecimal digits
    ends = df.sparkSession.createDataFrame(rows, f"{by} string, _end string, _rest long")
    placed = hashed.join(F.broadcast(ends), by).withColumn("_own", F.expr("substring(_order, 1, length(_end))"))
    before = placed.filter(F.col("_own") < F.col("_end"))
    at_end = placed.filter((F.col("_own") == F.col("_end")) & (F.col("_rest") > 0))
    turn = F.row_number().over(Window.partitionBy(by).orderBy("_order"))
    ordered = at_end.filter(F.length("_end") < ALL_HEX).withColumn("_turn", turn).filter("_turn <= _rest")
    # the end lies among rows alike in all columns: one of them, as often as needed
    alike = at_end.filter(F.length("_end") == ALL_HEX).dropDuplicates([by]).withColumn("_turn", F.explode(F.expr("sequence(1, _rest)")))
    return before.select(*df.columns).unionByName(ordered.select(*df.columns)).unionByName(alike.select(*df.columns))


Draw = Callable[[DataFrame, float, int], DataFrame]


def by_hash(key: list[str]) -> Draw:
    """A way of drawing that does not depend on the partitioning."""
    return lambda df, fraction, seed: hash_sample(df, fraction, key, seed)


def split_samples(
    df: DataFrame, train: float = 0.01, valid: float = 0.05, test: float = 0.05, seed: int = 42, draw: Draw = sample
) -> dict[str, DataFrame]:
    """A sample of each split, with seeds that follow each other."""
    fractions = {"train": train, "valid": valid, "test": test}
    return {name: draw(of_split(df, name), fraction, seed + i) for i, (name, fraction) in enumerate(fractions.items())}


def dev_subset(valid_flights: DataFrame, years: list[int] = DEV_YEARS, draw: Draw = sample) -> DataFrame:
    """A small share of three years, for trying out features."""
    return draw(years_in(valid_flights, years), DEV_FRACTION, DEV_SEED)
