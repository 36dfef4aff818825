"""How five document filters interact, counted by a stream that takes its earlier counts back.

Filters, each a condition a document fails by: ``A`` fewer than 200 words; ``B`` distinct words under half of the words; ``C``
more than 2 % of the code points in A-Z; ``D`` any of ``#$%&*|``; ``E`` a text that a smaller id has anywhere in the table. A
document's mask says which it fails, and everything asked for follows from the counts of documents per part, mask and label.

The files are processed as micro-batches of an available-now stream. Tasks reduce texts to masks and digests, and rows of
one text within a slice to its smallest ids; what is left over fails ``E`` whatever else comes and is counted at once. The
others go to a state keyed by text, which holds the rows of the smallest id so far. These count as not failing ``E``. When a smaller id
arrives later, they are taken back (a count of -1) and counted anew as failing, and the new ones take their place. Texts
share a state row by a hash of their digests, about ``TEXTS_PER_BUCKET`` of the first run's in a row, as calling Python costs more than a
text does; a row is written anew once per micro-batch. Each
micro-batch writes the sum of its changes as a folder of its own, which a repeated batch replaces; the part counters are the
sums over the folders. State and progress are kept below the checkpoint folder, so a lost executor or driver resumes.

Defined results: a null text is empty, a null part the empty string. Null ids are larger than all numbers: they fail ``E`` if
a row with an id has their text, and have no labels. Rows that share the smallest id and a text do not fail ``E``, all of them.
Several labels of an id count as one that has what any of them has. An empty table has no parts and gives no rows. Other
columns are not looked at. Texts are looked at whole, however long.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from itertools import combinations, permutations
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ontarmac.llm import common
from ontarmac.session import scratch_path
from ontarmac.sources.storage import Folder

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
MICRO_BATCHES = 4
# fixed values of the filters
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 2
MARKS = re.compile(rb"[#$%&*|]")

TEXTS_PER_BUCKET = 4096
LEAST_BUCKETS = 64

_SEEN = "digest binary, id {}, part string, mask int, n long"
_CHANGE = "part string, mask int, good int, toxic int, n long"


# --- masks -----------------------------------------------------------------------------------------


def mask(text: bytes) -> int:
    """The filters ``A`` to ``D`` that a text fails, as bits."""
    words = text.split()
    points = len(text.decode())
    capitals = len(text) - len(text.translate(None, common.UPPER.encode()))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        MARKS.search(text) is not None,
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def _seen(id_kind: pa.DataType):
    """Rows as digest, id, part and mask, equal ones counted."""
    schema = pa.schema(
        [("digest", pa.binary()), ("id", id_kind), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, int] = {}
            for i, part, text in zip(*(batch.column(c) for c in ("id", "part", "text"))):
                body = text.as_py().encode()
                key = (hashlib.sha256(body).digest(), i.as_py(), part.as_py(), mask(body))
                counts[key] = counts.get(key, 0) + 1
            columns = [*zip(*counts), list(counts.values())] if counts else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``digest`` of the text, ``id``, ``part``, ``mask`` and the number ``n`` of such rows met together."""
    kind = common.id_type(docs, id_col)
    text, part = (F.coalesce(docs[c].cast("string"), F.lit("")) for c in (text_col, part_col))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text"), part.alias("part"))
    return rows.mapInArrow(_seen(_arrow(kind)), _SEEN.format(kind))


def _arrow(kind: str) -> pa.DataType:
    kinds = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}
    if kind not in kinds:
        raise TypeError(f"ids are whole numbers, not {kind}")
    return kinds[kind]


# --- state per text --------------------------------------------------------------------------------


def _order(doc_id: str | None) -> float | int:
    return math.inf if doc_id is None else int(doc_id)


_ROW = [("digest", pa.binary()), ("id", pa.string()), ("part", pa.string()), ("mask", pa.int32()), ("good", pa.int32()),
        ("toxic", pa.int32()), ("n", pa.int64())]
_KEPT = "bucket int, digest binary, id string, part string, mask int, good int, toxic int, n long"


def _slice_firsts(buckets: int):
    """Of the rows of a text in a slice those of the smallest id, with the text's bucket; the others are counts of documents failing ``E``.

    Counts have no digest.
    """
    schema = pa.schema([("bucket", pa.int32()), *_ROW])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(name).to_pylist() for name, _ in _ROW)))
            smallest: dict[bytes, float | int] = {}
            for digest, doc_id, *_ in rows:
                smallest[digest] = min(smallest.get(digest, math.inf), _order(doc_id))
            kept, rest = [], {}
            for row in rows:
                digest, doc_id, part, failed, good, toxic, n = row
                if _order(doc_id) == smallest[digest]:
                    kept.append((int.from_bytes(digest[:8], "big") % buckets, *row))
                else:
                    key = (crc32(part.encode()) % buckets, None, None, part, failed | REPEATED, good, toxic)
                    rest[key] = rest.get(key, 0) + n
            kept.extend((*key, n) for key, n in rest.items())
            columns = zip(*kept) if kept else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


class Texts:
    """The rows of the smallest id of each text, and what new rows change in the part counters."""

    def __init__(self, held: str | None):
        #: per digest: id, mask, good, toxic, and rows per part
        self.held: dict[str, list] = json.loads(held) if held else {}
        self.counts: dict[tuple, int] = {}

    def count(self, part: str, failed: int, good: int, toxic: int, n: int) -> None:
        at = (part, failed, good, toxic)
        self.counts[at] = self.counts.get(at, 0) + n

    def add(self, digest: str, doc_id: str | None, part: str, failed: int, good: int, toxic: int, n: int) -> None:
        held = self.held.get(digest)
        if held is not None and _order(doc_id) > _order(held[0]):
            self.count(part, failed | REPEATED, good, toxic, n)
            return
        if held is None or _order(doc_id) < _order(held[0]):
            if held is not None:  # take back what was said of the larger id
                _, _, old_good, old_toxic, rows = held
                for old, m in rows.items():
                    self.count(old, failed, old_good, old_toxic, -m)
                    self.count(old, failed | REPEATED, old_good, old_toxic, m)
            held = self.held[digest] = [doc_id, failed, good, toxic, {}]
        held[4][part] = held[4].get(part, 0) + n
        self.count(part, failed, good, toxic, n)


def _changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the rows of a bucket's texts change in the part counters."""
    texts = Texts(state.get[0] if state.exists else None)
    for rows in batches:
        for digest, *row in rows[[name for name, _ in _ROW]].itertuples(index=False, name=None):
            if digest is None:
                texts.count(*row[1:])
            else:
                texts.add(bytes(digest).hex(), *row)
    if texts.held:
        state.update((json.dumps(texts.held),))
    changed = [(*at, n) for at, n in texts.counts.items() if n]
    if changed:
        yield pd.DataFrame(changed, columns=["part", "mask", "good", "toxic", "n"])


def _labelled(seen: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """``good`` and ``toxic`` of each row; null ids are spread, as nothing joins them."""
    known = labels.groupBy(labels[id_col].alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = known.select(F.col("id").alias("own"), F.lit(0).alias("place"), "good", "toxic")
    place = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1 << 20))).otherwise(0).cast("int")
    match = (F.col("id") == F.col("own")) & (F.col("spread") == F.col("place"))
    joined = seen.withColumn("spread", place).join(known.hint("merge"), match, "left")
    return joined.select(
        "digest", F.col("id").cast("string").alias("id"), "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "n"
    )


def part_counters(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    micro_batches: int = MICRO_BATCHES,
    checkpoint: str | None = None,
    target: str | None = None,
) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and the number ``n`` of such documents in the Parquet files of ``path``.

    The session's state store is used (``spark.sql.streaming.stateStore.providerClass``): RocksDB where the digests of all texts, about
    150 bytes each, exceed the executors' memory. With a ``checkpoint`` and a ``target`` of its own a later call goes on with the files that have come since, taking back what they
    overrule; else all files are counted from the start.
    """
    checkpoint, target = checkpoint or scratch_path(spark, "audit-state"), target or scratch_path(spark, "audit-counts")
    listed = spark.read.parquet(path)
    kind = common.id_type(listed, id_col)
    files = max(1, math.ceil(len(listed.inputFiles()) / micro_batches))
    # a pattern, because a stream takes a plain path for a folder, and a table may be one file
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(listed.schema).option("maxFilesPerTrigger", files).parquet(pattern)
    seen = _labelled(masks(stream, id_col, text_col, part_col), labels, id_col)
    # the number of buckets is that of the first run with this target
    wanted = max(LEAST_BUCKETS, math.ceil(listed.count() / TEXTS_PER_BUCKET))
    folder = Folder(spark, target)
    folder.publish("_buckets", str(wanted))
    kept = seen.mapInArrow(_slice_firsts(int(folder.read("_buckets"))), _KEPT)
    changes = kept.groupBy("bucket").applyInPandasWithState(
        _changes, _CHANGE, "held string", "update", GroupStateTimeout.NoTimeout
    )

    # so that there is a table even before the first batch
    spark.createDataFrame([], _CHANGE).write.mode("overwrite").parquet(f"{target}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        sums.write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    written = spark.read.schema(f"{_CHANGE}, batch long").parquet(target)
    return written.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).filter("n != 0")


# --- orders of the filters -------------------------------------------------------------------------


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """Every order of the filters and step: the order, the step, the bits of the filters before, the bit of the step's own."""
    bit = {f: 1 << i for i, f in enumerate(filters)}
    return [
        ("".join(order), k + 1, sum(bit[f] for f in order[:k]), bit[order[k]])
        for order in permutations(filters)
        for k in range(len(filters))
    ]


def audit(counters: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from the counters alone.

    What a filter does depends on the set of filters before it, so each set and filter is counted once (80 for five
    filters) and given to all orders that pass through it.
    """
    spark, k = counters.sparkSession, len(filters)
    steps = [
        (sum(1 << j for j in chosen), 1 << i, math.factorial(size) * math.factorial(k - 1 - size))
        for i in range(k)
        for size in range(k)
        for chosen in combinations([j for j in range(k) if j != i], size)
    ]
    literal = F.array(*[F.struct(F.lit(b).alias("before"), F.lit(o).alias("own"), F.lit(w).alias("ways")) for b, o, w in steps])
    rows = counters.select("*", F.explode(literal).alias("s")).select("*", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition, name: str):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(name)

    removed = fails & ~gone
    per_step = rows.groupBy("part", "before", "own", "ways").agg(
        total(~fails & ~gone, "kept"),
        total(removed, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("mask") == F.col("own"), "unique_fails"),
        total(removed & (F.col("good") == 1), "good_lost"),
        total(removed & (F.col("toxic") == 1), "toxic_lost"),
    )
    shapley = per_step.groupBy("part", "own").agg(F.sum(F.col("removed") * F.col("ways")).alias("shapley"))
    both = per_step.join(shapley, ["part", "own"])
    named = spark.createDataFrame(orders(filters), "filter_order string, step int, before int, own int")
    # 600 rows for five filters, whatever the corpus
    return both.join(F.broadcast(named), ["before", "own"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
