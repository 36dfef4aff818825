"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word is a run of anything but these; ``bytes.split()`` splits at exactly these.
BLANKS = " \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_ROWS = 256


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``text`` alone, so that other columns can have any names; a null text is empty."""
    return df.select(
        df[id_col].alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text")
    )


def id_type(df: DataFrame, id_col: str) -> str:
    kind: DataType = df.schema[id_col].dataType
    return kind.simpleString()


def per_text(fn: Callable[[list[str]], dict[str, list]], types: dict[str, pa.DataType]) -> Callable:
    """A ``mapInArrow`` function: the id and what ``fn`` gives for its text, a few hundred rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = fn(part.column("text").to_pylist())
                arrays = [part.column("id"), *(pa.array(found[name], kind) for name, kind in types.items())]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", *types])

    return run


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_digest(text: Column, fold: bool = False) -> Column:
    """SHA-256 of a text, null as empty; with ``fold`` of the text with A-Z lower-cased. Computed where the rows are."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.translate(text, UPPER, LOWER) if fold else text, 256))


def lowest(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """The ``n`` rows whose keys hash lowest, or all as they are; keys should not repeat much.

    Rows are counted first, and only those under a hash that leaves little more than ``n`` are sorted, so that no task is sent
    ``n`` rows from each of many others.
    """
    total = rows.count()
    if total <= n:
        return rows
    place = F.xxhash64(*key)
    if total > 2 * n:
        few = rows.filter(place < min(2**63 - 1, int(-(2**63) + 2**64 * ((1.25 * n + 100) / total))))
        if few.count() >= n:
            rows = few
    return rows.orderBy(place, *key).limit(n)


def keep_rows(
    docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: bool = False
) -> DataFrame:
    """One row of ``docs`` per row of ``kept`` (``id``, ``digest`` of :func:`text_digest`, ``many``), null ids matching null.

    The decision is per id and text, so rows that share an id only are told apart. ``many`` marks what several rows of
    ``docs`` have in common; of these the one with the smallest text stays, texts that differ in case being one digest.
    """
    digest = text_digest(docs[text_col], fold)
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs[id_col].alias("own"), digest.alias("mark"))
    # what is kept grows with the documents, so it is not broadcast even while it is little
    match = (F.col("mark") == F.col("digest")) & F.col("own").eqNullSafe(F.col("id"))
    found = marked.join(kept.hint("merge"), match).select("doc", "mark", "many")
    if kept.filter("many").isEmpty():
        return found.select("doc.*")
    # one digest is kept under one id only, so the digest is the key
    text = F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit(""))
    once = found.filter("many").groupBy("mark").agg(F.min_by("doc", text).alias("doc"))
    return found.filter("not many").select("doc.*").unionByName(once.select("doc.*"))
