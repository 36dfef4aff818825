"""Exact token counts of whole texts, with huge documents encoded in overlapping chunks.

A document above ``huge_bytes`` is cut into chunks that overlap, and its chunks are spread over tasks. Each chunk is
encoded by itself with the offsets of its tokens. Two neighbours are spliced at a boundary in their overlap that both have
and that is proven stable: no vocabulary piece holds the two characters at its sides next to each other, so no merge can
ever cross it, whatever stands before or behind. (The usual case: a word's last letter and the blank behind it.) Where an
overlap has no such boundary, as in long runs without blanks, the document is cut again with a wider overlap, in the end
one that reaches to its end.

Defined results: a null or empty text has no tokens. Rows repeated are counted each. An empty table gives an empty
result. Other columns are not looked at. Special strings in a text are ordinary text, as the library takes them by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ontarmac.llm import common
from ontarmac.session import cut

HUGE_BYTES = 32_768
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
WIDEN = 4
BLANK = "▁"  # fixed value: what the library writes for a blank
_JOINT = "array<struct<p: bigint, k: bigint>>"
CHUNK_SCHEMA = f"row bigint, chunk bigint, chunks bigint, tokens bigint, opens {_JOINT}, closes {_JOINT}"


class PieceEncoder:
    """A sentencepiece BPE model with the lengths of its pieces and the character pairs that pieces hold."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.joined = {a + b for piece in pieces for a, b in zip(piece, piece[1:])}
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        for i, piece in enumerate(pieces):
            if self.model.is_byte(i):  # the first byte of a character counts for it
                self.lengths[i] = int(piece[3:5], 16) & 0xC0 != 0x80

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def boundaries(self, text: str) -> np.ndarray:
        """For each token the offset where it ends, without the blank the library puts in front."""
        return np.cumsum(self.lengths[self.model.encode(text)]) - 1

    def stable(self, before: str, behind: str) -> bool:
        pair = (before + behind).replace(" ", BLANK)
        return pair not in self.joined


def _joints(encoder: PieceEncoder, text: str, ends: np.ndarray, start: int, low: int, high: int, total: int) -> list[dict]:
    """Stable boundaries of a chunk between two places of its document, with the number of its tokens before each."""
    reach = start + len(text)
    inner = range(max(low, start) + 1, min(high, reach))
    places = [p for p in inner if encoder.stable(text[p - start - 1], text[p - start])]
    if reach == total and low <= total <= max(high, low):
        places.append(total)
    k = np.searchsorted(ends, np.array(places, np.int64) - start, side="right")
    found = set((ends + start).tolist())
    return [{"p": p, "k": int(n)} for p, n in zip(places, k) if p in found or p == total]


def _encode_chunks(path: str, chunk: int):
    schema = pa.schema(
        [(n, pa.int64()) for n in ("row", "chunk", "chunks", "tokens")]
        + [(n, pa.list_(pa.struct([("p", pa.int64()), ("k", pa.int64())]))) for n in ("opens", "closes")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, start, overlap, total = r["text"], r["chunk"] * chunk, r["overlap"], r["total"]
                ends = encoder.boundaries(text)
                head = _joints(encoder, text, ends, start, start, start + overlap, total) if r["chunk"] else []
                last = r["chunk"] == r["chunks"] - 1
                tail = [] if last else _joints(encoder, text, ends, start, start + chunk, start + chunk + overlap, total)
                rows.append({**{n: r[n] for n in ("row", "chunk", "chunks")}, "tokens": len(ends), "opens": head, "closes": tail})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _cut_chunks(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, overlap, text in zip(*(batch.column(c).to_pylist() for c in ("row", "overlap", "text"))):
                chunks = max(1, -(-len(text) // chunk))
                for i in range(chunks):
                    part = text[i * chunk : (i + 1) * chunk + overlap]
                    one = {"row": row, "overlap": overlap, "total": len(text), "chunk": i, "chunks": chunks, "text": part}
                    yield pa.RecordBatch.from_pylist([one])

    return run


def _spliced(chunks: DataFrame) -> DataFrame:
    """``row``, ``n_tokens`` and ``open``, the number of overlaps without a common stable boundary."""
    a = chunks.select("row", F.col("chunk").alias("i"), "tokens", "closes")
    b = chunks.filter("chunk > 0").select("row", (F.col("chunk") - 1).alias("i"), "opens")
    common_places = F.array_intersect(F.transform("closes", lambda x: x["p"]), F.transform("opens", lambda x: x["p"]))
    joints = a.join(b, ["row", "i"], "left").withColumn("p", F.get(F.array_sort(common_places), F.lit(0)))

    def tokens_before(side: str):
        return F.get(F.filter(side, lambda x: x["p"] == F.col("p")), F.lit(0))["k"]

    last = F.col("opens").isNull()  # the chunk with nothing behind it
    return joints.select(
        "row",
        F.when(last, F.col("tokens")).otherwise(tokens_before("closes") - tokens_before("opens")).alias("own"),
        (~last & F.col("p").isNull()).alias("open"),
    ).groupBy("row").agg(F.sum("own").alias("n_tokens"), F.count_if("open").alias("open"))


def huge_counts(rows: DataFrame, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``row`` and ``n_tokens`` of documents (``row``, ``text``) that are encoded in chunks."""
    todo, done = rows.select("row", "text"), None
    while True:
        cuts = todo.select("row", F.lit(overlap).cast("long").alias("overlap"), "text").mapInArrow(
            _cut_chunks(chunk), "row long, overlap long, total long, chunk long, chunks long, text string"
        )
        encoded = cut(cuts.repartition("row", "chunk").mapInArrow(_encode_chunks(path, chunk), CHUNK_SCHEMA))
        spliced = cut(_spliced(encoded))
        found = spliced.filter("open = 0").select("row", "n_tokens")
        done = found if done is None else done.unionByName(found)
        left = spliced.filter("open > 0").select("row")
        if left.isEmpty():
            return done
        todo, overlap = todo.join(left, "row", "left_semi"), overlap * WIDEN


def count_tokens(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    huge_bytes: int = HUGE_BYTES,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_bytes`` and ``n_tokens`` as the model at ``path`` gives them for the whole text."""
    rows = common.two_columns(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = common.id_type(docs, id_col)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                found = pa.array(encoder.counts(part.column("text").to_pylist()), pa.int64())
                yield part.drop_columns(["text"]).append_column("n_tokens", found)

    small = rows.filter(F.col("n_bytes") <= huge_bytes).select("id", "n_bytes", "text")
    counted = small.mapInArrow(plain, f"id {kind}, n_bytes long, n_tokens long")
    huge = cut(rows.filter(F.col("n_bytes") > huge_bytes).withColumn("row", F.monotonically_increasing_id()))
    spliced = huge.select("row", "id", "n_bytes").join(huge_counts(huge, path, chunk, overlap), "row")
    return counted.unionByName(spliced.select("id", "n_bytes", "n_tokens"))
