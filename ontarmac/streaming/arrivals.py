"""Incremental landing: each run takes the archives that have arrived since the last."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ontarmac.plans import landing


def land_arrivals(
    spark: SparkSession,
    input_dir: str,
    output_root: str,
    checkpoint: str,
    start: str | None = None,
    end: str | None = None,
    overwrite: bool = False,
) -> None:
    """Land all archives not seen by earlier runs, then stop.

    The checkpoint remembers which files were taken. A batch repeated after a failure writes whole months
    again, so no rows are lost or doubled. Months already landed are skipped, or replaced with ``overwrite``. Archives
    outside the bounds count as seen; without bounds all are landed.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.zip")
        .load(input_dir)
    )

    def land_batch(batch, _batch_id: int) -> None:
        landing.land_files(batch, output_root, start, end, overwrite)

    stream = (
        files.select("path", "length")
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
