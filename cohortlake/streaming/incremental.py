"""Incremental landing: a file stream says when to look, the manifest says what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cohortlake.plans.landing import Lake, Source

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start_landing(lake: Lake, source: Source, checkpoint: str) -> StreamingQuery:
    """Land what is new below ``source.path`` whenever files arrive, and stop.

    A stream knows paths, and takes each once. What a load takes is the listing without the contents
    of the manifest. So a file that was too young comes with a later batch, new bytes under an old
    name are landed, a known content under a new name is not, and a batch replayed after a lost
    driver changes nothing. The stream reads names only.
    """

    def land(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            lake.load(source, distinct_content=True)

    stream = (
        lake.spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", str(source.recursive).lower())
        .load(source.path)
        .select("path")
    )
    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_available(lake: Lake, source: Source, checkpoint: str) -> None:
    """One round: the stream's batches, or one load where no path is new.

    The load without a batch is for files the stream has seen before: deferred ones that have
    settled, and ones rewritten in place.
    """
    query = start_landing(lake, source, checkpoint)
    query.awaitTermination()
    if not any(p["numInputRows"] for p in query.recentProgress):
        lake.load(source, distinct_content=True)
