"""Incremental ingest of newly landed page files.

Which files are done is kept in the stream's checkpoint, which rows are known in
the raw table, and pages wait in the landing folder until all that page 1 announces are there.
A micro-batch that is run again finds its rows known, so the result equals that of batch
ingest and needs no other state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest_job import ingest
from ..session import scratch
from ..sources.pages import accepted_pages, explode_rows, page_policy, parse_pages, read_landing, stream_landing
from ..sources.tables import drop, stored


def ingest_stream(spark: SparkSession, landing: str, raw_path: str, checkpoint: str,
                  stamp: Callable[[int], datetime] | None = None,
                  files_per_batch: int | None = None) -> StreamingQuery:
    """Take in what has landed since the last call, then stop.

    An indicator with newly landed files is judged by the page policy over all its pages, read
    from its own folders. It is taken in once every announced page is there and usable; until then it
    waits, and a late or repeated page brings it up again. Other indicators are not held up by it.
    """
    def take(pages: DataFrame, epoch: int) -> None:
        session = pages.sparkSession
        codes = [r[0] for r in pages.select("code").distinct().collect()]      # names of indicators
        landed = read_landing(session, landing).filter(F.col("code").isin(codes))
        workspace = scratch(session, "stream-pages")
        try:
            parsed = stored(parse_pages(landed), workspace)
            rows = explode_rows(accepted_pages(parsed, page_policy(parsed)))
            if not rows.isEmpty():
                ingest(session, rows, raw_path, stamp(epoch) if stamp else None)
        finally:
            drop(session, workspace)

    return (stream_landing(spark, landing, files_per_batch).writeStream
            .foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
