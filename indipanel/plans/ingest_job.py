"""Ingest of one batch into the raw table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import latest_hashes, only_new, recent_hashes, stamp_batch, with_row_hash
from ..operators.staging import one_per_entity
from ..schemas import RAW
from ..session import instant, scratch, utc
from ..sources.hash_index import index_batches, known_hashes
from ..sources.pages import accepted_pages, completeness, explode_rows, page_policy, parse_pages, read_entities
from ..sources.tables import append_batch, drop, replace_table, rollback_batch, scan, stored, unused_batch_id

OBSERVATION_KEYS = ["country.value", "date", "indicator.id"]


class NoData(ValueError):
    """Nothing usable was landed."""


class IncompleteIndicator(RuntimeError):
    """A page that page 1 announced is missing or unusable."""


def accepted_rows(spark: SparkSession, pages: DataFrame, workspace: str | None = None) -> tuple[DataFrame, dict]:
    """Rows of the accepted indicators, with the indicators that gave a warning.

    The parsed pages are written once below the workspace folder: policy,
    completeness and rows all use them. The verdicts, one row per indicator, are
    written too, so that Spark knows their size when it joins them.
    """
    workspace = workspace or scratch(spark, "pages")
    parsed = stored(parse_pages(pages), f"{workspace}/parsed")
    verdicts = stored(page_policy(parsed), f"{workspace}/verdicts")

    def codes(df: DataFrame) -> list[str]:
        return [r["code"] for r in df.select("code").orderBy("code").collect()]

    failed = codes(verdicts.filter(F.col("status") == "failed"))
    if failed:
        raise IncompleteIndicator(f"pages missing or unusable for: {', '.join(failed)}")
    kept = accepted_pages(parsed, verdicts)
    rows = explode_rows(kept)
    if rows.isEmpty():
        raise NoData("no row was landed for any indicator")
    return rows, {
        "skipped": codes(verdicts.filter(F.col("status") == "skipped")),
        "incomplete": codes(completeness(kept).filter(~F.col("complete")))}


def replace_metadata(spark: SparkSession, entity_pages: DataFrame, path: str) -> bool:
    """Replace the entity metadata, kept to one row per code; whether anything in it has changed."""
    workspace = scratch(spark, "metadata")
    try:
        new = stored(one_per_entity(read_entities(entity_pages)), workspace)
        old = scan(spark, path, new.schema)
        if new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty():
            return False
        replace_table(new, path)
        return True
    finally:
        drop(spark, workspace)


def ingest(spark: SparkSession, rows: DataFrame, raw_path: str, stamp: datetime | None = None,
           lookback: int | None = None, compare_to: str = "seen") -> dict:
    """Append the unseen rows as one batch; nothing is left behind on failure.

    compare_to  'seen': against every stored hash, so a value that goes back to an
                earlier one counts as known; 'latest': against current versions only.

    The hashed batch is written to the shared scratch folder first: it is read by the
    hash count and by the joins, and must not be fetched and parsed again for each. Of the
    stored hashes only the folders of the batch's indicators and years are read.
    """
    stamp = utc(stamp)
    # Never the folder of an earlier load, so that a rollback removes only what this load wrote.
    batch_id = unused_batch_id(spark, raw_path, stamp.strftime("%Y%m%d_%H%M%S_%f"))
    table = scan(spark, raw_path, RAW)
    workspace = scratch(spark, "batch")
    try:
        batch = stored(with_row_hash(rows), workspace)
        received = batch.count()
        if compare_to == "latest":
            seen = latest_hashes(table, OBSERVATION_KEYS)
        else:
            seen = known_hashes(spark, raw_path, batch) if lookback is None else recent_hashes(table, lookback)
        new = stamp_batch(only_new(batch, seen, batch_rows=received), instant(stamp), F.lit(batch_id))
        append_batch(new.select(*RAW.fieldNames()), raw_path)
    except Exception:
        rollback_batch(spark, raw_path, batch_id)
        raise
    finally:
        drop(spark, workspace)
    index_batches(spark, raw_path)
    inserted = scan(spark, raw_path, RAW).filter(F.col("batch_id") == batch_id).count()
    return {"batch_id": batch_id, "received": received, "inserted": inserted}
