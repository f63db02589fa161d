"""Landed page files: one JSON text per page, ``[about, rows]``.

Layout below the landing folder: ``code=<indicator>/page=<n>/<file>``, so the code
and the page number are known even when the text is broken. A page is a bounded
unit (the source limits its size); pages spread over tasks, rows are exploded there.
Where very many pages land at once they may come in bundles: files of a folder without
page number, each with some pages, a line ``{"page": n, "body": text}`` for each. A
broken line spoils its own page only. Both layouts may lie beside each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R
from ..schemas import ENTITY, OBSERVATION
from ..session import few_listing_tasks

PAGE_FILE = T.StructType([
    T.StructField("body", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("page", T.IntegerType()),
])


# Pages of a bundle: a few MB, one file instead of a folder and a file for each.
BUNDLE_PAGES = 200


def land_bundles(pages: DataFrame, path: str, most: int = BUNDLE_PAGES) -> None:
    """Land (code, page, body) as bundles of at most ``most`` pages."""
    bundles = pages.select(F.to_json(F.struct("page", "body")).alias("value"), "code", F.lit(None).cast("int").alias("page"))
    (bundles.hint("rebalance", F.col("code")).write.partitionBy("code", "page").option("maxRecordsPerFile", most)
     .mode("append").text(path))


def _unbundled(files: DataFrame, *more: str) -> DataFrame:
    """The pages of landed files; a file with a page number is one page."""
    bundle = F.col("page").isNull()
    texts = F.when(bundle, F.filter(F.split("body", "\n"), lambda line: line != "")).otherwise(F.array("body"))
    entry = F.when(bundle, F.from_json("_text", "page int, body string"))
    return files.select("code", "page", *more, F.explode(texts).alias("_text")).withColumn("_entry", entry).select(
        "code", F.coalesce("page", "_entry.page").alias("page"), *more,
        F.when(bundle, F.col("_entry.body")).otherwise(F.col("_text")).alias("body"))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """(code, page, body) of every landed page; of files of one page the newest (by path, if equally old)."""
    few_listing_tasks(spark)
    files = spark.read.schema(PAGE_FILE).text(path, wholetext=True)
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("_landed")
    return _unbundled(files.select("*", landed), "_landed").groupBy("code", "page").agg(
        F.max_by("body", "_landed").alias("body"))


def stream_landing(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(code, page, text) of landed files as a stream: each micro-batch holds those landed since the last, bundles
    unopened."""
    few_listing_tasks(spark)
    reader = spark.readStream.schema(PAGE_FILE).format("text").option("wholetext", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("code", "page", "body")


def parse_pages(pages: DataFrame, row_schema: T.StructType = OBSERVATION) -> DataFrame:
    """Add is_valid, announced, pages and rows; an unusable text only fails its own page.

    Valid: JSON, an array of at least two elements, an object first, second an array of objects.
    """
    doc = F.try_parse_json("body")
    items = F.try_variant_get(F.col("_doc"), "$", "array<variant>")
    about = F.try_variant_get(F.col("_doc"), "$[0]", "map<string,variant>")
    objects = F.try_variant_get(F.col("_doc"), "$[1]", "array<map<string,variant>>")
    valid = F.coalesce(
        (F.size(items) >= 2) & about.isNotNull() & F.forall(objects, lambda x: x.isNotNull()),
        F.lit(False))
    rows = F.try_variant_get(F.col("_doc"), "$[1]", f"array<{row_schema.simpleString()}>")
    rows = F.when(F.col("is_valid"), F.coalesce(rows, F.array().cast(f"array<{row_schema.simpleString()}>")))
    parsed = pages.withColumn("_doc", doc).withColumn("is_valid", valid).withColumn("rows", rows)

    def number(field: str) -> Column:
        return F.try_variant_get(F.col("_doc"), f"$[0].{field}", "bigint")

    return parsed.withColumns({
        "announced": F.when(F.col("is_valid"), F.coalesce(number("total"), F.size("rows").cast("bigint"))),
        "page_count": F.when(F.col("is_valid"), F.coalesce(number("pages"), F.lit(1).cast("bigint"))),
    }).drop("_doc", "body")


def page_policy(pages: DataFrame) -> DataFrame:
    """Verdict per indicator from its page flags: (code, status, bad_pages, announced_pages).

    skipped   page 1 is missing or unusable: leave the indicator out, go on
    failed    a later page announced by page 1 is missing or unusable: stop the run
    accepted  all announced pages are there
    """
    valid = F.col("is_valid")
    by_page = pages.groupBy("code", "page").agg(
        F.max(valid).alias("is_valid"), F.max(F.when(valid, F.col("page_count"))).alias("page_count"))
    first = (by_page.filter((F.col("page") == 1) & valid)
             .select("code", F.col("page_count").alias("_wanted")))
    # pages beyond the announced number are never asked for and do not count
    good = F.count_if(valid & (F.col("page") <= F.col("_wanted")))
    return by_page.join(first, "code", "left").groupBy("code", "_wanted").agg(
        good.alias("_good"), F.count_if(~valid).alias("bad_pages")).select(
        "code",
        F.when(F.col("_wanted").isNull(), "skipped")
        .when(F.col("_good") < F.col("_wanted"), "failed").otherwise("accepted").alias("status"),
        "bad_pages", F.col("_wanted").alias("announced_pages"))


def accepted_pages(parsed: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The announced pages of the accepted indicators."""
    wanted = verdicts.filter(F.col("status") == "accepted").select("code", "announced_pages")
    return parsed.join(wanted, "code").filter(F.col("page") <= F.col("announced_pages")).drop("announced_pages")


def explode_rows(parsed: DataFrame) -> DataFrame:
    """The rows of all valid pages, in the schema of the source."""
    return parsed.filter("is_valid").select(F.explode("rows").alias("_row")).select("_row.*")


def completeness(parsed: DataFrame) -> DataFrame:
    """Announced and received rows per indicator; a mismatch is a warning, not an error."""
    announced = F.max(F.when(F.col("page") == 1, F.col("announced")))
    return (
        parsed.filter("is_valid").groupBy("code")
        .agg(announced.alias("announced"), F.sum(F.size("rows")).cast("bigint").alias("received"))
        .withColumn("complete", F.col("announced") == F.col("received"))
    )


def entity_metadata(rows: DataFrame) -> DataFrame:
    """Flat metadata of published entities; the aggregates are marked as such."""
    region = F.col("region.value")
    kind = F.when(region.eqNullSafe(F.lit(R.AGGREGATES_REGION)), R.ENTITY_AGGREGATE).otherwise(R.ENTITY_COUNTRY)
    return rows.select(
        F.col("id").alias("countryiso3code"),
        F.col("name").alias("country_name"),
        region.alias("region"),
        F.col("incomeLevel.value").alias("income_level"),
        kind.alias("type_entite"),
    )


def read_entities(pages: DataFrame) -> DataFrame:
    """Entity pages to flat metadata."""
    return entity_metadata(explode_rows(parse_pages(pages, ENTITY)))
