"""Rows go to Python in small batches, and a text that is kept goes once."""

import pyarrow as pa
import pytest

pytest.importorskip("indipanel.llm")

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from indipanel.llm import toxicity  # noqa: E402
from indipanel.llm.common import map_texts  # noqa: E402
from indipanel.session import small_batches  # noqa: E402

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def no_limit(spark):
    before = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.unset(LIMIT) if before is None else spark.conf.set(LIMIT, before)


def test_batches_stay_small(spark, no_limit):
    def held():
        """How many bytes the batch of a text has in its text column."""
        return lambda texts: [pa.array([texts.buffers()[2].size] * len(texts), pa.int64())]

    docs = spark.range(4000).coalesce(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"))
    done = map_texts(docs, "text", [T.StructField("held", T.LongType())], held, ["doc_id"]).collect()
    assert len(done) == 4000 and max(r["held"] for r in done) < 2 << 20


def test_a_limit_of_the_session_stays(spark, no_limit):
    spark.conf.set(LIMIT, "1m")
    small_batches(spark)
    assert spark.conf.get(LIMIT, None) == "1m"


def test_a_kept_text_is_sent_once(spark):
    rows = [(k, None if k == 3 else "nasty vile" if k % 3 else "kind warm", f"s{k % 2}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(60)], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [r for r in rows if not r[0] % 3]
    assert "_text" not in kept._jdf.queryExecution().optimizedPlan().toString()
