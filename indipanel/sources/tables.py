"""Stored tables: scan, batch append with rollback, replace, partition replace.

An appended table is a folder of batches. A replaced table is a folder of versions: data lie in
``version=<id>`` and are never changed, and a commit below ``_commits`` names the folders that make up the
table. A write becomes visible by one commit, an interrupted one by none, so at any moment there is
the old table or the new one. Partitions that a write does not touch keep their files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a stored table; nothing happens when there is none."""
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, hidden things included."""
    fs, p = _folder(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def commits(spark: SparkSession, path: str) -> list[str]:
    """Names of the commits of a replaced table, oldest first."""
    return [c for c in _children(spark, f"{path.rstrip('/')}/_commits") if not c.startswith((".", "_"))]


def folders(spark: SparkSession, path: str, commit: str | None = None) -> list[str]:
    """The folders that make up a replaced table, relative to it, as of a commit (default: the last); none if there
    is no commit."""
    names = commits(spark, path)
    if not names:
        return []
    fs, p = _folder(spark, f"{path.rstrip('/')}/_commits/{commit or names[-1]}")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, named: list[str]) -> None:
    """Make the folders the table. The commit is written aside and gets its name in one step.

    Folders that neither this nor the last commit names are removed: a reader of the table as it was
    before still finds its files.
    """
    done = commits(spark, path)
    before = folders(spark, path) if done else []
    number = int(done[-1].split("-")[0]) + 1 if done else 0
    name = f"{number:010d}-{uuid.uuid4().hex}"
    fs, aside = _folder(spark, f"{path}/_commits/.{name}")
    stream = fs.create(aside)
    try:
        stream.write(json.dumps(sorted(named)).encode())
    finally:
        stream.close()
    if not fs.rename(aside, _folder(spark, f"{path}/_commits/{name}")[1]):
        raise OSError(f"commit of {path} failed")
    kept = {f.split("/")[0] for f in [*named, *before]}
    for child in _children(spark, path):
        if child.startswith("version=") and child not in kept:
            drop(spark, f"{path}/{child}")
    for old in done[:-1]:
        drop(spark, f"{path}/_commits/{old}")


def scan(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """A stored table with its declared schema; empty when nothing is stored yet."""
    path = path.rstrip("/")
    named = folders(spark, path)
    reader = spark.read.schema(schema)
    if named:
        df = reader.option("basePath", path).parquet(*[f"{path}/{f}" for f in named])
    elif exists(spark, path) and not exists(spark, f"{path}/_commits"):
        df = reader.parquet(path)
    else:
        df = spark.createDataFrame([], schema)
    return df.select(*(columns or schema.fieldNames()))


def unused_batch_id(spark: SparkSession, path: str, batch_id: str) -> str:
    """The id itself, or with the first free number behind it if a batch is or was stored under it."""
    free, n, path = batch_id, 1, path.rstrip("/")
    while exists(spark, f"{path}/batch_id={free}") or exists(spark, f"{path}_hashes/_indexed/{free}"):
        free, n = f"{batch_id}_{n}", n + 1
    return free


def append_batch(df: DataFrame, path: str) -> None:
    """Append one batch as its own partition; a failed write leaves nothing behind.

    The batch must carry a single ``batch_id``, passed on to the partition folder.
    """
    df.write.partitionBy("batch_id").mode("append").parquet(path)


def rollback_batch(spark: SparkSession, path: str, batch_id: str) -> bool:
    """Remove a batch by removing its partition; other batches are not touched."""
    fs, p = _folder(spark, f"{path.rstrip('/')}/batch_id={batch_id}")
    return bool(fs.exists(p)) and bool(fs.delete(p, True))


def without_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """The rows that survive the rollback of a batch."""
    return df.filter(~F.col("batch_id").eqNullSafe(F.lit(batch_id)))


def _write_version(df: DataFrame, path: str, partition_by: list[str] | None, sort_by: list[str] = ()) -> str:
    """The rows in a new folder of the table, seen by nobody before a commit names it."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    version = f"version={uuid.uuid4().hex}"
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{path}/{version}")
    except Exception:
        drop(df.sparkSession, f"{path}/{version}")
        if _children(df.sparkSession, path) == []:
            drop(df.sparkSession, path)
        raise
    return version


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] = ()) -> None:
    """Replace all rows by one commit; a failed write leaves the table as it is.

    Partitioned tables are rebalanced by their partition columns: few files per
    folder, while a large partition is still split over several tasks.

    sort_by  order of the rows within a file, so that readers skip parts of it
    """
    path = path.rstrip("/")
    _commit(df.sparkSession, path, [_write_version(df, path, partition_by, sort_by)])


def _partition_folders(spark: SparkSession, path: str, named: list[str], depth: int) -> dict[str, str]:
    """Partition -> folder of a replaced table."""
    out = {}
    for folder in named:
        found = [folder]
        while found and found[0].count("/") < depth:
            found = [f"{f}/{c}" for f in found for c in _children(spark, f"{path}/{f}") if "=" in c]
        out |= {f.split("/", 1)[1]: f for f in found}
    return out


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df``, by one commit; the files of all others stay."""
    spark, path = df.sparkSession, path.rstrip("/")
    version = _write_version(df, path, partition_by)
    depth = len(partition_by)
    now = _partition_folders(spark, path, folders(spark, path), depth)
    _commit(spark, path, list((now | _partition_folders(spark, path, [version], depth)).values()) or [version])


def stored(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table and give back a scan of it: the lineage ends at the files."""
    schema = df.schema
    replace_table(df, path, partition_by)
    return scan(df.sparkSession, path, schema)
