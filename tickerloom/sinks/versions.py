"""Full replacement of a table as a commit (row K3): a new version folder, then one small file that makes it current.

`path` holds `version-<id>` folders and `_commits/<number>`, files with the name of a version each. Readers take the
commit with the highest number, so they see one whole version; a load that fails leaves no commit and the version
before it stays. A commit file is created, never overwritten: of two loads at once the second fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version folder) of every commit, oldest first; their number is that of loads, not of rows."""
    where, files = _files(spark, f"{path}/_commits")
    if not files.exists(where):
        return []
    out = []
    for status in files.listStatus(where):
        stream = files.open(status.getPath())
        try:
            out.append((int(status.getPath().getName()), bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
    return sorted(out)


def replace_table(df: DataFrame, path: str) -> int:
    """Write `df` as the next version of the table and make it current; its commit number."""
    spark = df.sparkSession
    number = max((n for n, _ in commits(spark, path)), default=0) + 1
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    where, files = _files(spark, f"{path}/_commits/{number:010d}")
    stream = files.create(where, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    return number


def read_table(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current version of a table, or that of an earlier commit."""
    known = dict(commits(spark, path))
    if not known:
        raise FileNotFoundError(f"{path} has no committed version")
    return spark.read.parquet(f"{path}/{known[max(known) if number is None else number]}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all versions but the last `keep` ones and folders that were never committed; how many went."""
    known = commits(spark, path)
    current = {v for _, v in known[-keep:]}
    where, files = _files(spark, path)
    gone = 0
    for status in files.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("version-") and name not in current:
            files.delete(status.getPath(), True)
            gone += 1
    for number, version in known[:-keep]:
        files.delete(_files(spark, f"{path}/_commits/{number:010d}")[0], False)
    return gone
