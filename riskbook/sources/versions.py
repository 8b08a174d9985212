"""Tables that are replaced whole or not at all, and tables that are made once.

:func:`replace_table` writes a new version beside the old one and then commits it: a numbered file in
``_commits`` that names the version, created only if that number is not taken. Readers follow the highest
commit, so a job that fails, or is killed at any point, leaves the table as it was, and of two writers at once one is told so.
Nothing is renamed or copied, which object stores would do byte by byte.

:func:`read_or_create` names a table by what it is made of: the plan and the files that the plan reads. Equal
work is read back (no job runs), half-written work is done again.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

COMMITS, VERSIONS = "_commits", "versions"
KEEP = 2


class ConcurrentReplace(RuntimeError):
    """Another writer committed first; the table is as that writer left it."""


def _fs(spark: SparkSession, path: str):
    """The file system of a path, as Spark sees it, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the commits, oldest first."""
    fs, folder = _fs(spark, f"{path}/{COMMITS}")
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if re.fullmatch(r"[0-9]{12}", name) and status.getLen() > 0:  # an empty one was cut off
            with_version = fs.open(status.getPath())
            try:
                out.append((int(name), with_version.readUTF()))
            finally:
                with_version.close()
    return sorted(out)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed version of the table at ``path``."""
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(f"{path} has no committed version")
    return spark.read.parquet(f"{path}/{VERSIONS}/{commits[-1][1]}")


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = KEEP) -> DataFrame:
    """Write ``df`` as the table's next version and commit it; returns the table as readers see it now.

    ``df`` may read the table itself. The ``keep`` latest versions stay, so queries that still read
    the version before are not cut off.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = _commits(spark, path)
    version = uuid.uuid4().hex
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{VERSIONS}/{version}")
    number = before[-1][0] + 1 if before else 0
    fs, at = _fs(spark, f"{path}/{COMMITS}/{number:012d}")
    try:
        out = fs.create(at, False)
    except Py4JJavaError as e:
        raise ConcurrentReplace(f"{path}: commit {number} was made by another writer") from e
    try:
        out.writeUTF(version)
    finally:
        out.close()
    kept = {v for _, v in _commits(spark, path)[-max(1, keep) :]}
    for _, old in before:
        if old not in kept:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSIONS}/{old}"), True)
    return spark.read.schema(df.schema).parquet(f"{path}/{VERSIONS}/{version}").select(*df.columns)


def fingerprint(df: DataFrame, version: str = "") -> str:
    """Digest of the optimised plan (without its running numbers), the files it reads (names, sizes and times), and
    ``version`` (to be changed with Python functions in the plan, which its text does not hold)."""
    spark = df.sparkSession
    plan = re.sub(r"#[0-9]+L?|plan_id=[0-9]+", "", df._jdf.queryExecution().optimizedPlan().toString())
    digest = hashlib.sha256(f"{version}\n{plan}\n{df.schema.json()}".encode())
    for name in sorted(df.inputFiles()):
        fs, at = _fs(spark, name)
        status = fs.getFileStatus(at)
        digest.update(f"{name}:{status.getLen()}:{status.getModificationTime()}\n".encode())
    return digest.hexdigest()[:32]


def read_or_create(df: DataFrame, path: str, version: str = "") -> DataFrame:
    """The rows of ``df`` from the table that an equal call wrote below ``path``, else written there now.

    A table counts as whole once Spark's job commit left its marker (``_SUCCESS``).
    """
    spark = df.sparkSession
    table = f"{path.rstrip('/')}/{fingerprint(df, version)}"
    fs, marker = _fs(spark, f"{table}/_SUCCESS")
    if not fs.exists(marker):
        df.write.mode("overwrite").parquet(table)
    return spark.read.schema(df.schema).parquet(table)
