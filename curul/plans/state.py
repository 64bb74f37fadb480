"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Where the session names none, a temporary one is set if there is but one machine (tests); on a cluster that would be
    a folder the other machines can't read, so it raises.
    """
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="curul-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder; a lost executor costs no recomputation of what led here."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, as a compressed table of columns in the shared folder: for wide rows of which later steps read parts."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a ``stored`` table that nothing reads any more."""
    spark = table.sparkSession
    for name in {re.search(r"/(table-[0-9a-f]{32})/", f)[1] for f in table.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a job's shuffle files go as soon as it has ended, not when the driver happens to collect its garbage.

    For steps that each end in ``stored``, ``cut`` or rows for the driver; a table that is run twice would shuffle twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
