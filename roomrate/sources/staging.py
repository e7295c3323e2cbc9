"""Staged tables.

The reference wrote its prepared table to one CSV on the driver so later
scripts could start from it. We write Parquet from the executors, optionally
partitioned (e.g. by cluster id, so a per-cluster read skips the files of other
clusters), and read it back. Writing into the shared checkpoint folder also
cuts the lineage: a lost executor re-reads the staged files instead of
replaying every stage before them.

Partition columns come back with their own types (nothing is inferred from
folder names), and as a folder cannot tell an empty string from null, text
columns also keep their value in the files. Rows are redistributed by the
partition columns before the write (a rebalance, which splits a value that
holds much of the table), so files are few and of even size whatever the
number of writing tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomrate.session import scratch_path

#: Prefix of the copies of partitioning text columns in the files.
KEPT = "kept_"


def stage_table(df: DataFrame, path: str, partition_by: list[str] | str | None = None,
                mode: str = "overwrite") -> DataFrame:
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    text = [c for c in cols if dict(df.dtypes)[c] == "string"]
    out = df.withColumns({KEPT + c: F.col(f"`{c}`") for c in text}) if text else df
    if cols:
        out = out.hint("rebalance", *cols)
    w = out.write.mode(mode)
    (w.partitionBy(*cols) if cols else w).parquet(path)
    back = df.sparkSession.read.schema(out.schema).parquet(path)
    return back.select(*[F.col(f"`{KEPT + c}`").alias(c) if c in text else F.col(f"`{c}`")
                         for c in df.columns])


def stage(df: DataFrame, name: str, partition_by: list[str] | str | None = None) -> DataFrame:
    """Stage under a fresh folder of ``spark.checkpoint.dir``. The folder
    belongs to the session that made it; ``release_staged`` deletes them."""
    path = scratch_path(df.sparkSession, name)
    _folders(df.sparkSession).append(path)
    return stage_table(df, path, partition_by)


def _folders(spark: SparkSession) -> list[str]:
    if not hasattr(spark.sparkContext, "_roomrate_staged"):
        spark.sparkContext._roomrate_staged = []
    return spark.sparkContext._roomrate_staged


def release_staged(spark: SparkSession) -> int:
    """Delete the folders that this session has staged, once no DataFrame read
    from them is needed any more; returns how many there were."""
    folders, jvm = _folders(spark), spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in folders:
        path = jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(conf).delete(path, True)
    n = len(folders)
    folders.clear()
    return n
