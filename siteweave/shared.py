"""Tables in the folder that driver and executors share: lineage ends there, so a lost executor costs no recomputation before it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a session on this machine alone may do without, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = f"file://{tempfile.mkdtemp(prefix='siteweave-')}"
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def fresh(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/siteweave/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder."""
    spark = df.sparkSession
    path = fresh(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


#: Bytes of a compressed table beyond which it isn't broadcast. Repeated texts and vectors shrink a hundredfold in files, and Spark
#: takes their bytes there for their size in the driver's memory.
COMPRESSED = 1 << 16


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a table in the shared folder, for sort-merge joins unless it is small."""
    out = stored(df, what)
    if length(df.sparkSession, out.written_path) <= COMPRESSED:
        return out
    hinted = out.hint("merge")
    hinted.written_path = out.written_path
    return hinted


def length(spark: SparkSession, path: str) -> int:
    """Bytes of the files below the path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def remove(df: DataFrame) -> None:
    """Delete a table made by written() or stored() that nothing will read again."""
    delete(df.sparkSession, df.written_path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
