"""Reading tables, and writing intermediate results where every executor can reach them."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; an own one only where none is set and everything runs on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.environ.get("QUERN_SHARED_DIR")
    if not own:
        own = os.environ["QUERN_SHARED_DIR"] = tempfile.mkdtemp(prefix="quern-")
    return "file://" + own


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def settle(df: DataFrame, tag: str = "t") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors. The files go away
    when the session ends, or earlier by ``discard``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files behind a settled frame that nothing reads any more."""
    path = getattr(df, "_quern_path", None)
    if path:
        fs, p = _hadoop(df.sparkSession, path)
        fs.delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan before costly work per row, in ``spark.quern.scanPartitions`` partitions if that is set.

    By default a table is worked on as it is read. The setting is for tables of
    fewer files than cores, which would leave most cores idle; it costs a shuffle
    of the rows read, at any size.
    """
    n = df.sparkSession.conf.get("spark.quern.scanPartitions", None)
    return df.repartition(int(n)) if n else df
