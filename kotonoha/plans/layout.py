"""Placement of rows: spreading thin scans, cutting lineage, splitting documents."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Tokens per block when a document's tokens are regrouped. A (document, block)
# group has at most this many rows, however long the document is.
TOKENS_PER_BLOCK = 32_768

# Row groups of tables with wide rows (texts, token lists). Spark's vectorized reader
# decodes thousands of rows at once, whatever their width, but never across row groups.
ROW_GROUP_BYTES = 16 << 20


def size_in_bytes(setting: str) -> int:
    """Value of a Spark size setting such as 134217728b, 128m or 1GB."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", setting.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit[:1]]


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; reads statistics only, starts no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Give an under-parallel scan enough tasks to keep every core busy.

    Text work is CPU bound, so a file with few row groups would leave cores
    idle. Rows are moved only while the planned size is below what the cores
    read in one wave of splits; a large table is returned as it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    wave = cores * size_in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(2 * cores) if planned_bytes(df) < wave else df


def shared_scratch(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set up only where none is named."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="kotonoha-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this session wrote, with all below it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a lost executor re-reads the rows, never re-ranks them."""
    shared_scratch(df.sparkSession)
    return df.checkpoint(eager=True)


def wide_writer(df: DataFrame) -> DataFrameWriter:
    """Writer whose row groups are small enough to be decoded at once; zstd, half of Spark's snappy."""
    return df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).option("compression", "zstd")


def wide_folder(spark: SparkSession) -> str:
    """A new folder for ``fix_wide``, named by callers who remove it when they are done."""
    return f"{shared_scratch(spark)}/wide-{uuid.uuid4().hex}"


def fix_wide(df: DataFrame, schema: StructType | None = None, path: str | None = None) -> DataFrame:
    """Wide rows fixed as compressed Parquet beside the checkpoints, computed once.

    A checkpoint stores rows as they are in memory; token lists take a tenth of that here.
    ``schema`` names the types to read them as, where they are not those of ``df``.
    """
    path = path or wide_folder(df.sparkSession)
    wide_writer(df).parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def block_of(position: Column, size: int = TOKENS_PER_BLOCK) -> Column:
    """Block number of a token position inside its document."""
    return F.floor(position / F.lit(size)).cast("long")

