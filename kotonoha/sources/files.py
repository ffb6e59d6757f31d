"""Text files: listing, strict UTF-8 decoding, other charsets."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha.sources.tree import arrow_place, list_tree

DEFAULT_PATTERNS = ("*.txt",)

# Bytes of a file that still fit a row.
LARGEST_FILE = 2_000_000_000


def as_glob(patterns: str | Iterable[str]) -> str:
    """One Hadoop glob for a pattern list; a lone string is one pattern."""
    names = [patterns] if isinstance(patterns, str) else sorted(set(patterns))
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def binary_reader(reader, patterns: str | Iterable[str]):
    """Recursive binaryFile options on a batch or stream reader."""
    return (
        reader.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", as_glob(patterns))
    )


def arrow_reads(place: str) -> bool:
    """Whether the workers can open paths like this one by themselves."""
    return arrow_place(place) is not None


def list_files(
    spark: SparkSession, root: str | Iterable[str] | DataFrame, patterns: str | Iterable[str] = DEFAULT_PATTERNS
) -> DataFrame:
    """``[path, modificationTime, length]`` of all files below the roots (or a ``[folder]`` table).

    The workers list level by level. In a store that Arrow does not know Spark's
    own listing takes over, which passes over empty files and names that start
    with ``_`` or ``.``. No content is read.
    """
    if not isinstance(root, DataFrame):
        names = [(qualified(spark, r),) for r in dict.fromkeys([root] if isinstance(root, str) else root)]
        root = spark.createDataFrame(names, "folder string")
    scheme = F.regexp_extract("folder", "^[^:/]*:", 0)
    # A handful of stores, each with one of its folders.
    stores = root.groupBy(scheme.alias("scheme")).agg(F.min("folder").alias("one")).collect()
    unknown = [r["scheme"] for r in stores if not arrow_reads(r["one"])]
    listed = list_tree(root.where(~scheme.isin(unknown)) if unknown else root, patterns)
    if unknown:
        others = [r["folder"] for r in root.where(scheme.isin(unknown)).toLocalIterator()]
        seen = binary_reader(spark.read, patterns).load(others)
        listed = listed.unionByName(seen.select("path", "modificationTime", "length"))
    return listed


def qualified(spark: SparkSession, root: str) -> str:
    """The root as Spark writes it in paths, with its scheme."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    return system.makeQualified(place).toString()


def read_files(files: DataFrame) -> DataFrame:
    """``[doc_id, content, problem]`` of ``[doc_id, abs_path]`` rows, opened by name by the workers.

    A file that is gone or cannot be read has no content and says why.
    """
    id_type = files.schema["doc_id"].dataType.simpleString()

    def content_of(path: str) -> tuple[bytes | None, str | None]:
        if (place := arrow_place(path)) is None:
            return None, "no file system for this path"
        try:
            with place[0].open_input_file(place[1]) as file:
                if file.size() > LARGEST_FILE:
                    return None, f"file larger than {LARGEST_FILE} bytes"
                return file.read(), None
        except FileNotFoundError:
            return None, "file not found"
        except OSError as problem:
            return None, str(problem)

    def read(batches):
        for batch in batches:
            ids, paths = batch.column(0), batch.column(1).to_pylist()
            for row, path in enumerate(paths):
                content, problem = content_of(path)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, 1), pa.array([content], pa.binary()), pa.array([problem], pa.string())],
                    names=["doc_id", "content", "problem"],
                )

    return files.select("doc_id", "abs_path").mapInArrow(
        read, f"doc_id {id_type}, content binary, problem string"
    )


def relative_path(path: Column, root: str) -> Column:
    """Path below the root, also when Spark writes the root as a URI."""
    tail = root.rstrip("/").split("://", 1)[-1]
    return F.regexp_replace(path, "^.*?" + _quoted(tail) + "/", "")


def _quoted(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def universal_newlines(text: Column) -> Column:
    """CRLF and CR become LF, as reading a file in text mode does."""
    return F.regexp_replace(text, "\r\n?", "\n")


def _unread(files: DataFrame) -> Column:
    missing = F.lit("file not found")
    return F.coalesce(F.col("problem"), missing) if "problem" in files.columns else missing


def decode_utf8(files: DataFrame, *, content_col: str = "content") -> DataFrame:
    """Add ``[text, char_count, error]``; invalid bytes give an error, not a failure.

    ``char_count`` counts code points. Missing content is an error too, with the
    ``problem`` of reading it where there is that column.
    """
    content = F.col(content_col)
    valid = F.is_valid_utf8(content.cast("string"))
    text = F.when(valid, universal_newlines(F.try_validate_utf8(content.cast("string"))))
    error = F.when(content.isNull(), _unread(files)).when(
        ~valid, F.lit("invalid UTF-8 byte sequence")
    )
    return (
        files.withColumn("text", text)
        .withColumn("char_count", F.length("text"))
        .withColumn("error", error)
    )


def decode_charset(files: DataFrame, charset: str, *, content_col: str = "content") -> DataFrame:
    """The same columns for another charset, decoded strictly in Arrow batches."""
    "".encode(charset)  # unknown charset fails here, on the driver

    @F.pandas_udf("text string, error string")
    def decode(contents: pd.Series) -> pd.DataFrame:
        def one(content):
            if content is None:
                return None, "file not found"
            try:
                return bytes(content).decode(charset, "strict"), None
            except UnicodeDecodeError as problem:
                return None, str(problem)

        return pd.DataFrame([one(c) for c in contents], columns=["text", "error"])

    decoded = files.withColumn("_decoded", decode(F.col(content_col)))
    return (
        decoded.withColumn("text", universal_newlines(F.col("_decoded.text")))
        .withColumn("char_count", F.length("text"))
        .withColumn("error", F.when(F.col(content_col).isNull(), _unread(files)).otherwise(F.col("_decoded.error")))
        .drop("_decoded")
    )
