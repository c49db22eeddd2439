"""Helpers that the operators of this package share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediaspark.session import shared_folder

_OWN_FOLDERS: dict[str, str] = {}
_SAVED: dict[str, DataFrame] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder; a local master (tests) may do without and gets one of its own."""
    base = shared_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_FOLDERS:
            _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="llm-")
            atexit.register(shutil.rmtree, _OWN_FOLDERS[app], ignore_errors=True)
        base = _OWN_FOLDERS[app]
    return os.path.join(base, f"llm-{uuid.uuid4().hex}")


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """The path, which its file system deletes when the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def saved(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: lineage is cut and lost executors cost nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(removed_at_exit(df.sparkSession, path))
    table.saved_at = path
    _SAVED[path] = table
    return table


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that no later result reads; what was derived from them must be saved itself."""
    for table in tables:
        spark = table.sparkSession
        target = spark._jvm.org.apache.hadoop.fs.Path(table.saved_at)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _SAVED.pop(table.saved_at, None)


@contextmanager
def noted() -> Iterator[list[DataFrame]]:
    """Tables saved within the block that are still there at its end."""
    before, made = set(_SAVED), []
    yield made
    made += [table for path, table in _SAVED.items() if path not in before]


def placed(docs: DataFrame, file: str, row: str) -> DataFrame:
    """The rows with where each lies: a 64-bit hash of its file's path and its place in that file.

    Both stay the same however often and in whatever parts the files are read, so no numbered copy is needed. Rows
    that are not plainly read from Parquet files are written first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    files = plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"
    plain = files and plan.relation().fileFormat().toString() == "Parquet" and fresh(docs, "_metadata") == "_metadata"
    lying = docs if plain else saved(docs)
    return lying.withColumns({file: F.xxhash64("_metadata.file_path"), row: F.col("_metadata.row_index")})


def fresh(df: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo the folds; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at exactly these six characters."""
    return text.split()


def shingles_of(words: list[bytes], size: int) -> set[bytes]:
    """Distinct runs of words; with fewer words, all of them as one; without words, none."""
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def hashes_of(items, width: int = 8) -> np.ndarray:
    """64-bit hashes of byte strings, the same on every machine."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, items), np.uint64, count=len(items))
