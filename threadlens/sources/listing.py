"""Folders listed and files read in tasks.

Spark's readers list every path of a glob on the driver before a job begins.
Here the folders of a level are rows: a task lists the folders it holds, their
entries are the rows of the next level, and the files found are dealt to tasks
so that each reads about the same number of bytes. The driver knows one path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.index import prefix_sum
from threadlens.session import materialize, qualified, ship_package
from threadlens.sources.layout import filesystem

ENTRIES = "path string, name string, is_dir boolean, size bigint"
_ENTRIES = pa.schema([("path", pa.string()), ("name", pa.string()), ("is_dir", pa.bool_()), ("size", pa.int64())])
ROWS = 8192               # entries of a batch
BATCH_BYTES = 8 << 20     # text of a batch (or one file)
TASK_BYTES = 64 << 20     # text a task reads
FILE_COST = 64 << 10      # what opening a file costs, in bytes read


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSelector, FileType

    for b in batches:
        for path in b.column("path").to_pylist():
            fs, p = filesystem(path)
            rows = [(f"{path.rstrip('/')}/{e.base_name}", e.base_name, e.type == FileType.Directory, e.size or 0)
                    for e in fs.get_file_info(FileSelector(p)) if not e.base_name.startswith(".")]
            for lo in range(0, len(rows), ROWS):
                part = rows[lo:lo + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], _ENTRIES.field(k).type) for k in range(4)], schema=_ENTRIES)


def children(folders: DataFrame) -> DataFrame:
    """(path, name, is_dir, size) of every entry of the folders (path), hidden
    ones (a leading dot) left out. Stored, so folders are listed once."""
    spark = folders.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(folders.select("path").repartition(n).mapInArrow(_list, ENTRIES), "listed")


def folders(spark: SparkSession, root: str, levels: int) -> DataFrame:
    """(path) of the folders ``levels`` below the root."""
    at = spark.createDataFrame([(qualified(spark, root),)], "path string")
    for _ in range(levels):
        at = children(at).where("is_dir").select("path")
    return at


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(paths, texts):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())], ["file_path", "value"])

    for b in batches:
        paths, texts, size = [], [], 0
        for path in b.column("path").to_pylist():
            fs, p = filesystem(path)
            with fs.open_input_stream(p) as f:
                texts.append(f.read().decode("utf-8", "replace"))
            paths.append(path)
            size += len(texts[-1])
            if size >= BATCH_BYTES:
                yield made(paths, texts)
                paths, texts, size = [], [], 0
        yield made(paths, texts)


def read_texts(files: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(file_path, value) of whole files (path, size). Files in the order of
    their paths are cut into stretches of about ``task_bytes`` by a running
    sum of their sizes; a task reads the stretches that share its number."""
    ship_package(files.sparkSession)
    at = prefix_sum(files.select("path", "size"), ["path"], "_before", F.col("size") + FILE_COST, stored=True)
    total = at.agg(F.max(F.col("_before") + F.col("size"))).first()[0] or 0
    parts = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))
    # stretches of a parts-th of all bytes, one a task
    no = F.floor(F.col("_before") * parts / F.lit(total + FILE_COST)).cast("int") if total else F.lit(0)
    return at.select("path", no.alias("_no")).repartitionById(parts, F.col("_no")).select("path").mapInArrow(_read, "file_path string, value string")
