"""Writers for the on-disk thread layout (the inverse of ``threads.py``).

Each post is its own file, named by the post id, so Spark's part-file
writers do not fit; executors write the files of their partition through
``pyarrow.fs`` (local paths, HDFS or S3 — whatever the shared folder is).
Used to build test inputs from tables and to export threads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.tree import walk
from threadlens.session import qualified, ship_package


def filesystem(path: str):
    """The pyarrow file system of a path and the path in it."""
    import pyarrow.fs as pafs
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    uri = path.replace("s3a://", "s3://", 1)
    return pafs.FileSystem.from_uri(uri)


def _write_batch(it):
    import os

    import pandas as pd
    for pdf in it:
        n = 0
        made = set()
        for path, content in zip(pdf["path"], pdf["content"]):
            fs, p = filesystem(path)
            d = os.path.dirname(p)
            if d not in made:
                fs.create_dir(d, recursive=True)
                made.add(d)
            with fs.open_output_stream(p) as f:
                f.write(content.encode("utf-8"))
            n += 1
        yield pd.DataFrame({"n": [n]})


def write_files(files: DataFrame) -> int:
    """Write every ``(path, content)`` row as one file; returns the count. A
    path without a scheme belongs to the default file system, as for Spark."""
    spark = files.sparkSession
    ship_package(spark)
    default = qualified(spark, "/").rstrip("/")
    path = F.when(F.col("path").rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("path")).otherwise(F.concat(F.lit(default), F.col("path")))
    out = files.select(path.alias("path"), "content").mapInPandas(_write_batch, "n long").agg(F.sum("n")).first()[0]
    return int(out or 0)


def _json_str(c: Column) -> Column:
    """A JSON string literal for a string column (quotes and escapes)."""
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


def tree_documents(edges: DataFrame) -> DataFrame:
    """``(conv_id, value)``: the nested ``{"id": {...} | []}`` document of
    every conversation, written down in pre-order: a node opens an object if
    the next one is deeper, else it is a leaf and closes as many as the next
    one is higher. One document is one row, by nature of the format."""
    nd = walk(edges).select("conv_id", F.struct("ord", "depth", _json_str(F.col("post_id")).alias("name")).alias("n"))
    g = nd.groupBy("conv_id").agg(F.array_sort(F.collect_list("n")).alias("_n"))

    def pieces(nodes: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            before, after = F.when(i > 0, F.get(nodes, i - 1)["depth"]), F.get(nodes, i + 1)["depth"]
            comma = F.when(before >= x["depth"], ", ").otherwise("")
            leaf = F.concat(F.lit("[]"), F.repeat(F.lit("}"), x["depth"] - F.coalesce(after, F.lit(0))))
            return F.concat(comma, x["name"], F.lit(": "), F.when(after > x["depth"], "{").otherwise(leaf))
        return F.array_join(F.transform(nodes, piece), "")

    return g.select("conv_id", F.concat(F.lit("{"), F.transform(F.array("_n"), pieces)[0], F.lit("}")).alias("value"))
