"""The post stream over a table that is one file, a folder of part files, or empty."""

import pytest

from threadlens.plans import registry
from threadlens.session import shared_dir

TURNS = [(c, t, "user", f"Is it true, {c} {t}?") for c in range(6) for t in range(4)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")


def streamed(spark, d):
    registry.load_all()
    return sorted(registry.QUERIES["stream_post_features"](spark, d).select("conv_id", "post_id", "hasqmark", "clean_text").collect())


def test_folder_of_part_files_gives_the_rows_of_one_file(spark, rows, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    parts = shared_dir(spark, "t-stream-parts")
    rows.repartition(3).write.parquet(f"{parts}/conversations.parquet")
    pq.write_table(pa.Table.from_pylist([r.asDict() for r in rows.collect()]), f"{tmp_path}/conversations.parquet")
    got = streamed(spark, parts)
    assert len(got) == len(TURNS) and got == streamed(spark, str(tmp_path))


def test_empty_table(spark, rows):
    d = shared_dir(spark, "t-stream-empty")
    rows.limit(0).write.parquet(f"{d}/conversations.parquet")
    assert streamed(spark, d) == []
