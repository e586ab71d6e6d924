"""The pipeline: each stage's decisions take effect, columns stay."""

import corpus_pipeline as C

import __spark_entry__ as E


def test_stages(spark, sf_small):
    docs = C.documents(spark, sf_small)
    sizes = [docs.count()]
    for name, stage in C.STAGES:
        out = C.saved(stage(spark, docs, sf_small), "test-stage")
        if name != "source mix":
            assert out.columns == docs.columns
        sizes.append(out.count())
        if name == "personal data":
            assert out.where("text rlike '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|@mail[0-9][.]example'").count() == 0
        docs = out
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4]
    assert 1.0 < docs.agg({"n_chars": "sum"}).first()[0] / 1.0


def test_registered():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names
