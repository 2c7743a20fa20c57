import pathlib

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf():
    if not pathlib.Path(SF).exists():
        pytest.skip("given tables not present")
    return SF


@pytest.fixture
def stored(spark, tmp_path):
    """Writes rows to parquet in a few files, and reads them back."""

    def write(rows, schema, name="documents", files=3):
        path = str(tmp_path / f"{name}.parquet")
        spark.createDataFrame(rows, schema).repartition(files).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(stored, tmp_path):
    """Nulls, empty and long texts, ties and repeated rows, in a folder as the queries read it."""

    def write(extra=()):
        texts = [None, "", " ", "a", "the quick brown fox " * 3000, "the quick brown fox", "the quick brown fox", "Ünïcödé \U0001f600 text", *extra]
        rows = [(i, t, None if i % 3 else "en", None, None if t is None else len(t)) for i, t in enumerate(texts)]
        rows += [rows[5], (None, "no id", "en", "s", 5), (None, None, None, None, None)]
        stored(rows, DOCS)
        return str(tmp_path)

    return write


@pytest.fixture
def no_docs(stored, tmp_path):
    stored([], DOCS)
    return str(tmp_path)
