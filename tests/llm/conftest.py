import pytest


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, lang, source]) rows."""

    def make(*rows):
        full = [(r + ("en", "web"))[:4] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame(
            [(*r, None if r[1] is None else len(r[1])) for r in full],
            "doc_id long, text string, lang string, source string, n_chars long",
        )

    return make


@pytest.fixture
def as_table(tmp_path):
    """Write a frame as a table of an input folder, which is returned."""

    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/sf/{name}.parquet")
        return f"{tmp_path}/sf"

    return write
