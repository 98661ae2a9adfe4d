import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """(rows of (doc_id, text)) -> documents, with columns that clash with the operators' own names."""
    def make(rows, clash=True):
        data = [(d, t, "en", "src", None if t is None else len(t)) for d, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            from pyspark.sql import functions as F

            for name in ("key1", "key2", "hash", "line", "position", "bucket", "node", "root", "group", "cell", "seed",
                         "spans", "score", "kept", "size", "_label", "words", "start"):
                df = df.withColumn(name, F.lit(None).cast("string"))
        return df
    return make


ODD = [(1, None), (2, ""), (3, ""), (4, " \t\n"), (5, "!!! ???"), (6, "one"), (7, "one two\nthree"), (7, "one two\nthree"),
       (7, "another text of the same id"), (None, "no id at all"), (None, None), (8, "word " * 60_000),
       (9, "ÀÉ ñandú straße ΣΑΣ 日本語 😀"), (-5, "negative id"), (10, "x" * 50_000), (11, "\n" * 3000)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, ids shared by texts."""
    return ODD
