import pytest

#: Nulls, empty and long texts, repeated rows, ties, blanks only, and columns with clashing names.
ROWS = [
    (7, "The cat, the dog and <|endoftext|> it's 42.\n\tNaïve café x", "en", 1),
    (3, None, "en", 2), (None, "lost key", None, 3), (None, "lost key", None, 3),
    (5, "", "de", 4), (5, "same id", None, 5), (9, "word " * 30_000, "en", 6),
    (11, "same text twice", "en", 7), (12, "same text twice", "en", 7), (12, "same text twice", "en", 7),
    (13, " \t\n ", "fr", 8), (14, "ÀÉ 漢字 \U0001f600 ß. ΑΣ ΑΣ. é", "fr", 9), (15, "x" * 20_000, None, None),
]
CLASH = "doc_id long, text string, lang string, shard int"


@pytest.fixture(scope="session")
def odd(spark):
    extra = "grp slot key bucket node size length start piece offset tie h n words score source n_chars".split()
    from pyspark.sql import functions as F

    return spark.createDataFrame(ROWS, CLASH).withColumns({name: F.lit("clash") for name in extra})


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    """The whole small table as a list of (doc_id, text)."""
    return sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
