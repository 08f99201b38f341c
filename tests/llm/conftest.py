import pytest

SF_DIR = "/root/testdata/sf0.001"

#: Rows that every text operator must take: null and empty texts, a null id, repeated rows and ids, a very long text.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "src0", 70),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "src0", 70),
    (2, None, None, None, None),
    (3, "", "en", "src1", 0),
    (None, "Mail bob.smith@mail.example.com now, password=abcdefgh12345678 ok", "en", "src1", 60),
    (4, "word " * 60_000, "en", "src2", 300_000),
    (5, "é́ 漢字 🎉\x00\x1f   <|endoftext|> It's İstanbul's", None, "src2", 9),
    (6, "x" * 50_000, "en", "src2", 50_000),
    (7, "The quick brown fox jumps over the lazy dog near the river bank today.", "de", "src3", 70),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows, with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, SCHEMA)
    for name in ("score", "label", "fp", "id", "rank", "row_key", "base", "spans", "component"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")
