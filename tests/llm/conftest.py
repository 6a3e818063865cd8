import pytest

TEXTS = [
    (1, "Hello world.\nLicensed under X.\npassword = hunter22", "en", "s1"),
    (2, None, None, None),
    (3, "", "en", "s1"),
    (None, "no id here " * 30, "en", "s2"),
    (4, "same words again " * 12, "en", "s2"),
    (4, "same words again " * 12, "en", "s2"),
    (5, "same words again " * 12, "de", None),
    (6, "Ünï çödé テキスト 🎉 don't <|endoftext|> x\x1cy", "fr", "s3"),
    (7, "long " * 30000, "en", "s3"),
    (8, "   \n\t\n ", "en", "s4"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and
    extra columns called like working or result columns."""
    rows = [(*t, i % 3, "x", None) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, a int, shard string, score double")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")
