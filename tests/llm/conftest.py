import pytest

AWKWARD = [
    (1, "The cat sat on the mat and looked around the room.", "en", "a", 1),
    (2, "the CAT sat on the mat and looked around the room.", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "   \n\t \n\n", "en", "b", 0),
    (6, "été naïve Ünder ß 漢字 😀 \x1c\x85\xa0 ﬁ é", "fr", "b", 0),
    (7, "<|endoftext|> it's <|startoftext|> we'll </s> ▁x", "en", "c", 0),
    (8, "word " * 30_000, "en", "c", 0),
    (9, "x" * 20_000, "en", "c", 0),
    (9, "x" * 20_000, "en", "c", 0),
    (None, "no id at all, but some words in a row", "en", "c", 0),
    (10, "a\nb\na\nb\n", "en", "c", 0),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with clashing names."""
    frame = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", "1 as kept", "2 as fingerprint", "'x' as line", "0.5 as score", "3 as length", "4 as line_dedup_removed", "5 as gone_doc", "6 as part", "7 as salt", "8 as body")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
