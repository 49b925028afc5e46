import pytest


@pytest.fixture(scope="session")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


#: Rows that every operator must take: nulls, empty texts, ties, repeated rows, long texts, clashing columns.
ODD = [
    (0, "the quick brown fox jumps over the lazy dog and runs far away from the old red barn"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away from the old red barn"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away from the old red barn"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "word"),
    (None, "a row without an id, mail me at a.b@c.de or call +1 (212) 555-0100"),
    (7, "x" * 70_000 + " tail"),
    (8, "Ünïcödé ΣΊΣΥΦΟΣ 😀 ẞ <|endoftext|> it's é   end"),
    (9, "long " * 40_000),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "x", 0.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score int, row_key string, predicted double").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
