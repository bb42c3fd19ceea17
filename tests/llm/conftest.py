import pytest

#: Texts that every operator must take: null, empty, blank, punctuation, one word, other scripts, very long, repeated.
LONG = ("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 4000).strip()
TEXTS = [None, "", "   \n\t ", "!!! ... ???", "word", "Word", "éÉß ÀÇ 日本語 😀", LONG, "the same text twice over here", "the same text twice over here", "x" * 3000]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null ids, repeated ids and rows, odd texts, and columns that clash with names used inside."""
    rows = [(i, t, "en", "s", 1, "a", 7, "h", "n", 0) for i, t in enumerate(TEXTS)]
    rows += [(3, "another text under a repeated id", None, None, None, None, None, None, None, None), (None, "no id at all here", "fr", "s", 1, "a", 1, "h", "n", 1), rows[8], rows[8]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, row int, fp string, words string, hash long")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
