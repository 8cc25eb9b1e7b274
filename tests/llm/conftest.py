import pytest

NASTY = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the deep dark forest again"),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, "word"),
    (None, "A row without an id but with quite some words in it, as many as a sentence may have, and then a few more"),
    (6, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the deep dark forest again"),
    (6, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf in the deep dark forest again"),
    (7, "é" * 300 + " ñandú <|endoftext|> it's \u0000 \u001c x"),
    (8, "ab " * 4000),
]


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, empty and blank texts, repeated rows, a missing id, a very long text, and columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", 1, 2, b"x") for i, t in NASTY]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, fp string, length int, first int, h binary")


@pytest.fixture(scope="session")
def empty(nasty):
    return nasty.where("false")


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
