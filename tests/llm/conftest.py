from __future__ import annotations

import pytest

SF_SMALL = "/root/testdata/sf0.001"
PROSE = ("The committee met on a grey morning to discuss the budget of the small harbour town. Nobody had expected the "
         "figures to be so clear, and the mayor read them twice. A fisherman asked whether the old pier could be saved. "
         "The engineer answered that timber was cheap this year but labour was not. After lunch they walked along the "
         "quay and counted the broken planks together. In the evening a short note was pinned to the door of the hall.")

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, ord long, id long, own_id string, q int, cut int, bpe string"


def clash(rows):
    """Rows of (doc_id, text, lang) with more columns whose names the operators use themselves."""
    return [(i, t, lang, "s", None if t is None else len(t), "r", "k", 7, 8, "o", 9, 10, "b") for i, t, lang in rows]


MESSY = [
    (1, PROSE, "en"),
    (2, PROSE, "en"),                      # an exact copy under another id
    (2, PROSE, "en"),                      # a repeated row
    (3, None, None),
    (4, "", "en"),
    (5, "   \n\t ", None),
    (6, "one", "en"),
    (None, "A document without an id, and nothing else to say about it.", "en"),
    (None, "A document without an id, and nothing else to say about it.", "en"),
    (7, " ".join(f"word{i}" for i in range(30_000)), "en"),   # a very long text
    (8, "x" * 200_000, None),              # a very long word
    (9, "é ü 日本語 <|endoftext|> 🙂    tail", "fr"),
    (10, "same words\nsame words\nsame words\nsame words", "en"),
]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(clash(MESSY), CLASHING)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], CLASHING)
