import re

import pytest

TEXTS = {
    1: "the quick brown fox jumps over the lazy dog near the old stone bridge today",
    2: "the quick brown fox jumps over the lazy dog near the old stone bridge tomorrow",
    3: "", 4: None, 5: " \t\n ", 6: "two words", 7: "TWO words", 8: "a", 9: "x" * 5000,
    10: "Überraschung — 日本語 text 😀 it's 12 345!!", 11: "tab\tline\nreturn\rfeed\x0cend",
}


@pytest.fixture
def documents(spark):
    """Rows with the columns of documents and some of the operators' own names: nulls, blanks, long words, repeated rows."""
    rows = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 3 else None, len(t or ""), "x") for i, t in TEXTS.items()]
    rows += [rows[0], rows[0], (None, "a row without id", "en", "src1", 16, "x"), (1, "another text with id one", "en", "src1", 24, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
