"""Small frames with awkward rows, shared by the tests of the operators."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} of the,long text{i % 13}" for i in range(20_000)) + "\n" + "x" * 70_000
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, score double, held_out string, fp long, row string, "
           "n_tokens string, rate string, `a.b` string, spans string")


def docs(spark, texts):
    """Rows (doc_id, text[, lang]) with further columns whose names the operators use themselves."""
    rows = []
    for r in texts:
        doc_id, text, lang = (*r, None)[:3]
        rows.append((doc_id, text, lang, "src", None if text is None else len(text), -1.0, "h", 7, "r", "n", "r", "dot", "s"))
    return spark.createDataFrame(rows, COLUMNS)


AWKWARD = [
    (1, "The quick brown fox, it jumps over the lazy dog.\nAgain and again."),
    (1, "The quick brown fox, it jumps over the lazy dog.\nAgain and again."),
    (2, None, "en"),
    (3, ""),
    (4, " \t\n\x0b "),
    (None, "A row without an id but with some words in it."),
    (None, None),
    (5, LONG, "en"),
    (6, "### *** ||| 123 456"),
    (7, "Ünïcödé wörds — größe 😀 naïve\u00a0space"),
    (-8, "one"),
]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, label string")
