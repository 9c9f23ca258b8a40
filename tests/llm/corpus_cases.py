"""Rows that every corpus operator has to take: nulls, empties, repeats, one very long text, clashing columns."""

LONG = " ".join(f"word{i % 997} and the tail {i}" for i in range(20_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog."),
    (1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog."),
    (2, None), (None, "a text without an id"), (None, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "Ünïcödé ça va 日本 \U0001F600 <|endoftext|> it's"),
]


def documents(spark):
    """The cases, with further columns named like columns that operators make."""
    rows = [(i, t, "en", "s", len(t or ""), 7, "x", 0.5, [1], "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, row string, score double, hits array<int>, key string")


def empty(spark):
    return documents(spark).filter("false")
