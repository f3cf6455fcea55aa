"""Small tables that all document operators must take."""

LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "b", 3, "x", 1), (1, "alpha beta gamma delta epsilon zeta", "en", "b", 3, "x", 1), (2, None, None, None, None, None, None),
        (None, "no id here at all", "fr", "a", 1, "y", 2), (3, "", "en", "a", 0, "z", 3), (4, " \t\n", "en", None, 3, "z", 3), (5, LONG, "de", "a", len(LONG), "q", 9), (6, "alpha beta gamma delta epsilon zeta", "en", "c", 3, "x", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, size int")


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
