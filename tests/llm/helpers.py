"""Small tables of odd rows, shared by the tests of this folder."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Found string"


def odd_documents(spark, more=()):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing extra column."""
    long_text = " ".join(f"word{i % 997} und {i}" for i in range(20_000))
    rows = [
        (1, "", "en", "s", 0, "x"), (2, None, None, None, None, None),
        (None, "a text without an id at all, of some length", "en", "s", 5, "x"),
        (3, "one two", "en", "s", 7, "x"), (3, "one two", "en", "s", 7, "x"),
        (4, long_text, "de", "s", len(long_text), "x"), (5, " \n\t ", "fr", None, 4, "x"),
        (6, "1234 5678", "en", "s", 9, "x"), *more,
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(rng, n, size=400):
    return [f"w{int(k)}" for k in rng.integers(0, size, n)]
