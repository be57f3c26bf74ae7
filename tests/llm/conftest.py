import pytest

CLASHES = "n_words long, spans string, score double, row string, counts string, node long, region string, spread long, comp string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank and long texts, ties, repeated rows and columns named like the operators' own."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    same = "one two three four five six seven eight nine ten eleven twelve"
    texts = [(1, same), (1, same), (2, same), (None, same), (None, None), (3, None), (4, ""), (5, " \n\t "), (6, "short text"),
             (7, long_text), (8, long_text + " tail"), (9, "naïve ÇA 漢字 \x1c odd line <|endoftext|> é"), (9, "other text, same id")]
    rows = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else "web", None if t is None else len(t),
             k, "s", 0.5, "r", "c", None, "g", k, "p") for k, (i, t) in enumerate(texts)]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
