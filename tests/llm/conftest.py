import pytest

KIND = "doc_id long, text string, lang string, source string, n_chars long, start long, size long, score double, key string, part int"


@pytest.fixture(scope="session")
def documents(spark):
    """make(texts or (doc_id, text) pairs): documents with columns whose names the operators use themselves."""

    def make(rows, sources=None):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(rows)]
        full = [
            (i, t, None, (sources[k] if sources else "s"), None, 7, 7, 0.5, "k", 3) for k, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(full, KIND).repartition(3)

    return make


#: Nulls, empty and long texts, ties and repeated texts, and characters of one to four bytes.
ODD = [
    None, "", " ", "a", "a  b \n c", "the cat sat on the mat", "the cat sat on the mat", "ÄÖ é 漢字 🙂   end",
    "x" * 5000, "one two three four five six seven eight nine ten " * 400, "\x00\t\r\n", "İstanbul ı ſ K",
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)
