import random

import pytest

CLASH = "doc_id long, text string, lang string, source string, n_chars long, words_ string, row_ int, n int, key string, sig int, ids string, kept int, base_spans int, open int"


def edge_rows():
    """Nulls, blanks, long texts, ties, repeated rows and columns whose names clash with those of the operators."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base = text(120)
    near = base.replace(" ", "  ", 1).rsplit(" ", 2)[0] + " tail end"
    texts = [None, "", " \t\n", "one", "Two words", base, base, base.upper(), near, text(300), "x " * 5000, "y" * 30_000, "9" * 3000, "a b éß \U0001f600 中文", "l1\nl2\nl1\n\nl1", "<|endoftext|> mid <|endoftext|>", "</s>[INST] \\ <| <\\|", base + "\n" + text(40), " ".join(text(8) for _ in range(2)) * 3]
    rows = [(i, t, ("en", "fr", None, "xx")[i % 4], f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "null id", "en", "s", 7), (77, None, None, None, None)]
    return [(*row, "w", 1, 2, "k", 3, "i", 4, 5, 6) for row in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), CLASH).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], CLASH)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
