import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _row string, _text string, words string, lines string, "
    "spans string, k1 long, runs string, fp long, score double, kept boolean, y int, tie long, part int, component_id string, place string"
)


def edge_rows():
    prose = "The old river ran past nine quiet houses, and nobody in the village could say where it went after that. "
    long_text = " ".join(f"word{i} goes on" for i in range(30_000))
    texts = [
        (1, prose * 3), (1, prose * 3), (2, prose * 3), (3, ""), (4, None), (None, prose + "mail a@b.example"), (None, None),
        (5, long_text), (6, "a" * 40_000), (7, " \t\n\x0b\x0c\r   "), (8, "\x00\x1c é ß \U0001f600 漢字"), (9, "one"), (10, long_text + " end"),
        (11, "#" * 5000), (-12, "negative id"), (13, "\n".join(["same line here"] * 50)),
    ]
    extra = ("r", "t", "w", "l", "s", 1, "u", 2, 0.5, True, 0, 3, 4, "c", "p")
    return [(i, t, None if i == 9 else "en", None if i == 2 else "s", len(t or ""), *extra) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 1, 0), (6, 0, 0), (11, 0, None), (11, None, 0), (None, 1, 0), (13, 0, 0)], "doc_id long, quality int, toxic int")
