import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows and repeated ids."""
    base = " ".join(f"word{i % 97}x{i}" for i in range(400))
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "b", 1),
        (3, base.replace("word5x5", "other"), None, None, None),
        (4, None, "en", "a", None),
        (5, "", "en", "a", 0),
        (6, "a b c", "en", "a", 5),
        (6, "a b c", "en", "a", 5),
        (7, "a  b\nc", "en", "a", 6),
        (8, "x " * 60_000, "en", "a", 120_000),
        (9, "y" * 70_000, "en", "a", 70_000),
        (10, "start " + " ".join(base.split()[100:160]) + " end of a passage", "en", "a", 1),
        (None, "no id at all but some words in it", "en", "a", 1),
        (11, "Üñï ödé 漢字   wide space 😀", "fr", "a", 1),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
