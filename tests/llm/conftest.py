import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(12_000))
BASE = "the quick brown fox jumps over the lazy dog while seven other animals watch from the wide green hill near the old mill by the slow river at noon"


@pytest.fixture(scope="session")
def edge(spark):
    """Null and empty texts, a null id, ties, repeated rows, copies, a very long text, and columns with clashing names."""
    rows = [
        (1, BASE, "en", "src0", None),
        (2, BASE, "en", "src0", 10),
        (2, BASE, "en", "src0", 10),
        (3, None, None, None, None),
        (4, "", "en", "src1", 0),
        (5, " \t\n ", "en", "src1", 3),
        (6, LONG, "en", "src1", 3),
        (7, BASE.replace("noon", "night"), "en", "src2", 3),
        (8, "short one", "en", "src2", 3),
        (9, "Ünï¢ode 😀 tëxt Σς with\x00controls\x1cand more", "xx", "src2", 3),
        (None, BASE, "en", "src2", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
