import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the package shipped to its workers and few shuffle partitions."""
    from promo_engine.llm.common import ship_package
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return ship_package(spark)


WORDS = [f"w{i}x" for i in range(400)]


def prose(start, n):
    return " ".join(WORDS[(start + 7 * i) % len(WORDS)] for i in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and blank texts, a very long text, a long run of blanks, ties and
    repeated rows, copies that differ in white space, near copies."""
    long = prose(3, 60_000)
    near = prose(11, 200)
    return [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, " \n\t ", "en", "s", 4),
        (None, "one two three", "en", "s", 13), (None, None, None, None, None),
        (4, long, "en", "s", len(long)), (5, long, "en", "s", len(long)),
        (6, near, "en", "s", 1), (7, near.replace(" ", "\n", 20), "fr", "t", 2), (8, near + " tail", "en", "s", 3),
        (9, "one two three", "en", "s", 13), (9, "one two three", "en", "s", 13), (10, " " * 70_000 + "x", "en", "s", 1),
        (11, "Ünïcödé ☃ 😀 done.\nline 42 of 99 here\n", "en", "s", 5), (12, "a", "en", "s", 1)]


@pytest.fixture(scope="session")
def edge(llm, edge_rows):
    """The edge rows, with further columns whose names the operators could use themselves."""
    return llm.createDataFrame(edge_rows, SCHEMA).withColumns({c: F.lit("clash") for c in (
        "block", "row", "hash", "size", "key", "score", "rep", "p", "words", "features", "__row", "__id", "label")})


@pytest.fixture(scope="session")
def empty(llm):
    return llm.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(llm):
    return llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
