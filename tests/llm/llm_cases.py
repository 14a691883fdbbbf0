"""Tables for the tests of this folder."""

import pytest

from thermoflow.llm.common import read

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside or return.
CLASHING = (
    "row id at size seed words key name hash tie rank block slot place position score label n_tokens n_bytes fitting_chars n_lines "
    "n_removed _doc_id _key _at _norm _id _sim class_id n_links kept host failed component node rep copies first windows "
    "anchor content first_doc spans text_key body turn root depth"
).split()


@pytest.fixture(scope="session")
def documents(spark):
    return read(spark, SF, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    """Id to text of the given table."""
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def awkward_rows():
    passage = " ".join(f"w{i}" for i in range(70))
    return [
        (None, passage, "en", "a", 1), (None, None, None, None, None), (1, None, "en", "a", None), (2, "", "en", None, 0),
        (3, " \t\n\r\n ", "en", "a", 6), (4, passage, "en", "a", 1), (4, passage, "en", "a", 1), (5, passage, "en", None, 1),
        (6, "one", "en", "b", 3), (7, "One", "en", "b", 3), (8, "ünï çødé 中文   x", "fr", "b", 9),
        (9, "long " * 60_000 + "\n" + "x" * 50_000, "en", "c", 0), (10, "\n".join(["same line of words here"] * 500), "en", "c", 0),
        (11, "token = \"f33e61083db5dbdf4bd2369d2f80176e57f7fda2\"", "en", "c", 0), (11, "another text of eleven", "en", "c", 0),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    """Nulls in any column, empty and long texts, ties, repeated rows and ids, extra columns with clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, DOCUMENTS)
    return df.withColumns({name: F.lit(f"extra {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
