import pytest

from chronicell.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores=4, shuffle_partitions=4, app="chronicell-llm-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOCS)

    return make
