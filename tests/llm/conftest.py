import pytest

from carecast.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, a string, b string, node string, size string, _tie string, tie string"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table with columns whose names the operators use inside."""
    ship_package(spark)

    def make(rows, sources=("s",)):
        full = [(i, t, "en", sources[k % len(sources)], None if t is None else len(t), "x", "x", "x", "x", "x", "x")
                for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, SCHEMA)

    return make
