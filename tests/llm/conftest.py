import random

import pytest


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of small document tables, with columns whose names operators might use themselves."""

    def make(rows):
        full = [(i, t, "en", s, len(t) if t is not None else None, i, "x", 1, "y") for i, t, s in rows]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "line long, node string, label int, score string"
        )
        return spark.createDataFrame(full, schema)

    return make
