"""Small document tables with the awkward rows every operator must take: nulls, empty and long texts, copies, clashing columns."""

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rid long, fp string, score string, term string, uid string"


@pytest.fixture(scope="session")
def docs_frame(spark):
    """rows of (doc_id, text) or (doc_id, text, lang) -> documents with extra columns that operators also use as names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or ""), 7, "x", "y", "z", "w") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    def make(seed, words, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary):x}{rng.choice('xyz')}" for _ in range(words))

    return make


@pytest.fixture(scope="session")
def real(spark):
    """The smallest given tables as Python rows."""

    def read(name, *cols):
        return [tuple(r) for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(*cols).collect()]

    return read


SF = "/root/testdata/sf0.001"
