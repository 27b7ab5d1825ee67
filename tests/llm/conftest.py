import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    # names that operators might want for themselves
    " id string, digest int, size int, found string, place int, word string, part int, label string"
)


@pytest.fixture(scope="session")
def table(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, with clashing columns."""

    def make(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", None, None if r[1] is None else len(r[1]), "x", 1, 2, "f", 3, "w", 4, "l")
            for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make
