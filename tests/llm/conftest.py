import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for folder in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from conftest_helpers import prose, rows  # noqa: E402

#: Columns whose names operators use themselves.
CLASHING = "size long, target long, score long, uid long, fp long, rank long, text_crc32 long, row long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


@pytest.fixture(scope="session")
def documents(spark):
    def make(entries):
        return spark.createDataFrame(entries, SCHEMA)

    return make


@pytest.fixture(scope="session")
def tricky(documents):
    """Nulls in every column, empty and very long texts, ties, repeated rows, odd characters."""
    base = prose(1, 60)
    entries = rows(
        [
            (1, base),
            (2, base),
            (2, base),
            (3, None),
            (4, ""),
            (5, " \t\n\x0b\x0c\r "),
            (6, "one"),
            (7, "two words"),
            (8, prose(2, 30_000)),
            (9, "ÄÖÜ ünïcödé 漢字 \U0001f600 İ"),
            (10, "x" * 5_000),
            (11, "no break\u0085here"),
            (None, base),
            (None, None),
        ]
    )
    entries.append((12, base, None, None, None, *([None] * 8)))
    entries.append((None, None, None, None, None, *([None] * 8)))
    return documents(entries)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
