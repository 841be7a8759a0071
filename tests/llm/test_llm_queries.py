"""Every query that has SQL against that SQL, over the same tables."""

import duckdb
import pytest

from qadump.llm import queries

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def against_sql(spark, name, sf_dir):
    result = queries.queries()[name](spark, sf_dir)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = con.execute(queries.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(names) == sorted(result.columns)
    rows = sorted(map(repr, expected.fetchall()))
    assert sorted(repr(tuple(r)) for r in result.select(*names).collect()) == rows
    return rows


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert against_sql(spark, name, SF_DIR)


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_odd_tables_equal_their_sql(spark, name, tmp_path):
    tables = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "embeddings": "vec_id long, embedding array<float>, label int",
        "pages": "page_id long, url string, html string",
        "benchmark": "item_id long, text string",
        "labels": "doc_id long, quality int, toxic int",
        "conversations": "conv_id long, turn long, role string, text string",
    }
    words = "The QUICK brown-fox, \u00c9t\u00e9 7 na\u00efve \u6f22\u5b57 "
    data = {
        "documents": [
            (1, words * 9, "en", "a", 1),
            (2, words * 9, None, None, None),
            (2, words * 9, "en", "a", 1),
            (3, None, "en", "a", 1),
            (4, "", "en", "a", 1),
            (5, "\x00\x7f -- !", "en", "a", 1),
            (6, "x" * 20_000, "en", "a", 1),
            (7, "one two " * 3_000, "en", "a", 1),
        ],
        "pages": [
            (1, "HTTP://A.Example.NET/en/\u00e9?x", ""),
            (1, "http://a.example.net/EN/", ""),
            (None, "x://org/fr/://y", None),
            (3, None, None),
            (4, "no scheme", ""),
            (5, "://net/", ""),
        ],
        "benchmark": [(1, words), (2, None), (3, "")],
        "conversations": [
            (c, t, role, text)
            for c in (0, 1, 2, 4, 7, 10, 12, 1_000_000_007)
            for t, role, text in (
                (None, "user", "first"), (None, None, None), (3, "user", "\u00e9"), (3, "", "tie"), (3, "", "tie"), (9, "a", "z" * c if c < 99 else "")
            )[: 1 + c % 6]
        ]
        + [(None, 1, "user", "none")],
    }
    for table, kind in tables.items():
        spark.createDataFrame(data.get(table, []), kind).coalesce(1).write.parquet(f"{tmp_path}/{table}")
        (file,) = (tmp_path / table).glob("part-*.parquet")
        file.rename(tmp_path / f"{table}.parquet")
    assert against_sql(spark, name, str(tmp_path))
