"""The corpus queries that have SQL equal it, on given tables and on odd rows."""

from __future__ import annotations

import duckdb
import pytest

from dockside.llm.queries import ORACLE, QUERIES


def rows_and_sql(spark, name, folder):
    mine = QUERIES[name](spark, folder)
    columns = sorted(mine.columns)
    with duckdb.connect() as con:
        for table in ("documents", "embeddings"):
            try:
                con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
            except duckdb.IOException:
                pass
        sql = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    return sorted(map(str, (tuple(r) for r in mine.select(columns).collect()))), sorted(map(str, sql))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_given_tables(spark, name):
    mine, sql = rows_and_sql(spark, name, "/root/testdata/sf0.001")
    assert mine and mine == sql


def test_quality_rules_on_odd_rows(spark, tmp_path):
    shared = "All rights\t reserved 20{}.\nSee the terms"
    own = " ".join(f"word{{0}}x{k}" for k in range(60))
    rows = [(n, f"{shared.format(n % 10)}\n{own.format(n)}", "en", "hot", 1) for n in range(40)]
    rows += [(100 + n, f"{shared.format(n % 10)}\nshort {n}", "en", None, 1) for n in range(30)]
    rows += [(None, None, None, None, None), (None, "", "en", "hot", 0), (7, " \t\x0b\n\r ", "en", "hot", 0)]
    rows += [(8, "a b c " * 40, "en", "hot", 1), (9, "a b c a b c", "en", "", 1), (9, "a b c a b c", "en", "", 1)]
    rows += [(10, "#*$ %&|<> é ü " + own.format("é"), "en", "hot", 1), (11, "one two three", "en", "x", 1)]
    rows += [(12, "\n".join(["same line here"] * 3 + ["Same Line here"]) + own.format(1), "en", "x", 1)]
    rows += [(13, "long " + " ".join(str(k) for k in range(50_000)), "en", "hot", 1)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    table.coalesce(1).write.parquet(f"{tmp_path}/written")
    part = next((tmp_path / "written").glob("*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    mine, sql = rows_and_sql(spark, "op10_quality_rules", str(tmp_path))
    assert mine == sql and len(mine) == len(rows)
    assert any("True" in r for r in mine)
