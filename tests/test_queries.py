"""Every query with SQL, on both engines."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import pytest

from rulelode.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return None
        return round(float(x), 6) if isinstance(x, (int, float, Decimal)) else str(x)

    return sorted(columns), sorted(repr([one(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(catalog.oracle_sql()[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_doc_render_holds_whole_texts(spark):
    told = {r.rule_id: r.rule_text.replace("\n", " ") for r in catalog.placed(spark, SF).select("rule_id", "rule_text").collect() if r.rule_text}
    files = "".join(r.text for r in catalog.doc_render(spark, SF).collect())
    shown = {int(part.split(" -->\n- ", 1)[0]): part.split(" -->\n- ", 1)[1] for part in files.split("<!-- rule:")[1:]}
    assert sum(len(told[i]) > 60 for i in shown) > 10
    assert all(line.startswith(told[i] + " — ") for i, line in shown.items())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["comment_id", "pr_number", "context"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
