"""Every query with SQL gives the SQL's rows; the others are checked elsewhere."""

import compare
import duck_oracle
import pytest
from conftest import FOLDER

from restock.queries import CATALOGUE

SQL = duck_oracle.queries()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(CATALOGUE)
    assert set(CATALOGUE) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, oracle, name):
    names, rows = compare.spark_rows(CATALOGUE[name](spark, FOLDER))
    sql_names, sql_rows = compare.sql_rows(oracle, SQL[name])
    assert names == sql_names
    assert rows == sql_rows


def test_documents_are_unique(spark):
    detail = CATALOGUE["doc_enrich"](spark, FOLDER)
    assert detail.count() == detail.select("doc").distinct().count() > 0


def test_emitted_messages_hold_the_rows(spark):
    import json

    messages = [r.value for r in CATALOGUE["cdc_emit_json"](spark, FOLDER).collect()]
    rows = {tuple(r) for r in CATALOGUE["cdc_apply"](spark, FOLDER).collect()}
    assert {tuple(json.loads(m)[c] for c in ("id", "value", "event_type", "k")) for m in messages} == rows
