"""The registered queries: against their SQL where there is one, else that they cover the table."""

import oracle
import pytest

import __spark_entry__ as entry
from dimweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS_OF = {
    "op1_html_extraction": "pages", "op3_simhash": "documents", "op5_token_counts": "documents",
    "op9_toxicity": "documents",
}


def test_registered():
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    rows, difference = oracle.compare(oracle.connect(SF), QUERIES[name](spark, SF), ORACLES[name])
    assert difference is None and rows > 0


@pytest.mark.parametrize("name", sorted(ROWS_OF))
def test_whole_table(spark, name):
    want = spark.read.parquet(f"{SF}/{ROWS_OF[name]}.parquet").count()
    assert QUERIES[name](spark, SF).count() == want
