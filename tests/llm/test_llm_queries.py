import zlib

import pytest

from parity import connect, differences
from plotwright.llm.queries import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLE = {"op3_url_rules": "pages", "op6_lattice": "embeddings", "op11_hard_negatives": "embeddings"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_one_row_for_each_given(spark, name):
    given = spark.read.parquet(f"{SF_DIR}/{TABLE.get(name, 'documents')}.parquet")
    assert queries()[name](spark, SF_DIR).count() == given.count()


def test_folds_are_those_of_crc32(spark):
    for name, modulus, left in (("op1_toxicity", 5, 0), ("op8_language", 4, 2)):
        for r in queries()[name](spark, SF_DIR).select("doc_id", "held_out").collect():
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == left)
