"""Every query against its SQL on the smallest tables."""

import importlib.util
from pathlib import Path

import pytest

from finlake.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

ENTRY = Path(__file__).resolve().parent.parent / "__spark_entry__.py"


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, sf, con, name):
    assert name in ORACLES
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.oracle_sql()) <= set(module.queries())
    df = module.entry(spark)
    assert df.columns == ["cnpj", "ano_referencia", "ativo_circulante", "passivo_circulante", "liquidez_corrente"]
    assert df.count() > 0
