"""Every registered query against its DuckDB oracle on the sf0.001 tables (same check as the driver)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import check

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 20  # FIXTURES.md §6


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    r = check(spark, duck, SF_SMALL, key, QUERIES[key], ORACLE.get(key))
    assert r["status"] in ("ok", "rows-only"), r
    if key not in ORACLE:
        assert r["spark_rows"] > 0


def test_checked_counts(spark):
    # FIXTURES.md §6 at sf0.001
    got = {tuple(r)[:3] for r in QUERIES["mei_inactive_by_status"](spark, SF_SMALL).collect()}
    assert got == {(3, "SUSPENSA", 29), (4, "INAPTA", 27), (8, "BAIXADA", 23)}
    assert QUERIES["mei_active_leads"](spark, SF_SMALL).count() == 93
    h = QUERIES["health_leads"](spark, SF_SMALL)
    assert h.count() == 6 and h.where("tipo_saude = 'CLINICA'").count() == 3
    assert tuple(QUERIES["establishment_count"](spark, SF_SMALL).first()) == (1500, 1495)
