"""Every query outside llm gives exactly the rows and columns of its SQL; floats to six places, nothing looser."""

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = {k: (f, part.ORACLES[k]) for part in __spark_entry__.PARTS for k, f in part.QUERIES.items()}
#: Queries that may have no row at this size.
MAY_BE_EMPTY = {"policy_denied", "join_anti_orphans", "alert_large_burst", "alert_claim_ratio", "report_breaches", "check_insurance_breaches", "scalar_subquery", "join_semi_restrict", "join_claims_premiums", "alert_unusual_country", "check_recent_alerts"}


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    f, sql = QUERIES[name]
    df = f(spark, SF)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns) and len(set(names)) == len(names)
    want = sorted((plain(r) for r in cur.fetchall()), key=repr)
    assert sorted((plain(tuple(r)) for r in df.select(*names).collect()), key=repr) == want
    assert want or name in MAY_BE_EMPTY


def test_names_are_registered_once():
    assert len(QUERIES) == sum(len(part.QUERIES) for part in __spark_entry__.PARTS) and all(part.QUERIES.keys() == part.ORACLES.keys() for part in __spark_entry__.PARTS)


def scans(df, table, column):
    """How many times a plan reads a base table, known by one of its columns."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(column in line for line in plan.splitlines() if "Relation [" in line)


def test_metrics_read_lines_once(spark):
    """Months of loans come from one pass over lines, and metrics that don't count outliers work out no limits."""
    for name, most in (("gold_npl", 1), ("report_banking", 1), ("gold_arpu", 1), ("gold_claim_time", 1)):
        assert scans(QUERIES[name][0](spark, SF), "lineitem", "l_orderkey") == most, name


@pytest.mark.parametrize("name", ["check_npl_latest", "check_banking_by_regulator"])
def test_metrics_named_twice_are_made_once(spark, name):
    assert scans(QUERIES[name][0](spark, SF), "lineitem", "l_orderkey") == 0


def test_volumes_shuffle_lines_for_no_limits(spark):
    assert scans(QUERIES["check_metric_volumes"][0](spark, SF), "lineitem", "l_orderkey") <= 6
