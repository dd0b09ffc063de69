"""Every query against its SQL on the smallest data, and the plans of the scans."""

import re
from collections import Counter
from pathlib import Path
from xml.etree import ElementTree as ET

import duckdb
import pytest

import __spark_entry__ as entry
from compare import bag

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")
SKIP_LLM = {n for n in entry.queries() if n[0] == "p" and n[1].isdigit() and n[1] not in "134"}
NAMES = sorted(set(entry.queries()) - SKIP_LLM)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = Counter(re.findall(r"sf0.001/(\w+)\.parquet", plan))
    assert max(scans.values(), default=0) <= 4 and "CartesianProduct" not in plan and "NestedLoop" not in plan, scans
    rows = [r.asDict(recursive=True) for r in df.collect()]
    if name == "akn_acts":
        acts = {}
        for r in sorted(rows, key=lambda r: (r["act_id"], r["part"], r["ord"])):
            acts[r["act_id"]] = acts.get(r["act_id"], "") + r["xml"]
        assert len([ET.fromstring(x) for x in acts.values()]) > 10
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(df.columns) == len(set(df.columns))
        return
    cur = con.execute(sql)
    assert bag(df.columns, [tuple(r.values()) for r in rows]) == bag([c[0] for c in cur.description], cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["table_name", "row_id", "reason"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
