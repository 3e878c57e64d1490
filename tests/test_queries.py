import json
import os
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest

from tests.oracle import assert_same, bag, twin
from tidewell.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_twin(spark, data, name):
    df = catalog.QUERIES[name](spark, data)
    if name in catalog.ORACLE_SQL:
        assert assert_same(df, catalog.ORACLE_SQL[name], data) > 0
    else:
        assert df.count() > 0


def test_latest_version_is_limited_before_the_shuffle(spark, data):
    plan = catalog.cdc_latest_upserts(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scans_read_only_what_they_need(spark, data):
    plan = catalog.skew_groups(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "l_suppkey" in plan and "l_discount" not in plan


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


ON_A_CLUSTER = """
import json, sys
from pyspark.sql import SparkSession
from tidewell.plans import catalog
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config(map=json.loads(sys.argv[1])).getOrCreate()
for name in sys.argv[3:]:
    df = catalog.QUERIES[name](spark, sys.argv[2])
    print(json.dumps([name, sorted(df.columns), [[r[c] for c in sorted(df.columns)] for r in df.collect()]]), flush=True)
"""
DATABASE_QUERIES = ["jdbc_bounds", "jdbc_pushed_query", "jdbc_range_read"]


@pytest.fixture(scope="module")
def on_a_cluster(data, tmp_path_factory):
    """Results of queries with two executors, which share nothing but the checkpoint folder with the driver."""
    base, root = tmp_path_factory.mktemp("cluster"), Path(pyspark.__file__).parent
    for p in root.iterdir():  # executors work below Spark's home
        if p.name != "work":
            (base / p.name).symlink_to(p)
    (base / "work").mkdir()
    conf = {"spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.executor.memory": "1024m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1"}
    env = os.environ | {"SPARK_HOME": str(base), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    env = {k: v for k, v in env.items() if k not in {"PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET"}}
    ran = subprocess.run([sys.executable, "-c", ON_A_CLUSTER, json.dumps(conf), data, *DATABASE_QUERIES], env=env, cwd=base, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-3000:]
    return {name: (columns, rows) for name, columns, rows in map(json.loads, ran.stdout.splitlines())}


@pytest.mark.parametrize("name", DATABASE_QUERIES)
def test_executors_reach_the_database(on_a_cluster, data, name):
    columns, rows = on_a_cluster[name]
    names, wanted = twin(catalog.ORACLE_SQL[name], data)
    at = [names.index(c) for c in columns]
    assert rows and bag(rows) == bag([[r[i] for i in at] for r in wanted])
