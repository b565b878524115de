import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark import cloudpickle

from stratus import session


def fake(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder), sparkContext=SimpleNamespace(master=master)
    )


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_folder(fake("spark://host:7077", None))


def test_a_local_master_may_use_a_temporary_folder():
    folder = session.shared_folder(fake("local[2]", None))
    assert folder == session.shared_folder(fake("local[*]", None))


def test_materialise_keeps_rows_and_cuts_the_plan(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    stored = session.materialise(df, "t")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_functions_reach_workers_that_lack_the_package(tmp_path):
    from stratus.operators.alerts import throttle_instants
    from stratus.streaming.holding import HoldProcessor
    from stratus.streaming.throttling import ThrottleProcessor

    shipped = tmp_path / "shipped"
    shipped.write_bytes(cloudpickle.dumps((throttle_instants, HoldProcessor(["k"], 1), ThrottleProcessor())))
    code = (
        "import pickle, sys, numpy\n"
        f"throttle, *_ = pickle.load(open({str(shipped)!r}, 'rb'))\n"
        "assert 'stratus' not in sys.modules\n"
        "assert list(throttle(numpy.array([0, 1, 5]), 2)) == [0, 2]\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=100)
