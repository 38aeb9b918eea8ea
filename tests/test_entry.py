"""Every registered query against its SQL, and the driver contract."""

import os

import pytest

from compare import compare, oracle
from conftest import SF
from __spark_entry__ import entry, oracle_sql, queries
from tickward.plans.oracles import ORACLES
from tickward.plans.workloads import QUERIES
from tickward.session import shared_dir


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


def test_entry_fires_rules(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(f"{root}/x-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_no_secrets_and_no_local_checkpoints_in_code():
    top = os.path.join(os.path.dirname(__file__), "..", "tickward")
    for folder, _, files in os.walk(top):
        for file in files:
            if file.endswith(".py"):
                text = open(os.path.join(folder, file), encoding="utf-8").read()
                assert "localCheckpoint" not in text
                if not folder.rstrip("/").endswith("llm"):
                    assert ".collect()" not in text and "broadcast(" not in text
