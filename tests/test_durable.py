"""Intermediate rows on a cluster whose machines mount one folder."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from matchcast import durable as module
from matchcast.durable import durable, scratch_folder


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session as a standalone cluster names itself; its checkpoint folder stays a mounted one, ``file:``."""
    durable(spark.range(1))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.sparkContext, "_matchcast_tried", None, raising=False)
    assert spark.sparkContext.getCheckpointDir().startswith("file:")
    return spark


def test_a_mounted_folder_serves_a_cluster(cluster):
    assert sorted(r["id"] for r in durable(cluster.range(5)).collect()) == [0, 1, 2, 3, 4]
    assert scratch_folder(cluster) == cluster.sparkContext.getCheckpointDir()


@pytest.mark.parametrize("name", ["csv_round_trip", "expanding_fold_rows", "accuracy"])
def test_queries_run_on_a_cluster(cluster, name):
    assert entry.queries()[name](cluster, SMALL).count() > 0


def test_the_folder_is_tried_once(cluster, monkeypatch):
    tried = []
    monkeypatch.setattr(type(cluster), "range", lambda *a, f=type(cluster).range: tried.append(a[1:]) or f(*a))
    for _ in range(3):
        module._set_folder(cluster)
    assert len(tried) == 1


def test_a_folder_of_one_machine_is_an_error(cluster, monkeypatch):
    def unseen(df, eager=True):
        raise OSError("a different number of partitions")

    monkeypatch.setattr(type(cluster.range(1)), "checkpoint", unseen)
    with pytest.raises(RuntimeError, match="one machine"):
        scratch_folder(cluster)


@pytest.fixture(scope="module")
def orders_and_customers(spark, tmp_path_factory):
    """Rows of its own: 600 orders of 40 customers over 150 days."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(2024, 1, 1)
    orders = [(i, i * 7 % 40, "FOP"[i * i % 3], 100.0 + i * 37 % 900, day + dt.timedelta(days=i // 4)) for i in range(600)]
    customers = [(i, f"Customer {i}", i * 3 % 25, i * 211 % 1000 - 300.0) for i in range(40)]
    for name, rows, columns in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        ("customer", customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
    ):
        spark.createDataFrame(rows, columns).write.parquet(f"{folder}/{name}.parquet")
    return folder


#: Queries that write intermediate rows, and the rows they return.
WRITING = {
    "analyse_features": 72,
    "anova_f": 36,
    "auc": 18,
    "augment_exact": 237,
    "bag": 120,
    "bayes_out_of_fold": 480,
    "best_model": 1,
    "bootstrap_exact": 1149,
    "bootstrap_exact_sizes": 10,
    "bootstrap_logistic": 120,
    "bootstrap_majority": 120,
    "brier": 18,
    "calibrate": 120,
    "class_metrics": 18,
    "class_report": 90,
    "confusion": 18,
    "corr_filter": 36,
    "csv_round_trip": 600,
    "ece": 18,
    "empty_gate": 1,
    "evaluate_scores": 18,
}


@pytest.mark.parametrize("name", WRITING)
def test_named_queries_run_on_a_cluster(cluster, orders_and_customers, name):
    assert entry.queries()[name](cluster, orders_and_customers).count() == WRITING[name]
