"""Plans that keep a task's memory and a query's bytes in bounds."""

import re

import tenderfold.session as S
from tenderfold.plans.queries import QUERIES
import tenderfold.plans.queries_fold  # noqa: F401  (registers more queries)
import tenderfold.plans.queries_staging  # noqa: F401

SF = "/root/testdata/sf0.001"


def _plan(df, of="executedPlan"):
    return getattr(df._jdf.queryExecution(), of)().toString()


def test_two_folds_do_not_share_the_tasks_of_one_stage(spark):
    plan = _plan(QUERIES["events_two_batch_fold"](spark, SF))
    assert plan.count("Sort [") == 0 and "Exchange" not in plan         # what is left reads the written folds


def test_integrity_checks_take_more_tasks_as_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_A_TASK", 100)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    parts = set(re.findall(r"hashpartitioning\(numeroseao#\d+L?, (\d+)\)", _plan(QUERIES["orphans_check"](spark, SF))))
    assert parts == {str(-(-rows // 100))}


def test_bids_take_their_party_from_the_names(spark):
    plan = _plan(QUERIES["migrate_bids"](spark, SF), "optimizedPlan")
    assert not re.search(r"Join Inner, [^\n]*\(seq#\d+ = seq#\d+\)", plan)      # no write is joined to its own copy


def test_release_folds_read_parquet_stages(spark):
    for name in ("release_fold_contracts", "release_fold_parties"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "ExistingRDD" not in plan and "FileScan parquet" in plan


def test_a_batch_stages_events_and_versions_once(spark, tmp_path, monkeypatch):
    from tenderfold.streaming import incremental as INC
    from tenderfold.streaming.state import Run
    names, staged = [], Run.staged
    monkeypatch.setattr(Run, "staged", lambda run, df, name: names.append(name) or staged(run, df, name))
    doc = '{"releases": [{"ocid": "o1", "id": "r1", "tender": {"lots": [{"id": "L1"}]}, "parties": [{"id": "P1", "name": "x", "roles": ["buyer"]}]}]}'
    docs = spark.createDataFrame([("mensuel_20210101_20210131.json", doc)], "file_name string, value string")
    INC.fold_releases(docs, "one", INC.release_state(spark, str(tmp_path), 4), batch_ts="2024-01-01 00:00:00")
    for table in INC.TABLE_KEYS:
        assert names.count(f"{table}_events") == 1 and names.count(f"_{table}_versions") == 1, table
    assert INC.current_tables(spark, str(tmp_path))["lots"].count() == 1


def test_documents_are_delivered_without_a_second_copy(spark, monkeypatch, tmp_path):
    import os
    from types import SimpleNamespace
    from pyspark.sql import functions as F
    from tenderfold.plans import queries_stream as Q
    monkeypatch.setattr(Q, "shared_path", lambda _spark, name: str(tmp_path / name))
    docs = spark.createDataFrame([("a", "1", 0), ("b", "2", 2)], "file_name string, value string, k int")
    done = SimpleNamespace(awaitTermination=lambda: True, exception=lambda: None)
    Q._deliver(spark, docs, F.col("k"), lambda source, checkpoint: done)
    assert [n for n in os.listdir(tmp_path / "publications" / "all") if n.startswith("batch=")] == []
    assert spark.read.parquet(str(tmp_path / "publications" / "inbox" / "n=*")).count() == 2
