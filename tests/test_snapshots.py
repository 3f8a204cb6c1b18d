from pyspark.sql import functions as F

from debtloom.operators.snapshots import snapshot_changes
from debtloom.plans.snapshot_queries import matter_changes

SCHEMA = "snapshot_no int, matter_id string, acn string, appointment_date string, appointment_type string, loaded_at timestamp"


def changes(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.snapshot_no, r.matter_id, r.change_kind): r.changed_columns for r in matter_changes(df).collect()}


def test_kinds_and_meaning(spark):
    rows = [
        (1, "a", "82173001", "1/9/2026", "Receiver", None), (3, "a", "ACN 082 173 001", "2026-09-01", "RECEIVER ", None), (4, "a", "082173002", None, "Receiver", None),
        (1, "b", "1", None, None, None), (4, "b", "1", None, "", None), (3, "c", None, "x", None, None), (4, "c", "", "X ", None, None), (3, "c", None, "x", None, None),
    ]
    got = changes(spark, rows)
    assert set(got) == {(4, "a", "changed"), (3, "b", "removed"), (4, "b", "added"), (3, "c", "added")}
    assert got[4, "a", "changed"] == ["acn", "appointment_date"]


def test_empty_single_and_null_keys(spark):
    assert changes(spark, []) == {}
    assert changes(spark, [(1, "a", None, None, None, None)]) == {}
    assert changes(spark, [(1, None, "1", None, None, None), (2, "a", "1", None, None, None), (None, "a", "2", None, None, None)]) == {}


def test_repeated_rows_take_the_latest_and_clashing_names_do_no_harm(spark):
    df = spark.createDataFrame([(1, "a", "x", 1, "p"), (1, "a", "y", 2, "p"), (2, "a", "y", 1, "q")], "version int, key string, __c string, __v int, value string")
    got = snapshot_changes(df, "key", "version", {"value": F.col("`__c`")}, prefer=[F.col("`__v`")]).collect()
    assert got == []
    got = snapshot_changes(df, "key", "version", {"value": F.col("value")}).collect()
    assert [(r.version, r.key, r.change_kind) for r in got] == [(2, "a", "changed")]


def test_against_brute_force(spark):
    import random

    random.seed(1)
    rows = [(s, f"m{k}", str(random.randrange(3)), None, None, None) for s in (1, 2, 5, 6) for k in range(30) if random.random() < 0.7]
    by = {}
    for s, k, a, *_ in rows:
        by.setdefault(s, {})[k] = a
    want = set()
    for old, new in ((1, 2), (2, 5), (5, 6)):
        want |= {(new, k, "added") for k in by[new].keys() - by[old].keys()} | {(new, k, "removed") for k in by[old].keys() - by[new].keys()}
        want |= {(new, k, "changed") for k in by[new].keys() & by[old].keys() if by[new][k] != by[old][k]}
    assert set(changes(spark, rows)) == want


def test_kept_runs_give_the_same_changes_one_by_one(spark, tmp_path):
    import pytest

    from debtloom.operators.snapshots import SnapshotStore

    rows = [(v, f"k{i}", str((i * v) % 7 if i % 3 else 1)) for v in (1, 2, 5) for i in range(60) if (i + v) % 4]
    df = spark.createDataFrame(rows, "version int, key string, value string")
    want = {(r.version, r.key, r.change_kind) for r in snapshot_changes(df, "key", "version", {"value": F.col("value")}).collect()}
    got = set()
    for v in (1, 2, 5):
        store = SnapshotStore(spark, str(tmp_path / "runs"), "key", "version")
        got |= {(r.version, r.key, r.change_kind) for r in store.append(df.where(F.col("version") == v), {"value": F.col("value")}).collect()}
    assert got == want and len(store.runs()) == 3
    for bad in (df.where("version = 2"), df.limit(0), df):
        with pytest.raises(ValueError):
            store.append(bad, {"value": F.col("value")})
