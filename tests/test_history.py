import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.functions.dates import canonical_date
from cohortloom.operators import history
from cohortloom.operators.history import coalesce_history, trial_versions, version_starts
from cohortloom.session import table

SCHEMA = "snapshot_id long, trial_id string, status string, enrollment int, completion_date string, data_collection_date timestamp_ntz, processing_timestamp timestamp_ntz, STATUS_NOTE string"
T0 = dt.datetime(2020, 1, 1)


def rows(*items):
    return [(i, t, s, e, c, d, p, "x") for i, (t, s, e, c, d, p) in enumerate(items)]


def starts(spark, items):
    return sorted(tuple(r) for r in version_starts(spark.createDataFrame(items, SCHEMA)).collect())


def test_changes_blank_null_and_corrections(spark):
    day = lambda n: T0 + dt.timedelta(days=n)
    got = starts(spark, rows(
        ("A", "Recruiting", 5, "2021-03-01", day(0), day(0)),
        ("A", " RECRUITING_ ", 5, "March 1, 2021", day(1), day(1)),  # the same state, written differently
        ("A", "recruiting", 5, "2021-03", day(2), day(2)),  # a month alone is another value
        ("A", "recruiting", None, "2021/03", day(3), day(3)),
        ("A", "recruiting", None, " ", day(4), day(4)),
        ("A", "recruiting", None, None, day(5), day(5)),
        ("A", "Completed", None, None, day(6), day(6)),
        ("A", "recruiting", None, "", day(6), day(9)),  # corrects the row before
        (None, "x", 1, None, day(1), day(1)), ("  ", "x", 1, None, day(1), day(1)), ("B", None, None, None, day(1), None), ("C", "x", 1, None, None, day(1)),
    ))
    assert [x[1][:10] for x in got if x[0] == "A"] == ["2020-01-01", "2020-01-03", "2020-01-04", "2020-01-05"]
    assert [x for x in got if x[0] != "A"] == [("B", "2020-01-02 00:00:00")]


def test_empty_table(spark):
    assert starts(spark, []) == []


@pytest.mark.parametrize("parts, fan_in", [(13, 16), (13, 2), (40, 3)])
def test_periods_of_a_hot_entity_join_across_partitions(spark, monkeypatch, parts, fan_in):
    random.seed(3)
    items, want, prev = [], [], None
    for i in range(4000):
        status = prev if prev and random.random() < 0.9 else random.choice("abc")
        items.append(("HOT", status, 1, None, T0 + dt.timedelta(hours=i), T0))
        if status != prev:
            want.append(T0 + dt.timedelta(hours=i))
        prev = status
    items += [("COLD", "a", 1, None, T0, T0)] * 500  # copies
    df = spark.createDataFrame(rows(*items), SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    monkeypatch.setattr(history, "FAN_IN", fan_in)
    try:
        got = {(r.entity, r.valid_from): r for r in trial_versions(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    hot = sorted(k[1] for k in got if k[0] == "HOT")
    assert hot == want
    ends = [got["HOT", a].valid_to for a in hot]
    assert ends == [*hot[1:], None]
    assert sum(got["HOT", a].observations for a in hot) == 4000
    assert got["COLD", T0].observations == 1


def test_same_as_brute_force_on_the_small_table(spark, small):
    import re

    df = table(spark, small, "trials_scd2_snapshots")
    got = {tuple(r) for r in version_starts(df).collect()}
    best = {}
    for r in df.withColumn("c", canonical_date(F.col("completion_date"))).collect():
        if r.trial_id and r.trial_id.strip():
            k = (r.trial_id, r.data_collection_date)
            if k not in best or (r.processing_timestamp, r.snapshot_id) > (best[k].processing_timestamp, best[k].snapshot_id):
                best[k] = r
    want, prev = set(), None
    for (t, at), r in sorted(best.items()):
        state = (t, re.sub(r"[\W_]+", "", (r.status or "").lower()), r.enrollment, r.c or "")
        if state != prev:
            want.add((t, at.strftime("%Y-%m-%d %H:%M:%S")))
        prev = state
    assert got == want


def test_ties_take_the_largest_id(spark):
    got = trial_versions(spark.createDataFrame(rows(("A", "x", 1, None, T0, T0), ("A", "y", 1, None, T0, T0)), SCHEMA)).collect()
    assert len(got) == 1 and '"y"' in got[0].payload


def test_general_operator_with_other_columns(spark):
    df = spark.createDataFrame([("k", "2020-01-01 00:00:00", 1, 1, "p"), ("k", "2020-01-02 00:00:00", 1, 2, "q")], "e string, at string, w int, id int, v string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    out = coalesce_history(df, "e", "at", "w", "id", {"v": F.col("v")}).collect()
    assert len(out) == 2


def test_date_forms(spark):
    forms = {"2012-03-20": "2012-03-20", "20120320": "2012-03-20", "03/20/2012": "2012-03-20", "2012/03/20": "2012-03-20", "20-MAR-12": "2012-03-20", "Mar 20, 2012": "2012-03-20", "March 20, 2012": "2012-03-20",
             "March 2012": "2012-03", "2012-03": "2012-03", "2012/03": "2012-03", "20 March 2012": "2012-03-20", "2012-03-20T10:00:00": "2012-03-20", "3/5/12": "2012-03-05", "tbd": "tbd", " ": None}
    df = spark.createDataFrame([(k,) for k in forms], "s string").select("s", canonical_date(F.col("s")).alias("c"))
    assert {r.s: r.c for r in df.collect()} == forms
