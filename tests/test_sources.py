"""T1: delimited text, duplicate policies, hold-out split, JSON report."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kinnear.sources.ratings import (
    coalesce_duplicates,
    count_rejected,
    holdout_split,
    read_ratings,
)
from kinnear.sources.report import write_report


def _write(lines):
    d = tempfile.mkdtemp(prefix="kinnear-t1-", dir="/tmp")
    p = os.path.join(d, "ratings.txt")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


@pytest.mark.parametrize(
    "line,sep",
    [
        ("1\t10\t5\t881250949", "\t"),
        ("1::10::5::978300760", "::"),
        ("1,10;5", "[,;]"),
    ],
)
def test_formats(spark, line, sep):
    rows = read_ratings(spark, _write([line]), sep=sep).collect()
    assert [tuple(r) for r in rows] == [(1, 10, 5.0)]


def test_padded_fields_are_trimmed(spark):
    rows = read_ratings(spark, _write(["2::11 ::3::98"]), sep="::").collect()
    assert [tuple(r) for r in rows] == [(2, 11, 3.0)]


def test_literal_separator(spark):
    rows = read_ratings(spark, _write(["7|8|2.5"]), sep="|", literal=True).collect()
    assert [tuple(r) for r in rows] == [(7, 8, 2.5)]


def test_malformed_strict_fails_lenient_counts(spark):
    p = _write(["x::1::2", "1::2::3"])
    with pytest.raises(Exception, match="malformed rating line"):
        read_ratings(spark, p, sep="::").collect()
    ok = read_ratings(spark, p, sep="::", mode="lenient").collect()
    assert [tuple(r) for r in ok] == [(1, 2, 3.0)]
    assert count_rejected(spark.read.text(p), sep="::").first().rejected == 1


def test_duplicate_policies(spark):
    df = read_ratings(spark, _write(["1::10::2", "1::10::3", "2::10::4"]), sep="::")
    get = lambda pol: {(r.user, r.item): r.rating for r in coalesce_duplicates(df, pol).collect()}
    assert get("sum")[(1, 10)] == 5.0
    assert get("max")[(1, 10)] == 3.0
    assert get("mean")[(1, 10)] == 2.5
    with pytest.raises(Exception, match="duplicate rating"):
        get("error")


def test_holdout_split_rules(spark):
    rows = [(1, i, 3.0) for i in range(1, 6)] + [(2, 1, 4.0), (2, 2, 5.0)]
    df = spark.createDataFrame(rows, "user long, item long, rating double")
    h = holdout_split(df, n=2)
    flags = {(r.user, r.item): r.is_test for r in h.collect()}
    assert sum(flags[(1, i)] for i in range(1, 6)) == 2
    # a user with n or fewer cells keeps everything in train
    assert not flags[(2, 1)] and not flags[(2, 2)]
    assert h.count() == len(rows)


def test_holdout_takes_large_and_repeated_ids(spark):
    """No overflow at user 8e17; rows that repeat a cell are one cell and aren't multiplied."""
    big = 8 * 10**17
    rows = [(big, big + i, 3.0) for i in range(5)] + [(1, 1, 2.0), (1, 1, 4.0), (1, 2, 1.0), (1, 3, 1.0)]
    h = holdout_split(spark.createDataFrame(rows, "user long, item long, rating double"), n=2).collect()
    assert len(h) == len(rows)
    assert sum(r.is_test for r in h if r.user == big) == 2
    assert len({r.is_test for r in h if (r.user, r.item) == (1, 1)}) == 1
    assert len({(r.user, r.item) for r in h if r.user == 1 and r.is_test}) == 2


def test_report_json(spark):
    m = spark.createDataFrame(
        [("k=30", "mae", 1.5), ("k=30", "edges", 10.0), ("data", "test_cells", 4.0)],
        "section string, metric string, value double",
    )
    out = tempfile.mkdtemp(prefix="kinnear-report-", dir="/tmp")
    write_report(m, out + "/r")
    files = [f for f in os.listdir(out + "/r") if f.endswith(".json")]
    objs = [json.loads(line) for f in files for line in open(os.path.join(out, "r", f))]
    by = {o["section"]: o["metrics"] for o in objs}
    assert by == {"k=30": {"edges": 10.0, "mae": 1.5}, "data": {"test_cells": 4.0}}


LINES = ["1::10::5::978300760", "2::11 ::3::98::x", " 3::12:: 4.5 ", "4::13", "x::1::2", "5::14::y::1", "6::15::2"]


def _written(spark, lines):
    folder = tempfile.mkdtemp(prefix="kinnear-test-", dir="/tmp") + "/lines"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    return folder


@pytest.mark.parametrize("sep", ["::", "\t", "|", "#@#"])
def test_csv_source_reads_what_the_text_path_reads(spark, sep):
    """Padded and extra fields, separators of one or more characters that are no pattern."""
    from kinnear.sources.ratings import read_ratings_csv

    good = _written(spark, [x.replace("::", sep) for x in LINES[:3] + LINES[6:]])
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(read_ratings_csv(spark, good, sep)) == rows(read_ratings(spark, good, sep, literal=True)) == [
        (1, 10, 5.0), (2, 11, 3.0), (3, 12, 4.5), (6, 15, 2.0)]
    bad = _written(spark, [x.replace("::", sep) for x in LINES])
    assert rows(read_ratings_csv(spark, bad, sep, "lenient")) == rows(read_ratings(spark, bad, sep, literal=True, mode="lenient"))
    with pytest.raises(Exception, match="malformed rating line"):
        read_ratings_csv(spark, bad, sep).collect()
    quoted = _written(spark, ['"1"::2::3'.replace("::", sep), '7::8::"9'.replace("::", sep)])
    assert rows(read_ratings_csv(spark, quoted, sep, "lenient")) == []


def test_rejects_are_counted_in_the_reading_pass(spark):
    from kinnear.sources.ratings import read_ratings_counted

    ratings, seen = read_ratings_counted(spark, _written(spark, LINES), "::")
    assert sorted(r.user for r in ratings.collect()) == [1, 2, 3, 6]
    assert seen.get == {"lines": 7, "rejected": 3}
    empty, none = read_ratings_counted(spark, _written(spark, []), "::")
    assert empty.collect() == [] and none.get == {"lines": 0, "rejected": 0}


def test_split_into_two_files(spark):
    from kinnear.sources.ratings import read_split, write_split

    rows = [(u, i, float(1 + (u + i) % 5), (u + i) % 3 == 0, 1000 + u) for u in range(20) for i in range(5)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double, is_test boolean, at long")
    folder = tempfile.mkdtemp(prefix="kinnear-test-", dir="/tmp") + "/split"
    write_split(ratings, folder, "::")
    for side in ("train", "test"):
        found = read_split(spark, folder, side, "::")
        assert sorted(map(tuple, found.collect())) == sorted(r[:3] for r in rows if r[3] == (side == "test"))
        assert sorted(map(tuple, read_ratings(spark, f"{folder}/side={side}", "::").collect())) == sorted(map(tuple, found.collect()))
        scan = read_split(spark, folder, side, "::")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(side" in scan


def test_policies_deal_by_rows(spark, monkeypatch):
    """Pairs are dealt into tasks by the number of rows, once for all policies, whatever adaptive execution would merge."""
    from kinnear.sources import ratings as R

    monkeypatch.setattr(R, "TASK_ROWS", 100)
    lines = spark.range(1000).select((F.col("id") % 40).alias("user"), (F.col("id") % 7).alias("item"), F.lit(2.0).alias("rating"))
    (out,) = R.dealt([lines], ["user", "item"])
    sums = R.coalesce_duplicates(out, "sum")
    assert sums.rdd.getNumPartitions() == 10
    assert sums.agg(F.sum("rating")).first()[0] == 2000.0 and sums.count() == 280
