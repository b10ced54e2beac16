"""Ordered operators split over spans give what one window over the whole group gives."""

import random

import pytest
from pyspark.sql import Window as W, functions as F

from assayflow.operators import ordered as od


@pytest.fixture(params=[1, 3, 4096])
def span(request, monkeypatch):
    monkeypatch.setattr(od, "SPAN", request.param)


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(5)
    data = [(None if k % 17 == 0 else 1 if k % 3 else k % 5, k, pick.choice([None, 1, 2]), pick.choice([None, "a", "b"])) for k in range(120) if k % 7]
    return spark.createDataFrame(data, "g int, k bigint, page int, v string")


def _same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_neighbours(rows, span):
    w = W.partitionBy("g").orderBy("k")
    _same(od.with_neighbours(rows, "g", "k", F.col("v")).select("g", "k", "prev", "next"), rows.select("g", "k", F.lag("v").over(w), F.lead("v").over(w)))


def test_running_count(rows, span):
    step = F.when(F.col("v") == "a", 2).otherwise(1)
    w = W.partitionBy("g").orderBy("k")
    _same(od.running_count(rows, "g", "k", step).select("g", "k", "total"), rows.select("g", "k", F.sum(step).over(w)))
    w = W.partitionBy("g").orderBy("page", "k")
    _same(od.running_count(rows, "g", "k", F.lit(1), lead=("page",)).select("g", "k", "total"), rows.select("g", "k", F.row_number().over(w)))


def test_carried(rows, span):
    w = W.partitionBy("g").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    _same(od.carried(rows, "g", "k", F.col("v")).select("g", "k", "carried"), rows.select("g", "k", F.last("v", ignorenulls=True).over(w)))


def test_after_first(rows, span):
    w = W.partitionBy("g").orderBy("k").rowsBetween(W.unboundedPreceding, 0)
    hit = F.col("v") == "b"
    _same(od.after_first(rows, "g", "k", hit).select("g", "k", "after"), rows.select("g", "k", F.max(F.coalesce(hit, F.lit(False))).over(w)))


def test_empty_table(rows):
    none = rows.limit(0)
    assert od.with_neighbours(none, "g", "k", F.col("v")).count() == 0 and od.running_count(none, "g", "k", F.lit(1)).count() == 0
    assert od.carried(none, "g", "k", F.col("v")).count() == 0 and od.after_first(none, "g", "k", F.col("v") == "b").count() == 0
