"""Nothing that grows with the input is broadcast, however small Spark takes it for."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadlens.operators import chains, components, dedupe, forest, ranks, similarity, validate
from roadlens.plans import catalogue
from roadlens.plans import fixtures as fx
from roadlens.session import materialize


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all scratch tables, as they are written."""
    seen = []

    def written(df, *a, **b):
        seen.append(plan(df))
        return materialize(df, *a, **b)

    for module in (chains, components, dedupe, forest, similarity, validate, catalogue):
        monkeypatch.setattr(module, "materialize", written)
    return seen


@pytest.mark.parametrize("name", ["near_duplicate_pairs", "cross_split_leakage", "leakage_classes", "duplicate_clusters", "merge_keepers_combined", "dedupe_removals_combined", "chain_links", "incremental_clusters"])
def test_tables_that_grow_are_shuffled(spark, sf, plans, name):
    out = catalogue.QUERIES[name](spark, sf)
    assert plans
    assert not [p for p in [*plans, plan(out)] if "Broadcast" in p]


def test_findings_of_files_are_shuffled(spark, sf, plans):
    files = fx.hashed_prints(spark, sf)
    told = [validate.duplicate_images(files), validate.leaked_images(files), fx.labels(spark, sf)]
    assert not [p for p in [*plans, *map(plan, told)] if "Broadcast" in p]


@pytest.fixture
def four_ranges(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_of_many_groups_are_not_carried(spark, four_ranges):
    """Of 2,000 groups only those in several ranges have a row that is broadcast: two for each range at most, and the ranks are right."""
    rows = spark.range(10_000).selectExpr("id % 2000 AS g", "id AS o").unionByName(spark.range(6000).selectExpr("7L AS g", "20000 + id AS o"))
    dealt = ranks.in_ranges(rows, ["g"], [F.col("o")])
    cells = dealt.groupBy("g", "__cell").agg(F.count(F.lit(1)).alias("n"))
    carried = ranks.carried(cells, ["g"], {"b": F.sum("n").over(Window.partitionBy("g").orderBy("__cell"))})
    assert 0 < carried.count() <= 2 * cells.select("__cell").distinct().count()
    got = ranks.ranked(rows, ["g"], [F.col("o")])
    want = rows.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert got.count() == 16_000 and got.exceptAll(want).isEmpty()
