"""Invariants over the whole derived tables (sf0.001)."""

from pyspark.sql import functions as F

from gaugeflow.operators import lineage, silver
from gaugeflow.plans.catalog import layers
from gaugeflow.sources import derived

SF = "/root/testdata/sf0.001"


def test_copies_sum_to_plotted_bronze_rows(spark):
    L = layers(spark, SF, materialize=False)
    flat = lineage.lineage_flat(L.bronze, L.silver, L.series)
    total = flat.agg(F.sum("copies")).first()[0]
    plotted = L.bronze.join(L.series.select("reading_id"), "reading_id", "left_semi").count()
    assert total == plotted


def test_silver_independent_of_layout(spark):
    b = derived.bronze(spark, SF)
    one = silver.build_silver(b, with_build_stamp=False)
    shuffled = silver.build_silver(b.repartition(7, "value").sortWithinPartitions(F.rand(3)), with_build_stamp=False)
    assert one.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(one).count() == 0


def test_one_silver_row_per_key_and_none_lost(spark):
    b = derived.bronze(spark, SF)
    s = silver.build_silver(b, with_build_stamp=False)
    keyed = b.where(F.col("measure").isNotNull() & F.col("date_time").isNotNull()).select("reading_id").distinct()
    assert s.count() == s.select("reading_id").distinct().count() == keyed.count()
