"""The learners' table: as its definition says, and written once, so that no fold computes or shuffles it again."""

from conftest import SF
from pyspark.sql import functions as F

from tessera.operators import groups
from tessera.plans import bindings as B
from tessera.plans import pair_queries


def test_training_table(spark):
    rows = pair_queries._training(spark, SF)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    hit = B.pair_truth(spark, SF).withColumn("_hit", F.lit(1.0))
    wanted = groups.pruned(pair_queries._competition(spark, SF), "p", 8, 0.0).join(hit, ["rec", "s1"], "left")
    wanted = wanted.select("rec", "s1", "ord", "country", *pair_queries.FEATURES, F.coalesce("_hit", F.lit(0.0)).alias("label"))
    assert rows.columns == wanted.columns
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, wanted.collect())) != []
