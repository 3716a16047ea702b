"""Successive halving against the exhaustive grid, and what it costs."""

from pyspark.sql import functions as F

from cardloom.operators import models as mo
from cardloom.operators.folds import fold_of


def test_halving_finds_the_setting_of_the_grid_at_half_the_cost(spark):
    df = spark.range(2000).select(F.col("id").alias("card_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("z"))
    df = df.withColumn("target", F.col("x") * F.col("z") + F.sin(F.col("card_id").cast("double")))
    matrix = mo.assemble_matrix(df, ["x", "z"], "card_id", "target")
    settings = [{"maxDepth": d, "minInstancesPerNode": n} for d in (1, 2, 5, 3) for n in (400, 1)]
    fold = fold_of(F.col("card_id"), 2, 1)
    est = mo.forest(bootstrap=False, featureSubsetStrategy="all", subsamplingRate=1.0)
    _, best, table = mo.halving_search(est, settings, "numTrees", 8, matrix, fold=fold)
    _, want, _ = mo._search(est, [{**s, "numTrees": 8} for s in settings], matrix, "card_id", "target", 2, 22, 4, "features", fold)
    assert best == {k: v for k, v in want.items() if k != "numTrees"} == {"maxDepth": 5, "minInstancesPerNode": 1}
    rows = table.collect()
    assert sum(r["rounds"] for r in rows) <= 8 * len(settings) / 2
    assert [sum(r["rung"] == i for r in rows) for i in range(4)] == [8, 4, 2, 1]
    assert [r["setting"] for r in rows if r["rung"] == 3] == [settings.index(best)] and rows[-1]["share"] == 1.0


def test_rungs_of_any_number_of_settings():
    for n in (1, 2, 3, 5, 26, 30):
        plan = mo.rungs(n, 100)
        assert plan[0].settings == n and plan[-1].settings == 1 and plan[-1].rounds == 100 and plan[-1].share == 1.0
        assert n < 8 or sum(r.settings * r.rounds for r in plan) <= 0.62 * n * 100
