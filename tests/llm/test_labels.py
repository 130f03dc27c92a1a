"""Every label counts for the model and the threshold of op8."""

import random

from pyspark.sql import functions as F

from filmdw.llm import quality


def test_no_label_is_left_out(spark):
    labels = spark.range(50_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("quality"))
    known = quality.labelled(labels.unionByName(labels.limit(10)))
    assert known.count() == 50_000
    good = {r["_good"]: r["n"] for r in known.groupBy("_good").agg(F.count("*").alias("n")).collect()}
    assert good == {False: 16_667, True: 33_333}
    assert 24_000 < known.where("_fits").count() < 26_000


def test_every_label_counts_for_the_target(spark):
    """30,000 labelled documents of one kind: the target's counts are those of the half that fits."""
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    rows = labels.select("doc_id", F.array(F.lit(3), F.lit(5)).alias("_grams"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    fits = quality.labelled(labels).where("_fits").count()
    ratios = quality.log_ratios(rows, quality.labelled(labels), 16)
    assert fits > 14_000
    share = (fits + 1) / (2 * fits + 16) / ((30_000 + 1) / (60_000 + 16))
    assert abs(2.718281828459045 ** ratios[3] - share) < 1e-12


def test_threshold_of_a_table(spark):
    for seed, n, kinds in ((1, 0, 5), (2, 1, 5), (3, 40, 6), (4, 3000, 200), (5, 500, 100_000)):
        rng = random.Random(seed)
        scored = [(round(rng.uniform(-1, 1) * kinds) / kinds, rng.random() < 0.6) for _ in range(n)]
        for some in (scored, [(s, True) for s, _ in scored], [(s, False) for s, _ in scored]):
            held = spark.createDataFrame(some, "score double, _good boolean").repartition(7)
            assert quality.best_threshold_of(held) == quality.best_threshold(some)
