"""Tables in the shared folder go when nothing reads them again."""

import os

from pyspark.sql import functions as F

from conftest import rows
from tripleweft.plans.components import components
from tripleweft.scratch import BatchScratch, Steps, base_dir, result_alone, write_and_read


def folders(spark):
    return {p.rsplit("-", 1)[0] for p in os.listdir(base_dir(spark)) if p.startswith("scratch-")}


def test_loops_keep_their_last_table(spark):
    steps, df = Steps("scratch-loop"), spark.range(5).toDF("n")
    for _ in range(4):
        df = steps.write(df.select((F.col("n") + 1).alias("n")))
    assert rows(df) == [(n,) for n in range(4, 9)]
    assert sum(p.startswith("scratch-loop") for p in os.listdir(base_dir(spark))) == 1
    steps.drop(spark)
    assert "scratch-loop" not in folders(spark)


def test_results_stand_alone(spark):
    def make():
        one, steps = write_and_read(spark.range(3).toDF("n"), "scratch-one"), Steps("scratch-two")
        return one.join(steps.write(one.select("n")), "n")

    out = result_alone(spark, make, "scratch-result")
    assert folders(spark) == {"scratch-result"} and rows(out) == [(0,), (1,), (2,)]
    batch = BatchScratch()
    batch.begin(spark, 1)
    result_alone(spark, make, "scratch-batch")
    batch.end()
    assert "scratch-batch" in folders(spark)
    batch.begin(spark, 2)
    batch.end()
    assert folders(spark) == {"scratch-result"}


def test_components_leave_one_table(spark):
    before = set(os.listdir(base_dir(spark)))
    found = components(spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long"))
    assert len(set(os.listdir(base_dir(spark))) - before) == 1 and found.count() == 41
