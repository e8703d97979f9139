"""Hot keys give the same rows as plain joins, and plans have the intended shape."""

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tripleweft import Mapping, TriplesMap, materialise, ref, triples_of
from tripleweft.operators.aggregates import distinct_triple_count
from tripleweft.operators.events import merge_bins
from tripleweft.operators.graph import dangling_links, star, star_join
from tripleweft.operators.setops import graph_diff, graph_distinct, graph_merge
from tripleweft.plans.fused import ntriples_text, turtle_text
from tripleweft.plans.joins import checked_join, fits, hot_keys, row_spread, salted_join
from tripleweft.plans.rowindex import global_row_index
from tripleweft.scratch import new_path, write_and_read
from tripleweft.vocab import SCHEMA, TRIPLES_SCHEMA

EX = "http://example.org/"


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one key, some have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.pmod("id", F.lit(40)))
    )
    return spark.range(3000).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def side(spark):
    return spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("zz", 4), (None, 5)], "key string, v int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(hot, side, how):
    want = hot.join(side, ["key"], how)
    got = salted_join(hot, side, ["key"], how, hot_rows=500)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_salted_join_spreads_the_hot_key(hot, side):
    assert rows(hot_keys(hot, ["key"], hot_rows=500)) == [("hot", 2)]
    keyed = salted_join(hot, side, ["key"], hot_rows=500)
    assert "_salt" in plan_of(keyed)


def test_salts_follow_the_count(spark):
    """A key of n rows gets n / rows-per-task salts, whatever the number of keys."""
    df = spark.range(40_000).select(F.when(F.col("id") < 20_000, F.lit(-1)).otherwise(F.col("id") % 10).alias("k"))
    assert rows(hot_keys(df, ["k"], hot_rows=1000)) == [(-1, 20), *[(k, 2) for k in range(10)]]
    side = df.select("k").distinct()
    joined = salted_join(df, side, ["k"], hot_rows=1000)
    assert joined.count() == 40_000


def test_no_row_level_input_goes_to_one_task(spark, hot, side):
    from tripleweft.operators.rules import expand_prefixes

    prefixes = spark.createDataFrame([("hot", "ex", "http://e/")], "key string, prefix string, iri string").withColumnRenamed("key", "tenant")
    named = hot.withColumnRenamed("key", "tenant").withColumn("o", F.lit("ex:a"))
    for frame in (salted_join(hot, side, ["key"], hot_rows=500), checked_join(hot, side, ["key"], max_rows=2), expand_prefixes(named, prefixes, ["o"])):
        assert "SinglePartition" not in plan_of(frame)


def test_copies_are_spread(spark):
    """Exact copies of one row lie in many partitions and so get many numbers."""
    copies = spark.range(0, 4000, 1, 16).select(F.lit("same").alias("key"), F.create_map(F.lit("a"), F.lit("b")).alias("m"))
    spread = copies.select(row_spread(copies, 64).alias("n")).groupBy("n").count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) <= 1000
    side = spark.createDataFrame([("same", 1), ("same", 2)], "key string, v int")
    assert salted_join(copies, side, ["key"], hot_rows=500).count() == 8000


def test_salted_join_rejects_other_kinds(hot, side):
    with pytest.raises(ValueError):
        salted_join(hot, side, ["key"], "full")


def test_checked_join_measures(hot, side):
    assert fits(side) and not fits(hot, max_rows=100) and not fits(side, max_bytes=10)
    small = checked_join(hot, side, ["key"])
    large = checked_join(hot, side, ["key"], max_rows=2)
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows(small) == rows(large)


def test_row_index_over_many_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    indexed = global_row_index(df, ["v"], partitions=7)
    assert indexed.filter("v <> row_index").isEmpty() and indexed.count() == 1000
    tied = global_row_index(spark.range(600).select(F.lit(1).alias("v")), ["v"], partitions=5)
    assert rows(tied.select("row_index")) == rows(spark.range(600))
    bins = merge_bins(df, ["v"], 3)
    assert bins.filter(F.col("bin_id") != F.floor(F.col("v") / 3)).isEmpty()


def test_scratch_follows_the_session(spark, tmp_path):
    assert new_path(spark, "x") != new_path(spark, "x")
    assert write_and_read(spark.range(5), "t").count() == 5


def test_fanout_is_one_narrow_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.col("id").cast("string").alias("name"), F.lit(1).alias("unused")).write.parquet(path)
    tm = TriplesMap("t", EX + "{id}", (SCHEMA + "Thing",), ((SCHEMA + "name", ref("name")),))
    other = TriplesMap("t", EX + "b/{id}", objects=((SCHEMA + "name", ref("name")),))
    df = spark.read.parquet(path)
    for frame in (
        triples_of(df, tm),
        ntriples_text(df, tm),
        turtle_text(df, [tm, other]),
        materialise(Mapping((tm, other)), {"t": df}),
    ):
        plan = plan_of(frame)
        assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
        assert plan.count("FileScan") == 1
        assert "unused" not in plan
        assert "*(1) Generate" in plan


def test_star_and_star_join(spark):
    data = [
        ("a", "p:x", "1"), ("a", "p:y", "2"), ("b", "p:x", "3"),
        ("c", "p:x", "4"), ("c", "p:x", "5"), ("c", "p:y", "6"), ("c", "p:y", "6"),
    ]
    triples = spark.createDataFrame([(s, p, o, "literal", None, None) for s, p, o in data], TRIPLES_SCHEMA)
    variables = {"x": "p:x", "y": "p:y"}
    single = star(triples.filter("s <> 'c'"), variables)
    # Read before the query runs: the plan of a finished query lists its stages twice.
    assert plan_of(single).count("Exchange hashpartitioning") == 1
    assert rows(single) == [("a", "1", "2")]
    assert rows(star_join(triples, variables)) == [("a", "1", "2"), ("c", "4", "6"), ("c", "5", "6")]
    with pytest.raises(Exception, match="several values"):
        star(triples, variables).collect()
    skewed = star_join(triples, variables, hot_rows=2)
    assert rows(skewed) == rows(star_join(triples, variables))
    typed = triples.unionByName(
        spark.createDataFrame([("a", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "C", "iri", None, None)], TRIPLES_SCHEMA)
    )
    # A literal with the text of the class is no type.
    typed = typed.unionByName(
        spark.createDataFrame([("b", "http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "C", "literal", None, None)], TRIPLES_SCHEMA)
    )
    assert rows(star(typed.filter("s <> 'c'"), {"x": "p:x"}, of_class="C")) == [("a", "1")]
    assert rows(star_join(typed, {"x": "p:x"}, of_class="C")) == [("a", "1")]


def test_dangling(spark):
    data = [("n:a", "p", "n:b"), ("n:a", "p", "n:gone"), ("n:b", "p", "n:gone"), ("n:b", "p", "other:x")]
    triples = spark.createDataFrame([(s, p, o, "iri", None, None) for s, p, o in data], TRIPLES_SCHEMA)
    assert rows(dangling_links(triples, "n:")) == [("n:gone", 2)]


def test_a_star_computes_its_input_once(spark, tmp_path):
    """The plan of the joins reads what was written, not the graph."""
    graph = spark.createDataFrame([("a", "p:x", "1"), ("a", "p:y", "2"), ("b", "p:x", "3")], "s string, p string, o string").withColumn("o_kind", F.lit("literal"))
    graph.write.parquet(str(tmp_path / "graph"))
    found = star_join(spark.read.parquet(str(tmp_path / "graph")), {"x": "p:x", "y": "p:y"})
    assert rows(found) == [("a", "1", "2")]
    assert f"{tmp_path}" not in plan_of(found) and "star-triples" in plan_of(found)


def _repeated(spark):
    """Thirty triples, each twice, some without a datatype."""
    i = F.col("id") % 30
    columns = [F.concat(F.lit(c + ":"), (i % n).cast("string")).alias(c) for c, n in (("s", 5), ("p", 2), ("o", 3))]
    datatype = F.when(i % 2 == 0, F.lit("d:x")).alias("o_datatype")
    triples = spark.range(60).select(*columns, F.lit("literal").alias("o_kind"), datatype, F.lit(None).cast("string").alias("o_lang"))
    return triples, {tuple(r) for r in triples.collect()}


def _below_exchange(df):
    first, *below = plan_of(df).split("Exchange hashpartitioning")
    assert "HashAggregate" in first and len(below) == 1
    return below[0]


def test_sets_drop_repeats_after_they_met_and_not_before(spark):
    triples, want = _repeated(spark)
    records = spark.range(40).select((F.col("id") % 7).alias("k"), (F.col("id") % 2).alias("v"))
    maps = Mapping((TriplesMap("r", "s:{k}", objects=(("p:v", ref("v")),)),))
    mapped = materialise(maps, {"r": records}, distinct=True)
    assert "HashAggregate" not in _below_exchange(graph_distinct(triples))
    assert "HashAggregate" not in _below_exchange(graph_merge(triples, triples, distinct=True))
    assert "HashAggregate" not in _below_exchange(distinct_triple_count(triples))
    assert "HashAggregate" not in _below_exchange(mapped)
    assert rows(graph_distinct(triples)) == rows(graph_merge(triples, triples, distinct=True)) == sorted(want, key=repr)
    assert distinct_triple_count(triples).first()[0] == len(want)
    assert rows(mapped.select("s", "o")) == sorted({(f"s:{i % 7}", str(i % 2)) for i in range(40)}, key=repr)


def test_a_bag_against_its_set_is_shuffled_once(spark):
    triples, want = _repeated(spark)
    delta = graph_diff(triples, graph_distinct(triples), bag=True)
    got = delta.collect()
    final = plan_of(delta).split("== Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") == 1 and "ReusedExchange" in final
    assert len(got) == len(want) and {r["side"] for r in got} == {"missing"} and sum(r["copies"] for r in got) == 60 - len(want)
