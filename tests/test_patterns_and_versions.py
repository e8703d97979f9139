"""Patterns of any shape, versions in force, graphs that grow, bounded candidates."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tripleweft.operators.events import first_event_since, first_of_candidates
from tripleweft.operators.patterns import join_tree, match_patterns
from tripleweft.plans.asof import as_of_join
from tripleweft.operators.sketches import graph_sketches, sketched_sizes
from tripleweft.scratch import untracked
from tripleweft.sinks.buckets import append_distinct, read_graph
from tripleweft.sinks.versions import current_version, publish, read_published
from tripleweft.vocab import TRIPLES_SCHEMA

# --- patterns -----------------------------------------------------------------------


def brute_match(triples, patterns, variables, tests=None):
    """Try all triples for all patterns; a term of an object place is its text, kind and datatype."""
    found = [{}]
    subjects = {t for s, p, _ in patterns for t in (s, p)}
    for s, p, o in patterns:
        more = []
        for known, (ts, tp, to, kind, datatype, _) in itertools.product(found, triples):
            new = dict(known)
            for term, value in ((s, ts), (p, tp), (o, to)):
                if not term.startswith("?"):
                    fine = term == value
                elif term is o and o not in subjects:
                    fine = new.setdefault(term, (value, kind, datatype)) == (value, kind, datatype)
                else:
                    fine = new.setdefault(term, value) == value and not (term is o and kind == "literal")
                if fine and term.startswith("?") and tests and term[1:] in tests:
                    fine = tests[term[1:]](value)
                if not fine:
                    break
            else:
                more.append(new)
        found = more
    text = [tuple(v[0] if isinstance(v := f["?" + name], tuple) else v for name in variables) for f in found]
    return sorted(set(text), key=repr)


PATTERNS = {
    "chain": [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?d"), ("?d", "p", "?e")],
    "star": [("?a", "p", "?b"), ("?a", "q", "?c"), ("?a", "r", "?d")],
    "circle": [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?a")],
    "circle and tail": [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?a"), ("?c", "q", "?t")],
    "loop": [("?a", "p", "?a"), ("?a", "q", "?b")],
    "same object": [("?a", "p", "?v"), ("?b", "q", "?v")],
    "any predicate": [("?a", "?how", "n1"), ("?a", "p", "?b")],
    "constant subject": [("n2", "p", "?b"), ("?b", "q", "?c")],
    "one": [("?a", "p", "?b")],
    "twice": [("?a", "p", "?b"), ("?a", "p", "?c"), ("?c", "q", "?d")],
}


@pytest.fixture(scope="module")
def graph():
    rng = random.Random(11)
    out = [(f"n{rng.randrange(7)}", rng.choice("pqr"), f"n{rng.randrange(7)}", "iri", None, None) for _ in range(45)]
    out += [(f"n{rng.randrange(7)}", rng.choice("pq"), f"n{rng.randrange(7)}", "literal", rng.choice([None, "t:int"]), None) for _ in range(12)]
    return out + out[:5]


@pytest.mark.parametrize("name", list(PATTERNS))
def test_patterns_equal_brute_force(spark, graph, name):
    patterns = PATTERNS[name]
    variables = sorted({t[1:] for p in patterns for t in p if t.startswith("?")})
    got = match_patterns(spark.createDataFrame(graph, TRIPLES_SCHEMA), patterns, variables)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_match(graph, patterns, variables)


def test_tests_of_variables(spark, graph):
    df, patterns = spark.createDataFrame(graph, TRIPLES_SCHEMA), PATTERNS["chain"]
    got = match_patterns(df, patterns, ["a", "e"], {"e": lambda c: c > "n3"})
    assert rows(got) == brute_match(graph, patterns, ["a", "e"], {"e": lambda v: v > "n3"})


def test_patterns_that_do_not_hang_together_fail(spark, graph):
    df = spark.createDataFrame(graph, TRIPLES_SCHEMA)
    with pytest.raises(ValueError, match="hang together"):
        match_patterns(df, [("?a", "p", "?b"), ("?c", "q", "?d")], ["a"])
    with pytest.raises(ValueError, match="no pattern"):
        match_patterns(df, [("?a", "p", "?b")], ["x"])


def test_tree_goes_from_large_leaves_to_small_roots():
    chain = [("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?d")]
    assert join_tree(chain, [5, 100, 1000]) == ([(2, 1), (1, 0)], [0])
    assert join_tree(chain, [1000, 100, 5]) == ([(0, 1), (1, 2)], [2])
    assert join_tree([("?a", "p", "?b"), ("?b", "q", "?c"), ("?c", "r", "?a")], [1, 1, 1]) == ([], [0, 1, 2])


# --- versions in force ----------------------------------------------------------------


def test_as_of_equals_brute_force(spark):
    """One key has nine tenths of all rows, over many ranges; others have few, none, or no version before them."""
    rng = random.Random(12)
    keys = ["hot"] * 27 + ["a", "b", None]
    records = [(k, rng.choice(keys), rng.choice([*range(0, 400), None])) for k in range(1500)] + [(7, "hot", 50)] * 60
    versions = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([*range(100, 400, 7), None]), v) for v in range(40)] + [("c", 3, 99)]
    want = []
    for i, key, at in records:
        known = [(since, v) for k, since, v in versions if k == key and k is not None and since is not None and at is not None and since <= at]
        want.append((i, key, at, max(known)[1] if known else None))
    left = spark.createDataFrame(records, "id int, k string, t int").repartition(5)
    right = spark.createDataFrame(versions, "k string, since int, version int")
    for partitions in (1, 12):
        got = as_of_join(left, right, "k", "t", "since", ["version"], partitions)
        assert rows(got) == sorted(want, key=repr)
    assert as_of_join(left.where(F.lit(False)), right, "k", "t", "since", ["version"]).count() == 0
    assert as_of_join(left, right.where(F.lit(False)), "k", "t", "since", ["version"], 3).where("version IS NOT NULL").count() == 0


# --- graphs that grow -------------------------------------------------------------------


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{path}/graph") for f in names if f.endswith(".parquet")}


def test_deliveries_keep_a_set(spark, tmp_path):
    path = str(tmp_path / "g")
    made = [(f"s{k}", "p", str(k % 3), "literal", None, "en" if k % 2 else None) for k in range(200)]
    df = spark.createDataFrame(made, TRIPLES_SCHEMA)
    assert read_graph(spark, path).count() == 0
    assert append_distinct(df.where("s < 's15'").union(df.where("s < 's11'")), path, buckets=8) == df.where("s < 's15'").count()
    before = files_of(path)
    assert append_distinct(df.where("s < 's13'"), path) == 0 and files_of(path) == before
    one = spark.createDataFrame([("new", "p", "x", "iri", None, None), made[0]], TRIPLES_SCHEMA)
    assert append_distinct(one, path) == 1
    added = files_of(path) - before
    assert before <= files_of(path) and len({os.path.dirname(f) for f in added}) == 1
    assert append_distinct(df, path, buckets=3) > 0  # the graph keeps its 8 buckets
    assert rows(read_graph(spark, path)) == rows(df.union(one.where("s = 'new'")).distinct())


# --- versions of results, sketches ------------------------------------------------------


def test_readers_see_whole_versions(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, path)

    def write(n, fail=False):
        def run(folder):
            spark.range(n).write.parquet(folder)
            if fail:
                raise RuntimeError("lost")

        return run

    first = publish(spark, path, write(3))
    open_ = read_published(spark, path)
    with pytest.raises(RuntimeError):
        publish(spark, path, write(5, fail=True))
    assert current_version(spark, path) == first and read_published(spark, path).count() == 3
    publish(spark, path, write(7))
    assert read_published(spark, path).count() == 7 and open_.count() == 3  # a reader that has begun ends
    publish(spark, path, write(8))
    assert len([v for v in os.listdir(path) if v.startswith("v")]) == 2 and not os.path.exists(first)
    last = publish(spark, path, write(9), keep=0)
    assert [v for v in os.listdir(path) if v.startswith("v")] == [os.path.basename(last)]


def test_sketches_unite_over_runs(spark):
    triples = spark.range(30_000).select(
        F.concat(F.lit("s"), F.col("id") % 20_000).alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"), (F.col("id") % 3).alias("run"), (F.col("id") % 20_000 < 500).alias("few"),
    )
    kept = graph_sketches(triples, "few", "run")
    got = {r.few: r for r in sketched_sizes(kept, "few").collect()}
    assert abs(got[True].distinct_triples - 500) <= 10 and abs(got[False].distinct_triples - 19_500) <= 390
    assert sum(r.triples for r in got.values()) == 30_000
    [whole] = sketched_sizes(kept).collect()
    assert abs(whole.distinct_triples - 20_000) <= 400


# --- candidates -------------------------------------------------------------------------


def test_only_the_first_candidates_count(spark):
    data = [("late", k, k == 51) for k in range(1, 60)] + [("last", k, k == 50) for k in range(1, 60)] + [("both", k, k in (3, 9)) for k in range(1, 60)] + [("none", 1, False)]
    events = spark.createDataFrame(data, "name string, n int, has boolean").withColumn("ts", F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(0), F.col("n") % 60, F.lit(0)))
    since = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    got = first_of_candidates(events.repartition(4), "name", "ts", ["n"], since, F.col("has"), [])
    assert sorted((r.name, r.n) for r in got.collect()) == [("both", 3), ("last", 50)]
    assert "WindowGroupLimit" in plan_of(got) and "Partial" in plan_of(got)
    assert {r.name for r in first_event_since(events, "name", "ts", ["n"], since, F.col("has"), []).collect()} == {"both", "last", "late"}


def test_circles_are_not_joined_by_their_few_values(spark, monkeypatch):
    """Customers and suppliers of one nation are not paired with one another before their orders are."""
    from tripleweft.operators import patterns

    made = [(f"c{k}", "nation", "n") for k in range(60)] + [(f"s{k}", "seat", "n") for k in range(60)]
    made += [(f"o{k}", "customer", f"c{k}") for k in range(60)] + [(f"o{k}", "from", f"s{(k * 7) % 60}") for k in range(60)]
    triples = spark.createDataFrame([(s, p, o, "iri", None, None) for s, p, o in made], TRIPLES_SCHEMA)
    sizes, joined = [], patterns._joined

    def counted(a, b):
        out = joined(a, b)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(patterns, "_joined", counted)
    circle = [("?o", "customer", "?c"), ("?o", "from", "?s"), ("?c", "nation", "?n"), ("?s", "seat", "?n")]
    got = rows(match_patterns(triples, circle, ["c", "s", "n"]))
    assert got == sorted((f"c{k}", f"s{(k * 7) % 60}", "n") for k in range(60))
    assert max(sizes) == 60


def test_stars_drop_repeats_once(spark):
    from tripleweft.operators.graph import star_join

    made = [("a", "p", "1", "literal"), ("a", "p", "1", "iri"), ("a", "p", "1", "literal"), ("a", "q", "2", "iri"), ("b", "p", "3", "iri")]
    triples = spark.createDataFrame([(*t, None, None) for t in made], TRIPLES_SCHEMA)
    star = star_join(triples, {"x": "p", "y": "q"}, "subject")
    assert rows(star) == [("a", "1", "2")]
    assert "HashAggregate" not in plan_of(star)


def test_what_a_graph_begins_with_is_written_to_one_table_on_the_way(spark, tmp_path):
    df = spark.createDataFrame([(f"s{i % 7}", "p", "o", "literal", None, None) for i in range(20)], TRIPLES_SCHEMA)
    path = f"{tmp_path}/graph"
    with untracked() as first:
        assert append_distinct(df.where("s < 's5'"), path, buckets=4) == 5
    with untracked() as second:
        assert append_distinct(df, path) == 2
    assert (len(first), len(second)) == (1, 2) and rows(read_graph(spark, path)) == rows(df.distinct())


def test_appending_leaves_the_graph_alone_and_no_shuffle_files(spark, tmp_path):
    """A graph that grows many times over has room for its rows only if what is on the way goes."""
    from tripleweft.scratch import base_dir

    df = spark.createDataFrame([(f"s{i % 9}", "p", None if i % 9 == 8 else "o", "literal", None, "en" if i % 2 else None) for i in range(60)], TRIPLES_SCHEMA)
    before = set(os.listdir(base_dir(spark)))
    with untracked() as made:
        assert append_distinct(df.where("s < 's3'"), f"{tmp_path}/graph", buckets=4) == df.where("s < 's3'").distinct().count()
        assert append_distinct(df.union(df), f"{tmp_path}/graph") == df.where("s >= 's3'").distinct().count()
    assert len(made) == 3 and set(os.listdir(base_dir(spark))) == before
    assert rows(read_graph(spark, f"{tmp_path}/graph")) == rows(df.distinct())
