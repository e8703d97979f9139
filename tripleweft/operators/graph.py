"""Queries on the triples of a graph."""

from functools import reduce

from pyspark.sql import functions as F

from tripleweft.plans.compile import union_all
from tripleweft.plans.joins import HOT_ROWS, fits, hot_keys, salted_join
from tripleweft.scratch import write_and_read
from tripleweft.vocab import IRI, LITERAL, RDF_TYPE, TRIPLE_COLUMNS


def number(col):
    """Literal text as a number; null where it is none."""
    return col.try_cast("decimal(38,10)")


def typed_filter(triples, predicate, test):
    """Triples of a predicate whose literal, as a number, passes a test.

    `test` maps a number column to a condition; text that is no number fails.
    """
    value = number(F.col("o"))
    return triples.filter((F.col("p") == predicate) & (F.col("o_kind") == LITERAL) & F.coalesce(test(value), F.lit(False)))


def _of_class(name):
    return (F.col("p") == RDF_TYPE) & (F.col("o_kind") == IRI) & (F.col("o") == name)


def star(triples, variables, subject="subject", of_class=None):
    """Subjects that have all the given predicates, one column each, where a subject has one value of each.

    A single grouped pass, with partial aggregates before the shuffle. A subject with two values of a predicate is an
    error; `star_join` takes those. `variables` maps column names to predicates; `of_class` asks for a type as well.
    """
    wanted = F.col("p").isin(list(variables.values()))
    if of_class is not None:
        wanted = wanted | _of_class(of_class)
    columns = []
    for name, p in variables.items():
        value = F.when(F.col("p") == p, F.col("o"))
        columns += [F.max(value).alias(name), F.min(value).alias(f"_min_{name}")]
    if of_class is not None:
        columns.append(F.max(_of_class(of_class)).alias("_typed"))
    rows = triples.filter(wanted).groupBy(F.col("s").alias(subject)).agg(*columns)
    found = [F.col(name).isNotNull() for name in variables]
    if of_class is not None:
        found.append(F.col("_typed"))
    several = F.raise_error(F.lit("a subject has several values of a predicate: use star_join")).cast("string")
    single = [F.when(F.col(name) != F.col(f"_min_{name}"), several).otherwise(F.col(name)).alias(name) for name in variables]
    return rows.filter(reduce(lambda a, b: a & b, found)).select(subject, *single)


def star_join(triples, variables, subject="subject", of_class=None, hot_rows=HOT_ROWS):
    """Every combination of the values that a subject has for the given predicates, by equi-joins on the subject.

    The triples that the pattern uses are computed once, as a set, and written; all else reads that. Subjects with very
    many of them are counted once and spread in each of the joins.
    """
    conditions = [F.col("p") == p for p in variables.values()]
    if of_class is not None:
        conditions.append(_of_class(of_class))
    # Only a pattern that asks for types of any kind and for a class needs the kinds apart; else no join takes repeats.
    kinds = ["o_kind"] if of_class is not None and RDF_TYPE in variables.values() else []
    used = triples.filter(reduce(lambda a, b: a | b, conditions)).select("s", "p", "o", *kinds).distinct()
    columns = [F.col("s").alias(subject)]
    if len(conditions) == 1:
        return used.select(*columns, *[F.col("o").alias(name) for name in variables]).distinct()
    used = write_and_read(used, "star-triples")
    parts = [used.filter(F.col("p") == p).select(*columns, F.col("o").alias(name)) for name, p in variables.items()]
    parts = [part.distinct() for part in parts] if kinds else parts
    if of_class is not None:
        typed = _of_class(of_class) if kinds else (F.col("p") == RDF_TYPE) & (F.col("o") == of_class)
        parts.append(used.filter(typed).select(*columns))
    hot = hot_keys(used.select(*columns), [subject], hot_rows)
    return reduce(lambda a, b: salted_join(a, b, [subject], hot=hot), parts)


def links(triples, predicate, subject="subject", target="target"):
    """IRI objects of one predicate as (subject, target) pairs."""
    rows = triples.filter((F.col("p") == predicate) & (F.col("o_kind") == IRI))
    return rows.select(F.col("s").alias(subject), F.col("o").alias(target))


def path_join(left, right, on, how="inner", counts_from=None):
    """Follow links: rows that point at IRIs meet the rows of those IRIs.

    The described side is written once; if it measures small it goes to the links. Else very many rows may point at one
    IRI, so its rows are spread; `counts_from` takes the plain links, if `left` is costly, to find such IRIs.
    """
    right = write_and_read(right, "described")
    if fits(right):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, [on], how, counts_from=counts_from)


def coreference_merge(graphs):
    """Union of graphs by name; each different triple with the names it came from."""
    tagged = [g.select(*TRIPLE_COLUMNS, F.lit(name).alias("source")) for name, g in graphs.items()]
    grouped = union_all(tagged).groupBy(*TRIPLE_COLUMNS)
    return grouped.agg(F.sort_array(F.collect_set("source")).alias("sources"))


def shared_subjects(graphs):
    """Subjects that more than one graph describes, with the number of graphs and triples."""
    per_graph = [
        g.groupBy("s").agg(F.count(F.lit(1)).alias("n")).select("s", "n", F.lit(1).alias("one"))
        for g in graphs.values()
    ]
    grouped = union_all(per_graph).groupBy("s")
    out = grouped.agg(F.sum("one").alias("graphs"), F.sum("n").alias("triples"))
    return out.filter(F.col("graphs") > 1)


def dangling_links(triples, namespace):
    """IRIs of a namespace that are linked to but never described, with their link counts.

    Links are counted per target before anything is joined, so a target that
    draws a third of all links is one row by then.
    """
    inside = (F.col("o_kind") == IRI) & (F.col("p") != RDF_TYPE) & F.col("o").startswith(namespace)
    targets = triples.filter(inside).groupBy(F.col("o").alias("iri")).agg(F.count(F.lit(1)).alias("links"))
    described = triples.filter(F.col("s").startswith(namespace)).select(F.col("s").alias("iri")).distinct()
    return targets.join(described, "iri", "left_anti")
