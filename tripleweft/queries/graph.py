"""Queries on triples: patterns, merges, counts, set operations."""

from pyspark.sql import functions as F

from tripleweft.mapping import Mapping, TriplesMap, ref, template
from tripleweft.operators.aggregates import (
    distinct_triple_count,
    duplicate_ids,
    mean_by,
    pivot_ratio,
    record_count,
    run_metrics,
    throughput,
    triple_count,
)
from tripleweft.operators.events import first_event_since, first_of_candidates, merge_bins, ordered_report
from tripleweft.operators.graph import (
    coreference_merge,
    dangling_links,
    links,
    number,
    path_join,
    shared_subjects,
    star,
    star_join,
    typed_filter,
)
from tripleweft.operators.isomorphism import graph_diff_unlabelled, graph_isomorphic
from tripleweft.operators.patterns import match_patterns
from tripleweft.operators.setops import graph_diff, graph_distinct, graph_merge
from tripleweft.operators.sketches import graph_sketches, sketched_sizes
from tripleweft.functions.text import short_key
from tripleweft.functions.times import start_text
from tripleweft.plans.compile import count_triples, materialise, triples_of
from tripleweft.queries.common import (
    COLS,
    CUSTOMER_SQL,
    DECIMAL,
    EX,
    LINEITEM_SQL,
    NATION_SQL,
    ORDERS_SQL,
    Registry,
    customer_map,
    iri,
    kind_of,
    lineitem_map,
    link,
    money,
    nation_map,
    orders_map,
    rule,
    table,
    triples_sql,
)
from tripleweft.scratch import new_path
from tripleweft.sinks.buckets import append_distinct, read_graph
from tripleweft.vocab import BLANK, BNODE, IRI, LITERAL, RDF_TYPE, SCHEMA

registry = Registry()


def orders_triples(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "orders"), orders_map())


def customer_triples(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "customer"), customer_map())


def lineitem_triples(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "lineitem"), lineitem_map())


def shop_graph(spark, sf_dir, *predicates):
    """Orders and customers as one graph, limited to what a pattern asks for."""
    mapping = Mapping((orders_map(), customer_map()))
    inputs = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    return materialise(mapping, inputs, predicates=predicates)


# --- graph patterns -----------------------------------------------------------


@registry.add(
    "typed_filter",
    f"SELECT {COLS} FROM ({ORDERS_SQL}) WHERE p = '{SCHEMA}price' AND TRY_CAST(o AS DECIMAL(38,10)) > 300000",
)
def typed_filter_query(spark, sf_dir):
    prices = triples_of(table(spark, sf_dir, "orders"), orders_map(), predicates=[SCHEMA + "price"])
    return typed_filter(prices, SCHEMA + "price", lambda v: v > 300000)


@registry.add(
    "bgp_star_join",
    f"""
    WITH t AS ({ORDERS_SQL})
    SELECT a.s AS "order", b.o AS customer, c.o AS price
    FROM t a JOIN t b ON a.s = b.s JOIN t c ON a.s = c.s
    WHERE a.o = '{SCHEMA}Order' AND b.p = '{SCHEMA}customer' AND c.p = '{SCHEMA}price'
    """,
)
def bgp_star_join(spark, sf_dir):
    variables = {"customer": SCHEMA + "customer", "price": SCHEMA + "price"}
    asked = {RDF_TYPE, *variables.values()}
    orders = triples_of(table(spark, sf_dir, "orders"), orders_map(), predicates=asked)
    return star_join(orders, variables, "order", of_class=SCHEMA + "Order")


@registry.add(
    "bgp_star_multi",
    f"""
    SELECT DISTINCT {iri("order", "o_orderkey")} AS "order", {iri("part", "a.l_partkey")} AS part, b.l_returnflag AS flag
    FROM orders JOIN lineitem a ON a.l_orderkey = o_orderkey
         JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber
    """,
)
def bgp_star_multi(spark, sf_dir):
    """Orders by the parts and the flags of their items: several values of both, joined in the items' own graph.

    Item nodes keep the pairs together; the pattern is order - item - (part, flag).
    """
    items = table(spark, sf_dir, "lineitem").withColumn("item", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    holds = TriplesMap("lineitem", EX + "order/{l_orderkey}", objects=((EX + "item", template(EX + "item/{item}")),))
    item = TriplesMap(
        "lineitem", EX + "item/{item}", objects=((EX + "part", template(EX + "part/{l_partkey}")), (EX + "flag", ref("l_returnflag")))
    )
    graph = triples_of(items, [holds, item])
    owned = star_join(graph, {"item": EX + "item"}, "order")
    parts = star_join(graph, {"part": EX + "part", "flag": EX + "flag"}, "item")
    orders = triples_of(table(spark, sf_dir, "orders"), orders_map(), predicates={RDF_TYPE})
    known = star_join(orders, {}, "order", of_class=SCHEMA + "Order")
    return path_join(owned.join(known, "order", "left_semi"), parts, "item").select("order", "part", "flag").distinct()


@registry.add(
    "bgp_star_product",
    f"""
    SELECT DISTINCT {iri("user", "a.user_id")} AS "user", a.event_type AS did, CAST(CAST(b.value AS DECIMAL(18,2)) AS VARCHAR) AS amount
    FROM events a JOIN events b ON a.user_id = b.user_id WHERE b.value > 450
    """,
)
def bgp_star_product(spark, sf_dir):
    """Every combination of what a user did and of the large amounts of that user."""
    large = F.when(F.col("value") > 450, money("value").cast("string"))
    tm = TriplesMap("events", EX + "user/{user_id}", objects=((EX + "did", ref("event_type")), (EX + "amount", ref("large"))))
    graph = triples_of(table(spark, sf_dir, "events").withColumn("large", large), tm)
    return star_join(graph, {"did": EX + "did", "amount": EX + "amount"}, "user")


@registry.add(
    "bgp_path_join",
    f"""
    WITH t AS ({ORDERS_SQL} UNION ALL {CUSTOMER_SQL})
    SELECT a.s AS "order", a.o AS customer, b.o AS name
    FROM t a JOIN t b ON a.o = b.s WHERE a.p = '{SCHEMA}customer' AND a.o_kind = 'iri' AND b.p = '{SCHEMA}name'
    """,
)
def bgp_path_join(spark, sf_dir):
    pointing = links(shop_graph(spark, sf_dir, SCHEMA + "customer"), SCHEMA + "customer", "order", "customer")
    named = star_join(shop_graph(spark, sf_dir, SCHEMA + "name"), {"name": SCHEMA + "name"}, "customer")
    return path_join(pointing, named, "customer").select("order", "customer", "name")


@registry.add(
    "bgp_query",
    f"""
    WITH t AS ({ORDERS_SQL} UNION ALL {CUSTOMER_SQL})
    SELECT n.o AS name, b.o AS balance, pr.o AS price
    FROM t ty JOIN t l ON ty.s = l.s JOIN t pr ON ty.s = pr.s
         JOIN t cy ON cy.s = l.o JOIN t n ON n.s = l.o JOIN t b ON b.s = l.o
    WHERE ty.o = '{SCHEMA}Order' AND l.p = '{SCHEMA}customer' AND pr.p = '{SCHEMA}price'
      AND cy.o = '{SCHEMA}Person' AND n.p = '{SCHEMA}name' AND b.p = '{EX}balance'
      AND TRY_CAST(b.o AS DECIMAL(38,10)) > 5000
    """,
)
def bgp_query(spark, sf_dir):
    """Two stars joined by a link, with a numeric filter ahead of the join."""
    offer_graph = shop_graph(spark, sf_dir, RDF_TYPE, SCHEMA + "customer", SCHEMA + "price")
    people_graph = shop_graph(spark, sf_dir, RDF_TYPE, SCHEMA + "name", EX + "balance")
    offers = star_join(
        offer_graph, {"customer": SCHEMA + "customer", "price": SCHEMA + "price"}, "order", of_class=SCHEMA + "Order"
    )
    large = (F.col("p") != EX + "balance") | F.coalesce(number(F.col("o")) > 5000, F.lit(False))
    rich = star_join(
        people_graph.filter(large), {"balance": EX + "balance", "name": SCHEMA + "name"}, "customer", of_class=SCHEMA + "Person"
    )
    pointing = links(shop_graph(spark, sf_dir, SCHEMA + "customer"), SCHEMA + "customer", "order", "customer")
    return path_join(offers, rich, "customer", counts_from=pointing).select("name", "balance", "price")


def chain_graph(spark, sf_dir):
    """Regions, nations, customers, orders and items, each linked to the one before."""
    maps = [
        TriplesMap("region", EX + "region/{r_regionkey}", objects=((SCHEMA + "name", ref("r_name")),)),
        TriplesMap("nation", EX + "nation/{n_nationkey}", objects=((EX + "region", template(EX + "region/{n_regionkey}")), (SCHEMA + "name", ref("n_name")))),
        TriplesMap("customer", EX + "customer/{c_custkey}", objects=((EX + "nation", template(EX + "nation/{c_nationkey}")), (SCHEMA + "name", ref("c_name")))),
        TriplesMap("orders", EX + "order/{o_orderkey}", objects=((EX + "customer", template(EX + "customer/{o_custkey}")),)),
        TriplesMap("lineitem", EX + "item/{l_orderkey}-{l_linenumber}", objects=((EX + "order", template(EX + "order/{l_orderkey}")), (EX + "quantity", ref(money("l_quantity"), datatype=DECIMAL)))),
    ]
    return graph_merge(*[triples_of(table(spark, sf_dir, m.source), m) for m in maps])


CHAIN = (
    ("?region", SCHEMA + "name", "ASIA"),
    ("?nation", EX + "region", "?region"),
    ("?nation", SCHEMA + "name", "?country"),
    ("?customer", EX + "nation", "?nation"),
    ("?order", EX + "customer", "?customer"),
    ("?item", EX + "order", "?order"),
    ("?item", EX + "quantity", "?quantity"),
)


@registry.add(
    "bgp_chain",
    f"""
    SELECT DISTINCT n_name AS country, {iri("customer", "c_custkey")} AS customer, {iri("order", "o_orderkey")} AS "order",
           {iri("item", "l_orderkey || '-' || l_linenumber")} AS item
    FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
         JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE r_name = 'ASIA' AND l_quantity >= 49
    """,
)
def bgp_chain(spark, sf_dir):
    """Items of large quantity whose customers live in one region: a chain of five with a selective end on both sides."""
    large = {"quantity": lambda text: number(text) >= 49}
    return match_patterns(chain_graph(spark, sf_dir), CHAIN, ["country", "customer", "order", "item"], large)


@registry.add(
    "bgp_circle",
    f"""
    SELECT DISTINCT {iri("customer", "c_custkey")} AS customer, {iri("supplier", "s_suppkey")} AS supplier, {iri("nation", "n_nationkey")} AS nation
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
         JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = c_nationkey AND n_nationkey = s_nationkey
    """,
)
def bgp_circle(spark, sf_dir):
    """Customers who ordered from a supplier of their own nation: the patterns close a circle."""
    maps = [
        TriplesMap("customer", EX + "customer/{c_custkey}", objects=((EX + "nation", template(EX + "nation/{c_nationkey}")),)),
        TriplesMap("supplier", EX + "supplier/{s_suppkey}", objects=((EX + "seat", template(EX + "nation/{s_nationkey}")),)),
        TriplesMap("orders", EX + "order/{o_orderkey}", objects=((EX + "customer", template(EX + "customer/{o_custkey}")),)),
        TriplesMap("lineitem", EX + "order/{l_orderkey}", objects=((EX + "from", template(EX + "supplier/{l_suppkey}")),)),
    ]
    graph = graph_merge(*[triples_of(table(spark, sf_dir, m.source), m) for m in maps])
    circle = [("?order", EX + "customer", "?customer"), ("?order", EX + "from", "?supplier"), ("?customer", EX + "nation", "?nation"), ("?supplier", EX + "seat", "?nation")]
    return match_patterns(graph, circle, ["customer", "supplier", "nation"])


def _three_sources(spark, sf_dir):
    """Customers, orders and events that describe the same subjects."""
    subject = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
    objects = {
        "customer": ((SCHEMA + "name", ref("c_name")),),
        "orders": ((EX + "placed", template(EX + "order/{o_orderkey}")),),
        "events": ((EX + "did", ref("event_type")),),
    }
    return {
        name: triples_of(
            table(spark, sf_dir, name),
            TriplesMap(name, EX + "customer/{" + key + "}", (SCHEMA + "Person",), objects[name]),
        )
        for name, key in subject.items()
    }


def _three_sql():
    person = kind_of(SCHEMA + "Person")
    return " UNION ALL ".join(
        triples_sql(name, iri("customer", key), [person, item], extra=f"'{name}' AS source, ")
        for name, key, item in (
            ("customer", "c_custkey", rule(SCHEMA + "name", "c_name")),
            ("orders", "o_custkey", link(EX + "placed", iri("order", "o_orderkey"))),
            ("events", "user_id", rule(EX + "did", "event_type")),
        )
    )


@registry.add(
    "coreference_merge",
    f"SELECT {COLS}, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM ({_three_sql()}) GROUP BY {COLS}",
)
def coreference_merge_query(spark, sf_dir):
    merged = coreference_merge(_three_sources(spark, sf_dir))
    return merged.withColumn("sources", F.array_join("sources", ","))


@registry.add(
    "shared_subjects",
    f"""
    SELECT s, count(DISTINCT source) AS graphs, count(*) AS triples FROM ({_three_sql()})
    GROUP BY s HAVING count(DISTINCT source) > 1
    """,
)
def shared_subjects_query(spark, sf_dir):
    return shared_subjects(_three_sources(spark, sf_dir))


_LABEL_SQL = (
    triples_sql("documents", iri("document", "doc_id"), [link(EX + "label", iri("label", "doc_id"))])
    + " UNION ALL "
    + triples_sql("labels", iri("label", "doc_id"), [rule(EX + "quality", "quality")])
)


@registry.add(
    "dangling_links",
    f"""
    WITH t AS ({_LABEL_SQL})
    SELECT o AS iri, count(*) AS links FROM t
    WHERE o_kind = 'iri' AND o LIKE '{EX}label/%' AND o NOT IN (SELECT s FROM t) GROUP BY o
    """,
)
def dangling_links_query(spark, sf_dir):
    """Documents point at labels, and not all labels exist."""
    pointing = TriplesMap(
        "documents", EX + "document/{doc_id}", objects=((EX + "label", template(EX + "label/{doc_id}")),)
    )
    labels = TriplesMap("labels", EX + "label/{doc_id}", objects=((EX + "quality", ref("quality")),))
    graph = graph_merge(
        triples_of(table(spark, sf_dir, "documents"), pointing), triples_of(table(spark, sf_dir, "labels"), labels)
    )
    return dangling_links(graph, EX + "label/")


# --- counts ---------------------------------------------------------------------


@registry.add("triple_count", f"SELECT count(*) AS triples FROM ({LINEITEM_SQL})")
def triple_count_query(spark, sf_dir):
    return triple_count(lineitem_triples(spark, sf_dir))


@registry.add("triple_count_inline", f"SELECT CAST(count(*) AS BIGINT) AS triples FROM ({LINEITEM_SQL})")
def triple_count_inline(spark, sf_dir):
    """The same number from the records, without building the triples."""
    return count_triples(table(spark, sf_dir, "lineitem"), lineitem_map())


@registry.add(
    "distinct_triple_count", f"SELECT count(*) AS triples FROM (SELECT DISTINCT {COLS} FROM ({LINEITEM_SQL}))"
)
def distinct_triple_count_query(spark, sf_dir):
    return distinct_triple_count(lineitem_triples(spark, sf_dir))


@registry.add(
    "distinct_sketch",
    """
    WITH e AS (
      SELECT l_returnflag AS tenant, 'from' AS p, l_orderkey AS s, l_partkey AS o FROM lineitem
      UNION ALL SELECT l_returnflag, 'of', l_suppkey, l_partkey FROM lineitem)
    SELECT tenant, CAST(count(DISTINCT (p, s, o)) AS BIGINT) AS exact, TRUE AS near, CAST(2 * count(*) AS BIGINT) AS triples FROM e GROUP BY tenant
    """,
)
def distinct_sketch(spark, sf_dir):
    """Distinct triples per tenant by sketches of overlapping inputs, within 2 % of the exact count."""
    items = table(spark, sf_dir, "lineitem")
    maps = [
        TriplesMap("lineitem", EX + "order/{l_orderkey}", objects=((EX + "from", template(EX + "part/{l_partkey}")),)),
        TriplesMap("lineitem", EX + "supplier/{l_suppkey}", objects=((EX + "of", template(EX + "part/{l_partkey}")),)),
    ]
    graph = triples_of(items, maps, keep=("l_returnflag",)).withColumnRenamed("l_returnflag", "tenant")
    runs = graph.withColumn("run", F.lit(1)).unionByName(graph.withColumn("run", F.lit(2)))
    sizes = sketched_sizes(graph_sketches(runs, "tenant", "run"), "tenant")
    exact = graph.distinct().groupBy("tenant").agg(F.count(F.lit(1)).alias("exact"))
    near = F.abs(F.col("distinct_triples") - F.col("exact")) <= 0.02 * F.col("exact")
    return exact.join(sizes, "tenant").select("tenant", "exact", near.alias("near"), "triples")


@registry.add(
    "record_count",
    """
    SELECT 'documents' AS source, 'all' AS triples_map, count(*) AS records FROM documents
    UNION ALL SELECT 'documents', 'english', count(*) FROM documents WHERE lang = 'en'
    UNION ALL SELECT 'documents', 'long', count(*) FROM documents WHERE n_chars > 5000
    """,
)
def record_count_query(spark, sf_dir):
    subject = EX + "document/{doc_id}"
    maps = [
        TriplesMap("documents", subject, name="all"),
        TriplesMap("documents", subject, name="english", where=F.col("lang") == "en"),
        TriplesMap("documents", subject, name="long", where=F.col("n_chars") > 5000),
    ]
    return record_count(table(spark, sf_dir, "documents"), maps)


@registry.add(
    "run_metrics",
    """
    SELECT 'doc-' || doc_id || '.json' AS file_name, 'spark' AS engine, 'STRICT' AS reason, n_chars AS input_bytes,
           'JSONLD' AS output_format, CAST(CASE WHEN doc_id % 7 = 0 THEN 0 WHEN lang <> 'en' THEN 3 ELSE 2 END AS BIGINT) AS triples,
           'application/ld+json' AS mime_type
    FROM documents
    """,
)
def run_metrics_query(spark, sf_dir):
    """Each document as one input of a run."""
    records = table(spark, sf_dir, "documents").select(
        "*",
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_name"),
        F.col("n_chars").alias("file_size"),
        F.nullif("lang", F.lit("en")).alias("other_lang"),
        # Some inputs yield no triples, and have a row all the same.
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("id"),
    )
    tm = TriplesMap(
        "documents",
        EX + "document/{id}",
        (SCHEMA + "CreativeWork",),
        ((EX + "source", ref("source")), (SCHEMA + "inLanguage", ref("other_lang"))),
    )
    return run_metrics(records, tm, output_format="JSONLD")


@registry.add(
    "mean_by",
    "SELECT event_type, round(avg(value), 4) AS mean_value, count(*) AS runs FROM events GROUP BY event_type",
)
def mean_by_query(spark, sf_dir):
    means = mean_by(table(spark, sf_dir, "events"), "value", "event_type")
    return means.withColumn("mean_value", F.round("mean_value", 4))


@registry.add(
    "throughput",
    """
    SELECT l_returnflag, round(avg(l_discount / (l_extendedprice / 1000.0)), 6) AS per_second
    FROM lineitem WHERE l_discount > 0 GROUP BY l_returnflag
    """,
)
def throughput_query(spark, sf_dir):
    rates = throughput(table(spark, sf_dir, "lineitem"), "l_discount", "l_extendedprice", "l_returnflag")
    return rates.withColumn("per_second", F.round("per_second", 6))


@registry.add(
    "pivot_speedup",
    """
    SELECT l_returnflag, round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 4) AS first_mean,
           round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 4) AS second_mean,
           round(avg(l_extendedprice) FILTER (l_linestatus = 'O') / avg(l_extendedprice) FILTER (l_linestatus = 'F'), 6) AS ratio
    FROM lineitem GROUP BY l_returnflag
    """,
)
def pivot_speedup(spark, sf_dir):
    wide = pivot_ratio(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["O", "F"], "l_extendedprice")
    return wide.select(
        "l_returnflag",
        F.round("first_mean", 4).alias("first_mean"),
        F.round("second_mean", 4).alias("second_mean"),
        F.round("ratio", 6).alias("ratio"),
    )


@registry.add(
    "duplicate_ids",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_ids_query(spark, sf_dir):
    return duplicate_ids(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


# --- set operations -------------------------------------------------------------


@registry.add("graph_distinct", f"SELECT DISTINCT {COLS} FROM ({LINEITEM_SQL})")
def graph_distinct_query(spark, sf_dir):
    return graph_distinct(lineitem_triples(spark, sf_dir))


@registry.add("mapping_distinct", f"SELECT DISTINCT {COLS} FROM ({LINEITEM_SQL} UNION ALL {CUSTOMER_SQL})")
def mapping_distinct(spark, sf_dir):
    """A mapping over two tables as a set, shuffled by rule number, subject and object."""
    inputs = {name: table(spark, sf_dir, name) for name in ("lineitem", "customer")}
    return materialise(Mapping((lineitem_map(), customer_map())), inputs, distinct=True)


@registry.add("graph_merge", f"SELECT {COLS} FROM ({CUSTOMER_SQL} UNION ALL {ORDERS_SQL} UNION ALL {NATION_SQL})")
def graph_merge_query(spark, sf_dir):
    return graph_merge(
        customer_triples(spark, sf_dir),
        orders_triples(spark, sf_dir),
        triples_of(table(spark, sf_dir, "nation"), nation_map()),
    )


_CHANGED_SQL = (
    f"SELECT s, p, CASE WHEN p = '{SCHEMA}orderStatus' AND o = 'F' THEN 'X' ELSE o END AS o, o_kind, o_datatype, o_lang FROM base"
)


@registry.add(
    "graph_diff",
    f"""
    WITH base AS ({ORDERS_SQL}), changed AS ({_CHANGED_SQL})
    SELECT *, 'missing' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM base EXCEPT SELECT * FROM changed)
    UNION ALL
    SELECT *, 'extra' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM changed EXCEPT SELECT * FROM base)
    """,
)
def graph_diff_query(spark, sf_dir):
    base = orders_triples(spark, sf_dir)
    is_done = (F.col("p") == SCHEMA + "orderStatus") & (F.col("o") == "F")
    changed = base.withColumn("o", F.when(is_done, F.lit("X")).otherwise(F.col("o")))
    return graph_diff(base, changed)


@registry.add(
    "graph_diff_bag",
    f"""
    WITH b AS (SELECT {COLS}, count(*) AS n FROM ({LINEITEM_SQL}) GROUP BY {COLS})
    SELECT {COLS}, 'missing' AS side, n - 1 AS copies FROM b WHERE n > 1
    """,
)
def graph_diff_bag(spark, sf_dir):
    """A bag against its set: the surplus copies."""
    bag = lineitem_triples(spark, sf_dir)
    return graph_diff(bag, graph_distinct(bag), bag=True)


def blank_orders(spark, sf_dir, label, changed=False):
    """Orders and their items as blank nodes, labelled by a function of their keys; `changed`: one item has another part."""
    items = table(spark, sf_dir, "lineitem").select(
        label("o", F.col("l_orderkey")).alias("order"),
        label("i", F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("item"),
        F.concat(F.lit(EX + "part/"), "l_partkey").alias("part"),
        F.col("l_quantity").cast("decimal(18,2)").cast("string").alias("quantity"),
        "l_orderkey",
        "l_linenumber",
    )
    if changed:
        first = items.agg(F.min(F.struct("l_orderkey", "l_linenumber"))).first()[0]
        here = (F.col("l_orderkey") == first["l_orderkey"]) & (F.col("l_linenumber") == first["l_linenumber"])
        items = items.withColumn("part", F.when(here, F.lit(EX + "part/none")).otherwise(F.col("part")))
    orders = table(spark, sf_dir, "orders").select(label("o", F.col("o_orderkey")).alias("order"), F.concat(F.lit(EX + "customer/"), "o_custkey").alias("customer"))
    none = F.lit(None).cast("string")

    def triple(rows, s, p, o, kind):
        return rows.select(F.col(s).alias("s"), F.lit(EX + p).alias("p"), F.col(o).alias("o"), F.lit(kind).alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))

    return graph_merge(
        triple(orders, "order", "customer", "customer", IRI),
        triple(items, "order", "item", "item", BNODE),
        triple(items, "item", "part", "part", IRI),
        triple(items, "item", "quantity", "quantity", LITERAL),
    )


def _plain_label(prefix, key):
    return F.concat(F.lit(BLANK + prefix), key.cast("string"))


def _hashed_label(prefix, key):
    return F.concat(F.lit(BLANK), F.md5(F.concat(F.lit(prefix), key.cast("string"))))


@registry.add(
    "graph_isomorphic",
    """
    SELECT 'other labels' AS against, TRUE AS isomorphic
    UNION ALL SELECT 'other labels, one part changed', (SELECT count(*) = 0 FROM lineitem)
    """,
)
def graph_isomorphic_query(spark, sf_dir):
    """Orders as blank nodes against the same under other labels, and against a graph with one edge changed."""
    base = blank_orders(spark, sf_dir, _plain_label)
    same, other = [graph_isomorphic(base, blank_orders(spark, sf_dir, _hashed_label, changed)) for changed in (False, True)]
    return spark.createDataFrame([("other labels", same), ("other labels, one part changed", other)], "against string, isomorphic boolean")


@registry.add(
    "graph_diff_unlabelled",
    f"""
    WITH f AS (SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY 1, 2 LIMIT 1),
    own AS (SELECT l.*, l.l_linenumber = f.l_linenumber AS here FROM lineitem l JOIN f USING (l_orderkey)),
    before AS (
      SELECT '{EX}customer' AS p, '{EX}customer/' || o_custkey AS o FROM orders JOIN f ON o_orderkey = l_orderkey
      UNION ALL SELECT '{EX}item', '_:' FROM own
      UNION ALL SELECT '{EX}part', '{EX}part/' || l_partkey FROM own
      UNION ALL SELECT '{EX}quantity', CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) FROM own),
    after AS (
      SELECT * FROM before WHERE p <> '{EX}part'
      UNION ALL SELECT '{EX}part', '{EX}part/' || CASE WHEN here THEN 'none' ELSE CAST(l_partkey AS VARCHAR) END FROM own)
    SELECT p, o, 'missing' AS side, CAST(count(*) AS BIGINT) AS triples FROM before GROUP BY p, o
    UNION ALL SELECT p, o, 'extra', CAST(count(*) AS BIGINT) FROM after GROUP BY p, o
    """,
)
def graph_diff_unlabelled_query(spark, sf_dir):
    """Where one part changed: the order of that item and all its items differ, and nothing else."""
    delta = graph_diff_unlabelled(blank_orders(spark, sf_dir, _plain_label), blank_orders(spark, sf_dir, _hashed_label, True))
    shown = F.when(F.col("o_kind") == BNODE, F.lit(BLANK)).otherwise(F.col("o"))
    return delta.groupBy("p", shown.alias("o"), "side").agg(F.sum("copies").alias("triples"))


@registry.add("graph_append_distinct", f"SELECT DISTINCT {COLS} FROM ({LINEITEM_SQL})")
def graph_append_distinct(spark, sf_dir):
    """Three deliveries that overlap, added one after the other to a graph without repeats."""
    path = new_path(spark, "graph")
    everything = table(spark, sf_dir, "lineitem")
    for low, high in ((0, 5), (3, 8), (0, 100)):
        part = everything.where(F.col("l_linenumber").between(low, high))
        append_distinct(triples_of(part, lineitem_map()), path, buckets=16)
    return read_graph(spark, path)


# --- events and reports -----------------------------------------------------------


@registry.add(
    "first_event_since",
    """
    SELECT user_id, ts, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
      WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' - INTERVAL 2 SECOND AND event_type = 'error')
    WHERE rn = 1
    """,
)
def first_event_since_query(spark, sf_dir):
    since = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return first_event_since(
        table(spark, sf_dir, "events"), "user_id", "ts", ["event_id"], since, F.col("event_type") == "error", ["value"]
    )


@registry.add(
    "first_of_candidates",
    """
    SELECT user_id, ts, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS found FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE ts >= TIMESTAMP '2024-01-04 23:59:58')
      WHERE rn <= 3 AND event_type = 'error')
    WHERE found = 1
    """,
)
def first_of_candidates_query(spark, sf_dir):
    """The first error among the first three events of a user; later ones do not count."""
    since = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return first_of_candidates(table(spark, sf_dir, "events"), "user_id", "ts", ["event_id"], since, F.col("event_type") == "error", ["value"], 3)


@registry.add(
    "merge_bins",
    "SELECT event_id, user_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 3 AS bin_id FROM events",
)
def merge_bins_query(spark, sf_dir):
    """Bins of three over the global event order, without a single-task window."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return merge_bins(events, ["ts", "event_id"]).select("event_id", "user_id", "bin_id")


@registry.add(
    "ordered_report",
    """
    SELECT event_type, count(*) AS events,
           CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS BIGINT) AS position
    FROM events GROUP BY event_type
    """,
)
def ordered_report_query(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return ordered_report(counts, "event_type", ["signup", "view", "click", "purchase"])


@registry.add("url_hash16", "SELECT page_id, substr(sha256(url), 1, 16) AS key FROM pages")
def url_hash16(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", short_key(F.col("url")).alias("key"))


@registry.add(
    "epoch_start_text",
    "SELECT event_id, strftime(ts - INTERVAL 2 SECOND, '%m/%d/%Y %H:%M:%S') || ' UTC' AS start_text FROM events",
)
def epoch_start_text(spark, sf_dir):
    """Event times as epoch milliseconds, printed with the slack taken off."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    millis = F.timestamp_diff("MILLISECOND", epoch, F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", start_text(millis).alias("start_text"))
