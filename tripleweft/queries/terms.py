"""Queries on term generation: references, templates, objects, fan-out."""

from pyspark.sql import functions as F

from tripleweft.functions.names import expand_curie
from tripleweft.functions.paths import json_text_value, resolver
from tripleweft.functions.templates import expand, fill_then_expand
from tripleweft.mapping import Mapping, TriplesMap, constant, ref, template
from tripleweft.plans.compile import materialise, triples_of
from tripleweft.queries.common import (
    COLS,
    CUSTOMER_SQL,
    EX,
    INTEGER,
    NATION_SQL,
    ORDERS_SQL,
    Registry,
    customer_map,
    iri,
    kind_of,
    link,
    nation_map,
    orders_map,
    rule,
    table,
    triples_sql,
)
from tripleweft.scratch import new_path
from tripleweft.sources.json import json_records, parse_text
from tripleweft.vocab import RDF_TYPE, SCHEMA

registry = Registry()


@registry.add(
    "reference_value",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS customer,
           CAST(NULL AS VARCHAR) AS absent
    FROM orders
    """,
)
def reference_value(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    value = resolver(orders, "table")
    names = {"key": "o_orderkey", "status": "o_orderstatus", "customer": "o_custkey", "absent": "o_nowhere"}
    return orders.select(*[value(r).alias(n) for n, r in names.items()])


@registry.add(
    "nested_reference",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS by_text, json_extract_string(props, '$.k') AS by_variant,
           json_extract_string(props, '$.k.none') AS missed
    FROM events
    """,
)
def nested_reference(spark, sf_dir):
    """A path into JSON held in a column, read as text and as a variant."""
    events = table(spark, sf_dir, "events")
    records = parse_text(events, "props", keep=["event_id", "props"])
    value = resolver(records, "json")
    return records.select(
        "event_id",
        json_text_value(F.col("props"), "$.k").alias("by_text"),
        value("$.k").alias("by_variant"),
        value("$.k.none").alias("missed"),
    )


_MAYBE_LANG = "nullif(lang, 'en')"


def _maybe_lang(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("en")))


@registry.add(
    "template_expand",
    f"SELECT doc_id, '{EX}' || {_MAYBE_LANG} || '/' || doc_id AS plain, "
    "'src/' || replace(source, 'src', 'a b') AS raw, 'src/' || replace(source, 'src', 'a%20b') AS encoded FROM documents",
)
def template_expand(spark, sf_dir):
    """A null reference makes the whole text null; values go in raw unless encoded."""
    documents = _maybe_lang(spark, sf_dir).withColumn("spaced", F.replace("source", F.lit("src"), F.lit("a b")))
    value = resolver(documents, "table")
    return documents.select(
        "doc_id",
        expand(EX + "{lang}/{doc_id}", value).alias("plain"),
        expand("src/{spaced}", value).alias("raw"),
        expand("src/{spaced}", value, encode=True).alias("encoded"),
    )


@registry.add(
    "subject_map",
    triples_sql("documents", f"'{EX}' || {_MAYBE_LANG} || '/' || doc_id", [rule(EX + "source", "source")]),
)
def subject_map(spark, sf_dir):
    """Records without a subject yield nothing."""
    tm = TriplesMap("documents", EX + "{lang}/{doc_id}", objects=((EX + "source", ref("source")),))
    return triples_of(_maybe_lang(spark, sf_dir), tm)


@registry.add(
    "class_triples",
    triples_sql("supplier", iri("supplier", "s_suppkey"), [kind_of(SCHEMA + "Organization"), kind_of(EX + "Supplier")]),
)
def class_triples(spark, sf_dir):
    tm = TriplesMap("supplier", EX + "supplier/{s_suppkey}", (SCHEMA + "Organization", EX + "Supplier"))
    return triples_of(table(spark, sf_dir, "supplier"), tm)


@registry.add(
    "literal_object",
    triples_sql(
        "conversations", f"'{EX}turn/' || conv_id || '/' || turn", [rule(EX + "role", "role"), rule(SCHEMA + "text", "text")]
    ),
)
def literal_object(spark, sf_dir):
    tm = TriplesMap(
        "conversations",
        EX + "turn/{conv_id}/{turn}",
        objects=((EX + "role", ref("role")), (SCHEMA + "text", ref("text"))),
    )
    return triples_of(table(spark, sf_dir, "conversations"), tm)


@registry.add(
    "iri_object",
    triples_sql(
        "lineitem",
        f"'{EX}lineitem/' || l_orderkey || '/' || l_linenumber",
        [link(EX + "supply", f"'{EX}supply/' || l_partkey || '/' || l_suppkey")],
    ),
)
def iri_object(spark, sf_dir):
    tm = TriplesMap(
        "lineitem",
        EX + "lineitem/{l_orderkey}/{l_linenumber}",
        objects=((EX + "supply", template(EX + "supply/{l_partkey}/{l_suppkey}")),),
    )
    return triples_of(table(spark, sf_dir, "lineitem"), tm)


@registry.add(
    "constant_object",
    triples_sql(
        "part",
        iri("part", "p_partkey"),
        [rule(SCHEMA + "priceCurrency", "'EUR'"), link(EX + "catalog", "'urn:catalog:1'"), link(EX + "home", "'https://example.org/'")],
    ),
)
def constant_object(spark, sf_dir):
    tm = TriplesMap(
        "part",
        EX + "part/{p_partkey}",
        objects=(
            (SCHEMA + "priceCurrency", constant("EUR")),
            (EX + "catalog", constant("urn:catalog:1")),
            (EX + "home", constant("https://example.org/")),
        ),
    )
    return triples_of(table(spark, sf_dir, "part"), tm)


@registry.add(
    "typed_literal",
    triples_sql("part", iri("part", "p_partkey"), [rule(EX + "size", "p_size", datatype=INTEGER)]),
)
def typed_literal(spark, sf_dir):
    tm = TriplesMap("part", EX + "part/{p_partkey}", objects=((EX + "size", ref("p_size", datatype=INTEGER)),))
    return triples_of(table(spark, sf_dir, "part"), tm)


@registry.add(
    "lang_literal",
    f"""
    SELECT {iri("document", "doc_id")} AS s, '{SCHEMA}text' AS p, text AS o, 'literal' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype,
           lang AS o_lang FROM documents WHERE text IS NOT NULL
    """,
)
def lang_literal(spark, sf_dir):
    """Language tags that come from a column, whatever languages there are."""
    tm = TriplesMap(
        "documents", EX + "document/{doc_id}", objects=((SCHEMA + "text", ref("text", lang=F.col("lang"))),)
    )
    return triples_of(table(spark, sf_dir, "documents"), tm)


@registry.add(
    "null_skip",
    triples_sql(
        "documents",
        iri("document", "doc_id"),
        [
            rule(EX + "lang", _MAYBE_LANG),
            rule(EX + "source", "source"),
            link(EX + "group", f"'{EX}group/' || {_MAYBE_LANG} || '/' || source"),
        ],
    ),
)
def null_skip(spark, sf_dir):
    """A null object leaves out its own triple only."""
    tm = TriplesMap(
        "documents",
        EX + "document/{doc_id}",
        objects=(
            (EX + "lang", ref("lang")),
            (EX + "source", ref("source")),
            (EX + "group", template(EX + "group/{lang}/{source}")),
            (EX + "none", ref("no_such_column")),
        ),
    )
    return triples_of(_maybe_lang(spark, sf_dir), tm)


@registry.add("triples_fanout", f"SELECT {COLS} FROM ({CUSTOMER_SQL})")
def triples_fanout(spark, sf_dir):
    """Flagship: one record to many triples in one narrow pass."""
    return triples_of(table(spark, sf_dir, "customer"), customer_map())


@registry.add(
    "multi_map_union",
    f"{CUSTOMER_SQL} UNION ALL {NATION_SQL} UNION ALL "
    + triples_sql("customer", iri("segment", "c_mktsegment"), [link(EX + "member", iri("customer", "c_custkey"))]),
)
def multi_map_union(spark, sf_dir):
    """Two maps over one table and one over another: two scans, bag semantics."""
    members = TriplesMap(
        "customer",
        EX + "segment/{c_mktsegment}",
        objects=((EX + "member", template(EX + "customer/{c_custkey}")),),
        name="members",
    )
    mapping = Mapping((customer_map(), members, nation_map()))
    inputs = {name: table(spark, sf_dir, name) for name in ("customer", "nation")}
    return materialise(mapping, inputs)


@registry.add(
    "curie_expand",
    """
    SELECT p_partkey, curie,
           CASE split_part(curie, ':', 1) WHEN 'economy' THEN 'http://example.org/economy#' || substr(curie, strpos(curie, ':') + 1)
                WHEN 'promo' THEN 'http://example.org/promo/' || substr(curie, strpos(curie, ':') + 1) ELSE curie END AS iri
    FROM (SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN p_brand ELSE lower(p_type) || ':' || p_name || ':' || p_partkey END AS curie FROM part)
    """,
)
def curie_expand(spark, sf_dir):
    """Known prefix, unknown prefix, and no prefix at all."""
    prefixes = {"economy": "http://example.org/economy#", "promo": "http://example.org/promo/"}
    known = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])
    curie = F.when(F.col("p_type") == "LARGE", F.col("p_brand")).otherwise(
        F.concat(F.lower("p_type"), F.lit(":"), "p_name", F.lit(":"), F.col("p_partkey").cast("string"))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", curie.alias("curie"))
    return parts.select("p_partkey", "curie", expand_curie(F.col("curie"), known).alias("iri"))


@registry.add(
    "attr_substitute",
    """
    SELECT c_custkey,
           'http://' || lower(c_mktsegment) || '.example.org/customer/' || c_custkey AS subject,
           coalesce(CASE WHEN c_nationkey < 10 THEN 'n' || c_nationkey END, 'public') || '/' || c_name AS label,
           CASE WHEN c_nationkey < 10 THEN 'at-n' || c_nationkey END AS strict
    FROM customer
    """,
)
def attr_substitute(spark, sf_dir):
    """Input attributes in templates, with a default and without."""
    customer = table(spark, sf_dir, "customer")
    nation = F.when(F.col("c_nationkey") < 10, F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    attrs = F.map_filter(
        F.create_map(F.lit("tenant.id"), F.lower("c_mktsegment"), F.lit("nation"), nation), lambda k, v: v.isNotNull()
    )
    records = customer.withColumn("attrs", attrs)
    value, known = resolver(records, "table"), F.col("attrs")
    return records.select(
        "c_custkey",
        fill_then_expand("http://${tenant.id}.example.org/customer/{c_custkey}", known, value).alias("subject"),
        fill_then_expand("${nation:-public}/{c_name}", known, value).alias("label"),
        fill_then_expand("at-${nation}", known, value).alias("strict"),
    )


_SEGMENT = "'http://' || lower(c_mktsegment) || '.example.org/"


@registry.add(
    "attr_mapping",
    f"""
    SELECT s, p, o, o_kind, o_datatype, CAST(NULL AS VARCHAR) AS o_lang FROM (
      SELECT {_SEGMENT}customer/' || c_custkey AS s, '{RDF_TYPE}' AS p, '{SCHEMA}Person' AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype FROM customer
      UNION ALL SELECT {_SEGMENT}customer/' || c_custkey, '{SCHEMA}name', c_name, 'literal', NULL FROM customer
      UNION ALL SELECT {_SEGMENT}customer/' || c_custkey, '{EX}nation', {_SEGMENT}nation/' || c_nationkey, 'iri', NULL FROM customer
      UNION ALL SELECT {_SEGMENT}customer/' || c_custkey, '{EX}tenant', lower(c_mktsegment), 'literal', NULL FROM customer
      UNION ALL SELECT {_SEGMENT}customer/' || c_custkey, '{EX}home', {_SEGMENT}at/eu', 'iri', NULL FROM customer)
    """,
)
def attr_mapping(spark, sf_dir):
    """A mapping with input attributes in its subject, a template and two constants."""
    customer = table(spark, sf_dir, "customer").withColumn("attrs", F.create_map(F.lit("tenant.id"), F.lower("c_mktsegment")))
    tm = TriplesMap(
        "customer",
        "http://${tenant.id}.example.org/customer/{c_custkey}",
        (SCHEMA + "Person",),
        (
            (SCHEMA + "name", ref("c_name")),
            (EX + "nation", template("http://${tenant.id}.example.org/nation/{c_nationkey}")),
            (EX + "tenant", constant("${tenant.id}")),
            (EX + "home", constant("http://${tenant.id}.example.org/at/${region:-eu}")),
        ),
    )
    return triples_of(customer, tm, attrs="attrs")


@registry.add("nested_path_links", ORDERS_SQL)
def nested_path_links(spark, sf_dir):
    """Nested objects in JSON: the customer inside an order becomes a link."""
    path = new_path(spark, "orders-links-json")
    orders = table(spark, sf_dir, "orders")
    document = F.struct(
        F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status")).alias("order"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
    )
    orders.select(F.to_json(document).alias("value")).write.text(path)
    base = orders_map()
    datatypes = dict(base.objects)
    tm = TriplesMap(
        source="orders",
        subject=EX + "order/{order.key}",
        classes=base.classes,
        objects=(
            (SCHEMA + "customer", template(EX + "customer/{customer.id}")),
            (SCHEMA + "price", ref("total", datatype=datatypes[SCHEMA + "price"].datatype)),
            (SCHEMA + "orderDate", ref("$.date", datatype=datatypes[SCHEMA + "orderDate"].datatype)),
            (SCHEMA + "orderStatus", ref("order.status")),
        ),
        formulation="json",
    )
    return triples_of(json_records(spark, path, tm.references()), tm)
