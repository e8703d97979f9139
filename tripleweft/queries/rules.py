"""Queries on mappings held as data, made from table rows so that they grow with them."""

from pyspark.sql import functions as F

from tripleweft.operators.routing import failure_routing, file_filter, route_by_attribute, size_class_route
from tripleweft.operators.rules import (
    apply_rules,
    normalise_short_rules,
    record_maps,
    rules_from_mapping_triples,
    validate_rules,
)
from tripleweft.plans.asof import as_of_join
from tripleweft.plans.joins import checked_join
from tripleweft.queries.common import DECIMAL, EX, INTEGER, Registry, table
from tripleweft.sources.ntriples import parse_ntriples
from tripleweft.vocab import QL, RDF_TYPE, RML, RR, SCHEMA, XSD

registry = Registry()


def _line(s, p, o):
    """N-Triples line from SQL-free pieces; `$k` and `$n` stand for key and nation."""
    cols, text = [], f"{s} <{p}> {o} ."
    for i, piece in enumerate(text.split("$k")):
        if i:
            cols.append(F.col("s_suppkey").cast("string"))
        for j, part in enumerate(piece.split("$n")):
            if j:
                cols.append(F.col("s_nationkey").cast("string"))
            cols.append(F.lit(part))
    return F.concat(*cols)


def mapping_documents(spark, sf_dir):
    """One mapping document per supplier, as N-Triples lines."""
    m = "<http://maps.example.org/$k#main>"
    always = [
        (m, RML + "logicalSource", "_:ls"),
        ("_:ls", RML + "source", '"supplier-$k.csv"'),
        ("_:ls", RML + "iterator", '"$[*]"'),
        (m, RR + "subjectMap", "_:sm"),
        ("_:sm", RR + "template", f'"{EX}t$k/item/{{id}}"'),
        ("_:sm", RR + "class", f"<{SCHEMA}Product>"),
        ("_:sm", RR + "class", f"<{EX}Nation$n>"),
        (m, RR + "predicateObjectMap", "_:p1"),
        ("_:p1", RR + "predicate", f"<{SCHEMA}name>"),
        ("_:p1", RR + "objectMap", "_:o1"),
        ("_:o1", RML + "reference", '"name"'),
        ("_:o1", RR + "language", '"en"'),
        (m, RR + "predicateObjectMap", "_:p2"),
        ("_:p2", RR + "predicateMap", "_:pm"),
        ("_:pm", RR + "constant", f"<{EX}balance>"),
        ("_:p2", RR + "objectMap", "_:o2"),
        ("_:o2", RML + "reference", '"balance"'),
        ("_:o2", RR + "datatype", f"<{DECIMAL}>"),
        (m, RR + "predicateObjectMap", "_:p3"),
        ("_:p3", RR + "predicate", f"<{EX}nation>"),
        ("_:p3", RR + "object", f"<{EX}nation/$n>"),
        (m, RR + "predicateObjectMap", "_:p4"),
        ("_:p4", RR + "predicate", f"<{EX}group>"),
        ("_:p4", RR + "objectMap", "_:o4"),
        ("_:o4", RR + "template", f'"{EX}group/{{kind}}/{{id}}"'),
    ]
    csv = F.when(F.col("s_acctbal") > 0, _line("_:ls", RML + "referenceFormulation", f"<{QL}CSV>"))
    lines = F.array_compact(F.array(*[_line(*t) for t in always], csv))
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select(F.col("s_suppkey").cast("string").alias("tenant"), F.explode(lines).alias("value"))


def _mapping_rule_sql(p, kind, value, datatype="NULL", lang="NULL"):
    return f"""
    SELECT CAST(s_suppkey AS VARCHAR) AS tenant, 'http://maps.example.org/' || s_suppkey || '#main' AS triples_map,
           'supplier-' || s_suppkey || '.csv' AS source, CASE WHEN s_acctbal > 0 THEN 'CSV' ELSE 'JSONPath' END AS formulation,
           '$[*]' AS iterator, '{EX}t' || s_suppkey || '/item/{{id}}' AS subject_template,
           '{EX}Nation' || s_nationkey || ',{SCHEMA}Product' AS classes, '{p}' AS predicate, '{kind}' AS obj_kind,
           {value} AS obj_value, CAST({datatype} AS VARCHAR) AS datatype, CAST({lang} AS VARCHAR) AS lang
    FROM supplier"""


@registry.add(
    "rules_from_mapping_triples",
    " UNION ALL ".join(
        [
            _mapping_rule_sql(SCHEMA + "name", "reference", "'name'", lang="'en'"),
            _mapping_rule_sql(EX + "balance", "reference", "'balance'", datatype=f"'{DECIMAL}'"),
            _mapping_rule_sql(EX + "nation", "constant", f"'{EX}nation/' || s_nationkey"),
            _mapping_rule_sql(EX + "group", "template", f"'{EX}group/{{kind}}/{{id}}'"),
        ]
    ),
)
def rules_from_mapping_triples_query(spark, sf_dir):
    triples = parse_ntriples(mapping_documents(spark, sf_dir), keep=["tenant"])
    rules = rules_from_mapping_triples(triples)
    return rules.withColumn("classes", F.array_join("classes", ","))


def short_rows(spark, sf_dir):
    """Short-notation mapping rows of each part, and its prefix list."""
    part = table(spark, sf_dir, "part")
    tenant = F.col("p_partkey").cast("string").alias("tenant")
    null = F.lit(None).cast("string")

    def row(p, o, datatype=null):
        return F.struct(p.alias("p"), o.alias("o"), datatype.alias("datatype"))

    rows = F.array(
        row(F.lit("a"), F.concat(F.lit("ex:"), "p_type")),
        row(F.lit("schema:name"), F.lit("$(name)")),
        row(F.lit("ex:brand"), F.concat(F.lit("ex:brand/$(brand)/"), "p_brand")),
        row(F.lit("schema:priceCurrency"), F.lit("EUR")),
        row(F.lit("http://full.example.org/size"), F.lit("$(size)"), F.lit("xsd:integer")),
        row(F.lit("other:label"), F.lit("$(a)-$(b)")),
    )
    short = part.select(
        tenant,
        F.lit("item").alias("triples_map"),
        F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("source"),
        F.when(F.col("p_size") > 25, F.lit(" Csv")).otherwise(F.lit("jsonpath")).alias("formulation"),
        null.alias("iterator"),
        F.lit("ex:part/$(id)").alias("s"),
        F.inline(rows),
    ).withColumn("lang", null)
    pairs = {"ex": EX, "schema": SCHEMA, "xsd": XSD}
    entries = F.array(*[F.struct(F.lit(k).alias("prefix"), F.lit(v).alias("iri")) for k, v in pairs.items()])
    return short, part.select(tenant, F.inline(entries))


def _short_rule_sql(p, kind, value, datatype="NULL"):
    return f"""
    SELECT CAST(p_partkey AS VARCHAR) AS tenant, 'item' AS triples_map, 'part-' || p_partkey AS source,
           CASE WHEN p_size > 25 THEN 'CSV' ELSE 'JSONPath' END AS formulation, CAST(NULL AS VARCHAR) AS iterator,
           '{EX}part/{{id}}' AS subject_template, '' AS classes, '{p}' AS predicate, '{kind}' AS obj_kind,
           {value} AS obj_value, CAST({datatype} AS VARCHAR) AS datatype, CAST(NULL AS VARCHAR) AS lang
    FROM part"""


@registry.add(
    "yarrrml_rules_normalise",
    " UNION ALL ".join(
        [
            _short_rule_sql(RDF_TYPE, "constant", f"'{EX}' || p_type"),
            _short_rule_sql(SCHEMA + "name", "reference", "'name'"),
            _short_rule_sql(EX + "brand", "template", f"'{EX}brand/{{brand}}/' || p_brand"),
            _short_rule_sql(SCHEMA + "priceCurrency", "constant", "'EUR'"),
            _short_rule_sql("http://full.example.org/size", "reference", "'size'", f"'{INTEGER}'"),
            _short_rule_sql("other:label", "template", "'{a}-{b}'"),
        ]
    ),
)
def yarrrml_rules_normalise(spark, sf_dir):
    rules = normalise_short_rules(*short_rows(spark, sf_dir))
    return rules.withColumn("classes", F.array_join("classes", ","))


@registry.add(
    "mapping_validate",
    """
    SELECT tenant, nullif(concat_ws(',',
        CASE WHEN source IS NULL THEN 'missing_source' END,
        CASE WHEN subject_template = '' THEN 'missing_subject_template' END,
        CASE WHEN formulation = 'SQL' THEN 'unsupported_formulation' END,
        CASE WHEN predicate IS NULL THEN 'missing_predicate' END,
        CASE WHEN obj_kind IS NULL THEN 'missing_object' END,
        CASE WHEN subject_template LIKE '%${%' THEN 'unresolved_attribute' END,
        CASE WHEN source LIKE 'gone%' THEN 'unknown_source' END), '') AS errors
    FROM (
      SELECT CAST(c_custkey AS VARCHAR) AS tenant,
        CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_nationkey = 7 THEN 'gone.csv' ELSE 'in.csv' END END AS source,
        CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN 'http://${tenant.id}/x' ELSE 'http://example.org/{id}' END AS subject_template,
        CASE WHEN c_nationkey < 5 THEN 'SQL' WHEN c_nationkey < 10 THEN NULL ELSE 'CSV' END AS formulation,
        CASE WHEN c_acctbal < 9000 THEN 'http://example.org/p' END AS predicate,
        CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'reference' END AS obj_kind
      FROM customer)
    """,
)
def mapping_validate(spark, sf_dir):
    """A rule per customer, spoilt in several ways at once."""
    customer = table(spark, sf_dir, "customer")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    null = F.lit(None).cast("string")
    rules = customer.select(
        F.col("c_custkey").cast("string").alias("tenant"),
        F.lit("main").alias("triples_map"),
        F.when(F.col("c_acctbal") >= 0, F.when(nation == 7, F.lit("gone.csv")).otherwise(F.lit("in.csv"))).alias("source"),
        F.when(nation < 5, F.lit("SQL")).when(nation >= 10, F.lit("CSV")).alias("formulation"),
        null.alias("iterator"),
        F.when(segment == "BUILDING", F.lit(""))
        .when(segment == "MACHINERY", F.lit("http://${tenant.id}/x"))
        .otherwise(F.lit(EX + "{id}"))
        .alias("subject_template"),
        F.array().cast("array<string>").alias("classes"),
        F.when(F.col("c_acctbal") < 9000, F.lit(EX + "p")).alias("predicate"),
        F.when(segment != "FURNITURE", F.lit("reference")).alias("obj_kind"),
        F.lit("name").alias("obj_value"),
        null.alias("datatype"),
        null.alias("lang"),
    )
    sources = customer.select(F.col("c_custkey").cast("string").alias("tenant"), F.lit("in.csv").alias("source"))
    checked = validate_rules(rules, sources)
    return checked.select("tenant", F.nullif(F.array_join("errors", ","), F.lit("")).alias("errors"))


def nation_rules(spark, sf_dir):
    """A mapping per nation as tenant: own subjects, one class, four rules, some tagged."""
    null = F.lit(None).cast("string")
    key = F.col("n_nationkey").cast("string")

    def row(p, kind, value, datatype=null, lang=null):
        return F.struct(
            F.lit(p).alias("predicate"),
            F.lit(kind).alias("obj_kind"),
            value.alias("obj_value"),
            datatype.alias("datatype"),
            lang.alias("lang"),
        )

    rows = F.array(
        row(SCHEMA + "name", "reference", F.lit("c_name"), lang=F.when(F.col("n_regionkey") == 1, F.lit("en"))),
        row(EX + "balance", "reference", F.lit("c_acctbal"), datatype=F.lit(DECIMAL)),
        row(EX + "segment", "template", F.concat(F.lit(EX + "t"), key, F.lit("/{c_mktsegment}"))),
        row(EX + "home", "constant", F.concat(F.lit("urn:nation:"), key)),
    )
    return table(spark, sf_dir, "nation").select(
        key.alias("tenant"),
        F.lit("customer").alias("source"),
        F.lit("customer").alias("triples_map"),
        F.lit("CSV").alias("formulation"),
        null.alias("iterator"),
        F.concat(F.lit(EX + "t"), key, F.lit("/customer/{c_custkey}")).alias("subject_template"),
        F.array(F.concat(F.lit(EX + "Customer"), key)).alias("classes"),
        F.inline(rows),
    )


def customer_records(spark, sf_dir):
    """Customers as record maps of their nation; one segment has no value."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("tenant"),
        F.lit("customer").alias("source"),
        "c_custkey",
        "c_name",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )
    return record_maps(customer, ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"], ["tenant", "source"])


_NATION_RULES_SQL = f"""
    WITH r AS (SELECT '{EX}t' || c_nationkey || '/customer/' || c_custkey AS s, c.*, n_regionkey,
                      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS bal
               FROM customer c JOIN nation ON c_nationkey = n_nationkey)
    SELECT s, '{RDF_TYPE}' AS p, '{EX}Customer' || c_nationkey AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang FROM r
    UNION ALL SELECT s, '{SCHEMA}name', c_name, 'literal', NULL, CASE WHEN n_regionkey = 1 THEN 'en' END FROM r
    UNION ALL SELECT s, '{EX}balance', bal, 'literal', '{DECIMAL}', NULL FROM r
    UNION ALL SELECT s, '{EX}segment', '{EX}t' || c_nationkey || '/' || c_mktsegment, 'iri', NULL, NULL FROM r WHERE c_mktsegment <> 'BUILDING'
    UNION ALL SELECT s, '{EX}home', 'urn:nation:' || c_nationkey, 'iri', NULL, NULL FROM r
"""


@registry.add("rules_join_materialise", _NATION_RULES_SQL)
def rules_join_materialise(spark, sf_dir):
    """Each tenant's records by that tenant's rules, in one job."""
    return apply_rules(customer_records(spark, sf_dir), nation_rules(spark, sf_dir))


@registry.add(
    "tenant_mapping_join",
    """
    SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS tenant,
           'http://mappings.example.org/' || c_nationkey || '/customer.ttl' AS mapping
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def tenant_mapping_join(spark, sf_dir):
    """The mapping document of each record's tenant."""
    catalog = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("tenant"),
        F.lit("customer").alias("source"),
        F.concat(F.lit("http://mappings.example.org/"), F.col("n_nationkey").cast("string"), F.lit("/customer.ttl")).alias("mapping"),
    )
    records = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("tenant"), F.lit("customer").alias("source")
    )
    return checked_join(records, catalog, ["tenant", "source"]).select("c_custkey", "tenant", "mapping")


# --- routing ------------------------------------------------------------------


@registry.add(
    "route_by_attribute",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'unmatched' END AS route
    FROM orders
    """,
)
def route_by_attribute_query(spark, sf_dir):
    routed = route_by_attribute(table(spark, sf_dir, "orders"), "o_orderstatus", {"finished": "F", "open": "O"})
    return routed.select("o_orderkey", "route")


@registry.add(
    "size_class_route",
    """
    SELECT doc_id, n_chars, CASE WHEN n_chars <= 2000 THEN 'small' ELSE 'large' END AS route,
           CASE WHEN n_chars <= 2000 THEN 'AUTO_BELOW_THRESHOLD' ELSE 'AUTO_ABOVE_THRESHOLD' END AS reason,
           CASE WHEN n_chars <= 2000 THEN 'AUTO_BELOW_THRESHOLD' ELSE 'AUTO_FALLBACK' END AS fallback_reason
    FROM documents
    """,
)
def size_class_route_query(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    fallback = size_class_route(documents, "n_chars", 2000, large_path=False)
    fallback = fallback.select("doc_id", "n_chars", F.col("reason").alias("fallback_reason"))
    return size_class_route(fallback, "n_chars", 2000).select("doc_id", "n_chars", "route", "reason", "fallback_reason")


@registry.add(
    "file_filter", "SELECT page_id, url FROM pages WHERE regexp_full_match(url, 'https://.*\\.example\\.(com|net)/.*')"
)
def file_filter_query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return file_filter(pages, "url", r"https://.*\.example\.(com|net)/.*")


_BAD_EVENT_SQL = "(event_type = 'error' AND value < 1)"


def split_events(spark, sf_dir, per_record=False):
    """Events with the user as input; small errors make an input fail."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    bad = (F.col("event_type") == "error") & (F.col("value") < 1)
    message = F.concat(F.lit("value "), F.col("value").cast("decimal(18,2)").cast("string"))
    return failure_routing(events, "user_id", bad, F.lit("BadValue"), message, per_record)


@registry.add(
    "failure_routing",
    f"""
    SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE {_BAD_EVENT_SQL})
    """,
)
def failure_routing_query(spark, sf_dir):
    good, _ = split_events(spark, sf_dir)
    return good.select("event_id", "user_id")


@registry.add(
    "failure_dead_letters",
    f"""
    SELECT user_id, 'BadValue' AS error_type, 'value ' || min(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)) AS error_message,
           count(*) AS bad_records
    FROM events WHERE {_BAD_EVENT_SQL} GROUP BY user_id
    """,
)
def failure_dead_letters(spark, sf_dir):
    _, failures = split_events(spark, sf_dir)
    return failures


@registry.add("failure_per_record", f"SELECT event_id, user_id FROM events WHERE NOT {_BAD_EVENT_SQL}")
def failure_per_record(spark, sf_dir):
    good, _ = split_events(spark, sf_dir, per_record=True)
    return good.select("event_id", "user_id")


@registry.add(
    "mapping_as_of",
    f"""
    SELECT '{EX}event/' || e.event_id AS s, '{EX}v' || v.version || '/value' AS p, CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR) AS o
    FROM events e ASOF JOIN (SELECT event_type, ts, event_id AS version FROM events WHERE event_id % 97 = 0) v
         ON e.event_type = v.event_type AND e.ts >= v.ts
    """,
)
def mapping_as_of(spark, sf_dir):
    """Events under the rules that their tenant had when they came; the rules change again and again."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "tenant")
    rules = events.where("event_id % 97 = 0").select("tenant", F.col("ts").alias("since"), F.concat(F.lit(EX + "v"), "event_id", F.lit("/value")).alias("predicate"))
    ruled = as_of_join(events.select("tenant", "ts", "event_id", "value"), rules, "tenant", "ts", "since", ["predicate"], partitions=8)
    ruled = ruled.where("predicate IS NOT NULL")
    return ruled.select(F.concat(F.lit(EX + "event/"), "event_id").alias("s"), F.col("predicate").alias("p"), F.col("value").cast("decimal(18,2)").cast("string").alias("o"))
