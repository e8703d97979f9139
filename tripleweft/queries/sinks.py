"""Queries on serialisers and file sinks."""

from pyspark.sql import functions as F

from tripleweft.functions.names import file_extension, mime_type, output_name
from tripleweft.plans.compile import triples_of
from tripleweft.plans.fused import jsonld_text, ntriples_text, turtle_text
from tripleweft.queries.common import (
    COLS,
    CUSTOMER_SQL,
    DOCUMENTS_SQL,
    EX,
    LINE_SQL,
    LINEITEM_SQL,
    OBJECT_SQL,
    ORDERS_SQL,
    Registry,
    customer_map,
    documents_map,
    iri,
    lineitem_map,
    orders_map,
    table,
)
from tripleweft.scratch import new_path
from tripleweft.sinks.files import convert_ntriples, write_ntriples_partitioned, write_partitioned, write_text
from tripleweft.sinks.jsonld import jsonld_scan, write_jsonld
from tripleweft.sinks.ntriples import ntriples_lines, write_ntriples
from tripleweft.sinks.rdfxml import write_rdfxml
from tripleweft.sinks.turtle import predicate_object, turtle_lines
from tripleweft.sinks.versions import publish, read_published
from tripleweft.sources.ntriples import parse_ntriples
from tripleweft.vocab import RDF_TYPE, SCHEMA

registry = Registry()


def _orders(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "orders"), orders_map())


def _documents(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "documents"), documents_map())


def _lineitem(spark, sf_dir):
    return triples_of(table(spark, sf_dir, "lineitem"), lineitem_map())


@registry.add("write_ntriples", f"SELECT {LINE_SQL} AS value FROM ({DOCUMENTS_SQL})")
def write_ntriples_query(spark, sf_dir):
    return ntriples_lines(_documents(spark, sf_dir))


@registry.add("write_ntriples_records", f"SELECT {LINE_SQL} AS value FROM ({DOCUMENTS_SQL})")
def write_ntriples_records(spark, sf_dir):
    """Records straight to N-Triples files without a triples table, read back as lines."""
    path = new_path(spark, "documents-fused-nt")
    write_text(ntriples_text(table(spark, sf_dir, "documents"), documents_map()), path)
    return spark.read.text(path)


_TURTLE_LINE = f"CASE WHEN p = '{RDF_TYPE}' THEN 'a' ELSE '<' || p || '>' END || ' ' || {OBJECT_SQL}"


@registry.add("write_turtle", f"SELECT s, {_TURTLE_LINE} AS line FROM ({LINEITEM_SQL})")
def write_turtle_query(spark, sf_dir):
    """Predicate-object lines by subject, of subjects that come from several records each."""
    return turtle_lines(_lineitem(spark, sf_dir)).select("s", predicate_object(F.col("value")).alias("line"))


@registry.add(
    "write_turtle_records",
    f"""
    SELECT '<' || {iri("customer", "c_custkey")} || '>' || chr(10) || '    a <{SCHEMA}Person> ;' || chr(10) ||
           '    <{SCHEMA}name> "' || c_name || '" ;' || chr(10) || '    <{EX}balance> "' ||
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '"^^<http://www.w3.org/2001/XMLSchema#decimal> ;' || chr(10) ||
           '    <{EX}nation> <{EX}nation/' || c_nationkey || '> .' || chr(10) AS value
    FROM customer
    """,
)
def write_turtle_records(spark, sf_dir):
    """Records straight to Turtle blocks, no shuffle."""
    return turtle_text(table(spark, sf_dir, "customer"), customer_map())


_JSONLD_SQL = f"""
    SELECT s, '{{"@id":"' || s || '","@type":["{SCHEMA}Person"],"{EX}balance":[{{"@type":"http://www.w3.org/2001/XMLSchema#decimal","@value":"' ||
           bal || '"}}],"{EX}nation":[{{"@id":"{EX}nation/' || c_nationkey || '"}}],"{SCHEMA}name":[{{"@value":"' || c_name || '"}}]}}' AS value
    FROM (SELECT {iri("customer", "c_custkey")} AS s, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS bal, * FROM customer)
"""


@registry.add("write_jsonld", f"SELECT {COLS} FROM ({CUSTOMER_SQL})")
def write_jsonld_query(spark, sf_dir):
    """Documents of a graph that holds every triple twice, read back from their files."""
    path = new_path(spark, "customer-jsonld")
    once = triples_of(table(spark, sf_dir, "customer"), customer_map())
    write_jsonld(once.unionByName(once), path)
    return jsonld_scan(spark, path)


@registry.add("write_jsonld_records", f"SELECT value FROM ({_JSONLD_SQL})")
def write_jsonld_records(spark, sf_dir):
    """Records with declared unique subjects straight to node objects."""
    return jsonld_text(table(spark, sf_dir, "customer"), customer_map())


@registry.add(
    "write_rdfxml",
    f"""
    SELECT {iri("document", "doc_id")} AS s, '{EX}source' AS p, source AS o FROM documents
    UNION ALL SELECT {iri("document", "doc_id")}, '{SCHEMA}text', text FROM documents
    """,
)
def write_rdfxml_query(spark, sf_dir):
    """Documents in RDF/XML, read back by Spark's XML reader."""
    path = new_path(spark, "documents-rdf")
    write_rdfxml(_documents(spark, sf_dir), path)
    value = "struct<_VALUE:string,`_xmlns:j`:string>"
    schema = f"`_rdf:about` string, `j:source` array<{value}>, `j:text` array<{value}>"
    rows = spark.read.format("xml").schema(schema).option("rowTag", "rdf:Description").option("ignoreSurroundingSpaces", False).load(path)
    parts = [rows.select(F.col("`_rdf:about`").alias("s"), F.explode(f"`j:{n}`").alias("v"), F.lit(n).alias("n")) for n in ("source", "text")]
    return parts[0].unionByName(parts[1]).select("s", F.concat("v.`_xmlns:j`", "n").alias("p"), F.col("v._VALUE").alias("o"))


@registry.add("convert_rdf", f"SELECT DISTINCT {COLS} FROM ({ORDERS_SQL})")
def convert_rdf(spark, sf_dir):
    """N-Triples files rewritten as JSON-LD files, read back as triples."""
    source, target = new_path(spark, "orders-nt"), new_path(spark, "orders-jsonld")
    write_ntriples(_orders(spark, sf_dir), source)
    convert_ntriples(spark, source, target, "JSON-LD")
    return jsonld_scan(spark, target)


@registry.add(
    "convert_blank_nodes",
    f"""
    SELECT '_:c' || c_custkey AS s, '{SCHEMA}name' AS p, c_name AS o, 'literal' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype,
           CAST(NULL AS VARCHAR) AS o_lang FROM customer
    UNION ALL SELECT {iri("order", "o_orderkey")}, '{SCHEMA}customer', '_:c' || o_custkey, 'bnode', NULL, NULL FROM orders
    """,
)
def convert_blank_nodes(spark, sf_dir):
    """Customers as blank nodes that orders point at, through N-Triples and JSON-LD files."""
    source, target = new_path(spark, "blank-nt"), new_path(spark, "blank-jsonld")
    null = F.lit(None).cast("string")
    named = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("_:c"), "c_custkey").alias("s"), F.lit(SCHEMA + "name").alias("p"), F.col("c_name").alias("o"), F.lit("literal").alias("o_kind")
    )
    placed = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(EX + "order/"), "o_orderkey").alias("s"),
        F.lit(SCHEMA + "customer").alias("p"),
        F.concat(F.lit("_:c"), "o_custkey").alias("o"),
        F.lit("bnode").alias("o_kind"),
    )
    write_ntriples(named.unionByName(placed).withColumns({"o_datatype": null, "o_lang": null}), source)
    convert_ntriples(spark, source, target, "JSON-LD")
    return jsonld_scan(spark, target)


@registry.add(
    "output_naming",
    """
    SELECT page_id, regexp_replace(url, '\\.[^.]*$', '') || '.' ||
           CASE page_id % 4 WHEN 0 THEN 'ttl' WHEN 1 THEN 'nt' WHEN 2 THEN 'jsonld' ELSE 'rdf' END AS file_name,
           CASE page_id % 4 WHEN 0 THEN 'text/turtle' WHEN 1 THEN 'application/n-triples' WHEN 2 THEN 'application/ld+json'
                ELSE 'application/rdf+xml' END AS mime_type,
           CASE page_id % 4 WHEN 0 THEN 'ttl' WHEN 1 THEN 'nt' WHEN 2 THEN 'jsonld' ELSE 'rdf' END AS extension
    FROM pages
    """,
)
def output_naming(spark, sf_dir):
    """Format names in several spellings."""
    spelling = F.element_at(
        F.array(F.lit("turtle"), F.lit("N-Triples"), F.lit(" json-ld "), F.lit("RDF/XML")),
        (F.col("page_id") % 4 + 1).cast("int"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url", spelling.alias("format"))
    return pages.select(
        "page_id",
        output_name(F.col("url"), F.col("format")).alias("file_name"),
        mime_type(F.col("format")).alias("mime_type"),
        file_extension(F.col("format")).alias("extension"),
    )


@registry.add("write_files", f"SELECT {COLS} FROM ({LINEITEM_SQL})")
def write_files(spark, sf_dir):
    """Triples in a folder per predicate; a second version replaces the first in one step."""
    path = new_path(spark, "lineitem-by-predicate")
    triples = _lineitem(spark, sf_dir)
    publish(spark, path, lambda folder: write_partitioned(triples.limit(10), folder, ["p"]))
    publish(spark, path, lambda folder: write_partitioned(triples, folder, ["p"]))
    return read_published(spark, path).select("s", "p", "o", "o_kind", "o_datatype", "o_lang")


@registry.add(
    "tenant_partitioned_sink",
    f"SELECT tenant, {COLS} FROM ({CUSTOMER_SQL}) JOIN (SELECT 't' || c_nationkey AS tenant, {iri('customer', 'c_custkey')} AS s FROM customer) USING (s)",
)
def tenant_partitioned_sink(spark, sf_dir):
    """N-Triples in a folder per tenant, read back with the tenant of the folder."""
    path = new_path(spark, "tenants-nt")
    customer = table(spark, sf_dir, "customer").withColumn(
        "tenant", F.concat(F.lit("t"), F.col("c_nationkey").cast("string"))
    )
    write_ntriples_partitioned(triples_of(customer, customer_map(), keep=("tenant",)), path, ["tenant"])
    return parse_ntriples(spark.read.text(path), keep=["tenant"])
