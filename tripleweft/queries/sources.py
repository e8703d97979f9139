"""Queries on sources: tables are written in a file format, read back and mapped."""

from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import functions as F

from tripleweft.functions.paths import resolver
from tripleweft.operators.rules import is_fresh, latest_mappings
from tripleweft.plans.compile import triples_of
from tripleweft.queries.common import (
    COLS,
    DOCUMENTS_SQL,
    EX,
    Registry,
    day,
    day_sql,
    documents_map,
    iri,
    kind_of,
    link,
    money,
    money_sql,
    rule,
    table,
    triples_sql,
)
from tripleweft.mapping import TriplesMap, template
from tripleweft.scratch import new_path, write_and_read
from tripleweft.sinks.ntriples import write_ntriples
from tripleweft.sources.csv import csv_records
from tripleweft.sources.deep_json import iterate_deep
from tripleweft.sources.json import iterate_variant, json_records, variant_documents
from tripleweft.sources.ntriples import ntriples_scan
from tripleweft.sources.streams import file_stream, with_file_attributes
from tripleweft.sources.synthetic import synthetic_customers, synthetic_invoices
from tripleweft.sources.xml import xml_records
from tripleweft.vocab import SCHEMA

registry = Registry()

_CSV_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_replace(text, '[\\r\\n]', ' ', 'g') AS text, lang, source,
       CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
"""


def write_documents_csv(spark, sf_dir):
    path = new_path(spark, "documents-csv")
    flat = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", r"[\r\n]", " "))
    writer = flat.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@registry.add("csv_scan", _CSV_SQL)
def csv_scan(spark, sf_dir):
    path = write_documents_csv(spark, sf_dir)
    return csv_records(spark, path, ["doc_id", "text", "lang", "source", "n_chars"])


@registry.add("csv_scan_fast", _CSV_SQL)
def csv_scan_fast(spark, sf_dir):
    path = write_documents_csv(spark, sf_dir)
    return csv_records(spark, path, ["doc_id", "text", "lang", "source", "n_chars"], mode="fast")


@registry.add(
    "csv_map",
    triples_sql(
        "documents",
        iri("document", "doc_id"),
        [rule(SCHEMA + "text", "regexp_replace(text, '[\\r\\n]', ' ', 'g')"), rule(EX + "source", "source")],
    ),
)
def csv_map(spark, sf_dir):
    """CSV to triples, with the read columns taken from the mapping."""
    tm = documents_map()
    return triples_of(csv_records(spark, write_documents_csv(spark, sf_dir), tm.references()), tm)


def write_order_arrays(spark, sf_dir):
    """A JSON array per line: two records of each order."""
    path = new_path(spark, "orders-json")
    key = F.col("o_orderkey").alias("key")
    first = F.struct(key, F.lit("status").alias("field"), F.col("o_orderstatus").alias("value"))
    second = F.struct(key, F.lit("priority").alias("field"), F.col("o_orderpriority").alias("value"))
    orders = table(spark, sf_dir, "orders")
    orders.select(F.to_json(F.array(first, second)).alias("value")).write.text(path)
    return path


@registry.add(
    "json_array_scan",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, 'status' AS field, o_orderstatus AS value FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'priority', o_orderpriority FROM orders
    """,
)
def json_array_scan(spark, sf_dir):
    names = ["key", "field", "value"]
    records = json_records(spark, write_order_arrays(spark, sf_dir), names, iterator="$[*]")
    value = resolver(records, "json")
    return records.select(*[value(n).alias(n) for n in names])


def _split_size(total):
    """Bytes of a split: 64 KB for a test table, so that its documents have several, and a 256th of all beyond 16 MB, up to 64 MB."""
    return min(max(1 << 16, total // 256), 1 << 26)


@contextmanager
def _small_splits(spark, path):
    """Small file splits for what is run meanwhile; their number is bounded, as every task has a start of its own."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    total = files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(files).getLength()
    wanted = {"spark.sql.files.maxPartitionBytes": str(_split_size(total)), "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in wanted}
    for n, v in wanted.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _as_array(batches):
    """The JSON lines of a file as one array."""
    comma = "["
    for batch in batches:
        lines = [comma + line if not k else "," + line for k, line in enumerate(batch.column(0).to_pylist())]
        comma = "," if lines else comma
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["[]" if comma == "[" else "]"])], ["value"])


@registry.add(
    "json_array_splits",
    """
    SELECT CAST(doc_id AS VARCHAR) AS id, text || ' "}], [{' AS text, '["' || lang || '",{"s\\\\}":"' || source || '"}]' AS tags FROM documents
    WHERE text IS NOT NULL
    """,
)
def json_array_splits(spark, sf_dir):
    """Items of large arrays, with brackets and quotes inside their strings, read in splits of 64 KB, or of a 256th of a larger table."""
    path = new_path(spark, "documents-array")
    tags = F.concat(F.lit('["'), "lang", F.lit('",{"s\\\\}":"'), "source", F.lit('"}]'))
    item = F.struct("doc_id", F.concat("text", F.lit(' "}], [{')).alias("text"), F.parse_json(tags).alias("tags"))
    lines = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.to_json(item).alias("value"))
    lines.mapInArrow(_as_array, "value string").write.text(path)
    with _small_splits(spark, path):
        records = json_records(spark, path, ["doc_id", "text", "tags"], "$[*]", multi_line=True)
        value = resolver(records, "json")
        out = records.select(value("doc_id").alias("id"), value("text").alias("text"), value("tags").alias("tags"))
        return write_and_read(out, "documents-read")


def write_order_documents(spark, sf_dir):
    """An object per line with the records two arrays down."""
    path = new_path(spark, "orders-nested-json")
    parts = F.array(
        F.struct(F.lit("status").alias("field"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("priority").alias("field"), F.col("o_orderpriority").alias("value")),
    )
    entry = F.struct(F.col("o_orderkey").alias("key"), parts.alias("parts"))
    document = F.struct(F.struct(F.array(entry).alias("orders")).alias("data"))
    table(spark, sf_dir, "orders").select(F.to_json(document).alias("value")).write.text(path)
    return path


_ITERATOR_SQL = """
SELECT 'status' AS field, o_orderstatus AS value FROM orders
UNION ALL SELECT 'priority', o_orderpriority FROM orders
"""


@registry.add("json_iterator_scan", _ITERATOR_SQL)
def json_iterator_scan(spark, sf_dir):
    names = ["field", "value"]
    path = write_order_documents(spark, sf_dir)
    records = json_records(spark, path, names, iterator="$.data.orders[*].parts[*]")
    value = resolver(records, "json")
    return records.select(*[value(n).alias(n) for n in names])


@registry.add("json_variant_iterator", _ITERATOR_SQL)
def json_variant_iterator(spark, sf_dir):
    """The same iterator over documents without a read schema."""
    documents = variant_documents(spark, write_order_documents(spark, sf_dir), multi_line=False)
    records = iterate_variant(documents, "$.data.orders[*].parts[*]")
    value = resolver(records, "json")
    return records.select(*[value(n).alias(n) for n in ("field", "value")])


@registry.add(
    "json_deep_iterator",
    f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'copy' FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R' AND l_linenumber = 1
    """,
)
def json_deep_iterator(spark, sf_dir):
    """Items at two depths of order documents, chosen by a number and a text."""
    item = F.struct(F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("string").alias("line"), F.col("l_quantity").cast("int").alias("size"), F.col("l_returnflag").alias("flag"))
    copy = F.struct(F.struct(F.struct(F.array(item.withField("line", F.lit("copy"))).alias("items")).alias("box")).alias("deeper"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", item.alias("item"), F.when(F.col("l_linenumber") == 1, copy).alias("copy"))
    orders = lines.groupBy("l_orderkey").agg(F.collect_list("item").alias("items"), F.collect_list("copy").alias("notes"))
    path = new_path(spark, "orders-deep-json")
    orders.select(F.to_json(F.struct(F.struct("items", F.lit("x").alias("size")).alias("order"), "notes")).alias("value")).write.text(path)
    records = iterate_deep(variant_documents(spark, path, multi_line=False), "$..items[?(@.size >= 45 && @.flag == 'R')]")
    value = resolver(records, "json")
    return records.select(value("key").alias("key"), value("line").alias("line"))


def write_orders_xml(spark, sf_dir):
    """Orders as XML: key and kind in attributes, customer nested, F orders with a base."""
    path = new_path(spark, "orders-xml")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("uml:Interface")).otherwise(F.lit("uml:Class")).alias("_kind"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.struct(
            money("o_totalprice").cast("string").alias("_VALUE"), F.lit("EUR").alias("_currency")
        ).alias("amount"),
        day("o_orderdate").alias("issued"),
        F.when(F.col("o_orderstatus") == "F", F.struct(F.col("o_custkey").alias("_general"))).alias("generalization"),
    )
    rows.write.format("xml").option("rootTag", "orders").option("rowTag", "order").save(path)
    return path


@registry.add(
    "xml_scan",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer,
           {money_sql("o_totalprice")} AS amount, 'EUR' AS currency, {day_sql("o_orderdate")} AS issued
    FROM orders
    """,
)
def xml_scan(spark, sf_dir):
    wanted = {
        "id": "@id",
        "customer": "customer/id",
        "amount": "amount",
        "currency": "amount/@currency",
        "issued": "issued",
    }
    records = xml_records(spark, write_orders_xml(spark, sf_dir), "/orders/order", list(wanted.values()))
    value = resolver(records, "xml")
    return records.select(*[value(path).alias(name) for name, path in wanted.items()])


@registry.add(
    "iterator_predicate",
    triples_sql("orders", iri("class", "o_orderkey"), [kind_of("http://www.w3.org/2002/07/owl#Class")], "o_orderstatus = 'O'")
    + " UNION ALL "
    + triples_sql(
        "orders",
        iri("class", "o_orderkey"),
        [kind_of(EX + "Derived"), link(EX + "general", iri("class", "o_custkey"))],
        "o_orderstatus = 'F'",
    ),
)
def iterator_predicate(spark, sf_dir):
    """Elements chosen by attribute and by presence of a child, in one scan."""
    subject = EX + "class/{@id}"
    base = TriplesMap("orders", subject, ("http://www.w3.org/2002/07/owl#Class",), (), "xml")
    derived = TriplesMap(
        "orders", subject, (EX + "Derived",), ((EX + "general", template(EX + "class/{generalization/@general}")),), "xml"
    )
    path = write_orders_xml(spark, sf_dir)
    plain = xml_records(spark, path, "//order[@kind='uml:Class' and not(generalization)]", base.references())
    special = xml_records(spark, path, "//order[@kind='uml:Class'][generalization]", derived.references())
    return triples_of(plain, base).unionByName(triples_of(special, derived))


@registry.add(
    "xml_iterator_path",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT'
    """,
)
def xml_iterator_path(spark, sf_dir):
    """Elements of one name below two parents and at two depths, chosen by the path and a predicate of its last step.

    What a path with another root names is nothing. Splits of 64 KB, or of a 256th of a larger table, cut records anywhere.
    """
    path = new_path(spark, "orders-by-state")
    order = F.struct(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderpriority").alias("_priority"), F.col("o_custkey").cast("string").alias("customer")
    )
    is_open = F.col("o_orderstatus") == "O"
    batches = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 50).alias("key"))
    groups = batches.agg(F.collect_list(F.when(is_open, order)).alias("a"), F.collect_list(F.when(~is_open, order)).alias("b"))
    closed, opened = F.struct(F.col("b").alias("order")), F.struct(F.col("a").alias("order"))
    # Deeper down, and under another parent, the same names hold what the path does not mean.
    rows = groups.select(opened.alias("open"), closed.alias("closed"), F.struct(F.struct(closed.alias("open")).alias("batch")).alias("old"))
    rows.write.format("xml").option("rootTag", "orders").option("rowTag", "batch").save(path)
    with _small_splits(spark, path):
        found = []
        for root in ("orders", "order"):
            records = xml_records(spark, path, f"/{root}/batch/open/order[not(@priority='1-URGENT')]", ["@id", "customer"])
            value = resolver(records, "xml")
            found.append(records.select(value("@id").alias("id"), value("customer").alias("customer")))
        return write_and_read(found[0].unionByName(found[1]), "orders-read")


@registry.add(
    "table_scan",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           {money_sql("c_acctbal")} AS c_acctbal, c_mktsegment FROM customer
    """,
)
def table_scan(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    value = resolver(customer, "table")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return customer.select(
        *[value(c).alias(c) for c in columns], value(money("c_acctbal")).alias("c_acctbal")
    )


@registry.add("ntriples_scan", f"SELECT {COLS} FROM ({DOCUMENTS_SQL})")
def ntriples_roundtrip(spark, sf_dir):
    """Triples with long, quoted and multi-line literals, written and read back."""
    path = new_path(spark, "documents-nt")
    write_ntriples(triples_of(table(spark, sf_dir, "documents"), documents_map()), path)
    return ntriples_scan(spark, path)


@registry.add(
    "file_stream_source",
    "SELECT event_id, user_id, event_type, 'events.parquet' AS file_name FROM events",
)
def file_stream_source(spark, sf_dir):
    """A watched directory read to its end, rows with the name of their file."""
    schema = table(spark, sf_dir, "events").schema
    stream = with_file_attributes(file_stream(spark, sf_dir, schema, name_glob="events.parquet", max_files=1000))
    out = new_path(spark, "stream-source")
    rows = stream.select("event_id", "user_id", "event_type", "file_name")
    query = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", new_path(spark, "stream-source-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


_FIRST = "['Alice','Bob','Carol','Dmitry','Elena','Farid','Grace','Hugo'][CAST(k % 8 AS INTEGER) + 1]"


@registry.add(
    "synthetic_records",
    f"""
    SELECT k AS id, {_FIRST} || ' ' || k AS name, lower({_FIRST}) || '.' || k || '@example.org' AS email,
           ['Berlin','Lyon','Madrid','Oslo','Porto','Riga','Turin'][CAST((k * 7 + 3) % 7 AS INTEGER) + 1] AS city,
           CAST((k * 37) % 1000 AS INTEGER) AS loyalty
    FROM (SELECT o_orderkey AS k FROM orders)
    """,
)
def synthetic_records(spark, sf_dir):
    return synthetic_customers(table(spark, sf_dir, "orders"), "o_orderkey")


@registry.add(
    "synthetic_invoices",
    """
    SELECT 'INV-' || lpad(CAST(k AS VARCHAR), 8, '0') AS id, CAST((k * 13) % 1000 AS VARCHAR) AS customer,
           CAST(CAST(((k * 7919) % 100000) / 100.0 AS DECIMAL(12,2)) AS VARCHAR) AS amount,
           ['EUR','USD','GBP'][CAST(k % 3 AS INTEGER) + 1] AS currency,
           '2026-' || lpad(CAST((k * 5) % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST((k * 11) % 28 + 1 AS VARCHAR), 2, '0') AS issued
    FROM (SELECT o_orderkey AS k FROM orders)
    """,
)
def synthetic_invoice_records(spark, sf_dir):
    return synthetic_invoices(table(spark, sf_dir, "orders"), "o_orderkey")


@registry.add(
    "mapping_catalog",
    """
    SELECT tenant, dataset, strftime(fetched_at, '%Y-%m-%d') AS fetched_on, version,
           fetched_at > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAY AS fresh
    FROM (SELECT o_custkey AS tenant, o_orderpriority AS dataset, o_orderdate AS fetched_at, o_orderkey AS version,
                 row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders)
    WHERE rn = 1
    """,
)
def mapping_catalog(spark, sf_dir):
    """Newest mapping version per tenant and dataset, and whether it is still valid."""
    catalog = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("tenant"),
        F.col("o_orderpriority").alias("dataset"),
        F.col("o_orderdate").alias("fetched_at"),
        F.col("o_orderkey").alias("version"),
    )
    newest = latest_mappings(catalog, ["tenant", "dataset"], "fetched_at", ["version"])
    now = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    return newest.select(
        "tenant",
        "dataset",
        day("fetched_at").alias("fetched_on"),
        "version",
        is_fresh(F.col("fetched_at"), now, 30 * 24 * 3600).alias("fresh"),
    )
