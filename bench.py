"""Headline timings: files to RDF files, and the shuffling operators.

Prints one JSON line. Inputs in file formats are written before the clock
starts, as the tables come only as parquet; each timed run reads its input
files and writes its output files in full. `BENCH_SF_DIR` and `BENCH_CPUS`
choose data and cores.
"""

import glob
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from tripleweft.mapping import Mapping, TriplesMap, ref, template
from tripleweft.operators.rules import apply_rules, record_maps
from tripleweft.plans.compile import count_triples, materialise, triples_of
from tripleweft.plans.fused import jsonld_text, ntriples_text, turtle_text
from tripleweft.queries import all_queries
from tripleweft.queries.common import DECIMAL, EX, INTEGER, day, lineitem_map, money, table
from tripleweft.queries.rules import nation_rules
from tripleweft.session import get_session
from tripleweft.sinks.files import convert_ntriples, write_text
from tripleweft.sinks.jsonld import write_jsonld
from tripleweft.sinks.ntriples import write_ntriples
from tripleweft.sources.csv import csv_records
from tripleweft.sources.json import json_records
from tripleweft.sources.tables import parquet_table
from tripleweft.sources.xml import xml_records
from tripleweft.vocab import SCHEMA

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def record_map(formulation, key):
    """Five triples per record, as the published cases have."""
    return TriplesMap(
        source="items",
        subject=EX + "item/{" + key + "}",
        classes=(SCHEMA + "Thing",),
        objects=(
            (SCHEMA + "identifier", ref(key)),
            (SCHEMA + "name", ref("flag")),
            (SCHEMA + "email", ref("mail")),
            (EX + "loyalty", ref("size", datatype=INTEGER)),
        ),
        formulation=formulation,
        unique_subject=True,
    )


def invoice_map():
    return TriplesMap(
        source="invoices",
        subject=EX + "invoice/{@id}",
        classes=(SCHEMA + "Invoice",),
        objects=(
            (SCHEMA + "identifier", ref("@id")),
            (SCHEMA + "customer", template(EX + "customer/{customer/id}")),
            (SCHEMA + "price", ref("amount", datatype=DECIMAL)),
            (SCHEMA + "paymentDueDate", ref("issued")),
        ),
        formulation="xml",
        unique_subject=True,
    )


def one_array(folder, target):
    """The lines of JSON files as one file that holds an array."""
    with open(target, "w", encoding="utf-8") as out:
        start = "["
        for part in sorted(glob.glob(f"{folder}/part-*")):
            with open(part, encoding="utf-8") as lines:
                for line in lines:
                    out.write(start + line.rstrip("\n"))
                    start = ",\n"
        out.write("]\n")


def prepare(spark, base):
    """Line items and orders in file formats; ids are made unique by row number."""
    items = table(spark, SF_DIR, "lineitem").select(
        F.monotonically_increasing_id().alias("id"),
        F.concat(F.lit("Item "), "l_returnflag", F.col("l_orderkey").cast("string")).alias("flag"),
        F.concat(F.lit("u"), F.col("l_partkey").cast("string"), F.lit("@example.org")).alias("mail"),
        F.col("l_quantity").cast("int").alias("size"),
    )
    items = items.repartition(int(CPUS))
    items.write.option("header", True).csv(f"{base}/csv")
    items.write.json(f"{base}/json")
    one_array(f"{base}/json", f"{base}/array.json")
    orders = table(spark, SF_DIR, "orders").select(
        F.col("o_orderkey").alias("_id"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.struct(money("o_totalprice").cast("string").alias("_VALUE"), F.lit("EUR").alias("_currency")).alias("amount"),
        day("o_orderdate").alias("issued"),
    )
    orders = orders.repartition(int(CPUS))
    orders.write.format("xml").option("rootTag", "invoices").option("rowTag", "invoice").save(f"{base}/xml")
    write_ntriples(triples_of(csv_records(spark, f"{base}/csv"), record_map("csv", "id")), f"{base}/nt")
    return {"items": items.count(), "orders": orders.count()}


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def cases(spark, base, counts):
    """Name to (job, number of triples)."""
    items, orders = counts["items"] * 5, counts["orders"] * 5
    csv_map, json_map, xml_map = record_map("csv", "id"), record_map("json", "id"), invoice_map()

    def csv_in(mode):
        return csv_records(spark, f"{base}/csv", csv_map.references(), mode)

    def json_in():
        return json_records(spark, f"{base}/json", json_map.references())

    def array_in():
        return json_records(spark, f"{base}/array.json", json_map.references(), multi_line=True)

    def out(name):
        return f"{base}/out/{name}"

    def rules_job():
        customer = table(spark, SF_DIR, "customer").withColumn("tenant", F.col("c_nationkey").cast("string"))
        records = record_maps(
            customer.withColumn("source", F.lit("customer")),
            ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"],
            ["tenant", "source"],
        )
        write_ntriples(apply_rules(records, nation_rules(spark, SF_DIR)), out("rules"))

    def lineitem():
        # The file is a single row group.
        return parquet_table(spark, f"{SF_DIR}/lineitem.parquet", spread=int(CPUS))

    def xml_in():
        return xml_records(spark, f"{base}/xml", "/invoices/invoice", xml_map.references())

    jobs = {
        "csv_to_turtle": (lambda: write_text(turtle_text(csv_in("exact"), csv_map), out("csv_ttl")), items),
        "csv_fast_to_turtle": (lambda: write_text(turtle_text(csv_in("fast"), csv_map), out("csvf_ttl")), items),
        "csv_to_jsonld": (lambda: write_text(jsonld_text(csv_in("exact"), csv_map), out("csv_jsonld")), items),
        # Without declared keys the triples are sorted into a set.
        "csv_to_jsonld_undeclared": (lambda: write_jsonld(triples_of(csv_in("exact"), csv_map), out("csv_jsonld_set")), items),
        "json_array_to_turtle": (lambda: write_text(turtle_text(array_in(), json_map), out("array_ttl")), items),
        "json_to_turtle": (lambda: write_text(turtle_text(json_in(), json_map), out("json_ttl")), items),
        "json_to_jsonld": (lambda: write_text(jsonld_text(json_in(), json_map), out("json_jsonld")), items),
        "json_to_ntriples": (lambda: write_text(ntriples_text(json_in(), json_map), out("json_nt")), items),
        "xml_to_turtle": (lambda: write_text(turtle_text(xml_in(), xml_map), out("xml_ttl")), orders),
        "tenant_rules_to_ntriples": (rules_job, None),
        "ntriples_to_jsonld": (lambda: convert_ntriples(spark, f"{base}/nt", out("nt_jsonld"), "JSON-LD"), items),
        "ntriples_to_turtle": (lambda: convert_ntriples(spark, f"{base}/nt", out("nt_ttl"), "Turtle"), items),
        "table_fanout": (lambda: noop(triples_of(lineitem(), lineitem_map())), items),
        "count_inline": (lambda: noop(count_triples(lineitem(), lineitem_map())), items),
        "distinct_graph": (
            lambda: noop(materialise(Mapping((lineitem_map(),)), {"lineitem": lineitem()}, distinct=True)),
            items,
        ),
    }
    for name in ("bgp_query", "graph_diff", "coreference_merge", "merge_bins", "failure_routing", "dangling_links"):
        jobs[name] = (lambda name=name: noop(all_queries()[name](spark, SF_DIR)), None)
    return jobs


def main():
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="run-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="run-")
    counts = prepare(spark, base)
    times, rates = {}, {}
    for name, (job, triples) in cases(spark, base, counts).items():
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            job()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        if triples:
            rates[name] = round(triples / min(runs))
    line = {
        "metric": "mapping and graph jobs, best of runs, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "triples_per_second": rates,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
