"""Mappings as data, routing and the mapping catalogue."""

import datetime

from pyspark.sql import functions as F

from conftest import rows
from tripleweft import TriplesMap, ref, template, triples_of
from tripleweft.operators.routing import failure_routing, file_filter, route_by_attribute, routed, size_class_route
from tripleweft.operators.rules import (
    apply_rules,
    documents_without_maps,
    is_fresh,
    latest_mappings,
    normalise_short_rules,
    quarantine,
    record_maps,
    rules_from_mapping_triples,
    validate_rules,
)
from tripleweft.operators.setops import graph_diff
from tripleweft.sources.ntriples import parse_ntriples
from tripleweft.vocab import RDF_TYPE, SCHEMA

EX = "http://example.org/"
RR = "http://www.w3.org/ns/r2rml#"
RML = "http://semweb.mmlab.be/ns/rml#"
RULES = (
    "tenant string, triples_map string, source string, formulation string, iterator string, subject_template string, "
    "classes array<string>, predicate string, obj_kind string, obj_value string, datatype string, lang string"
)


def rule(tenant, predicate, kind, value, subject=EX + "{id}", classes=(), datatype=None, lang=None, source="in"):
    return (tenant, "main", source, "CSV", None, subject, list(classes), predicate, kind, value, datatype, lang)


def test_rules_equal_mapping(spark):
    records = spark.createDataFrame([("1", "a", None), ("2", None, "x"), (None, "b", "y")], "id string, name string, city string")
    tm = TriplesMap(
        "in",
        EX + "{id}",
        (EX + "C",),
        (("p:name", ref("name", lang="en")), ("p:city", template(EX + "{city}/{id}")), ("p:n", ref("name", datatype="x:t"))),
    )
    rules = spark.createDataFrame(
        [
            rule("t", "p:name", "reference", "name", classes=[EX + "C"], lang="en"),
            rule("t", "p:city", "template", EX + "{city}/{id}", classes=[EX + "C"]),
            rule("t", "p:n", "reference", "name", classes=[EX + "C"], datatype="x:t", lang="en"),
            rule("other", "p:name", "reference", "name"),
        ],
        RULES,
    )
    maps = record_maps(
        records.withColumn("tenant", F.lit("t")).withColumn("source", F.lit("in")), ["id", "name", "city"], ["tenant", "source"]
    )
    assert graph_diff(triples_of(records, tm), apply_rules(maps, rules), bag=True).isEmpty()
    # Too many rules to broadcast: the same triples by the salted join.
    assert graph_diff(triples_of(records, tm), apply_rules(maps, rules, broadcast_rows=1), bag=True).isEmpty()


def test_rules_from_triples(spark):
    doc = f"""
    <#m> <{RML}logicalSource> _:l .
    _:l <{RML}source> "a.json" .
    <#m> <{RR}subjectMap> _:s .
    _:s <{RR}template> "{EX}{{id}}" .
    <#m> <{RR}predicateObjectMap> _:p .
    _:p <{RR}predicate> <p:lit> .
    _:p <{RR}object> "fixed" .
    <#bare> <{RML}logicalSource> _:l .
    """
    lines = [(t, line.strip()) for t in ("t1", "t2") for line in doc.split("\n")]
    triples = parse_ntriples(spark.createDataFrame(lines, "tenant string, value string"), keep=["tenant"])
    rules = rules_from_mapping_triples(triples)
    got = rows(rules.select("tenant", "triples_map", "source", "formulation", "subject_template", "predicate", "obj_kind", "obj_value"))
    assert got == sorted(
        [
            (t, "#bare", "a.json", "JSONPath", None, None, None, None) for t in ("t1", "t2")
        ]
        + [(t, "#m", "a.json", "JSONPath", EX + "{id}", "p:lit", "constant", "fixed") for t in ("t1", "t2")],
        key=repr,
    )
    good, bad = quarantine(rules)
    assert good.count() == 2
    assert {tuple(r.errors) for r in bad.collect()} == {("missing_subject_template", "missing_predicate", "missing_object")}


def test_short_rules(spark):
    rows_in = spark.createDataFrame(
        [
            ("d", "m", "s", "XPATH", None, "ex:v/$(@name)", p, o, dt, None)
            for p, o, dt in (
                ("a", "ex:Car", None),
                ("schema:name", "$(model)", None),
                ("ex:hp", "$(hp)", "xsd:integer"),
                ("ex:of", "ex:v/$(code)-$(x)", None),
                ("ex:cur", "EUR", None),
                ("ex:const", "ex:kept", None),
            )
        ]
        + [("nopfx", "m", "s", "odd", None, "http://x/$(id)", "p:q", "$(id)", None, None)],
        "tenant string, triples_map string, source string, formulation string, iterator string, s string, p string, o string, datatype string, lang string",
    )
    prefixes = spark.createDataFrame(
        [("d", "ex", EX), ("d", "schema", SCHEMA), ("d", "xsd", "x#"), ("d", "ex", EX)], "tenant string, prefix string, iri string"
    )
    got = normalise_short_rules(rows_in, prefixes)
    assert rows(got.select("formulation", "subject_template", "predicate", "obj_kind", "obj_value", "datatype")) == sorted(
        [
            ("XPath", EX + "v/{@name}", RDF_TYPE, "constant", EX + "Car", None),
            ("XPath", EX + "v/{@name}", SCHEMA + "name", "reference", "model", None),
            ("XPath", EX + "v/{@name}", EX + "hp", "reference", "hp", "x#integer"),
            ("XPath", EX + "v/{@name}", EX + "of", "template", EX + "v/{code}-{x}", None),
            ("XPath", EX + "v/{@name}", EX + "cur", "constant", "EUR", None),
            ("XPath", EX + "v/{@name}", EX + "const", "constant", "ex:kept", None),
            ("odd", "http://x/{id}", "p:q", "reference", "id", None),
        ],
        key=repr,
    )


def test_validation(spark):
    rules = spark.createDataFrame(
        [
            rule("ok", "p:a", "reference", "a"),
            rule("attr", "p:a", "constant", "${tenant.id}"),
            rule("src", "p:a", "reference", "a", source="gone"),
        ],
        RULES,
    )
    sources = spark.createDataFrame([("ok", "in"), ("attr", "in"), ("src", "in")], "tenant string, source string")
    got = {r.tenant: r.errors for r in validate_rules(rules, sources).collect()}
    assert got == {"ok": [], "attr": ["unresolved_attribute"], "src": ["unknown_source"]}
    documents = spark.createDataFrame([("ok",), ("empty",)], "tenant string")
    assert rows(documents_without_maps(documents, rules)) == [("empty",)]


def test_catalog(spark):
    t = lambda day: datetime.datetime(2024, 1, day)
    catalog = spark.createDataFrame(
        [("a", t(1), "v1"), ("a", t(3), "v2"), ("b", t(2), "v1")], "tenant string, at timestamp, doc string"
    )
    newest = latest_mappings(catalog, ["tenant"], "at", ["doc"])
    assert rows(newest.select("tenant", "doc")) == [("a", "v2"), ("b", "v1")]
    now = F.lit(t(3))
    day = 24 * 3600
    fresh = newest.select("tenant", is_fresh(F.col("at"), now, day), is_fresh(F.col("at"), now, day + 1), is_fresh(F.col("at"), now, 0))
    assert rows(fresh) == [("a", True, True, False), ("b", False, True, False)]


def test_routing(spark):
    df = spark.createDataFrame([("x", 4096), ("y", 4097), (None, None)], "k string, size long")
    by_value = route_by_attribute(df, "k", {"first": "x"})
    assert rows(by_value.select("route")) == [("first",), ("unmatched",), ("unmatched",)]
    assert {n: d.count() for n, d in routed(by_value, {"first": "x"}).items()} == {"first": 1, "unmatched": 2}
    two = df.limit(2)
    pick = lambda d: [tuple(r) for r in d.select("route", "reason").collect()]
    assert pick(size_class_route(two, "size", 4096)) == [("small", "AUTO_BELOW_THRESHOLD"), ("large", "AUTO_ABOVE_THRESHOLD")]
    assert pick(size_class_route(two, "size", 4096, large_path=False)) == [("small", "AUTO_BELOW_THRESHOLD"), ("small", "AUTO_FALLBACK")]
    assert pick(size_class_route(two, "size", mode="LARGE")) == [("large", "STRICT"), ("large", "STRICT")]
    names = spark.createDataFrame([("a.csv",), ("a.csv.bak",)], "n string")
    assert rows(file_filter(names, "n", r".*\.csv")) == [("a.csv",)]


def test_failures(spark):
    df = spark.createDataFrame([("f1", 1), ("f1", -1), ("f1", -2), ("f2", 2), (None, 3)], "file string, v int")
    good, failed = failure_routing(df, "file", F.col("v") < 0, F.lit("Negative"), F.col("v").cast("string"))
    assert rows(good) == rows(spark.createDataFrame([("f2", 2), (None, 3)], df.schema))
    assert rows(failed) == [("f1", "Negative", "-1", 2)]
    good, _ = failure_routing(df, "file", F.col("v") < 0, F.lit("Negative"), F.col("v").cast("string"), per_record=True)
    assert good.count() == 3


def test_large_rule_tables_give_the_same(spark, monkeypatch):
    """With nothing small enough to broadcast, the salted look-ups give the same rules."""
    doc = [
        f"<#m> <{RML}logicalSource> _:l .",
        f'_:l <{RML}source> "a.csv" .',
        f"<#m> <{RR}subjectMap> _:s .",
        f'_:s <{RR}template> "{EX}{{id}}" .',
        f"_:s <{RR}class> <{EX}C> .",
        f"<#m> <{RR}predicateObjectMap> _:p .",
        f"_:p <{RR}predicateMap> _:q .",
        f"_:q <{RR}constant> <p:x> .",
        f"_:p <{RR}objectMap> _:o .",
        f'_:o <{RML}reference> "x" .',
    ]
    lines = [(str(t), line) for t in range(5) for line in doc]
    triples = parse_ntriples(spark.createDataFrame(lines, "tenant string, value string"), keep=["tenant"])
    short = spark.createDataFrame(
        [(str(t), "m", "s", "csv", None, "ex:$(id)", "ex:p", "ex:$(a)/b", "ex:t", None) for t in range(5)],
        "tenant string, triples_map string, source string, formulation string, iterator string, s string, p string, o string, datatype string, lang string",
    )
    prefixes = spark.createDataFrame([(str(t), "ex", f"http://{t}/") for t in range(4)], "tenant string, prefix string, iri string")
    before = rows(rules_from_mapping_triples(triples)), rows(normalise_short_rules(short, prefixes))
    assert len(before[0]) == 5 and before[0][0][7:10] == ("p:x", "reference", "x")
    monkeypatch.setattr("tripleweft.plans.joins.fits", lambda *a, **k: False)
    after = rows(rules_from_mapping_triples(triples)), rows(normalise_short_rules(short, prefixes))
    assert before == after
