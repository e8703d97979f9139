"""What a record yields: nulls, empty values, kinds of objects, golden graphs."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tripleweft import Mapping, ObjectMap, TriplesMap, constant, materialise, ref, template, triples_of
from tripleweft.functions.names import expand_curie, format_key, looks_like_iri, output_name, xml_name
from tripleweft.functions.paths import json_steps
from tripleweft.functions.templates import expand, fill_text, fill_then_expand, template_pieces
from tripleweft.functions.text import short_key
from tripleweft.operators.aggregates import run_metrics
from tripleweft.operators.setops import graph_diff
from tripleweft.plans.compile import count_triples, is_set_already, repeated_subjects
from tripleweft.sources.csv import csv_records
from tripleweft.sources.json import json_records
from tripleweft.sources.xml import xml_records
from tripleweft.vocab import RDF_TYPE, SCHEMA, TRIPLES_SCHEMA, XSD

EX = "http://example.org/"


def person_map(formulation):
    return TriplesMap(
        source="people",
        subject=EX + "person/{id}",
        classes=(SCHEMA + "Person",),
        objects=((SCHEMA + "name", ref("name")), (SCHEMA + "email", ref("email"))),
        formulation=formulation,
    )


@pytest.fixture(scope="module")
def golden(spark):
    """Two people, six triples."""
    triples = []
    for key, name, email in (("1", "Zoë Müller", "zoe@example.org"), ("2", "Ивáн", "ivan@example.org")):
        s = EX + "person/" + key
        triples.append((s, RDF_TYPE, SCHEMA + "Person", "iri", None, None))
        triples.append((s, SCHEMA + "name", name, "literal", None, None))
        triples.append((s, SCHEMA + "email", email, "literal", None, None))
    return spark.createDataFrame(triples, TRIPLES_SCHEMA)


def test_json_golden(spark, put, golden):
    path = put(
        "p.json",
        '[{"id": 1, "name": "Zoë Müller", "email": "zoe@example.org", "x": {"y": 1}},\n'
        ' {"id": 2, "name": "Ивáн", "email": "ivan@example.org"}]',
    )
    tm = person_map("json")
    got = triples_of(json_records(spark, path, tm.references(), iterator="$[*]", multi_line=True), tm)
    assert got.count() == 6
    assert graph_diff(golden, got).isEmpty()


@pytest.mark.parametrize("mode", ["exact", "fast"])
def test_csv_golden(spark, put, golden, mode):
    path = put("p.csv", "id,name,email\n1,Zoë Müller,zoe@example.org\n2,Ивáн,ivan@example.org\n")
    tm = person_map("csv")
    got = triples_of(csv_records(spark, path, tm.references(), mode), tm)
    assert got.count() == 6
    assert graph_diff(golden, got).isEmpty()


def test_xml_golden(spark, put, golden):
    path = put(
        "p.xml",
        "<people><person><id>1</id><name>Zoë Müller</name><email>zoe@example.org</email></person>"
        "<person><id>2</id><name>Ивáн</name><email>ivan@example.org</email></person></people>",
    )
    tm = person_map("xml")
    got = triples_of(xml_records(spark, path, "/people/person", tm.references()), tm)
    assert graph_diff(golden, got).isEmpty()


def test_template_null_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("", "x"), ("a b", "c/d")], "p string, q string")
    value = lambda name: F.col(name)
    got = df.select(expand("{p}-{q}!", value), expand("{p}-{q}", value, encode=True), expand("fixed", value))
    assert [tuple(r) for r in got.collect()] == [
        (None, None, "fixed"),
        ("-x!", "-x", "fixed"),
        ("a b-c/d!", "a%20b-c%2Fd", "fixed"),
    ]
    assert template_pieces("x{a}{b}y") == [("text", "x"), ("ref", "a"), ("ref", "b"), ("text", "y")]


def test_object_kinds(spark):
    df = spark.createDataFrame([(1, "v", None)], "id int, a string, b string")
    tm = TriplesMap(
        "t",
        EX + "{id}",
        objects=(
            ("p:ref", ref("a")),
            ("p:none", ref("b")),
            ("p:gone", ref("nowhere")),
            ("p:template", template(EX + "{a}")),
            ("p:null_template", template(EX + "{a}/{b}")),
            ("p:iri", constant("urn:x")),
            ("p:text", constant("ftp://x")),
            ("p:both", ref("a", datatype=XSD + "token", lang="en")),
            ("p:lang", ref("a", lang="en")),
            ("p:empty", ObjectMap()),
        ),
    )
    assert rows(triples_of(df, tm).select("p", "o", "o_kind", "o_datatype", "o_lang")) == sorted(
        [
            ("p:ref", "v", "literal", None, None),
            ("p:template", EX + "v", "iri", None, None),
            ("p:iri", "urn:x", "iri", None, None),
            ("p:text", "ftp://x", "literal", None, None),
            ("p:both", "v", "literal", XSD + "token", None),
            ("p:lang", "v", "literal", None, "en"),
        ],
        key=repr,
    )
    assert count_triples(df, tm).first().triples == 6


def test_no_subject_no_triples(spark):
    df = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, a string")
    tm = TriplesMap("t", EX + "{id}", (EX + "C",), (("p:a", ref("a")),))
    assert triples_of(df, tm).count() == 2
    assert count_triples(df, tm).first().triples == 2


def test_bag_and_set(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b")], "id string, a string")
    tm = TriplesMap("t", EX + "{id}", (EX + "C",), (("p:a", ref("a")), ("p:b", ref("a", lang="en"))))
    mapping = Mapping((tm,))
    assert materialise(mapping, {"t": df}).count() == 9
    distinct = materialise(mapping, {"t": df}, distinct=True)
    assert distinct.count() == 5
    assert graph_diff(triples_of(df, tm), distinct).isEmpty()


def test_only_the_asked_predicates(spark):
    df = spark.createDataFrame([("1", "a", "b")], "id string, a string, b string")
    tm = TriplesMap("t", EX + "{id}", (EX + "C",), (("p:a", ref("a")), ("p:b", ref("b"))))
    other = TriplesMap("u", EX + "{id}", objects=(("p:b", ref("b")),))
    mapping = Mapping((tm, other))
    got = materialise(mapping, {"t": df, "u": df}, predicates=["p:a", RDF_TYPE])
    assert {r.p for r in got.collect()} == {"p:a", RDF_TYPE}
    assert materialise(mapping, {"t": df, "u": df}, distinct=True, predicates=["p:b"]).count() == 1
    with pytest.raises(ValueError):
        triples_of(df, tm, predicates=["p:none"])


def test_declared_keys_avoid_distinct():
    unique = TriplesMap("t", EX + "a/{id}", (EX + "C",), (("p:a", ref("a")),), unique_subject=True)
    other = TriplesMap("u", EX + "b/{id}", objects=(("p:a", ref("a")),), unique_subject=True)
    twice = TriplesMap("u", EX + "c/{id}", objects=(("p:a", ref("a")), ("p:a", ref("b"))), unique_subject=True)
    shared = TriplesMap("u", EX + "a/{id}", objects=(("p:a", ref("a")),), unique_subject=True)
    assert is_set_already([unique, other])
    assert not is_set_already([twice])
    assert not is_set_already([unique, shared])


def test_attributes(spark):
    df = spark.createDataFrame([("7", {"tenant.id": "acme"}), ("8", {})], "id string, attrs map<string,string>")
    value, attrs = (lambda n: F.col(n)), F.col("attrs")
    got = df.select(
        fill_then_expand("http://${tenant.id}/{id}", attrs, value),
        fill_then_expand("${tenant.id:-none}/{id}", attrs, value),
        fill_then_expand("x${tenant.id}", attrs, value, missing="empty"),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("http://acme/7", "acme/7", "xacme"),
        (None, "none/8", "x"),
    ]


def test_names(spark):
    df = spark.createDataFrame(
        [("ex:a:b",), ("no:x",), (":x",), ("plain",)], "c string"
    ).withColumn("m", F.create_map(F.lit("ex"), F.lit(EX)))
    assert [r[0] for r in df.select(expand_curie(F.col("c"), F.col("m"))).collect()] == [EX + "a:b", "no:x", ":x", "plain"]
    one = spark.range(1)
    local = xml_name(F.lit("http://a/b#c"))
    got = one.select(
        *local,
        *xml_name(F.lit("http://a/b")),
        format_key(F.lit("rdf/xml ")),
        output_name(F.lit("a.b.csv"), F.lit("turtle")),
        output_name(F.lit("noext"), F.lit("N-Triples")),
        looks_like_iri(F.lit("https://x")),
        looks_like_iri(F.lit("mailto:x")),
        short_key(F.lit("abc")),
    ).first()
    assert tuple(got) == (
        "http://a/b#", "c", "http://a/", "b", "RDFXML", "a.b.ttl", "noext.nt", True, False, "ba7816bf8f01cfea",
    )


def test_json_steps():
    assert json_steps("$.a[0]['b.c'][*].d") == ["a", 0, "b.c", "*", "d"]
    assert json_steps("a.b") == ["a", "b"]
    with pytest.raises(ValueError):
        json_steps("$.a[?(@.x)]")


def test_attributes_in_a_mapping(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string").withColumn("attrs", F.create_map(F.lit("t"), F.lit("acme")))
    tm = TriplesMap(
        "d",
        "http://${t}.example.org/{id}",
        objects=(("p:v", ref("v")), ("p:t", constant("${t}")), ("p:l", template("http://${host:-h}/{v}")), ("p:gone", constant("a ${none}"))),
    )
    got = rows(triples_of(df, tm, attrs="attrs").select("s", "p", "o", "o_kind"))
    assert got == [
        ("http://acme.example.org/1", "p:l", "http://h/x", "iri"),
        ("http://acme.example.org/1", "p:t", "acme", "literal"),
        ("http://acme.example.org/1", "p:v", "x", "literal"),
        ("http://acme.example.org/2", "p:t", "acme", "literal"),
    ]
    with pytest.raises(ValueError, match="no attributes"):
        triples_of(df, tm)
    assert fill_text("/${a}/x[@k='${b:-c}']", {"a": "r"}) == "/r/x[@k='c']"
    with pytest.raises(ValueError):
        fill_text("${a}", {})


def test_inputs_without_triples_have_metrics(spark):
    df = spark.createDataFrame([("f1", 5, "1"), ("f2", 7, None)], "file_name string, file_size long, id string")
    tm = TriplesMap("d", "s:{id}", ("c:C",))
    assert rows(run_metrics(df, tm).select("file_name", "input_bytes", "triples")) == [("f1", 5, 1), ("f2", 7, 0)]


def test_declared_keys_can_be_checked(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d"), (None, "e")], "id string, v string")
    tm = TriplesMap("d", "s:{id}", objects=(("p:v", ref("v")),), unique_subject=True)
    assert rows(repeated_subjects(df, tm)) == [("s:2", 2)]
    assert rows(repeated_subjects(df.where("v <> 'c'"), tm)) == []
