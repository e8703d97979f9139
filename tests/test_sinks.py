"""Round trips through every format, and bounded blocks for large subjects."""

import glob
import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from tripleweft import TriplesMap, constant, ref, template, triples_of
from tripleweft.operators.setops import graph_diff, graph_distinct
from tripleweft.plans.fused import jsonld_text, ntriples_text, turtle_text
from tripleweft.sinks.files import convert_ntriples, write_ntriples_partitioned, write_partitioned, write_rdf, write_text
from tripleweft.sinks import subjects
from tripleweft.sinks.jsonld import jsonld_nodes, jsonld_scan, parse_jsonld, write_jsonld
from tripleweft.sinks.ntriples import write_ntriples
from tripleweft.sinks.rdfxml import rdfxml_lines, write_rdfxml
from tripleweft.sinks.turtle import predicate_object, turtle_lines
from tripleweft.sources.ntriples import ntriples_scan, parse_ntriples
from tripleweft.vocab import RDF, RDF_TYPE, SCHEMA, TRIPLES_SCHEMA, XSD

EX = "http://example.org/"
NASTY = 'Zoë "q" \\n \\\\ back\\slash\nline\r\ttab <&> \u0001 > <x> .'


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, NASTY, "a@b", None), (2, None, "c", 5), (2, None, "c", 5), (3, "x", None, 0)],
        "id long, name string, email string, n int",
    )


def person_map(unique=False):
    return TriplesMap(
        "people",
        EX + "person/{id}",
        (SCHEMA + "Person", EX + "Thing"),
        (
            (SCHEMA + "name", ref("name", lang="fr")),
            (SCHEMA + "email", ref("email")),
            (EX + "n", ref("n", datatype=XSD + "integer")),
            (EX + "link", template(EX + "n/{n}")),
            (EX + "const", constant("urn:x")),
            (EX + "const", constant('q"x')),
        ),
        unique_subject=unique,
    )


def test_ntriples_round_trip(spark, people, tmp_path):
    triples = triples_of(people, person_map())
    write_ntriples(triples, str(tmp_path / "nt"))
    assert graph_diff(triples, ntriples_scan(spark, str(tmp_path / "nt")), bag=True).isEmpty()


def test_fused_ntriples_equal_triples(spark, people, tmp_path):
    write_text(ntriples_text(people, person_map()), str(tmp_path / "nt"))
    got = ntriples_scan(spark, str(tmp_path / "nt"))
    assert graph_diff(triples_of(people, person_map()), got, bag=True).isEmpty()


def test_fused_without_fixed_terms(spark):
    df = spark.createDataFrame([("1", "a"), ("2", None), (None, "b")], "id string, a string")
    tm = TriplesMap("t", EX + "{id}", objects=(("p:a", ref("a")),))
    assert rows(ntriples_text(df, tm)) == [(f'<{EX}1> <p:a> "a" .',)]
    assert rows(turtle_text(df, tm)) == [(f'<{EX}1>\n    <p:a> "a" .\n',)]
    unique = TriplesMap("t", EX + "{id}", objects=(("p:a", ref("a")),), unique_subject=True)
    assert rows(jsonld_text(df, unique)) == [('{"@id":"' + EX + '1","p:a":[{"@value":"a"}]}',)]


def _turtle_as_triples(spark, texts):
    """Triples of our own Turtle blocks: every predicate-object line with its subject."""
    lines = []
    for text in texts:
        head, *body = text.rstrip("\n").split("\n    ")
        for item in body:
            item = item.removesuffix(" ;").removesuffix(" .")
            if item.startswith("a "):
                item = f"<{RDF_TYPE}> " + item[2:]
            lines.append((f"{head} {item} .",))
    return parse_ntriples(spark.createDataFrame(lines, "value string"))


def _turtle_lines_as_triples(lines):
    """Triples of rows (s, value) of Turtle lines."""
    pair = predicate_object(F.col("value"))
    verb = F.regexp_replace(pair, "^a ", f"<{RDF_TYPE}> ")
    head = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), "s", F.lit(">")))
    return parse_ntriples(lines.select(F.concat_ws(" ", head, verb, F.lit(".")).alias("value")))


def test_turtle_holds_the_same_triples(spark, people, tmp_path):
    triples = triples_of(people, person_map())
    texts = [r.value for r in turtle_text(people, person_map()).select("value").collect()]
    assert graph_diff(triples, _turtle_as_triples(spark, texts), bag=True).isEmpty()
    assert graph_diff(triples, _turtle_lines_as_triples(turtle_lines(triples)), bag=True).isEmpty()
    once = _turtle_lines_as_triples(turtle_lines(triples, distinct=True))
    assert graph_diff(graph_distinct(triples), once, bag=True).isEmpty()
    # The lines of a file, in their order, are blocks: a subject, then lines that end in ';', the last in '.'.
    write_rdf(triples.coalesce(1), str(tmp_path / "ttl"), "turtle")
    blocks = []
    for part in glob.glob(str(tmp_path / "ttl" / "part-*")):
        with open(part, encoding="utf-8") as f:
            blocks += [b for b in f.read().split("\n\n") if b]
    assert graph_diff(triples, _turtle_as_triples(spark, blocks), bag=True).isEmpty()


def test_jsonld_round_trip(people):
    triples = triples_of(people, person_map())
    nodes = jsonld_nodes(triples)
    for row in nodes.collect():
        assert json.loads(row.value)["@id"] == row.s
    assert graph_diff(graph_distinct(triples), parse_jsonld(nodes), bag=True).isEmpty()


def test_jsonld_documents(spark, people, tmp_path):
    triples = triples_of(people, person_map())
    write_jsonld(triples.repartition(3), str(tmp_path / "docs"), documents=True)
    ids = []
    for part in glob.glob(str(tmp_path / "docs" / "part-*")):
        with open(part, encoding="utf-8") as f:
            ids += [node["@id"] for node in json.load(f)["@graph"]]
    assert sorted(ids) == [EX + "person/1", EX + "person/2", EX + "person/3"]
    assert graph_diff(graph_distinct(triples), jsonld_scan(spark, str(tmp_path / "docs")), bag=True).isEmpty()


def test_fused_jsonld(people):
    unique = people.dropDuplicates(["id"])
    nodes = jsonld_text(unique, person_map(unique=True))
    assert graph_diff(triples_of(unique, person_map()), parse_jsonld(nodes), bag=True).isEmpty()
    with pytest.raises(ValueError):
        jsonld_text(people, person_map())


def _rdfxml_triples(folder):
    found = []
    for part in glob.glob(f"{folder}/part-*"):
        with open(part, encoding="utf-8", newline="") as f:
            root = ET.fromstring(f.read())
        for node in root:
            label = node.get("{%s}nodeID" % RDF)
            s = "_:" + label if label else node.get("{%s}about" % RDF)
            for element in node:
                p = element.tag[1:].replace("}", "")
                target, inner = element.get("{%s}resource" % RDF), element.get("{%s}nodeID" % RDF)
                lang = element.get("{http://www.w3.org/XML/1998/namespace}lang")
                kind = "iri" if target else "bnode" if inner else "literal"
                o = target or ("_:" + inner if inner else element.text or "")
                found.append((s, p, o, kind, element.get("{%s}datatype" % RDF), lang))
    return found


def test_rdfxml_files_are_documents(people, tmp_path):
    triples = triples_of(people, person_map())
    with pytest.raises(Exception, match="cannot hold"):
        write_rdf(triples, str(tmp_path / "raw"), "rdf/xml")
    write_rdf(triples, str(tmp_path / "rdf"), "rdf/xml", forbidden="replace")
    want = {tuple(r) for r in triples.withColumn("o", F.replace("o", F.lit("\u0001"), F.lit("\ufffd"))).collect()}
    found = _rdfxml_triples(tmp_path / "rdf")
    assert set(found) == want and len(found) == len(want)


def test_rdfxml_names(spark, tmp_path):
    rows = [("s:a", p, "1", "literal", None, None) for p in ("http://e/1a", "http://e/x#b.c-1", "urn:x:y", "http://e/Ünï")]
    triples = spark.createDataFrame(rows, TRIPLES_SCHEMA)
    write_rdfxml(triples, str(tmp_path / "ok"))
    assert {t[1] for t in _rdfxml_triples(tmp_path / "ok")} == {r[1] for r in rows}
    for bad in ("http://e/", "http://e/12"):
        with pytest.raises(Exception, match="no XML name"):
            rdfxml_lines(triples.withColumn("p", F.lit(bad))).collect()


BLANK_TRIPLES = [
    ("_:a", "http://e/knows", "_:b", "bnode", None, None),
    ("_:b", "http://e/name", "_:not a node", "literal", None, None),
    ("http://e/x", "http://e/knows", "_:a", "bnode", None, None),
    ("http://e/x", RDF_TYPE, "http://e/T", "iri", None, None),
]


def test_blank_nodes_through_every_format(spark, tmp_path):
    triples = spark.createDataFrame(BLANK_TRIPLES, TRIPLES_SCHEMA)
    source = str(tmp_path / "nt")
    write_ntriples(triples, source)
    assert rows(ntriples_scan(spark, source)) == rows(triples)
    convert_ntriples(spark, source, str(tmp_path / "jsonld"), "JSON-LD")
    assert rows(jsonld_scan(spark, str(tmp_path / "jsonld"))) == rows(triples)
    convert_ntriples(spark, source, str(tmp_path / "rdf"), "RDF/XML")
    assert sorted(_rdfxml_triples(tmp_path / "rdf"), key=repr) == rows(triples)
    assert rows(_turtle_lines_as_triples(turtle_lines(triples))) == rows(triples)
    by_file = ntriples_scan(spark, source, blank_nodes="file")
    assert by_file.where("o_kind = 'bnode' AND o LIKE '_:_-%'").count() == 2


def test_jsonld_scan_takes_white_space_and_refuses_other_lines(spark, put):
    node = '{"@id":"s:a","p:x":[{"@value":"1"}]}'
    path = put("j/a.jsonld", '{"@graph":[\n' + node + "\n ,{ " + node[1:].replace("s:a", "s:b") + "\n]}\n")
    assert rows(jsonld_scan(spark, path).select("s")) == [("s:a",), ("s:b",)]
    with pytest.raises(Exception, match="not a JSON-LD node"):
        jsonld_scan(spark, put("k/a.jsonld", node + "\nsomething else\n")).collect()


@pytest.mark.parametrize("output_format", ["ntriples", "Turtle", "json-ld", "RDF/XML"])
def test_convert(spark, people, tmp_path, output_format):
    write_ntriples(triples_of(people, person_map()), str(tmp_path / "in"))
    if output_format == "RDF/XML":
        people = people.withColumn("name", F.replace("name", F.lit("\u0001"), F.lit("")))
        write_ntriples(triples_of(people, person_map()), str(tmp_path / "in"))
    convert_ntriples(spark, str(tmp_path / "in"), str(tmp_path / "out"), output_format)
    # JSON-LD has a line per subject, of which there are three; the others have more.
    assert spark.read.text(str(tmp_path / "out")).count() >= 3
    with pytest.raises(ValueError):
        write_rdf(triples_of(people, person_map()), str(tmp_path / "x"), "n3")


def test_large_subject_streams(spark, tmp_path):
    """A million triples on one subject in one partition: all are written, and each once."""
    n = 1_000_000
    triples = spark.range(n + 5).select(
        F.when(F.col("id") < n, F.lit("s:hot")).otherwise(F.concat(F.lit("s:"), F.col("id").cast("string"))).alias("s"),
        F.lit("p:x").alias("p"),
        F.col("id").cast("string").alias("o"),
        F.lit("literal").alias("o_kind"),
        F.lit(None).cast("string").alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"),
    )
    nodes = jsonld_nodes(triples.unionByName(triples.limit(1000)))
    assert nodes.agg(F.max(F.length("value"))).first()[0] < 3_000_000
    back = parse_jsonld(nodes)
    assert (back.count(), back.distinct().count()) == (n + 5, n + 5)
    lines = turtle_lines(triples)
    assert lines.count() == n + 5
    opened = lines.where(F.col("value").startswith("<")).count()
    assert opened == lines.where(F.col("value").endswith(" .\n")).count() < 50


def test_folders_have_few_files(spark, tmp_path):
    """Sixteen tasks and fifty folders do not make 800 files."""
    df = spark.range(0, 5000, 1, 16).select("id", F.pmod("id", F.lit(50)).alias("k"))
    write_partitioned(df, str(tmp_path / "p"), ["k"])
    files = glob.glob(str(tmp_path / "p" / "k=*" / "part-*"))
    assert len(files) <= 100 and spark.read.parquet(str(tmp_path / "p")).count() == 5000


def test_partitioned_sinks(spark, people, tmp_path):
    triples = triples_of(people.withColumn("tenant", F.concat(F.lit("t"), F.col("id"))), person_map(), keep=("tenant",))
    write_ntriples_partitioned(triples, str(tmp_path / "nt"), ["tenant"])
    got = parse_ntriples(spark.read.text(str(tmp_path / "nt")), keep=["tenant"])
    assert rows(got.groupBy("tenant").count()) == rows(triples.groupBy("tenant").count())
    write_partitioned(triples, str(tmp_path / "pq"), ["tenant"])
    write_partitioned(triples.filter("tenant = 't1'").limit(1), str(tmp_path / "pq"), ["tenant"])
    counts = {r.tenant: r["count"] for r in spark.read.parquet(str(tmp_path / "pq")).groupBy("tenant").count().collect()}
    assert counts["t1"] == 1 and counts["t3"] == triples.filter("tenant = 't3'").count()


def test_sorted_rows_are_taken_by_bytes():
    import pyarrow as pa

    from tripleweft.sinks.subjects import BATCH_BYTES, subject_runs

    texts = [f"{k}" + "x" * 200_000 for k in range(100)]
    batch = pa.RecordBatch.from_pydict({"s": [f"{k:03}" for k in range(100)], "head": [""] * 100, "key": [""] * 100, "text": texts})
    runs = list(subject_runs([batch], False))
    assert [t for rows, *_ in runs for t in rows.column("text").to_pylist()] == texts
    assert max(rows.column("text").combine_chunks().nbytes for rows, *_ in runs) <= BATCH_BYTES + 400_000
    assert all(o.all() and e.all() for _, o, _, e in runs)


def test_jsonld_files_are_read_once(spark, put):
    """Types and values come from one reading, also of nodes that hold numbers, or values that are no array."""
    node = '{"@id":"s:a","@type":["t:A","t:B"],"p:n":[{"@value":1.50},{"@value":true},{"@id":"_:b"}],"@context":{"a":"b"}'
    path = put("j/a.jsonld", node + ',"p:x":[{"@value":"\\u00e9","@language":"fr"}]}\n' + node.replace("s:a", "s:c") + ',"p:t":"x"}\n')
    found = jsonld_scan(spark, path)
    assert plan_of(found).count("Scan text") == 1
    both = [(RDF_TYPE, "t:A", "iri"), (RDF_TYPE, "t:B", "iri"), ("p:n", "1.5", "literal"), ("p:n", "true", "literal"), ("p:n", "_:b", "bnode")]
    want = [(s, p, o, kind, None, None) for s in ("s:a", "s:c") for p, o, kind in both]
    assert rows(found) == sorted([*want, ("s:a", "p:x", "é", "literal", None, "fr")], key=repr)


def test_json_text_is_the_same_in_arrow(spark):
    import pyarrow as pa

    from tripleweft.sinks.jsonld import _quoted, json_string

    texts = [NASTY, "plain", "", "Zoë \u2028", "\\u001f", *map(chr, range(1, 128))]
    want = [r.t for r in spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").orderBy("n").select(json_string(F.col("t")).alias("t")).collect()]
    assert _quoted(pa.array(texts)).to_pylist() == want


def test_a_conversion_deals_triples_out_without_ranges(spark, monkeypatch):
    """With a sample triples are not evaluated once more; a hot subject is many tasks' all the same, others are one's."""
    monkeypatch.setattr(subjects, "SUBJECT_ROWS", 100)
    monkeypatch.setattr(subjects, "SAMPLE", 1.0)
    data = [("s:hot", "p:x", str(n), "literal", None, None) for n in range(1000)] + [(f"s:{n % 50}", "p:x", str(n % 80), "literal", None, None) for n in range(900)]
    triples = spark.createDataFrame(data * 2, TRIPLES_SCHEMA).repartition(5)
    nodes = jsonld_nodes(triples, triples)
    assert "rangepartitioning" not in plan_of(nodes)
    assert rows(parse_jsonld(nodes)) == rows(graph_distinct(triples))
    assert rows(_turtle_lines_as_triples(turtle_lines(triples, True, triples))) == rows(graph_distinct(triples))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = subjects.by_subject(triples, triples).select("s", F.spark_partition_id().alias("task"))
        tasks = placed.groupBy("s").agg(F.countDistinct("task").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all((r.n > 1) == (r.s == "s:hot") for r in tasks)


def test_text_is_made_behind_the_shuffle(people):
    """Ranges are chosen by a reading of their own, which should not make text."""
    plan = plan_of(turtle_lines(triples_of(people, person_map())).select("s"))
    below = plan[plan.index("rangepartitioning") :]
    assert "replace(" not in below and "head" not in below


def test_predicate_object_of_any_text(spark):
    """Also where a literal holds a line end that is none in Turtle, or a subject a blank."""
    triples = spark.createDataFrame([("s:a b", "p:x", "one\u2028two\u0085", "literal", None, None), ("s:a b", "p:y", " ;", "literal", None, None)], TRIPLES_SCHEMA)
    got = turtle_lines(triples).select("s", predicate_object(F.col("value")))
    assert rows(got) == [("s:a b", '<p:x> "one\u2028two\u0085"'), ("s:a b", '<p:y> " ;"')]
