"""Edge cases of the readers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tripleweft.functions.paths import resolver
from tripleweft.sources.csv import csv_records
from tripleweft.sources.deep_json import iterate_deep
from tripleweft.sources.json import iterate_variant, json_records, parse_text, variant_documents
from tripleweft.sources.ntriples import ntriples_scan, parse_ntriples
from tripleweft.sources.splits import JsonPieces, XmlPieces, record_texts
from tripleweft.sources.synthetic import generate_ids, rate_ids, synthetic_customers, synthetic_invoices
from tripleweft.sources.tables import parquet_table
from tripleweft.sources.xml import xml_records


def test_csv_exact_cells(spark, put):
    path = put(
        "a.csv",
        'id,name,x\n1,"A, ""q""",\n2,ab"c"d,"open, z\n\n3,"a"b,""\n4\n5,é,7,8\n6,"""a""b",z\n7,"",""""\n8, " q" ,"x" \n9,"a""\n10,"a"b"c,d\n',
    )
    got = [tuple(r) for r in csv_records(spark, path).collect()]
    assert got == [
        ("1", 'A, "q"', ""),
        ("2", 'ab"c"d', "open, z"),
        ("3", "ab", ""),
        ("4", None, None),
        ("5", "é", "7"),
        ("6", '"a"b', "z"),
        ("7", "", '"'),
        ("8", ' " q" ', "x "),
        ("9", 'a"', None),
        ("10", 'ab"c', "d"),
    ]


def test_csv_fast_fills_missing(spark, put):
    path = put("a.csv", "id,name\n1,\n2\n")
    assert rows(csv_records(spark, path, mode="fast")) == [("1", ""), ("2", "")]
    assert rows(csv_records(spark, path, mode="fast", empty_cells="null")) == [("1", None), ("2", None)]


@pytest.mark.parametrize("mode", ["exact", "fast"])
def test_csv_last_of_repeated_names(spark, put, mode):
    path = put("a.csv", "id,v,v\n1,a,b\n")
    assert rows(csv_records(spark, path, ["v", "id", "none"], mode)) == [("b", "1")]


def test_csv_empty_file(spark, put):
    with pytest.raises(ValueError):
        csv_records(spark, put("a.csv", ""))


def test_csv_header_per_file(spark, put, tmp_path):
    put("d/1.csv", "id,v\n1,a\n")
    put("d/2.csv", "id,v\n2,b\nid,v\n")
    assert rows(csv_records(spark, str(tmp_path / "d"))) == [("1", "a"), ("2", "b"), ("id", "v")]


@pytest.mark.parametrize("mode", ["exact", "fast"])
def test_csv_other_header_fails(spark, put, tmp_path, mode):
    put("d/1.csv", "id,v\n1,a\n")
    put("d/2.csv", "v,id\nb,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_records(spark, str(tmp_path / "d"), mode=mode).collect()


def test_json_values_as_text(spark, put):
    path = put(
        "a.json",
        '{"i":1,"s":"1.50","f":1.50,"e":1e3,"w":1.0,"b":true,"n":null,"o":{"a":[1,{"c":"d"}]},"k.x":5,"d":"2020-01-01"}',
    )
    references = ["i", "s", "f", "e", "w", "b", "n", "o", "o.a[1].c", "$['k.x']", "d", "none", "o.none"]
    records = json_records(spark, path, references)
    value = resolver(records, "json")
    got = records.select(*[value(r).alias(str(i)) for i, r in enumerate(references)]).first()
    assert list(got) == ["1", "1.50", "1.5", "1000.0", "1.0", "true", None, '{"a":[1,{"c":"d"}]}', "d", "5", "2020-01-01", None, None]


def test_json_roots(spark, put):
    array = put("a.json", '[{"id":1},{"id":2}]')
    single = put("b.json", '{"id":3}')
    for path, want in ((array, ["1", "2"]), (single, ["3"])):
        for iterator in (None, "$", "$[*]"):
            records = json_records(spark, path, ["id"], iterator, multi_line=True)
            assert [r[0] for r in records.select(resolver(records, "json")("id")).collect()] == want


def test_json_malformed_fails(spark, put):
    with pytest.raises(Exception, match="(?i)malformed"):
        json_records(spark, put("a.json", '{"id": 1'), ["id"]).collect()


@pytest.mark.parametrize(
    ("iterator", "want"),
    [
        ("$.data.items[*].tags[*]", ["a", "b", "c"]),
        ("$.data.items", [None, None]),
        ("$.data.one", ["z"]),
        ("$.data.none", []),
        ("$.data.items[*].tags", [None, None]),
    ],
)
def test_variant_iterators(spark, put, iterator, want):
    path = put("a.json", '{"data":{"items":[{"tags":[{"t":"a"},{"t":"b"}]},{"tags":[{"t":"c"}]}],"one":{"t":"z"}}}')
    records = iterate_variant(variant_documents(spark, path), iterator)
    assert [r[0] for r in records.select(resolver(records, "json")("t")).collect()] == want


DEEP = (
    '{"a":{"k":1,"b":[{"k":"1","n":"x"},{"k":2.5,"c":{"k":null,"k2":[{"k":true}]}},[{"k":[{"k":7}]}]]},"k":"top",'
    '"list":[{"k":1,"t":"u"},{"k":3,"t":"v"},{"t":"w"},{"k":"3"},5,null]}'
)


@pytest.mark.parametrize(
    ("iterator", "want"),
    [
        ("$..k", ['"1"', '"top"', '"3"', "1", "1", "2.5", "3", "7", "true", '[{"k":7}]']),
        ("$.a..k", ['"1"', "1", "2.5", "7", "true", '[{"k":7}]']),
        ("$.list[?(@.k)].t", ['"u"', '"v"']),
        ("$.list[?(@.k >= 1)].k", ["1", "3"]),
        ("$.list[?(@.k == 3 || @.t=='w')].t", ['"v"', '"w"']),
        ("$.list[?(@.k == '3')].k", ['"3"']),
        ("$.list[?(@.k != 3)].k", ['"3"', "1"]),
        ("$.list[?(@.k > 0 && @.t == \"u\")].t", ['"u"']),
        ("$..k2[*].k", ["true"]),
        ("$..b[?(@.c.k2[0].k == true)].k", ["2.5"]),
        ("$..c[?(@.k)]", []),
        ("$..b[2][0].k[0]", ['{"k":7}']),
        ("$..none", []),
        ("$.list[*].k", ['"3"', "1", "3"]),
        ("$.a.k", ["1"]),
    ],
)
def test_deep_iterators(spark, put, iterator, want):
    documents = variant_documents(spark, put("a.json", DEEP)).withColumn("file", F.lit("f"))
    records = iterate_deep(documents, iterator)
    assert sorted(r[0] for r in records.select(F.to_json("record")).collect()) == sorted(want)
    assert records.columns == ["file", "record"]


@pytest.mark.parametrize("iterator", ["$..*", "$.a[0:2]", "$.a[?(@.k =~ 'x')]", "$.a[?(length(@) > 1)]", "$.a[?(@.k > true)]", "$.a[?((@.k))]", "$.a[-1]"])
def test_other_deep_iterators_fail(spark, put, iterator):
    with pytest.raises(ValueError, match="unsupported JSON"):
        iterate_deep(variant_documents(spark, put("a.json", DEEP)), iterator)


def test_typed_iterator(spark, put):
    path = put("a.json", '{"data":{"items":[{"id":1,"c":{"n":"x"}},{"id":2}]}}\n{"data":{"items":[]}}\n')
    records = json_records(spark, path, ["id", "c.n"], "$.data.items[*]")
    value = resolver(records, "json")
    assert rows(records.select(value("id"), value("c.n"))) == [("1", "x"), ("2", None)]


def test_json_text_column(spark):
    df = spark.createDataFrame([(1, '{"k":{"v":7}}'), (2, "broken")], "id int, t string")
    records = parse_text(df, "t", keep=["id"])
    assert rows(records.select("id", resolver(records, "json")("k.v"))) == [(1, "7"), (2, None)]


def test_xml_paths(spark, put):
    path = put(
        "a.xml",
        '<r><inv id="7"><customer><id>c1</id></customer><customer><id>c2</id></customer>'
        '<amount currency="EUR"> 10 </amount><empty/><issued>x</issued></inv>'
        "<inv><customer/><customer><id>c3</id></customer><amount>5</amount></inv></r>",
    )
    references = ["@id", "customer/id", "amount", "amount/@currency", "empty", "./issued", "none"]
    records = xml_records(spark, path, "/r/inv", references)
    value = resolver(records, "xml")
    assert rows(records.select(*[value(r) for r in references])) == rows(
        spark.createDataFrame(
            [("7", "c1", " 10 ", "EUR", None, "x", None), (None, "c3", "5", None, None, None, None)],
            "a string, b string, c string, d string, e string, f string, g string",
        )
    )


def test_xml_predicates(spark, put):
    path = put(
        "a.xmi",
        '<x:XMI xmlns:x="u:x" xmlns:m="u:m"><m:Model>'
        '<packagedElement x:type="m:Class" name="Base"/>'
        '<packagedElement x:type="m:Class" name="Car"><generalization general="B"/></packagedElement>'
        '<packagedElement x:type="m:Enum" name="Colour"/></m:Model></x:XMI>',
    )

    def names(predicate):
        records = xml_records(spark, path, f".//packagedElement{predicate}", ["@name"])
        return rows(records.select(resolver(records, "xml")("@name")))

    assert names("[@x:type='m:Class' and not(generalization)]") == [("Base",)]
    assert names("[@x:type='m:Class'][generalization]") == [("Car",)]
    assert names("[generalization/@general='B' or @x:type=\"m:Enum\"]") == [("Car",), ("Colour",)]
    assert names("[@none]") == []
    for bad in ("[1]", "[position()=1]", "[starts-with(@name,'B')]", "[(a)]"):
        with pytest.raises(ValueError, match="unsupported XML predicate"):
            names(bad)


def test_xml_iterator_paths(spark, put):
    path = put(
        "p.xml",
        "<r><a t='1'><item kind='z'><n>1</n></item><item><n>2</n></item></a><b><item kind='z'><n>3</n></item></b><item><n>4</n></item></r>",
    )

    def found(iterator, **options):
        records = xml_records(spark, path, iterator, ["n"], **options)
        return rows(records.select(resolver(records, "xml")("n")))

    assert found("/r/a/item") == [("1",), ("2",)]
    assert found("/r/b/item") == [("3",)]
    assert found("/r/a/item[@kind='z']") == [("1",)]
    assert found("/r/a[@t='2']/item") == []
    assert found("//item[@kind='z']") == [("1",), ("3",)]
    assert found("/r/item") == [("4",)]
    assert found("/r[@x]/item") == []
    assert found("/r[b/item]/a/item") == [("1",), ("2",)]
    assert found("/nope/item") == found("/nope/a/item") == []
    for bad in ("/r/*", "item", "/r//item"):
        with pytest.raises(ValueError):
            found(bad)


@pytest.fixture(params=[7, 13, 40, 1000, 1 << 20])
def small_splits(spark, request):
    """Splits of so many bytes, which cut texts anywhere."""
    names = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield request.param
    for n, v in before.items():
        spark.conf.set(n, v)


XML = (
    '<?xml version="1.0"?>\n<!-- <r><item>no</item></r> -->\n<r><item a="x > y">1</item><x><item>2</item><r><item>no</item></r></x><item/>'
    "<![CDATA[<item>3</item>]]><item><item>4</item><!-- </item> --><?x </item> ?></item>\n<item>é < 5</item></r>".replace("é < 5", "é &lt; 5")
)


def test_xml_elements_over_splits(spark, put, small_splits):
    path = put("a.xml", XML)

    def texts(*names):
        return sorted(r.text for r in record_texts(spark, path, XmlPieces(names)).collect())

    assert texts("r", "item") == sorted(['<item a="x > y">1</item>', "<item/>", "<item><item>4</item><!-- </item> --><?x </item> ?></item>", "<item>é &lt; 5</item>"])
    assert texts("r", "x", "item") == ["<item>2</item>"]
    assert texts("item") == texts("nope", "item") == []
    assert texts("r") == [XML[XML.index("\n<r>") + 1 :]]
    records = xml_records(spark, path, "/r/item", ["@a", "text()"])
    value = resolver(records, "xml")
    assert rows(records.select(value("@a"), value("text()")).where(value("text()").isNotNull())) == [("x > y", "1"), (None, "é < 5")]


def _some_json(rng, depth=0):
    kind = rng.random()
    if depth < 3 and kind < 0.25:
        return {rng.choice('ab"{}\\'): _some_json(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    if depth < 3 and kind < 0.4:
        return [_some_json(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return rng.choice([1, 2.5, None, True, "x}y", '{"', "\\", "é]", '"', "", "},{"])


def test_json_items_over_splits(spark, put, small_splits):
    rng = random.Random(small_splits)
    for n in range(4):
        items = [{"k": i, "v": _some_json(rng)} if rng.random() < 0.8 else [_some_json(rng)] for i in range(rng.randint(0, 25))]
        document = items if n else {"only": items}
        path = put(f"{n}.json", json.dumps(document, indent=rng.choice([None, 1]), ensure_ascii=False) + rng.choice(["", "\n"]))
        got = [json.dumps(json.loads(r.text)) for r in record_texts(spark, path, JsonPieces()).collect()]
        assert sorted(got) == sorted(map(json.dumps, document if n else [document]))


def test_json_array_over_splits(spark, put, small_splits):
    path = put("a.json", json.dumps([{"id": k, "t": f'] }}, [{{ "{k}\\'} for k in range(30)]))
    records = json_records(spark, path, ["id", "t"], "$[*]", multi_line=True)
    value = resolver(records, "json")
    assert rows(records.select(value("id"), value("t"))) == sorted([(str(k), f'] }}, [{{ "{k}\\') for k in range(30)], key=repr)


@pytest.mark.parametrize("text", ['[{"a":1},{"b":2', '[{"a":1}', '[{"a":"x}', "[1, 2]", '[{"a":1}, "s"]'])
def test_broken_arrays_fail(spark, put, text):
    with pytest.raises(Exception, match="ends within|neither objects nor arrays"):
        json_records(spark, put("a.json", text), ["a"], multi_line=True).collect()


def test_open_elements_fail(spark, put):
    with pytest.raises(Exception, match="ends within"):
        xml_records(spark, put("a.xml", "<r><item>1</item>"), "/r/item", ["text()"]).collect()


def test_other_splits_than_before_fail(spark, put):
    path = put("a.json", json.dumps([{"id": k} for k in range(50)]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        records = json_records(spark, path, ["id"], multi_line=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(Exception, match="another split"):
        records.collect()


def test_csv_keeps_lines_of_white_space(spark, put):
    path = put("w.csv", "a\nx\n   \n\n\t\ny\n")
    assert rows(csv_records(spark, path)) == [("   ",), ("\t",), ("x",), ("y",)]


def test_json_lists_are_text(spark, put):
    path = put("l.json", '{"a":[{"b":1,"c":"x"},{"b":null},{"c":"y"}],"t":["p","q"]}\n{"a":null}\n')
    for records in (json_records(spark, path, ["a[*].c", "t[*]"]), variant_documents(spark, path, multi_line=False)):
        value = resolver(records, "json")
        assert rows(records.select(value("a[*].c"), value("$.t[*]"))) == [('["x","y"]', '["p","q"]'), (None, None)]
        with pytest.raises(ValueError):
            value("a[*].b[*]")


def test_xml_attribute_fallback(spark, put):
    path = put("a.xml", '<r><i id="1"><v>x</v></i><i v="y"><id>2</id></i><i id="3" v="z"><id/></i></r>')
    got = []
    for fallback in (False, True):
        records = xml_records(spark, path, "/r/i", ["id", "v"], attr_fallback=fallback)
        value = resolver(records, "xml")
        got.append([tuple(r) for r in records.select(value("id"), value("v")).collect()])
    assert got == [[(None, "x"), ("2", None), (None, None)], [("1", "x"), ("2", "y"), ("3", "z")]]


def test_ntriples_lines(spark):
    lines = [
        "# comment",
        "",
        r'<a:b> <c:d> "A\U0001F600\\u0041 \"q\" \n" .',
        '  <a:b>   <c:d>\t"x"@en-US .  # said "y" .',
        "_:b1 <p:q> _:b2 .",
        '<a> <b> "" .',
        '<a> <b> "x > y"^^<t:d> .',
        '<a> <b> "say \\"> <\\" ." .',
        "<a> <b> <c#d> .",
        '<a> <b> "<i>" .',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [tuple(r) for r in parse_ntriples(df).collect()] == [
        ("a:b", "c:d", 'A😀\\u0041 "q" \n', "literal", None, None),
        ("a:b", "c:d", "x", "literal", None, "en-US"),
        ("_:b1", "p:q", "_:b2", "bnode", None, None),
        ("a", "b", "", "literal", None, None),
        ("a", "b", "x > y", "literal", "t:d", None),
        ("a", "b", 'say "> <" .', "literal", None, None),
        ("a", "b", "c#d", "iri", None, None),
        ("a", "b", "<i>", "literal", None, None),
    ]


def test_ntriples_malformed(spark, put):
    path = put("a.nt", '<a> <b> <c> .\nnot a triple\n<a> <b> "x" "y" .\n')
    assert ntriples_scan(spark, path, mode="DROP").count() == 1
    with pytest.raises(Exception, match="malformed"):
        ntriples_scan(spark, path).collect()


def test_synthetic_records_repeat(spark):
    ids = generate_ids(spark, 100)
    first, again = synthetic_customers(ids), synthetic_customers(ids.repartition(7))
    assert first.exceptAll(again).isEmpty()
    assert synthetic_invoices(ids).select("id").distinct().count() == 100
    assert rate_ids(spark).isStreaming


def test_parquet_table(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert parquet_table(spark, str(tmp_path / "t")).count() == 3


def test_small_splits_are_bounded_in_number():
    from tripleweft.queries.sources import _split_size

    assert _split_size(0) == _split_size(16 << 20) == 1 << 16
    assert all(total / _split_size(total) <= 256 for total in (1 << 20, 1 << 30, 9 << 30))


def test_a_split_that_may_start_in_a_comment_is_not_read_for_it(spark, put, monkeypatch):
    from tripleweft.sources import splits

    path = put("doc.xml", "<r>" + "<a>1</a><!-- <a> -->" * 50 + "</r>")
    monkeypatch.setattr(splits.XmlPieces, "read", _only_where_it_matters(splits.XmlPieces.read))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        texts = splits.record_texts(spark, path, splits.XmlPieces(["r", "a"])).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["text"] for r in texts] == ["<a>1</a>"] * 50


def _only_where_it_matters(read):
    def checked(self, state, piece):
        out = read(self, state, piece)
        if self.waits.get(state, "") not in piece:
            raise AssertionError(f"read in vain: {state} {piece}")
        return out

    return checked


def test_a_descent_opens_only_what_may_hold_the_name(spark, monkeypatch):
    from tripleweft.sources import deep_json

    opened, write = [], deep_json.Steps.write

    def counted(self, df):
        out = write(self, df)
        opened.append(out.count())
        return out

    monkeypatch.setattr(deep_json.Steps, "write", counted)
    texts = ['{"a": {"items": [{"k": 1}, {"k": 2}]}, "b": [1, {"items": [{"k": 3}]}, [4]], "c": {"d": {"e": {}}}}']
    documents = parse_text(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    records = iterate_deep(documents, "$..items[*]")
    assert rows(records.select(F.to_json(records.columns[0]))) == [('{"k":1}',), ('{"k":2}',), ('{"k":3}',)]
    # The root; `a` and the mixed array `b`; the object in `b`; nothing.
    assert opened == [1, 2, 1, 0]
