"""XML files as records, one per element of the iterator."""

import re
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripleweft.functions.paths import xml_present, xml_steps, xml_value
from tripleweft.plans.once import evaluate_once
from tripleweft.sources.splits import XmlPieces, record_texts

_STEP = re.compile(r"(//?)([\w:.-]+)((?:\[[^\]]*\])*)")
_TEST = re.compile(r"""^(not\()?\s*(@?[^\W\d][\w:.-]*(?:/@?[^\W\d][\w:.-]*)*)\s*(?:=\s*(?:'([^']*)'|"([^"]*)"))?\s*(?(1)\))$""")


def iterator_steps(iterator):
    """Steps of an iterator path as (name, predicates), and whether it starts with `//`."""
    steps, pos = [], 0
    text = iterator.strip().removeprefix(".")
    while pos < len(text):
        m = _STEP.match(text, pos)
        if not m or m.group(1) == "//" and pos:
            raise ValueError(f"unsupported XML iterator: {iterator}")
        steps.append((m.group(2), re.findall(r"\[([^\]]*)\]", m.group(3))))
        pos = m.end()
    if not steps:
        raise ValueError(f"unsupported XML iterator: {iterator}")
    return steps, text.startswith("//")


def _tests(predicate):
    """A predicate as alternatives of conjunctions of (negated, path, value or None)."""
    out = []
    for alternative in re.split(r"\s+or\s+", predicate.strip()):
        tests = []
        for part in re.split(r"\s+and\s+", alternative):
            m = _TEST.match(part.strip())
            if not m:
                raise ValueError(f"unsupported XML predicate: [{predicate}]")
            value = m.group(3) if m.group(3) is not None else m.group(4)
            tests.append((m.group(1) is not None, m.group(2), value))
        out.append(tests)
    return out


def _predicate_paths(predicates):
    return [path for p in predicates for tests in _tests(p) for _, path, _ in tests]


def _holds(schema, predicate):
    """A predicate as a condition on records of the schema."""

    def test(negated, path, value):
        if value is not None:
            found = F.coalesce(xml_value(schema, path) == value, F.lit(False))
        else:
            found = xml_present(schema, path)
        return ~found if negated else found

    alternatives = [reduce(lambda a, b: a & b, [test(*t) for t in tests]) for tests in _tests(predicate)]
    return reduce(lambda a, b: a | b, alternatives)


def schema_for(references, nested=""):
    """Read schema for element paths: elements are arrays, since they may repeat.

    `nested` is a path (ending in `/`) whose elements hold structures even where nothing below them is named.
    """
    tree = {}
    for reference in references:
        node, steps = tree, xml_steps(reference)
        for step in steps[:-1]:
            node = node.setdefault(step, {})
        last = steps[-1] if steps else "text()"
        if last.startswith("@"):
            node.setdefault("_" + last[1:], None)
        elif last == "text()":
            node.setdefault("_VALUE", None)
        else:
            node.setdefault(last, {}).setdefault("_VALUE", None)
    node = tree
    for step in xml_steps(nested):
        node = node.setdefault(step, {})

    def build(node):
        fields = []
        for name, inner in node.items():
            if inner is None:
                kind = T.StringType()
            elif set(inner) <= {"_VALUE"}:
                kind = T.ArrayType(T.StringType())
            else:
                kind = T.ArrayType(build(inner))
            fields.append(T.StructField(name, kind))
        return T.StructType(fields)

    return build(tree)


def xml_records(spark, path, iterator, references, also=(), attr_fallback=False, mode="FAILFAST"):
    """Records of an XML path: the elements that the iterator names.

    `//name` takes elements of that name wherever they are. `/root/a/b` takes elements of just that path: splits of large
    files know what is open where they start (`sources/splits.py`), and elements below the root's child are walked down
    from there. With a predicate on the root, a file's root is one record, which takes a task's memory for the file.

    Steps may have predicates: `@name='x'`, `path='x'`, `path`, `not(...)`, joined by `and` and `or`. Others are an
    error. The schema holds only the references, what predicates test, and the `also` paths. Names are taken raw,
    prefix included. With `attr_fallback`, a child that is absent or empty is taken from the attribute of its name.
    """
    steps, anywhere = iterator_steps(iterator)
    below = 0 if anywhere or len(steps) == 1 or steps[0][1] else 1
    walked = steps[below:]
    paths, prefix = [], ""
    for i, (name, predicates) in enumerate(walked):
        if i:
            prefix += name + "/"
        paths += [prefix + p for p in _predicate_paths(predicates)]
    paths += [prefix + r for r in (*references, *also)]
    fallbacks = [f"{prefix}@{r}" for r in references if attr_fallback and len(xml_steps(r)) == 1 and not r.startswith("@")]
    schema = schema_for([*paths, *fallbacks], nested=prefix)
    options = {"rowTag": walked[0][0], "ignoreSurroundingSpaces": "false", "mode": mode}
    if anywhere:
        records = spark.read.format("xml").schema(schema).options(**options).load(path)
    else:
        texts = record_texts(spark, path, XmlPieces([name for name, _ in steps[: below + 1]]))
        parsed = F.from_xml("text", schema, options)
        records = evaluate_once(texts, parsed.alias("_e")).select("_e.*")
    for i, (name, predicates) in enumerate(walked):
        if i:
            records = records.select(F.explode(F.col(f"`{name}`")).alias("_e"))
            structured = isinstance(records.schema["_e"].dataType, T.StructType)
            records = records.select("_e.*") if structured else records.select(F.col("_e").alias("_VALUE"))
        for p in predicates:
            records = records.where(_holds(records.schema, p))
    return _filled_from_attributes(records) if attr_fallback else records


def _filled_from_attributes(records):
    texts = T.ArrayType(T.StringType())
    for f in records.schema:
        if f.dataType == texts and "_" + f.name in records.columns:
            own = F.get(f"`{f.name}`", 0)
            attribute = F.col(f"`_{f.name}`")
            filled = F.when(F.coalesce(own, F.lit("")) == "", F.array(attribute)).otherwise(F.col(f"`{f.name}`"))
            records = records.withColumn(f.name, filled)
    return records
