"""N-Triples text as triples."""

from pyspark.sql import functions as F

from tripleweft.functions.text import has_code_escape, unescape_codes, unescape_plain
from tripleweft.plans.once import evaluate_once
from tripleweft.vocab import BLANK, BNODE, IRI, LITERAL

# Subject, predicate, then one of IRI, blank node, literal with optional tag.
_NODE = r'(?:<([^>]*)>|(_:[^\s<"]+))'
_LINE = (
    r"^\s*" + _NODE + r"\s*<([^>]*)>\s*"
    r'(?:<([^>]*)>|(_:[^\s<"]+)|"([^"\\]*+(?:\\.[^"\\]*+)*+)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)'
    r"\s*\.\s*(?:#.*)?$"
)
_MARK = "\x01"
# Object kind first, literal last: whatever it holds stays within the last piece.
_PICK = _MARK.join(["$1$2", "$3", "$4$5", "$7", "$8", "$6"])
_KIND_IRI = r'^\s*(?:<[^>]*>|_:[^\s<"]+)\s*<[^>]*>\s*(?:<|_:)'


def _contains(col, *texts):
    test = F.contains(col, F.lit(texts[0]))
    for text in texts[1:]:
        test = test | F.contains(col, F.lit(text))
    return test


def _plain_parts(lines, text, keep):
    """Cut lines of the usual form `<s> <p> object .` at fixed places.

    Gives the line, its subject and predicate, and the object's text `_o` with
    the end `_q` of its quoted part. What does not have the usual form is
    left to the pattern.
    """
    cut = lines.select(*keep, text.alias("_line"), F.split(text, "> ", 3).alias("_t"))
    rest = F.get("_t", 2)
    usual = F.col("_line").startswith("<") & F.get("_t", 1).startswith("<") & rest.endswith(" .")
    usual = usual & ~_contains(F.col("_line"), " #", ".#", "\t#")
    return cut.select(
        *keep,
        "_line",
        F.substr(F.get("_t", 0), F.lit(2)).alias("_s"),
        F.substr(F.get("_t", 1), F.lit(2)).alias("_p"),
        F.when(usual, F.substr(rest, F.lit(1), F.length(rest) - 2)).alias("_o"),
    )


def _object_parts(plain, keep):
    o = F.col("_o")
    is_iri = o.startswith("<") & (F.instr(o, ">") == F.length(o))
    last_quote = F.when(o.endswith('"'), F.length(o)).otherwise(
        F.length(o) - F.instr(F.reverse(o), '"') + 1
    )
    placed = plain.select(*keep, "_line", "_s", "_p", "_o", is_iri.alias("_iri"), last_quote.alias("_q"))
    body = F.substr("_o", F.lit(2), F.col("_q") - 2)
    tail = F.substr("_o", F.col("_q") + 1)
    cut = placed.select(
        *keep,
        "_line",
        "_s",
        "_p",
        "_iri",
        F.when(F.col("_iri"), F.substr("_o", F.lit(2), F.length("_o") - 2)).otherwise(body).alias("_o"),
        F.when(~F.col("_iri") & o.startswith('"') & (F.col("_q") > 1), tail).alias("_tail"),
    )
    tagged = (F.col("_tail") == "") | F.col("_tail").startswith("@")
    tagged = tagged | (F.col("_tail").startswith("^^<") & F.col("_tail").endswith(">"))
    done = F.col("_iri") | (tagged & ~_contains(F.col("_o"), '"', "\\"))
    return cut.withColumn("_done", F.coalesce(done, F.lit(False)))


def parse_ntriples(lines, column="value", keep=()):
    """Triples from a column of lines; empty and comment lines are left out.

    Usual lines are cut at fixed places; only lines with escapes, comments,
    blank nodes or unusual spacing go through the full pattern. A line that
    does not match it gives a null subject, for the caller to count or reject.
    """
    text = F.col(column)
    body = lines.filter((F.trim(text) != "") & ~F.ltrim(text).startswith("#"))
    parts = _object_parts(_plain_parts(body, text, keep), keep)
    line, done = F.col("_line"), F.col("_done")
    matched = F.split(F.regexp_replace(line, _LINE, _PICK), _MARK, 6)
    # A line that fails the pattern is not cut into six pieces.
    pattern = parts.select(
        *keep,
        "_s",
        "_p",
        "_o",
        "_tail",
        "_done",
        F.when(~done & line.rlike(_KIND_IRI), F.lit(True)).when(~done, F.lit(False)).otherwise(F.col("_iri")).alias("_iri"),
        F.when(~done, matched).alias("_m"),
    )
    ok = F.size("_m") == 6

    def pick(i):
        return F.when(ok, F.get("_m", i))

    datatype = F.when(F.col("_tail").startswith("^^<"), F.substr("_tail", F.lit(4), F.length("_tail") - 4))
    lang = F.when(F.col("_tail").startswith("@"), F.substr("_tail", F.lit(2)))
    coded = ~done & ~F.col("_iri") & ok & has_code_escape(F.get("_m", 5))
    literal = F.when(has_code_escape(pick(5)), pick(5)).otherwise(unescape_plain(pick(5)))
    triples = evaluate_once(
        pattern,
        F.when(done, F.col("_s")).otherwise(pick(0)).alias("s"),
        F.when(done, F.col("_p")).otherwise(pick(1)).alias("p"),
        F.when(done, F.col("_o")).otherwise(F.when(F.col("_iri"), pick(2)).otherwise(literal)).alias("o"),
        F.when(~F.col("_iri"), LITERAL).when(~done & F.startswith(pick(2), F.lit(BLANK)), BNODE).otherwise(IRI).alias("o_kind"),
        F.when(done, datatype).otherwise(F.nullif(pick(3), F.lit(""))).alias("o_datatype"),
        F.when(done, lang).otherwise(F.nullif(pick(4), F.lit(""))).alias("o_lang"),
        F.coalesce(coded, F.lit(False)).alias("_coded"),
        keep=keep,
    )
    # Code escapes need an array function, which would keep all of the above from being compiled.
    return triples.select(
        *keep,
        "s",
        "p",
        F.when(F.col("_coded"), unescape_codes(F.col("o"))).otherwise(F.col("o")).alias("o"),
        "o_kind",
        "o_datatype",
        "o_lang",
    )


def ntriples_scan(spark, path, mode="FAILFAST", blank_nodes="graph", fraction=None):
    """Triples of N-Triples files. A malformed line fails the job unless `mode="DROP"`.

    With a `fraction`, those of a sample of the lines, which are the only ones parsed.

    The files of a path are one graph, as Spark writes one in many files. Where each file is a graph of its own,
    `blank_nodes="file"` keeps their blank nodes apart by adding a hash of the file's name to the labels.
    """
    lines = spark.read.text(path)
    if fraction is not None:
        lines = lines.sample(fraction, seed=0)
    if blank_nodes == "file":
        triples = parse_ntriples(lines.select("value", F.hex(F.xxhash64(F.input_file_name())).alias("_file")), keep=["_file"])
        own = F.concat(F.lit("-"), F.col("_file"))
        triples = triples.select(
            F.when(F.col("s").startswith(BLANK), F.concat("s", own)).otherwise(F.col("s")).alias("s"),
            "p",
            F.when(F.col("o_kind") == BNODE, F.concat("o", own)).otherwise(F.col("o")).alias("o"),
            "o_kind",
            "o_datatype",
            "o_lang",
        )
    else:
        triples = parse_ntriples(lines)
    if mode == "DROP":
        return triples.filter(F.col("s").isNotNull())
    checked = F.coalesce("s", F.raise_error(F.lit("malformed N-Triples line")).cast("string"))
    return triples.withColumn("s", checked)
