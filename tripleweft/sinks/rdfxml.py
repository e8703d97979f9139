"""Triples as RDF/XML."""

import pyarrow as pa
from pyspark.sql import functions as F

from tripleweft.functions.names import xml_name
from tripleweft.functions.text import escape_xml, xml_characters
from tripleweft.sinks.subjects import subject_lines
from tripleweft.vocab import BLANK, BNODE, IRI, RDF, RDF_TYPE


def _quoted(name, col):
    return F.concat(F.lit(f' {name}="'), escape_xml(col), F.lit('"'))


def _label(col):
    """A blank node as a name."""
    return F.substr(col, F.lit(len(BLANK) + 1))


def property_element(forbidden="raise"):
    """Property element of a triples row, with its namespace declared in place.

    A predicate that no XML name ends is an error, and so are characters that XML 1.0 cannot hold, unless
    `forbidden="replace"` puts U+FFFD in their place.
    """
    namespace, local = xml_name(F.col("p"))
    is_type = F.col("p") == RDF_TYPE
    tag = F.when(is_type, F.lit("rdf:type")).otherwise(F.concat(F.lit("j:"), local))
    declared = F.when(is_type, F.lit("")).otherwise(_quoted("xmlns:j", namespace))
    kind, o = F.col("o_kind"), F.col("o")
    attribute = (
        F.when(kind == IRI, _quoted("rdf:resource", o))
        .when(kind == BNODE, _quoted("rdf:nodeID", _label(o)))
        .otherwise(F.coalesce(_quoted("rdf:datatype", F.col("o_datatype")), _quoted("xml:lang", F.col("o_lang")), F.lit("")))
    )
    text = escape_xml(xml_characters(o, forbidden))
    rest = F.when(kind.isin(IRI, BNODE), F.lit("/>")).otherwise(F.concat(F.lit(">"), text, F.lit("</"), tag, F.lit(">")))
    return F.concat(F.lit("<"), tag, declared, attribute, rest)


def rdfxml_lines(triples, forbidden="raise", sample=None):
    """Rows (s, value): the distinct graph as lines, an `rdf:Description` opening where the subject changes."""
    s = F.col("s")
    about = F.when(s.startswith(BLANK), _quoted("rdf:nodeID", _label(s))).otherwise(_quoted("rdf:about", s))
    head = F.concat(F.lit("<rdf:Description"), about, F.lit(">"))
    return subject_lines(triples, head, property_element(forbidden), True, "\n  ", "  ", "", "\n</rdf:Description>", sample)


def _framed(batches):
    """Put the document start before the rows of a partition and the end after them."""

    def line(text):
        return pa.RecordBatch.from_pydict({"value": [text]}, schema=pa.schema([("value", pa.string())]))

    yield line(f'<rdf:RDF xmlns:rdf="{RDF}">')
    yield from batches
    yield line("</rdf:RDF>")


def write_rdfxml(triples, path, mode="overwrite", forbidden="raise", sample=None):
    """RDF/XML files; each part is a document of its own."""
    text = rdfxml_lines(triples, forbidden, sample).select("value")
    text.mapInArrow(_framed, "value string").write.mode(mode).text(path)
