"""Mapping model: which triples a record of a source yields."""

from dataclasses import dataclass, field

from pyspark.sql import Column

from tripleweft.functions.templates import template_refs


@dataclass(frozen=True)
class ObjectMap:
    """One of reference, template or constant; none of them means no triple.

    A reference is a field name or path of the source, or any `Column`; the
    language may be a `Column` too, where the triples are built.
    """

    reference: str | Column | None = None
    template: str | None = None
    constant: str | None = None
    datatype: str | None = None
    lang: str | Column | None = None

    def references(self):
        if isinstance(self.reference, str):
            return [self.reference]
        if self.reference is None and self.template is not None:
            return template_refs(self.template)
        return []


def ref(reference, datatype=None, lang=None):
    """Object taken from a field: a literal."""
    return ObjectMap(reference=reference, datatype=datatype, lang=lang)


def template(text):
    """Object built from a template: an IRI."""
    return ObjectMap(template=text)


def constant(value, datatype=None, lang=None):
    """Fixed object: an IRI if it looks like one, else a literal."""
    return ObjectMap(constant=value, datatype=datatype, lang=lang)


@dataclass(frozen=True)
class TriplesMap:
    """Subject template, classes and (predicate, object) pairs over one source.

    `formulation` says how references are read: `table`, `csv`, `json`, `xml`.
    `where` keeps only some records (the element predicate of an iterator).
    `unique_subject` declares that no two records share a subject, which lets
    set semantics go without a shuffle.
    """

    source: str
    subject: str
    classes: tuple = ()
    objects: tuple = ()
    formulation: str = "table"
    iterator: str | None = None
    where: Column | None = None
    name: str | None = None
    unique_subject: bool = False

    def references(self):
        """Distinct textual references in order of first use."""
        seen = dict.fromkeys(template_refs(self.subject))
        for _, obj in self.objects:
            seen.update(dict.fromkeys(obj.references()))
        return list(seen)

    @property
    def label(self):
        return self.name or self.source


@dataclass(frozen=True)
class Mapping:
    """A list of triples maps."""

    maps: tuple = field(default_factory=tuple)

    def scans(self):
        """Maps grouped by what they read, so that each input is scanned once."""
        groups = {}
        for tm in self.maps:
            groups.setdefault((tm.source, tm.formulation, tm.iterator), []).append(tm)
        return groups

    def references(self, source):
        """All references that the maps of one source need: its read schema."""
        seen = {}
        for tm in self.maps:
            if tm.source == source:
                seen.update(dict.fromkeys(tm.references()))
        return list(seen)
