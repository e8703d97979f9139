"""Graph patterns of any shape: joins along a tree, after semi-joins up and down the tree.

The triples that any pattern can use are written once, and each pattern is a filter on them. Patterns that share variables
hang together as a tree where the shape allows it. First every pattern is reduced to what its neighbours can join, from the
leaves to the root and back, by semi-joins on keys; only then are rows joined, so no join takes in rows that lead nowhere.
"""

import math
from functools import reduce

from pyspark.sql import functions as F

from tripleweft.plans.joins import checked_join
from tripleweft.scratch import write_and_read
from tripleweft.vocab import LITERAL, TRIPLE_COLUMNS


def _variable(term):
    return isinstance(term, str) and term.startswith("?")


def _variables(pattern):
    return {t for t in pattern if _variable(t)}


def join_tree(patterns, sizes):
    """Order and parents (child, parent) by which patterns hang together, leaves first; and what is left over.

    A pattern is a leaf if one other holds all variables it shares with any; the largest leaf goes first, so that small
    patterns come near the root. Shapes with circles leave several patterns over.
    """
    left, edges = set(range(len(patterns))), []
    while len(left) > 1:
        leaves = []
        for i in left:
            others = left - {i}
            shared = _variables(patterns[i]) & set().union(*[_variables(patterns[j]) for j in others])
            holders = [j for j in others if shared and shared <= _variables(patterns[j])]
            if holders:
                leaves.append((sizes[i], i, min(holders, key=lambda j: (sizes[j], j))))
        if not leaves:
            break
        _, leaf, parent = max(leaves)
        edges.append((leaf, parent))
        left.remove(leaf)
    return edges, sorted(left, key=lambda i: (sizes[i], i))


def _relation(triples, pattern, both, tests):
    """The bindings of one pattern: a column per variable, and a key of the whole term for those in object places only."""
    s, p, o = pattern
    rows = triples.where(_fits(pattern, tests))
    columns = {}
    for place, term in (("s", s), ("p", p), ("o", o)):
        if not _variable(term):
            continue
        name = term[1:]
        if name in columns:
            rows = rows.where((columns[name] == F.col(place)) & ((F.col("o_kind") != LITERAL) if place == "o" else F.lit(True)))
            continue
        columns[name] = F.col(place)
        if place == "o" and term not in both:
            columns["_key_" + name] = F.to_json(F.struct("o", "o_kind", "o_datatype", "o_lang"))
        elif place == "o":
            rows = rows.where(F.col("o_kind") != LITERAL)
    return rows.select(*[c.alias(n) for n, c in columns.items()]).distinct()


def _fits(pattern, tests):
    """Condition on triples that fit the constants of a pattern and the tests of its variables."""
    found = [F.col(place) == F.lit(term) for place, term in zip(("s", "p", "o"), pattern, strict=True) if not _variable(term)]
    found += [F.coalesce(tests[term[1:]](F.col(place)), F.lit(False)) for place, term in zip(("s", "p", "o"), pattern, strict=True) if _variable(term) and term[1:] in tests]
    return reduce(lambda a, b: a & b, found, F.lit(True))


def _on(left, right):
    """Columns to join by: keys of whole terms where both sides have them, else the texts."""
    common = [c for c in left.columns if c in right.columns]
    return [c for c in common if not ("_key_" + c in common)]


def _joined(left, right):
    on = _on(left, right)
    extra = [c for c in right.columns if c in left.columns and c not in on]
    return checked_join(left, right.drop(*extra), on)


def _named(pattern):
    return {t[1:] for t in _variables(pattern)}


def _measured(relation, all_):
    """Rows of a relation, and of its columns that others have, roughly how many values there are."""
    shared = [c for c in relation.columns if sum(c in r.columns for r in all_) > 1]
    row = relation.agg(F.count(F.lit(1)).alias("rows"), *[F.approx_count_distinct(c).alias(c) for c in shared]).first()
    return row["rows"], {c: max(1, row[c]) for c in shared}


def _circle(relations, wanted):
    """Relations joined one after the other, first those that give the fewest rows by their numbers of rows and values.

    Two sides with few values in common (a nation) would meet in their product. What neither `wanted` nor a later
    relation asks for goes once it is joined, and the rows that it told apart become one.
    """
    if len(relations) == 1:
        return relations[0]
    known = [_measured(r, relations) for r in relations]

    def meet(a, b):
        common = a[1].keys() & b[1].keys()
        return a[0] * b[0] / max([max(a[1][c], b[1][c]) for c in common]) if common else None

    pairs = [(meet(known[i], known[j]), i, j) for i in range(len(relations)) for j in range(i)]
    rows, i, j = min(p for p in pairs if p[0] is not None)
    joined, waiting = None, set(range(len(relations)))
    while waiting:
        if joined is None:
            waiting -= {i, j}
            joined, values = _joined(relations[i], relations[j]), (known[i][1], known[j][1])
        else:
            rows, i = min((meet(size, known[k]), k) for k in waiting if set(_on(joined, relations[k])))
            waiting.remove(i)
            joined, values = _joined(joined, relations[i]), (size[1], known[i][1])
        size = (rows, {c: min(v.get(c, math.inf) for v in values) for c in values[0].keys() | values[1].keys()})
        later = wanted.union(*[relations[k].columns for k in waiting])
        kept = [c for c in joined.columns if c.removeprefix("_key_") in later or c in later]
        if len(kept) < len(joined.columns):
            joined = write_and_read(joined.select(*kept).distinct(), "pattern-circle")
    return joined


def match_patterns(triples, patterns, variables, tests=None):
    """Every binding of `variables` under which all `patterns` hold, as a set.

    A pattern is (subject, predicate, object); what starts with `?` is a variable, all else is the text of a constant.
    `tests` maps variables to conditions on their text. A variable in both a subject and an object place binds no
    literals; one in object places only must agree in datatype and language too. All patterns hang together by shared
    variables. Keys go to the other side by broadcast where they measure small, else by joins that spread hot keys.
    """
    tests = tests or {}
    patterns = [tuple(p) for p in patterns]
    unknown = [v for v in variables if "?" + v not in set().union(*map(_variables, patterns))]
    if unknown:
        raise ValueError(f"no pattern has {unknown}")
    conditions = [_fits(p, tests) for p in patterns]
    used = triples.select(*TRIPLE_COLUMNS).where(reduce(lambda a, b: a | b, conditions))
    used = write_and_read(used, "pattern-triples")
    row = used.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(conditions)]).first()
    sizes = [row[f"n{i}"] for i in range(len(patterns))]
    both = {t for s, p, _ in patterns for t in (s, p) if _variable(t)}
    relations = [_relation(used, p, both, tests) for p in patterns]
    edges, rest = join_tree(patterns, sizes)
    _connected(patterns, rest)
    for child, parent in edges:
        relations[parent] = write_and_read(_reduced(relations[parent], relations[child]), "pattern-up")
    for child, parent in reversed(edges):
        relations[child] = write_and_read(_reduced(relations[child], relations[parent]), "pattern-down")
    # Patterns around a circle are joined first, those that join to the fewest rows before others.
    joined = _circle([relations[i] for i in rest], set(variables).union(*[_named(patterns[i]) for edge in edges for i in edge]))
    for child, _ in reversed(edges):
        joined = _joined(joined, relations[child])
    return joined.select(*variables).distinct()


def _connected(patterns, rest):
    """What no tree reaches must share variables some other way."""
    if len(rest) < 2:
        return
    seen, open_ = _variables(patterns[rest[0]]), list(rest[1:])
    while open_:
        near = [i for i in open_ if _variables(patterns[i]) & seen]
        if not near:
            raise ValueError(f"patterns do not hang together: {[patterns[i] for i in open_]}")
        seen |= _variables(patterns[near[0]])
        open_.remove(near[0])


def _reduced(rows, by):
    """Rows that have a partner."""
    on = _on(rows, by)
    return checked_join(rows, by.select(*on).distinct(), on, "left_semi", write_right=True)
