"""Equal rows in one task, at a size that does not spill."""

_PARTITIONS = "spark.sql.shuffle.partitions"


def meet(rows):
    """Rows with a subject and an object, dealt over as many tasks as the session names for a shuffle, equal ones to the same.

    The number is given, so that adaptive execution leaves it: it joins partitions by their compressed size, and triples
    take some twenty times that in memory. It should grow with the data (200 do for a thousand million triples). Subject
    and object spread hot ones of either; other columns may be constants, by which a grouping would be dealt out again.
    """
    return rows.repartition(int(rows.sparkSession.conf.get(_PARTITIONS)), "s", "o")


def distinct_rows(rows):
    """Rows with a subject and an object as a set.

    Repeats meet first and are dropped then: a task that drops repeats ahead of the shuffle holds all different rows of
    its input, whatever its size, and spills them where few repeat. A triple that is very frequent is one task's.
    """
    return meet(rows).distinct()
