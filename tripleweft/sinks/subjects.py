"""Triples by subject as a stream: sorted rows, in which a subject opens where it changes."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


#: Bytes of sorted rows that are taken at a time: each step on the way to their text makes a copy.
BATCH_BYTES = 4 << 20
#: Rows of one subject that a task should take.
SUBJECT_ROWS = 1_000_000
#: Part of the triples that tells which subjects have more, and how many subjects are spread at most.
SAMPLE, MOST_HOT = 0.001, 100_000


def _slices(batches):
    """The same rows in batches of about `BATCH_BYTES`, however long the texts of a batch are."""
    for batch in batches:
        step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _changes(column, before):
    """Where a value differs from the one before it; `before` precedes the first."""
    out = np.empty(len(column), bool)
    if len(column):
        out[0] = before is None or column[0].as_py() != before
        out[1:] = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return out


def subject_runs(batches, distinct):
    """Batches of sorted rows with masks: first of its subject, first of its key, last of its subject.

    One row is held back until its successor is known. With `distinct`, rows that repeat the one before go.
    """
    held, subject, key = None, None, None
    for batch in _slices(batches):
        rows = pa.Table.from_batches([batch])
        rows = (pa.concat_tables([held, rows]) if held is not None else rows).combine_chunks()
        if distinct and rows.num_rows > 1:
            new = np.zeros(rows.num_rows, bool)
            for name in rows.column_names:
                new |= _changes(rows.column(name).combine_chunks(), None)
            new[0] = True
            rows = rows.filter(pa.array(new)).combine_chunks()
        n = rows.num_rows - 1
        if n < 0:
            continue
        s, k = rows.column("s").combine_chunks(), rows.column("key").combine_chunks()
        opens = _changes(s, subject)
        if n:
            turns = _changes(k, key) | opens
            yield rows.slice(0, n), opens[:n], turns[:n], opens[1:]
            subject, key = s[n - 1].as_py(), k[n - 1].as_py()
        held = rows.slice(n)
    if held is not None:
        s, k = held.column("s").combine_chunks(), held.column("key").combine_chunks()
        opens = _changes(s, subject)
        yield held, opens, _changes(k, key) | opens, np.ones(1, bool)


def text_of(rows, name):
    return rows.column(name).combine_chunks().cast(pa.string())


def choose(mask, yes, no):
    return pc.if_else(pa.array(mask), yes, no)


def _lines(distinct, opening, inner, between, closing):
    """A line of output for each row; the opening text takes the subject's `head`."""

    def run(batches):
        for rows, opens, _, ends in subject_runs(batches, distinct):
            start = choose(opens, pc.binary_join_element_wise(text_of(rows, "head"), opening, ""), inner)
            end = choose(ends, closing, between)
            value = pc.binary_join_element_wise(start, text_of(rows, "text"), end, "")
            yield pa.RecordBatch.from_arrays([text_of(rows, "s"), value], ["s", "value"])

    return run


def hot_subjects(sample):
    """Rows (s, tasks) of the subjects that a sample of triples shows to be too many for a task; None without any."""
    most = SUBJECT_ROWS * SAMPLE
    counts = sample.groupBy("s").count().where(F.col("count") > most).orderBy(F.desc("count")).limit(MOST_HOT)
    hot = [(r["s"], math.ceil(r["count"] / most)) for r in counts.collect()]
    return sample.sparkSession.createDataFrame(hot, "s string, tasks int") if hot else None


def by_subject(triples, sample):
    """Triples dealt out by subject, equal ones to the same task; a hot subject goes to several tasks, by predicate and object.

    Which are hot is told by a sample; it may be wrong without harm to the result.
    """
    hot = hot_subjects(sample)
    if hot is None:
        return triples.repartition("s")
    told = triples.join(F.broadcast(hot.withColumnRenamed("s", "_hot")), F.col("s") == F.col("_hot"), "left")
    turn = F.coalesce(F.pmod(F.xxhash64("p", "o"), F.col("tasks")), F.lit(0))
    return told.repartition("s", turn).drop("_hot", "tasks")


def sorted_subjects(triples, key, text, sample=None):
    """Rows (s, key, text) of triples, or (s, text) without a key, sorted in each task.

    So equal rows and those of a subject follow each other.
    Ranges of subject, predicate and object make up the tasks, for which Spark evaluates all triples once more. Where that
    is costly, a `sample` of a thousandth of them may be given, and subjects are dealt out instead, in order of a hash, which
    tells them apart sooner than names that begin alike. Either way a subject with very many rows is spread over several tasks; each opens it again, which all formats allow. Nothing is grouped, so
    memory does not depend on the size of a subject. Text is made behind the shuffle: it is wider, and not to be made twice.
    """
    dealt = triples.repartitionByRange("s", "p", "o") if sample is None else by_subject(triples, sample)
    columns = [F.col("s"), *([] if key is None else [key.alias("key")]), text.alias("text")]
    rows = dealt.select(*columns)
    if sample is None:
        return rows.sortWithinPartitions(*rows.columns)
    return rows.withColumn("_at", F.xxhash64("s")).sortWithinPartitions("_at", *rows.columns).drop("_at")


def subject_lines(triples, head, text, distinct, opening, inner, between, closing, sample=None):
    """Rows (s, value): the text of all subjects, one triple per line; `head` follows from the subject."""
    rows = sorted_subjects(triples, None, text, sample).select("s", head.alias("head"), F.lit("").alias("key"), "text")
    return rows.mapInArrow(_lines(distinct, opening, inner, between, closing), "s string, value string")
