"""Records of one large document, read in splits.

A text is read in pieces that end where markup may; a split knows neither whether it starts within a comment or a string nor
what is open there. So a first pass notes, for each way a split may start, how it ends and what it closes and opens. These
notes, one for each split, are put together in order of the splits, which tells each where it starts. A second pass then
takes the records that lie within a split; of those that reach over splits it takes the parts, which are joined.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

_PLACE = "struct<at: bigint, offset: bigint>"
_NOTES = f"file string, block bigint, pieces bigint, start string, end string, closed array<{_PLACE}>, opened array<struct<name: string, at: bigint, offset: bigint>>"
_STARTS = "file string, block bigint, pieces bigint, splits bigint, state string, open array<string>, since bigint, tail_at bigint, tail_offset bigint, head_at bigint, head_offset bigint"


class XmlPieces:
    """Elements of one path, in pieces that start with `<`; names are taken raw."""

    separator, before = "<", True
    states = ("content", "comment", "cdata", "instruction")
    _ENDS = {"comment": "-->", "cdata": "]]>", "instruction": "?>"}
    waits = _ENDS
    _TAG = re.compile(r"""<([^\s/>!?<"'=]+)(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")

    def __init__(self, path):
        self.path = list(path)

    def depth(self, open_):
        """How many elements are open where a record is; None outside of records."""
        d = len(self.path)
        return d if open_[:d] == self.path else None

    def read(self, state, piece):
        """The state after a piece, and what it opens (name, offset) and closes ("", offset)."""
        if state != "content":
            return ("content" if self._ENDS[state] in piece else state), ()
        kind = piece[1:2]
        if kind == "/":
            return state, (("", piece.find(">") + 1 or len(piece)),)
        if kind == "!":
            for start, inside in (("<!--", "comment"), ("<![CDATA[", "cdata")):
                if piece.startswith(start):
                    return ("content" if piece.find(self._ENDS[inside], len(start)) >= 0 else inside), ()
            return state, ()
        if kind == "?":
            return ("content" if "?>" in piece else "instruction"), ()
        tag = self._TAG.match(piece)
        if not tag:
            return state, ()
        if piece[tag.end() - 2] == "/":
            return state, ((tag.group(1), 0), ("", tag.end()))
        return state, ((tag.group(1), 0),)

    def between(self, text, open_):
        """Text beside records may be anything."""


class JsonPieces:
    """The items of an array, or a document that is none, in pieces that end with `}`."""

    separator, before = "}", False
    states = ("value", "string")
    waits = {"string": '"'}
    _REST = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)
    _PLAIN = re.compile(r'(?:[^"{}\[\]]++|"(?:[^"\\]++|\\.)*+")*+', re.DOTALL)

    def depth(self, open_):
        if not open_:
            return None
        d = 2 if open_[0] == "[" else 1
        return d if len(open_) >= d else None

    def read(self, state, piece):
        pos, changes = 0, []
        if state == "string":
            rest = self._REST.match(piece)
            if not rest:
                return state, ()
            pos = rest.end()
            changes.append(("", pos))
        size = len(piece)
        while (pos := self._PLAIN.match(piece, pos).end()) < size:
            sign = piece[pos]
            if sign == '"':
                changes.append((sign, pos))
                return "string", changes
            changes.append((sign, pos) if sign in "{[" else ("", pos + 1))
            pos += 1
        return "value", changes

    def between(self, text, open_):
        if open_ == ["["] and text.strip(" \t\r\n,[]"):
            raise ValueError(f"an array with items that are neither objects nor arrays is not read in splits: {text.strip()[:80]}")


def _pieces(spark, path, form):
    """Rows (file, block, value) of all pieces, in order within a split; `block` is where the split starts."""
    text = spark.read.option("lineSep", form.separator).text(path)
    sign = F.lit(form.separator)
    value = F.concat(sign, "value") if form.before else F.concat("value", sign)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value.alias("value"))


def _by_split(batches):
    """(file, block, number of the first piece, pieces) of stretches of rows of one split."""
    last, count = None, 0
    for batch in batches:
        files, blocks = batch.column(0), batch.column(1)
        start = 0
        while start < batch.num_rows:
            key, end = (files[start].as_py(), blocks[start].as_py()), batch.num_rows
            if (files[end - 1].as_py(), blocks[end - 1].as_py()) != key:
                end = next(i for i in range(start, end) if (files[i].as_py(), blocks[i].as_py()) != key)
            count = count if key == last else 0
            yield *key, count, batch.column(2).slice(start, end - start)
            last, count, start = key, count + end - start, end


def _notes(pieces, form):
    """For each split and each state that it may start in: how it ends, what it closes and what it leaves open."""

    def run(batches):
        last, runs, count = None, {}, 0

        def rows():
            if last is None:
                return
            columns = zip(*[(*last, count, s, state, _named(_AT, closed), _named(_OPENED, opened)) for s, (state, closed, opened) in runs.items()], strict=True)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_AT), pa.list_(_OPENED))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "block", "pieces", "start", "end", "closed", "opened"])

        for file, block, first, values in _by_split(batches):
            if (file, block) != last:
                yield from rows()
                last, runs = (file, block), {s: (s, [], []) for s in (form.states if block else form.states[:1])}
            texts, seen = values.to_pylist(), {}
            marked = {state: np.flatnonzero(pc.match_substring(values, mark)) for state, mark in form.waits.items()}
            for s, (state, closed, opened) in runs.items():
                k = 0
                while k < len(texts):
                    if state in marked:  # nothing happens in this state before its mark
                        following = marked[state].searchsorted(k)
                        if following == len(marked[state]):
                            break
                        k = int(marked[state][following])
                    found = seen.get((state, k))
                    if found is None:
                        found = form.read(state, texts[k])
                        if len(runs) > 1:
                            seen[state, k] = found
                    state, changes = found
                    for name, offset in changes:
                        if name:
                            opened.append((name, first + k, offset))
                        elif opened:
                            opened.pop()
                        else:
                            closed.append((first + k, offset))
                    k += 1
                runs[s] = (state, closed, opened)
            count = first + len(values)
        yield from rows()

    return pieces.mapInArrow(run, _NOTES)


def _named(kind, rows):
    return [dict(zip(kind.names, row, strict=True)) for row in rows]


_AT = pa.struct([("at", pa.int64()), ("offset", pa.int64())])
_OPENED = pa.struct([("name", pa.string()), ("at", pa.int64()), ("offset", pa.int64())])


def _starts(notes, form):
    """Per split where it starts, and the ends of the parts of records that reach into it or out of it."""

    def run(pdf):
        state, open_, since, out = form.states[0], [], None, []
        by_block = {}
        for r in pdf.to_dict("records"):
            by_block.setdefault(r["block"], {})[r["start"]] = r
        for block in sorted(by_block):
            note = by_block[block][state]
            closed, opened = list(note["closed"]), list(note["opened"])
            row = {"file": note["file"], "block": block, "pieces": note["pieces"], "splits": len(by_block), "state": state, "open": open_, "since": since}
            d = form.depth(open_)
            if since is not None and len(closed) > len(open_) - d:
                row |= {"tail_at": closed[len(open_) - d]["at"], "tail_offset": closed[len(open_) - d]["offset"]}
            kept = max(0, len(open_) - len(closed))
            open_ = open_[:kept] + [o["name"] for o in opened]
            d, state = form.depth(open_), note["end"]
            if d is None:
                since = None
            elif d > kept:
                since = block
                row |= {"head_at": opened[d - 1 - kept]["at"], "head_offset": opened[d - 1 - kept]["offset"]}
            out.append(row)
        if open_ or state != form.states[0]:
            raise ValueError(f"{note['file']} ends within {open_ or state}")
        names = [c.split()[0] for c in _STARTS.split(", ")]
        return pd.DataFrame(out, columns=names).astype({n: "Int64" for n in names if n not in ("file", "state", "open")})

    return notes.groupBy("file").applyInPandas(run, _STARTS)


def _whole(pieces, form, shared):
    """Texts of the records that start and end within a split."""

    def run(batches):
        starts, last, out, count = shared.value, None, [], 0

        def check():
            known = starts.get(last)
            if known[3] != count if known else last is not None and last[1]:
                raise ValueError(f"{last} is another split than before: were the settings of file splits changed in between?")

        for file, block, first, values in _by_split(batches):
            if (file, block) != last:
                check()
                last = (file, block)
                state, open_, reaching, _ = starts.get(last, (form.states[0], (), False, 0))
                open_, parts, begin = list(open_), None, 0
                d = form.depth(open_) if reaching else None
            count = first + len(values)
            for piece in values.to_pylist():
                state, changes = form.read(state, piece)
                done = 0
                for name, offset in changes:
                    if name:
                        if d is None:
                            open_.append(name)
                            d = form.depth(open_)
                            if d is not None:
                                form.between(piece[done:offset], open_[:-1])
                                parts, begin = [], offset
                            else:
                                done = offset
                        else:
                            open_.append(name)
                        continue
                    if d is not None and len(open_) == d:
                        if parts is not None:
                            parts.append(piece[begin:offset])
                            out.append("".join(parts))
                        parts, d = None, None
                    elif d is None:
                        form.between(piece[done:offset], open_)
                    done = offset
                    if open_:
                        open_.pop()
                if parts is not None:
                    parts.append(piece[begin:])
                    begin = 0
                elif d is None:
                    form.between(piece[done:], open_)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])
                out = []
        check()

    return pieces.mapInArrow(run, "text string")


def _parts(pieces, shared):
    """The parts of records that reach over splits: (file, since, block, text)."""

    def run(batches):
        edges = shared.value
        for file, block, first, values in _by_split(batches):
            if (file, block) not in edges:
                continue
            since, tail, head = edges[file, block]
            end = first + len(values)
            if since is not None:
                stop = end if tail is None else min(end, tail[0] + 1)
                texts = values.slice(0, max(0, stop - first)).to_pylist()
                if texts and tail is not None and first <= tail[0] < end:
                    texts[-1] = texts[-1][: tail[1]]
                yield _rows(file, since, block, first, texts)
            if head is not None and end > head[0]:
                texts = values.slice(max(0, head[0] - first)).to_pylist()
                if head[0] >= first:
                    texts[0] = texts[0][head[1] :]
                yield _rows(file, block, block, first, texts)

    return pieces.mapInArrow(run, "file string, since bigint, block bigint, at bigint, text string")


def _rows(file, since, block, at, texts):
    columns = ([file], [since], [block], [at], ["".join(texts)])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["file", "since", "block", "at", "text"])


def record_texts(spark, path, form):
    """The texts of all records of the documents of a path, one column `text`; each file is a document of its own.

    Files are read in splits whatever their size. What a task needs to know of its split is one short note; the driver
    holds those of files with several splits, some hundred bytes for a split of many megabytes. A record takes a task's
    memory only with its own text. A document that ends before all is closed is an error, and so are settings of file
    splits that change between the two passes.
    """
    pieces = _pieces(spark, path, form)
    starts, edges = {}, {}
    for r in _starts(_notes(pieces, form), form).where("splits > 1").toLocalIterator():
        key = (r["file"], r["block"])
        starts[key] = (r["state"], tuple(r["open"]), r["since"] is not None, r["pieces"])
        tail = None if r["tail_at"] is None else (r["tail_at"], r["tail_offset"])
        head = None if r["head_at"] is None else (r["head_at"], r["head_offset"])
        if r["since"] is not None or head is not None:
            edges[key] = (r["since"], tail, head)
    # Shared with each executor's workers once: in the function itself every task would read the notes of all splits.
    whole = _whole(pieces, form, spark.sparkContext.broadcast(starts))
    if not edges:
        return whole
    parts = _parts(pieces, spark.sparkContext.broadcast(edges)).groupBy("file", "since").agg(F.array_sort(F.collect_list(F.struct("block", "at", "text"))).alias("parts"))
    return whole.unionByName(parts.select(F.array_join("parts.text", "").alias("text")))
