"""JSON documents of any layout, cut out of splittable text files.

A file holds any number of documents, each on one line, over many lines, or
several on a line. The text source splits large files at line ends, so a document may
begin in one split and end in another. Cutting works like a prefix scan:

1. Each task walks the lines of its splits once and follows the nesting depth
   of brackets outside strings (a JSON string never holds a line break, so every line
   starts outside of one). Relative to the split's own start, the lowest depth it
   reaches is where documents end: text between two such ends is a whole
   document, text before the first is the rest of a document that began earlier, text
   behind the last is the start of one. Pieces leave the task as they are cut, with the
   lowest depth known by then; a later line may show that it was not the lowest, so a
   split also yields one row of facts, its change of depth and its lowest depth.
2. Running sums of the changes over the splits of a file (narrow rows) give the depth at
   which each split starts, which confirms its cuts: it has to be minus
   the lowest depth, or higher where the whole split lies inside one document.
3. Pieces cut at the lowest depth of a confirmed split are documents. The others, which lie
   at split borders, are joined to documents.

Text is read once and written once (the pieces); only border pieces are shuffled. A Python
worker holds a block of lines (``BLOCK`` bytes) and the document it is in, whatever the size
of the split, and a row one document. A file whose brackets do not close, with text
outside documents, or with a document that does not parse, raises an error that names it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.session import materialize

# Workers need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTE, _ESCAPE, _LINE, _OPEN, _CLOSE = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
for _c, _k in ((b'"', _QUOTE), (b"\\", _ESCAPE), (b"\n", _LINE), (b"{[", _OPEN), (b"}]", _CLOSE)):
    for _b in _c:
        _KIND[_b] = _k

PIECES = "file string, modified timestamp, start long, seq long, role string, body binary, level long, change long, lowest long, broken boolean"

# FIXED: bytes of text that a worker looks at together (the arrays over it take some 15 times as much).
BLOCK = 1 << 20


def brackets(text: bytes) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions and steps (+1 / -1) of the brackets outside strings, and whether
    a line ends inside a string."""
    at, step, broken, inside = _brackets(text, False)
    return at, step, broken or inside


def _brackets(text: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, bool, bool]:
    """The same of a text that starts ``inside`` a string or outside: a line break
    inside a string, and whether the text ends inside of one."""
    kind = _KIND[np.frombuffer(text, np.uint8)]
    at = np.flatnonzero(kind)
    kind = kind[at]
    quote = kind == _QUOTE
    escapes = at[kind == _ESCAPE]
    if len(escapes):
        # A quote is escaped behind an odd run of backslashes.
        index = np.arange(len(escapes))
        first = np.maximum.accumulate(np.where(np.diff(escapes, prepend=-2) != 1, index, 0))
        before = np.searchsorted(escapes, at[quote]) - 1
        held = (before >= 0) & (escapes[before] == at[quote] - 1) & ((before - first[before]) % 2 == 0)
        quote[np.flatnonzero(quote)[held]] = False
    count = np.cumsum(quote) + inside
    line = kind == _LINE
    seen = np.where(line, count, 0)
    base = np.maximum.accumulate(np.concatenate(([0], seen))) if len(seen) else np.zeros(1, np.int64)
    quoted = ((count - base[:-1]) & 1).astype(bool)
    structural = (kind >= _OPEN) & ~quoted
    open_end = bool((count[-1] - base[-1]) & 1) if len(count) else inside
    return at[structural], np.where(kind[structural] == _OPEN, 1, -1), bool(quoted[line].any()), open_end


def _blocks(lines: pa.Array) -> Iterator[bytes]:
    """The lines with their ends in texts of about ``BLOCK`` bytes. A longer line comes
    in parts, none of which starts behind a backslash."""
    block = np.cumsum(pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1) // BLOCK
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(lines)]
    for a, b in zip(edges, edges[1:]):
        text, last = b"\n".join(lines.slice(a, b - a).to_pylist()) + b"\n", 0
        while last < len(text):
            end = last + BLOCK if len(text) - last > 2 * BLOCK else len(text)
            while end < len(text) and text[end - 1] == 92:
                end += 1
            yield text if (last, end) == (0, len(text)) else text[last:end]
            last = end


class _Split:
    """The walk over one split of one file."""

    def __init__(self, file: str, modified, start: int):
        self.file, self.modified, self.start = file, modified, start
        self.depth = self.lowest = self.seq = 0
        self.broken = self.inside = False
        self.rest: list[bytes] = []  # text behind the last end

    def add(self, text: bytes) -> Iterator[tuple]:
        at, step, broken, self.inside = _brackets(text, self.inside)
        self.broken |= broken
        depth = self.depth + np.cumsum(step)
        last = 0
        if len(at):
            closing = step < 0
            lowest = min(self.lowest, int(depth[closing].min())) if closing.any() else self.lowest
            if self.start == 0 and lowest < 0:
                self.broken = True
            elif lowest < self.lowest:
                # Deeper out than known: all text so far belongs to the earlier document.
                first = int(at[closing & (depth == lowest)][0]) + 1
                self.lowest = lowest
                yield self._row("head", b"".join([*self.rest, text[:first]]), level=lowest)
                self.rest, last = [], first
            for end in at[closing & (depth == self.lowest)].tolist():
                if end < last:
                    continue
                yield self._row("document", b"".join([*self.rest, text[last : end + 1]]).strip(), level=self.lowest)
                self.rest, last = [], end + 1
            self.depth = int(depth[-1])
        tail = text[last:]
        if self.rest or tail.strip():
            self.rest.append(tail)

    def end(self) -> Iterator[tuple]:
        if any(r.strip() for r in self.rest):
            yield self._row("tail", b"".join(self.rest).removesuffix(b"\n"))
        yield self._row("facts", None, change=self.depth, lowest=self.lowest, broken=self.broken)

    def _row(self, role: str, body: bytes | None, level=None, change=None, lowest=None, broken=None) -> tuple:
        self.seq += 1
        return self.file, self.modified, self.start, self.seq, role, body, level, change, lowest, broken


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the splits whose lines come in order: file, modified, start, value."""
    schema = None
    split: _Split | None = None
    rows = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    for batch in batches:
        schema = pa.schema(
            [("file", pa.string()), ("modified", batch.schema.field(1).type), ("start", pa.int64()), ("seq", pa.int64()), ("role", pa.string()),
             ("body", pa.binary()), ("level", pa.int64()), ("change", pa.int64()), ("lowest", pa.int64()), ("broken", pa.bool_())]
        )
        file, start = batch.column(0).dictionary_encode(), batch.column(2).to_numpy(zero_copy_only=False)
        code = file.indices.to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1).tolist(), batch.num_rows]
        out: list[tuple] = []
        held = 0
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            name = file.dictionary[int(code[a])].as_py()
            if split is None or (split.file, split.start) != (name, int(start[a])):
                if split is not None:
                    out += split.end()
                split = _Split(name, batch.column(1)[a].as_py(), int(start[a]))
            for text in _blocks(batch.column(3).slice(a, b - a).cast(pa.binary())):
                out += split.add(text)
                held += len(text)
                if out and held >= BLOCK:
                    yield rows(out)
                    out, held = [], 0
        if out:
            yield rows(out)
    if split is not None:
        yield rows(list(split.end()))


def text_lines(lines: DataFrame) -> DataFrame:
    """What :func:`cut_documents` needs of a text scan or a micro-batch of one."""
    at = F.col("_metadata")
    return lines.select(
        at["file_path"].alias("file"), at["file_modification_time"].alias("modified"), at["file_block_start"].alias("start"), "value"
    )


def cut_documents(lines: DataFrame) -> DataFrame:
    """``json, file, modified``: every document of the files. ``lines`` is the plain
    projection :func:`text_lines` of a text scan, whose tasks read each split in order.
    The files are cut and checked at once; what comes back reads the written pieces."""
    json = F.col("body").cast("string")
    parses = lambda text: F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*[{\[]")
    # Parsed where it is cut: the pieces of all files are written with the outcome.
    valid = F.when(F.col("role") == "document", F.coalesce(parses(json), F.lit(False)))
    pieces = materialize(lines.mapInArrow(_cut, PIECES).select("*", valid.alias("valid")), "document-pieces")
    facts = pieces.where("role = 'facts'").select("file", "start", "change", "lowest", "broken")
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # One narrow row per split of a file.
    splits = materialize(
        facts.select(
            "file", "start", "lowest", "broken",
            F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("depth"),
            F.sum("change").over(of_file).alias("total"),
        ),
        "document-splits",
    )
    refuse(splits.where("broken OR total <> 0 OR depth + lowest < 0"))

    # The level at which documents of a split end; null where it lies inside one.
    outside = splits.select("file", "start", F.expr("CASE WHEN depth + lowest = 0 THEN lowest END").alias("outside"))
    cut = pieces.where("role <> 'facts'").join(outside, ["file", "start"], "left")
    closes = F.col("level").eqNullSafe(F.col("outside"))
    document = (F.col("role") == "document") & closes
    refuse(cut.where(document & ~F.col("valid")))
    # Border pieces: what a split holds before its first end and behind its last, and all pieces of a split inside one document.
    in_order = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when((F.col("role") == "head") & closes, 1).otherwise(0)
    numbered = cut.where(~document).withColumn("number", F.coalesce(F.sum(ends).over(in_order), F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("start", "seq", json.alias("json"))))
    joined = numbered.groupBy("file", "modified", "number").agg(F.array_join(F.transform(parts, lambda p: p["json"]), "\n").alias("json"))
    joined = materialize(joined.select("json", "file", "modified", F.coalesce(parses(F.col("json")), F.lit(False)).alias("valid")), "border-documents")
    refuse(joined.where(~F.col("valid")))
    whole = cut.where(document).select(json.alias("json"), "file", "modified")
    return whole.unionByName(joined.select("json", "file", "modified"))


def refuse(found: DataFrame) -> None:
    """Stops at the first file that is found (one name comes to the driver)."""
    first = found.select("file").first()
    if first is not None:
        raise ValueError(f"not a JSON document, nor several of them: {first['file']}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Column ``json``: the documents of all files below ``path``."""
    return cut_documents(text_lines(spark.read.text(path))).select("json")
