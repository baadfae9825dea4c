"""JSON documents as tables (S10, S12, S14): rows per member of one large object, read in parallel.

A document is one file or a folder of part files that follow one another by name: an object whose members are
arrays, objects or plain values (several objects one after another count as one document).  It is cut
into chunks of ``CHUNK_BYTES`` wherever they fall, also inside of strings and numbers, in two scans:

* the first gives, for each chunk and each way it may begin (outside a string, inside one, behind a backslash), how it ends: in a
  string or not, how many brackets deeper, and the last member's name and bracket it saw at the levels that may be the
  members'.  These few values per chunk, taken one after another, tell each chunk's true beginning;
* the second hands out the elements: each belongs to the chunk in which it begins, whose task reads on to its end.

Neither holds more than a chunk and one element, so neither a document of one line nor one of many files is ever one row.
A chunk is a task of both scans, which costs the same however small it is: ``chunk_size`` gives a size that grows with the documents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanscope.session import ship_package
from loanscope.sources.registers import filesystem

CHUNK_BYTES = 16 << 20
READ_ON_BYTES = 1 << 18  # at a time, to the end of a chunk's last element
NAME_BYTES = 1 << 16  # longest member name, as written
BATCH_BYTES = 4 << 20
SLOT_CHUNKS = 4  # for each slot of the cluster, while the documents are small enough for it
ROW_SCHEMA = "document string, member string, entry string, pos long, value string"

STRUCTURE = np.zeros(256, bool)
STRUCTURE[list(b"{}[],:")] = True
DEEPER = np.zeros(256, np.int8)
DEEPER[list(b"{[")] = 1
DEEPER[list(b"}]")] = -1
OPENS, COMMA, COLON = b"{[", ord(","), ord(":")
CLOSE_OF = {"{": ord("}"), "[": ord("]")}


class BrokenDocument(ValueError):
    """A document that is no sequence of whole JSON objects."""


@dataclass(frozen=True)
class Part:
    path: str
    size: int


def parts_of(path: str) -> list[Part]:
    """The files of a document in order: ``path`` itself, or the data files directly below it by name."""
    from pyarrow import fs
    where, name = filesystem(path)
    info = where.get_file_info(name)
    if info.type == fs.FileType.File:
        return [Part(path, info.size)]
    found = [f for f in where.get_file_info(fs.FileSelector(name)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
    base = path.rstrip("/")
    return [Part(f"{base}/{f.base_name}", f.size) for f in sorted(found, key=lambda f: f.base_name)]


class Bytes:
    """A document's bytes by offset, over its parts."""

    def __init__(self, parts: Sequence[Part]):
        self.parts = parts
        self.starts = np.concatenate([[0], np.cumsum([p.size for p in parts])]).astype(np.int64)
        self.size = int(self.starts[-1])
        self.open: tuple[int, object] | None = None

    def read(self, start: int, end: int) -> bytes:
        out, start, end = [], max(0, start), min(end, self.size)
        while start < end:
            i = int(np.searchsorted(self.starts, start, "right")) - 1
            if self.open is None or self.open[0] != i:
                where, name = filesystem(self.parts[i].path)
                self.open = i, where.open_input_file(name)
            stop = min(end, int(self.starts[i + 1]))
            self.open[1].seek(start - int(self.starts[i]))
            data = self.open[1].read(stop - start)
            if not data:
                raise BrokenDocument(f"{self.parts[i].path} ended early")
            out.append(data)
            start += len(data)
        return b"".join(out)


@dataclass(frozen=True)
class State:
    """Where a byte is: inside a string, behind a backslash of it, and how many brackets deep."""
    in_string: bool = False
    escaped: bool = False
    depth: int = 0


def structure(data: bytes, state: State) -> tuple[np.ndarray, np.ndarray, np.ndarray, State]:
    """(places, bytes, depths before them) of the brackets, commas and colons outside strings, and the state behind ``data``."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        empty = np.empty(0, np.int64)
        return empty, empty.astype(np.uint8), empty, state
    quotes = np.flatnonzero(raw == 34)
    escaped = False
    if state.escaped or b"\\" in data:
        plain = np.flatnonzero(raw != 92)
        before = np.searchsorted(plain, quotes) - 1  # the last byte before a quote that is no backslash
        at = np.where(before >= 0, plain[np.maximum(before, 0)], -1) if len(plain) else np.full(len(quotes), -1)
        run = quotes - 1 - at + np.where(at < 0, int(state.escaped), 0)
        quotes = quotes[run % 2 == 0]
        last = int(plain[-1]) if len(plain) else -1
        escaped = bool((len(raw) - 1 - last + (int(state.escaped) if last < 0 else 0)) % 2)
    places = np.flatnonzero(STRUCTURE[raw])
    inside = (np.searchsorted(quotes, places) + int(state.in_string)) % 2
    places = places[inside == 0]
    found = raw[places]
    step = DEEPER[found].astype(np.int64)
    depth = state.depth + np.cumsum(step)
    in_string = bool((len(quotes) + int(state.in_string)) % 2)
    return places, found, depth - step, State(in_string, escaped and in_string, int(depth[-1]) if len(depth) else state.depth)


def name_before(data: bytes, colon: int) -> str | None:
    """The string that ends before the colon at ``colon`` of ``data``; None if it begins before ``data``."""
    end = len(data[:colon].rstrip(b" \t\r\n")) - 1
    if end < 0 or data[end] != 34:
        return None
    start = end
    while True:
        start = data.rfind(b'"', 0, start)
        if start < 0:
            return None
        slashes = len(data[:start]) - len(data[:start].rstrip(b"\\"))
        if slashes % 2 == 0:
            try:
                return json.loads(data[start:end + 1], strict=False)
            except ValueError:  # a wrong beginning took text for structure
                return None


def summary(source: Bytes, start: int, end: int, state: State) -> dict:
    """How a chunk ends if it begins in ``state`` (its depth counts as 0): the state behind it, its least depth, and for the least depth
    and the one above the last name before a colon there and the last bracket opened from there."""
    names: dict[int, str] = {}
    opened: dict[int, str | None] = {}
    least = 0
    ahead = source.read(start - NAME_BYTES, start)
    data = source.read(start, end)
    places, found, depth, after = structure(data, state)
    if len(depth):
        least = min(0, int((depth + DEEPER[found]).min()))
    for level in (least, least + 1):
        at = np.flatnonzero((depth == level) & (found == COLON))
        bracket = np.flatnonzero((depth == level) & (DEEPER[found] > 0))
        if len(at):
            colon = int(places[at[-1]])
            held = ahead + data[:colon + 1] if colon < NAME_BYTES else data[colon - NAME_BYTES:colon + 1]
            name = name_before(held, len(held) - 1)
            if name is not None:
                names[level] = name
            # A bracket belongs to the name if it is behind it.
            opened[level] = chr(found[bracket[-1]]) if len(bracket) and bracket[-1] > at[-1] else None
        elif len(bracket):
            opened[level] = chr(found[bracket[-1]])
    return {"in_string": after.in_string, "escaped": after.escaped, "depth": after.depth, "least": least,
            "names": {str(k): v for k, v in names.items()}, "opened": {str(k): v for k, v in opened.items()}}


BEGINNINGS = (State(), State(True), State(True, True))


@dataclass(frozen=True)
class Chunk:
    """A chunk and its true beginning: state, the member at hand and the bracket its value opened (None: not yet, or plain)."""
    document: str
    number: int
    start: int
    end: int
    state: State
    member: str | None
    bracket: str | None


def chained(document: str, chunks: list[tuple[int, int, list[dict]]], size: int) -> list[Chunk]:
    """True beginnings of a document's chunks (start, end, summaries by beginning) in order; BrokenDocument if it does not end well."""
    state, member, bracket, out = State(), None, None, []
    for number, (start, end, ways) in enumerate(chunks):
        out.append(Chunk(document, number, start, end, state, member, bracket))
        way = ways[BEGINNINGS.index(State(state.in_string, state.escaped))]
        if state.depth + way["least"] < 0:
            raise BrokenDocument(f"{document}: a bracket too many")
        level = str(1 - state.depth)
        if level in way["names"]:
            member, bracket = way["names"][level], way["opened"].get(level)
        elif level in way["opened"]:
            bracket = way["opened"][level]
        state = State(way["in_string"], way["escaped"], state.depth + way["depth"])
    if state.in_string or state.depth or not size:
        raise BrokenDocument(f"{document}: ends inside of a string or bracket" if size else f"{document}: empty")
    return out


ENTRY = re.compile(r'\s*("(?:[^"\\]|\\.)*+")\s*:\s*', re.S)


def elements(source: Bytes, chunk: Chunk) -> Iterator[tuple[str, str | None, int, str | None]]:
    """(member, entry, number, value's text) of the elements that begin in ``chunk``; of an object member's
    elements ``entry`` is their name, a plain member is one element.  Each member begins with a row without a value."""
    member, bracket = chunk.member, chunk.bracket
    base, data, state = chunk.start, source.read(chunk.start, chunk.end), chunk.state
    count, began, plain = 0, None, None  # offsets of an element's and a plain value's beginning

    def told(a: int, b: int):
        nonlocal count
        text = data[a - base:b - base].decode().strip()
        if not text:
            return None
        count += 1
        if bracket != "{":
            return member, None, count, text
        named = ENTRY.match(text)
        if not named:
            raise BrokenDocument(f"{chunk.document}: an entry of {member!r} without a name")
        return member, json.loads(named[1], strict=False), count, text[named.end():]

    at = chunk.start
    while True:
        places, found, depth, state = structure(data[at - base:], state)
        near = np.flatnonzero((depth <= 1) | ((depth == 2) & (DEEPER[found] <= 0) & (found != COLON)))
        for i in near.tolist():
            place, byte, level = at + int(places[i]), int(found[i]), int(depth[i])
            own = place < chunk.end
            if byte == COLON:
                if level == 1 and own:
                    held = source.read(place - NAME_BYTES, place + 1) if place - base < NAME_BYTES else data[place - base - NAME_BYTES:place - base + 1]
                    member, bracket, plain = name_before(held, len(held) - 1), None, place + 1
                    if member is None:
                        raise BrokenDocument(f"{chunk.document}: a value without a name, or with one of over {NAME_BYTES} bytes")
                    count += 1
                    yield member, None, count, None
            elif byte in OPENS:
                if level == 0 and byte != ord("{"):
                    raise BrokenDocument(f"{chunk.document}: not an object")
                if level == 1:
                    plain = None
                    if own:
                        bracket, began = chr(byte), place + 1
            else:  # the end of an element, a plain value, a member or an object
                if byte != COMMA and own and byte != CLOSE_OF.get(bracket if level == 2 else "{", byte):
                    raise BrokenDocument(f"{chunk.document}: a bracket closed by another kind")
                if level == 2 and began is not None:
                    row = told(began, place)
                    if row:
                        yield row
                    began = None
                if level == 1 and plain is not None:
                    text = data[plain - base:place - base].decode().strip()
                    count += 1
                    yield member, None, count, text
                    plain = None
                if byte == COMMA and level == 2 and own:
                    began = place + 1
            if not own and began is None and plain is None:
                return
        at = base + len(data)
        if (began is None and plain is None) or at >= source.size:
            if at >= chunk.end and (began is None and plain is None):
                return
            if at >= source.size:
                raise BrokenDocument(f"{chunk.document}: ends inside of an element")
        # Nothing before the element at hand is needed any more.
        keep = min(x for x in (began, plain) if x is not None)
        data = data[keep - base:] + source.read(at, at + READ_ON_BYTES)
        base = keep


def batches_of(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    fields = [("document", pa.string()), ("member", pa.string()), ("entry", pa.string()), ("pos", pa.int64()), ("value", pa.string())]
    schema, out, size = pa.schema(fields), [], 0
    for row in rows:
        out.append(row)
        size += len(row[-1] or "")
        if size > BATCH_BYTES or len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=schema)


def ways(source: Bytes, start: int, end: int) -> list[dict]:
    """A chunk's ``summary`` for each of the ``BEGINNINGS``."""
    plain, inside = (summary(source, start, end, state) for state in BEGINNINGS[:2])
    # An escape reaches no further than a first byte that is neither a quote nor a backslash.
    reaches = source.read(start, start + 1) in (b'"', b"\\")
    return [plain, inside, summary(source, start, end, BEGINNINGS[2]) if reaches else inside]


def chunk_size(spark: SparkSession, paths: Mapping[str, str], least: int) -> int:
    """Bytes of a chunk that give each slot of the cluster ``SLOT_CHUNKS`` of all documents: not under ``least``, nor over ``CHUNK_BYTES``
    (or ``least``), so that small documents are not cut into thousands of tasks and large ones are still read in bounded pieces."""
    total = sum(part.size for p in paths.values() for part in parts_of(p))
    wanted = -(-total // (SLOT_CHUNKS * spark.sparkContext.defaultParallelism))
    return max(least, min(wanted, CHUNK_BYTES))


def summaries(spark: SparkSession, parts: Mapping[str, list[Part]], chunk_bytes: int) -> dict[str, list[tuple[int, int, list[dict]]]]:
    """The first scan, one job over all documents: each one's chunks (start, end, summary of each beginning) in order."""
    pieces = [(d, s, min(s + chunk_bytes, size)) for d, p in parts.items() for size in [sum(x.size for x in p)] for s in range(0, size, chunk_bytes)]
    if not pieces:
        return {d: [] for d in parts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            told = [json.dumps(ways(Bytes(parts[r["document"]]), r["start"], r["end"])) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(told, pa.string())], names=["document", "start", "end", "ways"])

    chunks = spark.createDataFrame(pieces, "document string, start long, end long").repartition(len(pieces), "document", "start")
    out: dict[str, list] = {d: [] for d in parts}
    # A few values per chunk, as a file source's listing is.
    for r in chunks.mapInArrow(run, "document string, start long, end long, ways string").collect():
        out[r["document"]].append((r["start"], r["end"], json.loads(r["ways"])))
    return {d: sorted(c, key=lambda x: x[0]) for d, c in out.items()}


def read_documents(spark: SparkSession, paths: Mapping[str, str], chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """(rows, broken) of documents by name: document, member, entry, pos, value.

    An array member has a row per element, an object member one per entry (``entry`` is its name), a plain member one row; ``value`` is the
    JSON text as written.  Before them each member has a row without a value, so empty ones are told.  ``pos`` grows along a document
    (it is no count).  ``broken`` tells why a document is none, such as one that is cut; it gives no rows.  What is
    inside an element is not looked at.
    """
    ship_package(spark)
    parts = {d: parts_of(p) for d, p in paths.items()}
    chunks, broken = [], {}
    for d, found in summaries(spark, parts, chunk_bytes).items():
        try:
            chunks += chained(d, found, sum(p.size for p in parts[d]))
        except BrokenDocument as e:
            broken[d] = str(e)
    if not chunks:
        return spark.createDataFrame([], ROW_SCHEMA), broken
    rows = [(c.document, c.number, c.start, c.end, c.state.in_string, c.state.escaped, c.state.depth, c.member, c.bracket) for c in chunks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                chunk = Chunk(r["document"], r["number"], r["start"], r["end"], State(r["in_string"], r["escaped"], r["depth"]), r["member"], r["bracket"])
                source = Bytes(parts[chunk.document])
                yield from batches_of((chunk.document, m, e, (chunk.number << 32) + n, v) for m, e, n, v in elements(source, chunk))

    listed = spark.createDataFrame(rows, "document string, number long, start long, end long, in_string boolean, escaped boolean, depth long, member string, bracket string")
    return listed.repartition(len(rows), "document", "number").mapInArrow(run, ROW_SCHEMA), broken


def read_document(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of one document: member, entry, pos, value; a document that is none is an error."""
    rows, broken = read_documents(spark, {path: path}, chunk_bytes)
    if broken:
        raise BrokenDocument(next(iter(broken.values())))
    return rows.drop("document")


def member_table(rows: DataFrame, member: str, schema: str) -> DataFrame:
    """An array member's elements, or an object member as one row, with the columns of ``schema``; an element that does not fit is an error."""
    own = rows.filter((F.col("member") == member) & F.col("value").isNotNull())
    # Filters may be put in another order, so other members' rows are kept from the parser here.
    own = own.withColumn("value", F.when(F.col("member") == member, F.col("value")))
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")
    entries = own.filter(F.col("entry").isNotNull())
    if entries.isEmpty():
        return own.select(parsed).select("r.*")
    # An object's entries are put together again: as few as a report's figures.
    name = F.regexp_extract(F.to_json(F.struct("entry")), r'^\{"entry":(.*)\}$', 1)
    told = F.sort_array(F.collect_list(F.struct("pos", F.concat(name, F.lit(":"), "value").alias("text"))))
    whole = entries.agg(F.concat(F.lit("{"), F.array_join(told["text"], ","), F.lit("}")).alias("value"))
    return whole.select(parsed).select("r.*")


def entries_table(rows: DataFrame, member: str) -> DataFrame:
    """(dim, pos, code, label) of a member of lists or dictionaries (orders, labels): an order's label is its code."""
    own = rows.filter((F.col("member") == member) & F.col("entry").isNotNull())
    is_list = F.ltrim("value").startswith("[")
    listed = F.when(is_list, F.from_json("value", "array<string>"))
    codes = F.coalesce(listed, F.json_object_keys("value"))
    labels = F.coalesce(listed, F.map_values(F.from_json("value", "map<string,string>")))
    both = own.select(F.col("entry").alias("dim"), F.posexplode(F.arrays_zip(codes.alias("code"), labels.alias("label"))).alias("pos", "e"))
    return both.select("dim", "pos", "e.code", "e.label")
