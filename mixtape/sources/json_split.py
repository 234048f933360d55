"""One playlist document read by many tasks.

A multi-line JSON document is one task for Spark's JSON reader, whatever its
size. Here the text reader deals it out in byte ranges, with ``}`` as record
separator, and two passes find the playlists:

1. Every range reports how many quotes it holds and how much deeper it ends,
   for both cases: that it starts outside a string and inside one. Sums over the
   ranges of a file then say how each range really starts (a row per range).
2. Every range is read again from that state. A playlist that lies inside a range
   comes out whole; of one that is cut by range ends, the pieces come out and are
   put together afterwards, by a shuffle of these pieces only.

Each playlist is then parsed by ``from_json`` with the explicit schema. White space,
field order, other fields, nested objects, escaped quotes and ``}`` in names are
all as in JSON. The root is one object with an array ``playlists``; other arrays
beside it don't count. One playlist is one row, as for the JSON reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mixtape import schemas
from mixtape.session import stage

ARRAY = "playlists"
#: Depth of the root's arrays: objects that open here are the records.
LEVEL = 2
SEPARATOR = "}"

_ESCAPE = re.compile(r"\\.", re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
# a string (the group is its end, empty if the text stops before) or a bracket; ``}`` ends a fragment
_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)("|$)|[{\[\]]', re.S)

WHOLE, HEAD, MIDDLE, TAIL, END = 0, 1, 2, 3, 9


def _parts(fragment: str) -> list[str]:
    """What lies between the quotes, escapes left out."""
    return (_ESCAPE.sub("", fragment) if "\\" in fragment else fragment).split('"')


def _deeper(parts: list[str], inside: int) -> int:
    """Levels that a fragment and its ``}`` add."""
    outside = "".join(parts[inside::2])
    return (outside.count("{") + outside.count("[") - outside.count("]")
            - ((len(parts) - 1 + inside) % 2 == 0))


def _fragments(batches: Iterator[pa.RecordBatch], columns: int):
    """((file, range, ...), iterator of values) for each run of rows of one range."""
    key, values = None, []
    for batch in batches:
        fields = [c.to_pylist() for c in batch.columns]
        for row in zip(*fields):
            if row[1:columns] != key:
                if key is not None:
                    yield key, values
                key, values = row[1:columns], []
            values.append(row[0])
            if len(values) >= 10_000:       # a range comes in bounded runs
                yield key, values
                values = []
    if key is not None and values:
        yield key, values


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[tuple, list[int]] = {}
    for key, values in _fragments(batches, 3):
        sums = found.setdefault(key, [0, 0, 0])
        quotes, deeper = sums[0], sums[1:]
        for fragment in values:
            parts = _parts(fragment)
            # the two cases swap at every odd number of quotes
            now = quotes % 2
            deeper[0] += _deeper(parts, now)
            deeper[1] += _deeper(parts, 1 - now)
            quotes += len(parts) - 1
        found[key] = [quotes, *deeper]
    if found:
        rows = [(*key, *sums) for key, sums in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                                         names=["file", "start", "quotes", "deeper_out", "deeper_in"])


class _Range:
    """Reads one range from its state on and hands out records and pieces of them."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth
        # the array that records lie in; None if it opened in an earlier range
        self.array = None if depth >= LEVEL else ""
        self.key = ""
        self.record: list[str] | None = [] if depth > LEVEL else None
        self.opened = False                 # whether the record began in this range

    def take(self, fragment: str):
        """A finished (kind, array, text), or None."""
        parts = _parts(fragment) if self.depth > LEVEL else None
        if parts and self.depth - sum(p.count("]") for p in parts[self.inside::2]) > LEVEL:
            # all of it lies inside the record
            self.depth += _deeper(parts, self.inside)
            self.inside = (self.inside + len(parts) - 1) % 2
            self.record.append(fragment)
        else:
            begin = self._scan(fragment)
            if not self.inside:
                self.depth -= 1
            if begin is not None:
                self.record, self.opened = [fragment[begin:]], True
            elif self.record is not None:
                self.record.append(fragment)
            elif self.depth > LEVEL:        # something else that is nested
                self.record, self.opened = [fragment], True
        if self.record is not None and self.depth == LEVEL and not self.inside:
            out = (WHOLE if self.opened else HEAD, self.array, SEPARATOR.join(self.record) + SEPARATOR)
            self.record, self.opened = None, False
            return out
        return None

    def _scan(self, fragment: str) -> int | None:
        """Goes through a fragment at the outer levels; where a record opens, if one does."""
        at, begin = 0, None
        if self.inside:
            end = _STRING_END.match(fragment)
            if not end:
                return None
            at, self.inside = end.end(), 0
        for token in _TOKEN.finditer(fragment, at):
            mark = token.group()[0]
            if mark == '"':
                self.key = token.group(1)
                self.inside = int(not token.group(2))
            elif mark == "]":
                self.depth -= 1
                if self.depth <= LEVEL:
                    self.record = None      # no object: an array inside an array
                if self.depth < LEVEL:
                    self.array = ""
            else:
                if mark == "[" and self.depth == LEVEL - 1:
                    self.array = self.key
                elif mark == "{" and self.depth == LEVEL and begin is None:
                    begin = token.start()
                self.depth += 1
        return begin

    def rest(self):
        """What the range ends in the middle of, and its array at the end."""
        if self.record is not None and (self.record or not self.opened):
            yield TAIL if self.opened else MIDDLE, self.array, "".join(f + SEPARATOR for f in self.record)
        yield END, self.array, None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
    rows, held, key, reader = [], 0, None, None

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema)],
                                          names=["file", "start", "kind", "array", "text"])

    for (file, start, inside, depth), values in _fragments(batches, 5):
        if (file, start) != key:
            if reader is not None:
                rows += [(*key, *r) for r in reader.rest()]
            key, reader = (file, start), _Range(inside, depth)
        for fragment in values:
            out = reader.take(fragment)
            if out is not None:
                rows.append((*key, *out))
                held += len(out[2])
                if held > 1 << 22:
                    yield batch()
                    rows, held = [], 0
    if reader is not None:
        rows += [(*key, *r) for r in reader.rest()]
    if rows:
        yield batch()


def _text(spark: SparkSession, path: str | list[str], recursive: bool) -> DataFrame:
    reader = spark.read.option("lineSep", SEPARATOR)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.text(path).select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("start"))


def ranges(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """(file, start, inside, depth): how each byte range begins. One row per range, which is
    tens of bytes for each ``spark.sql.files.maxPartitionBytes`` of input."""
    sums = _text(spark, path, recursive).mapInArrow(
        _summaries, "file string, start long, quotes long, deeper_out long, deeper_in long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    met = sums.withColumn("inside", inside)
    deeper = F.when(F.col("inside") == 0, F.col("deeper_out")).otherwise(F.col("deeper_in"))
    return (met.withColumn("_d", deeper)
            .select("file", "start", "inside", F.coalesce(F.sum("_d").over(before), F.lit(0)).cast("int").alias("depth")))


def read_playlists(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """(pid, tracks) of every playlist of the documents at a path (file, folder, glob)."""
    starts = stage(ranges(spark, path, recursive), "json-ranges")
    # broadcast, so that the rows of a range stay in their order
    met = _text(spark, path, recursive).join(F.broadcast(starts), ["file", "start"])
    found = stage(met.select("value", "file", "start", "inside", "depth")
                  .mapInArrow(_records, "file string, start long, kind int, array string, text string"), "json-records")
    # the array that is open where a range begins
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = (found.where(F.col("kind") == END)
              .select("file", "start", F.last("array", ignorenulls=True).over(before).alias("_open")))
    located = (found.where(F.col("kind") != END).join(F.broadcast(opened), ["file", "start"])
               .withColumn("array", F.coalesce("array", "_open")).drop("_open"))
    whole = located.where(F.col("kind") == WHOLE).select("array", "text")
    # pieces belong to the next head of their file
    order = Window.partitionBy("file").orderBy("start", "kind")
    head = F.when(F.col("kind") == HEAD, F.col("start"))
    after = F.first(head, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    pieces = located.where(F.col("kind") != WHOLE).withColumn("_group", F.coalesce(head, after)).where(F.col("_group").isNotNull())
    joined = (pieces.groupBy("file", "_group")
              .agg(F.array_sort(F.collect_list(F.struct("start", "array", "text"))).alias("_p"))
              .select(F.col("_p")[0]["array"].alias("array"), F.array_join(F.transform("_p", lambda p: p["text"]), "").alias("text")))
    return (whole.unionByName(joined).where(F.col("array") == ARRAY)
            .select(F.from_json("text", schemas.PLAYLIST).alias("_r")).select("_r.*"))


def flatten_documents(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """Documents -> one row per (playlist, track), as ``json_slices.flatten_slices`` gives them."""
    rows = read_playlists(spark, path, recursive).select("pid", F.inline("tracks"))
    return rows.select(F.col("pid").alias("playlist_id"), *schemas.TRACK.names)


HEAD_LINES, LAST_LINE = '{"info": {"version": "v}1"},\n"playlists": [', "]}"


def write_document(rows: DataFrame, path: str) -> str:
    """Playlist-track rows as ONE document in a folder, a line per playlist: the shape of a large
    export. The lines are made by many tasks and stored; the one task that writes the document
    only passes them on, so it holds a line at a time."""
    fields = schemas.TRACK.names
    lists = rows.groupBy("playlist_id").agg(F.collect_list(F.struct(*fields)).alias("tracks"))
    lines = stage(lists.select(F.to_json(F.struct(F.col("playlist_id").alias("pid"), "tracks")).alias("value")), "document-lines")
    n = lines.count()
    if not n:
        lines.sparkSession.createDataFrame([(f"{HEAD_LINES}\n{LAST_LINE}",)], "value string").coalesce(1).write.text(path)
        return path
    # in a single partition these numbers are the lines' own
    at = F.monotonically_increasing_id()
    numbered = lines.coalesce(1).select(at.alias("_at"), "value")
    begin = F.when(F.col("_at") == 0, F.lit(HEAD_LINES + "\n")).otherwise(F.lit(""))
    end = F.when(F.col("_at") == n - 1, F.lit("\n" + LAST_LINE)).otherwise(F.lit(","))
    numbered.select(F.concat(begin, "value", end).alias("value")).write.text(path)
    return path
