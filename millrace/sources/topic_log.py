"""A partitioned topic kept as files in the shared folder: a Python data source
that reads and writes records by (partition, offset), in batch and as a stream.

A topic is a folder with ``data/`` (parquet segments) and ``_log/`` (numbered
versions). A write gives its rows no offsets: tasks write segments, and the
commit deals each partition's next offsets to its segments in task order. A
version names its new segments and the position of every partition before and
after, so the end of a topic is its newest version, and a range of offsets
takes the versions back to its start, not the whole history.

* Versions are created exclusively, so writers take turns and offsets have no
  gaps and no repeats. Segments of failed tasks are in no version.
* A stream's writer commits a micro-batch once: each version carries the last
  batch of every named writer, and a replayed batch is dropped.
* Offsets of a reading stream are its checkpoint's, so a restart goes on where
  the last batch ended. ``maxOffsetsPerTrigger`` bounds a micro-batch, shared
  evenly by the partitions.
* ``expire`` forgets whole segments older than a time; reading what is gone is
  an error unless ``failOnDataLoss`` is ``false``.

The folder must be a path that driver and executors mount (``file:`` or plain).
"""

from __future__ import annotations

import json
import os
import uuid
from collections import namedtuple
from collections.abc import Mapping
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery

FORMAT = "topic_log"
RECORD = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
SEGMENT_ROWS = 1 << 20  # rows of a segment before the next is begun
GROUP_ROWS = 1 << 16  # rows of a row group, the least a reading task skips
HELD_BYTES = 64 << 20  # rows a writing task holds back over all partitions
TASK_ROWS = 1 << 20  # rows of one reading task at most

STORED = pa.schema(
    [("key", pa.string()), ("value", pa.string()), ("timestamp", pa.timestamp("us", tz="UTC"))]
)
READ = pa.schema(
    [
        ("key", pa.string()),
        ("value", pa.string()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
    ]
)

# A segment holds offsets base to base + rows - 1. Its times are from low to high
# in microseconds (null without any); untimed says that some record has none.
Segment = namedtuple("Segment", "file partition base rows low high untimed")


def _micros(value: datetime) -> int:
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    gap = value - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (gap.days * 86_400 + gap.seconds) * 1_000_000 + gap.microseconds


class TopicFolder:
    """The versions of one topic."""

    def __init__(self, path: str, topic: str):
        if path.startswith("file:"):
            path = "/" + path[len("file:") :].lstrip("/")
        if "://" in path:
            raise ValueError(f"a topic log needs a mounted folder, not {path}")
        if not topic or "/" in topic or topic.startswith("."):
            raise ValueError(f"no name for a topic: {topic!r}")
        self.topic, self.root = topic, f"{path.rstrip('/')}/{topic}"
        self.log, self.data = f"{self.root}/_log", f"{self.root}/data"

    def newest(self) -> int:
        """Number of the newest version, -1 for an empty topic."""
        try:
            return max((int(n[:-5]) for n in os.listdir(self.log) if n.endswith(".json")), default=-1)
        except FileNotFoundError:
            return -1

    def version(self, number: int) -> dict:
        if number < 0:
            return {"next": {}, "start": {}, "writers": {}, "segments": []}
        with open(f"{self.log}/{number:020d}.json", encoding="utf-8") as file:
            return json.load(file)

    def ends(self) -> dict[str, int]:
        return self.version(self.newest())["next"]

    def starts(self) -> dict[str, int]:
        return self.version(self.newest())["start"]

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        """Segments that meet the offsets from ``start`` up to before ``end``."""
        found, number = [], self.newest()
        while number >= 0:
            version = self.version(number)
            for fields in version["segments"]:
                part = Segment(*fields)
                p = str(part.partition)
                if part.base < end.get(p, 0) and part.base + part.rows > start.get(p, 0):
                    found.append(part)
            if all(version["before"].get(p, 0) <= start.get(p, 0) for p in end):
                break
            number -= 1
        return sorted(found, key=lambda s: (s.partition, s.base))

    def commit(self, written: list[tuple], writer: str | None = None, batch: int | None = None) -> bool:
        """Add segments ``(file, partition, rows, low, high, untimed)``; False for a
        batch that its writer has committed before."""

        def grown(old: dict) -> dict | None:
            if writer is not None and old["writers"].get(writer, -1) >= batch:
                return None
            ends, parts = dict(old["next"]), []
            for file, partition, rows, *times in written:
                base = ends.get(str(partition), 0)
                parts.append([file, partition, base, rows, *times])
                ends[str(partition)] = base + rows
            writers = {**old["writers"], **({} if writer is None else {writer: batch})}
            starts = {p: old["start"].get(p, 0) for p in ends}
            return {"before": old["next"], "next": ends, "start": starts,
                    "writers": writers, "segments": parts}

        return self._append(grown)

    def expire(self, before: datetime) -> dict[str, int]:
        """Forget the leading segments of each partition whose records are all
        older than ``before``; gives the new first offsets. A segment with a
        record without a time stays."""
        cut, gone = _micros(before), []

        def raised(old: dict) -> dict:
            gone.clear()
            starts, blocked = dict(old["start"]), set()
            for part in self.segments(old["start"], old["next"]):
                if part.untimed or part.high >= cut or part.partition in blocked:
                    blocked.add(part.partition)
                    continue
                starts[str(part.partition)] = part.base + part.rows
                gone.append(part.file)
            return {"before": old["next"], "next": old["next"], "start": starts,
                    "writers": old["writers"], "segments": []}

        self._append(raised)
        for file in gone:
            os.remove(f"{self.data}/{file}")
        return self.starts()

    def _append(self, change) -> bool:
        os.makedirs(self.log, exist_ok=True)
        while True:
            number = self.newest()
            version = change(self.version(number))
            if version is None:
                return False
            draft = f"{self.log}/.{uuid.uuid4().hex}"
            with open(draft, "w", encoding="utf-8") as file:
                json.dump(version, file)
                file.flush()
                os.fsync(file.fileno())
            try:
                os.link(draft, f"{self.log}/{number + 1:020d}.json")
                return True
            except FileExistsError:
                continue  # another writer came first: deal the offsets anew
            finally:
                os.remove(draft)

    def first_at(self, cut: int) -> dict[str, int]:
        """For each partition the first offset whose time is ``cut`` or later,
        the end where there is none. One column of one segment a partition is read."""
        newest = self.version(self.newest())
        at = dict(newest["next"])
        open_ = set(at)
        for part in self.segments(newest["start"], newest["next"]):
            p = str(part.partition)
            if p not in open_ or part.high is None or part.high < cut:
                continue
            times = pq.read_table(f"{self.data}/{part.file}", columns=["timestamp"])["timestamp"]
            hit = pc.index(pc.fill_null(pc.greater_equal(times.cast(pa.int64()), cut), False), True)
            at[p] = part.base + hit.as_py()
            open_.discard(p)
        return at


def _pieces(parts: list[Segment], start: dict, end: dict) -> list[InputPartition]:
    """Reading tasks: at most ``TASK_ROWS`` rows of one segment each."""
    out = []
    for part in parts:
        p = str(part.partition)
        low = max(start.get(p, 0), part.base) - part.base
        high = min(end.get(p, 0), part.base + part.rows) - part.base
        for at in range(low, high, TASK_ROWS):
            piece = (part.file, part.partition, part.base, at, min(at + TASK_ROWS, high))
            out.append(InputPartition(piece))
    return out


def _read(folder: TopicFolder, partition: InputPartition | None):
    """Record batches of rows ``low`` up to before ``high`` of a segment; row
    groups outside are skipped."""
    if partition is None:  # an empty range has one task without rows
        return
    file, number, base, low, high = partition.value
    reader = pq.ParquetFile(f"{folder.data}/{file}")
    at, groups, first = 0, [], None
    for g in range(reader.num_row_groups):
        rows = reader.metadata.row_group(g).num_rows
        if at < high and at + rows > low:
            groups.append(g)
            first = at if first is None else first
        at += rows
    at = first or 0
    for batch in reader.iter_batches(batch_size=GROUP_ROWS, row_groups=groups):
        skip = max(low - at, 0)
        rows = batch.slice(skip, max(min(high - at, batch.num_rows) - skip, 0))
        if rows.num_rows:
            n = rows.num_rows
            offset = base + at + skip
            yield pa.RecordBatch.from_arrays(
                [
                    rows["key"], rows["value"], pa.repeat(folder.topic, n),
                    pa.repeat(pa.scalar(number, pa.int32()), n),
                    pa.array(range(offset, offset + n), pa.int64()),
                    rows["timestamp"].cast(READ.field("timestamp").type),
                ],
                schema=READ,
            )
        at += batch.num_rows


def _start(folder: TopicFolder, options: Mapping[str, str], default: str) -> dict[str, int]:
    """First offsets by the options; partitions that come later begin at 0."""
    when = options.get("startingTimestamp")
    if when:
        return folder.first_at(_micros(datetime.fromisoformat(when)))
    where = options.get("startingOffsets", default)
    if where == "earliest":
        return folder.starts()
    if where == "latest":
        return folder.ends()
    return {str(int(p)): int(n) for p, n in json.loads(where).items()}


def _checked(folder: TopicFolder, start: dict, strict: bool) -> dict[str, int]:
    """``start`` moved to what is still there, or an error if that loses records."""
    kept = folder.starts()
    lost = {p: (start.get(p, 0), n) for p, n in kept.items() if start.get(p, 0) < n}
    if lost and strict:
        raise ValueError(f"offsets of {folder.topic} have expired (asked, first kept): {lost}")
    return {p: max(start.get(p, 0), n) for p, n in kept.items()}


class LogReader(DataSourceReader):
    """A bounded read. Comparisons of partition, offset and timestamp leave out
    segments and offsets; Spark applies all filters to the rows again."""

    def __init__(self, folder: TopicFolder, options: Mapping[str, str]):
        self.folder, self.options, self.filters = folder, options, []

    def pushFilters(self, filters):
        self.filters = list(filters)
        return iter(self.filters)

    def partitions(self):
        strict = self.options.get("failOnDataLoss", "true") != "false"
        start = _start(self.folder, self.options, "earliest")
        start = _checked(self.folder, start, strict)
        end = self.folder.ends()
        if "endingOffsets" in self.options:
            asked = {str(int(p)): int(n) for p, n in json.loads(self.options["endingOffsets"]).items()}
            end = {p: min(n, asked.get(p, n)) for p, n in end.items()}
        low, high, only = None, None, None
        for f in self.filters:
            name = ".".join(getattr(f, "attribute", ()))
            if name == "partition" and isinstance(f, EqualTo | In):
                values = f.value if isinstance(f, In) else (f.value,)
                only = set(values) if only is None else only & set(values)
            elif name == "offset" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                start = {p: max(n, f.value) for p, n in start.items()}
            if name == "offset" and isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                end = {p: min(n, f.value + 1) for p, n in end.items()}
            if name == "timestamp" and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                low = max(_micros(f.value), low) if low is not None else _micros(f.value)
            if name == "timestamp" and isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                high = min(_micros(f.value), high) if high is not None else _micros(f.value)
        if only is not None:
            end = {p: n for p, n in end.items() if int(p) in only}
        parts = self.folder.segments(start, end)
        # A comparison drops records without a time.
        if low is not None:
            parts = [s for s in parts if s.high is not None and s.high >= low]
        if high is not None:
            parts = [s for s in parts if s.low is not None and s.low <= high]
        return _pieces(parts, start, end)

    def read(self, partition):
        return _read(self.folder, partition)


class LogStreamReader(DataSourceStreamReader):
    """A stream over the topic's offsets, ``{partition: next offset}``."""

    def __init__(self, folder: TopicFolder, options: Mapping[str, str]):
        self.folder, self.options = folder, options
        self.cap = int(options.get("maxOffsetsPerTrigger", 0))
        self.strict = options.get("failOnDataLoss", "true") != "false"
        self.begun, self.position = None, None

    def initialOffset(self):
        if self.begun is None:
            self.begun = _start(self.folder, self.options, "latest")
        return self.begun

    def latestOffset(self):
        ends = self.folder.ends()
        if not self.cap:
            return ends
        # Of a checkpoint, ``partitions`` has told the position.
        at = self.position if self.position is not None else self.initialOffset()
        kept = self.folder.starts()
        behind = [p for p, n in ends.items() if n > at.get(p, 0)]
        share = max(1, self.cap // max(1, len(behind)))
        return {
            **at,
            **{p: min(n, max(at.get(p, 0), kept.get(p, 0)) + share) for p, n in ends.items()},
        }

    def partitions(self, start, end):
        self.position = end
        if start == end:
            return []
        asked = _checked(self.folder, {**{p: 0 for p in end}, **start}, self.strict)
        return _pieces(self.folder.segments(asked, end), asked, end)

    def read(self, partition):
        return _read(self.folder, partition)


class Written(WriterCommitMessage):
    """The segments of one task."""

    def __init__(self, segments: list[tuple]):
        self.segments = segments


def _write(folder: TopicFolder, batches) -> Written:
    """Rows of one task as segments, one open file a partition at most. Rows are
    held back until there are a row group's worth of a partition, or
    ``HELD_BYTES`` of all."""
    held: dict[int, list] = {}
    files: dict[int, list] = {}  # partition: [writer, name, rows, low, high, untimed]
    done, size = [], 0

    def close(p: int) -> None:
        writer, name, rows, low, high, untimed = files.pop(p)
        writer.close()
        done.append((name, p, rows, low, high, untimed))

    def flush(p: int) -> None:
        table = pa.Table.from_batches(held.pop(p), STORED)
        if p not in files:
            name = f"{p}-{uuid.uuid4().hex}.parquet"
            files[p] = [pq.ParquetWriter(f"{folder.data}/{name}", STORED), name, 0, None, None, False]
        state = files[p]
        state[0].write_table(table, row_group_size=GROUP_ROWS)
        state[2] += table.num_rows
        times = table["timestamp"]
        state[5] = state[5] or times.null_count > 0
        if times.null_count < table.num_rows:
            ends = pc.min_max(times.cast(pa.int64())).as_py()
            state[3] = ends["min"] if state[3] is None else min(state[3], ends["min"])
            state[4] = ends["max"] if state[4] is None else max(state[4], ends["max"])
        if state[2] >= SEGMENT_ROWS:
            close(p)

    os.makedirs(folder.data, exist_ok=True)
    for batch in batches:
        rows = pa.RecordBatch.from_arrays([batch[n].cast(STORED.field(n).type) for n in STORED.names],
                                          schema=STORED)
        numbers = batch["partition"]
        if numbers.null_count:
            raise ValueError("a record without a partition")
        for p in pc.unique(numbers).to_pylist():
            part = rows.filter(pc.equal(numbers, p))
            held.setdefault(p, []).append(part)
            size += part.nbytes
            if sum(b.num_rows for b in held[p]) >= GROUP_ROWS:
                size -= sum(b.nbytes for b in held[p])
                flush(p)
        if size > HELD_BYTES:
            for p in list(held):
                flush(p)
            size = 0
    for p in list(held):
        flush(p)
    for p in list(files):
        close(p)
    return Written(done)


def _remove(folder: TopicFolder, messages) -> None:
    for message in messages:
        for segment in message.segments if message is not None else ():
            if os.path.exists(f"{folder.data}/{segment[0]}"):
                os.remove(f"{folder.data}/{segment[0]}")


def _segments(messages) -> list[tuple]:
    return [s for message in messages if message is not None for s in message.segments]


class LogWriter(DataSourceArrowWriter):
    def __init__(self, folder: TopicFolder):
        self.folder = folder

    def write(self, iterator):
        return _write(self.folder, iterator)

    def commit(self, messages):
        self.folder.commit(_segments(messages))

    def abort(self, messages):
        _remove(self.folder, messages)


class LogStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, folder: TopicFolder, writer: str):
        self.folder, self.writer = folder, writer

    def write(self, iterator):
        return _write(self.folder, iterator)

    def commit(self, messages, batchId):
        if not self.folder.commit(_segments(messages), self.writer, batchId):
            _remove(self.folder, messages)

    def abort(self, messages, batchId):
        _remove(self.folder, messages)


class TopicLogSource(DataSource):
    """Options: ``path``, ``topic``; reading: ``startingOffsets`` (``earliest``,
    ``latest`` or JSON by partition), ``startingTimestamp`` (ISO), ``endingOffsets``
    (JSON, batch), ``maxOffsetsPerTrigger``, ``failOnDataLoss``; a stream's
    writing: ``writer``, the name under which its batches are counted."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return RECORD

    def _folder(self) -> TopicFolder:
        return TopicFolder(self.options["path"], self.options["topic"])

    def reader(self, schema):
        return LogReader(self._folder(), self.options)

    def streamReader(self, schema):
        return LogStreamReader(self._folder(), self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a topic is only appended to")
        return LogWriter(self._folder())

    def streamWriter(self, schema, overwrite):
        name = self.options.get("writer")
        if not name:
            raise ValueError("a stream into a topic needs a writer name, the same after a restart")
        return LogStreamWriter(self._folder(), name)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TopicLogSource)


def records(df: DataFrame, partitions: int, partition: Column | None = None) -> DataFrame:
    """``key, value, partition, timestamp`` of topic records. Without a partition
    given it is the hash of the key; records without a key are spread by value."""
    spread = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions))
    chosen = (partition if partition is not None else spread).cast("int")
    when = F.col("timestamp") if "timestamp" in df.columns else F.current_timestamp()
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        chosen.alias("partition"),
        when.cast("timestamp").alias("timestamp"),
    )


def append(
    df: DataFrame,
    path: str,
    topic: str,
    partitions: int = 8,
    partition: Column | None = None,
    order: list[str] | None = None,
    tasks: int | None = None,
) -> None:
    """Append rows of ``key, value`` (and ``timestamp``) to a topic.

    With ``order`` (columns of ``df``) offsets rise in that order within each
    partition: rows are cut at ranges of (partition, order), so a partition that
    holds most rows is still written by many tasks. Without it nothing is
    shuffled and offsets follow the input's order.
    """
    register(df.sparkSession)
    rows = records(df, partitions, partition)
    if order:
        keyed = df.withColumn("__p", partition if partition is not None else F.pmod(
            F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)))
        cut = ["__p", *order]
        keyed = keyed.repartitionByRange(tasks, *cut) if tasks else keyed.repartitionByRange(*cut)
        rows = records(keyed.sortWithinPartitions(*cut), partitions, F.col("__p"))
    rows.write.format(FORMAT).option("path", path).option("topic", topic).mode("append").save()


def read_log(spark: SparkSession, path: str, topic: str, **options: str) -> DataFrame:
    """The topic's records as a table."""
    register(spark)
    reader = spark.read.format(FORMAT).option("path", path).option("topic", topic)
    return reader.options(**options).load()


def log_stream(
    spark: SparkSession,
    path: str,
    topic: str,
    start: str = "latest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """The topic as a stream, with the columns and options of ``ingest.topic_stream``."""
    register(spark)
    reader = spark.readStream.format(FORMAT).option("path", path).option("topic", topic)
    reader = reader.option("startingOffsets", start).options(**options)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets))
    return reader.load()


def start_log_sink(
    df: DataFrame,
    path: str,
    topic: str,
    checkpoint: str,
    writer: str,
    partitions: int = 8,
    partition: Column | None = None,
    interval: str | None = "10 seconds",
) -> StreamingQuery:
    """Start a stream of ``key, value`` records into a topic; every micro-batch is
    there once, also after a restart. ``interval=None`` takes what is there and stops."""
    register(df.sparkSession)
    out = records(df, partitions, partition).writeStream.format(FORMAT)
    out = out.option("path", path).option("topic", topic).option("writer", writer)
    out = out.option("checkpointLocation", checkpoint)
    if interval is None:
        return out.trigger(availableNow=True).start()
    return out.trigger(processingTime=interval).start()
