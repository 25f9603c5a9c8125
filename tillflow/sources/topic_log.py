"""Topics as a log of committed batches, with positions: a streaming source and sink.

Below one root, files of messages are written by tasks, and a batch becomes
visible by one small manifest, which the driver writes when all its tasks are
done. A manifest names the run and the batch, the files with their topic,
partition, first position and number of messages, and what holds after it: the
end of every partition and the last batch of every run. So

* a batch that is run again finds its number in the log and adds nothing, whether
  the second try brought the same rows, others or none;
* a run with a new checkpoint is another run: it adds, and replaces nothing;
* a reader's offset is the number of a manifest and a position per partition;
  it opens the manifests since its last one, and the files these name for its topic.

Files of tries that were never committed are in no manifest. One job at a time
writes below a root; a second writer on a local or mounted file system gets the
next number, elsewhere the store must not let two jobs write one root.
"""

import json
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader,
    InputPartition, WriterCommitMessage,
)

from tillflow.sources.files import Folder

FORMAT = "tillflow_topics"
PARTITIONS = 4
_MESSAGE = "key string, value string, at bigint, position bigint, partition int"
_FILE = pa.schema([("key", pa.string()), ("value", pa.string()), ("at", pa.int64())])
_ROWS = pa.schema([*_FILE, ("position", pa.int64()), ("partition", pa.int32())])
_BEFORE_ALL = {"ends": {}, "runs": {}, "files": []}


# Messages of a file that are written at once.
_GROUP_BYTES = 4 << 20


def _places(rows: pa.Table, partitions: int) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """(topic, partition) with the rows that go there; a message without a key is dealt by its value."""
    texts = pc.fill_null(pc.coalesce(rows["key"], rows["value"]).cast(pa.binary()), b"")
    crc = [zlib.crc32(text) % partitions for text in texts.to_pylist()]
    dealt = pa.table({"topic": rows["topic"], "partition": pa.array(crc, pa.int32()), "row": pa.array(range(len(crc)), pa.int64())})
    for topic in pc.unique(dealt["topic"]).to_pylist():
        own = dealt.filter(pc.is_null(dealt["topic"]) if topic is None else pc.equal(dealt["topic"], topic))
        for partition in sorted(pc.unique(own["partition"]).to_pylist()):
            yield (topic, partition), own.filter(pc.equal(own["partition"], partition))["row"].combine_chunks()


# --- the log --------------------------------------------------------------------------


@dataclass
class MessageFile(WriterCommitMessage):
    """A file of messages of one partition of a topic."""

    topic: str
    partition: int
    path: str
    rows: int


class TopicLog:
    """The manifests below a root. Numbers start at 1; 0 is before all."""

    def __init__(self, root: str):
        self._folder = Folder(root)

    @staticmethod
    def _name(number: int) -> str:
        return f"commits/{number:020d}.json"

    def last(self) -> int:
        """The number of the last manifest. A hint spares listing; it may lag, never lead."""
        number = int(self._folder.text("commits/_last")) if self._folder.has("commits/_last") else 0
        while self._folder.has(self._name(number + 1)):
            number += 1
        return number

    def manifest(self, number: int) -> dict:
        return json.loads(self._folder.text(self._name(number))) if number else _BEFORE_ALL

    def commit(self, run: str, batch: int, files: list[MessageFile]) -> bool:
        """Adds a batch as a whole. False if the run has committed it before; its files are then removed."""
        while True:
            number = self.last()
            known = self.manifest(number)
            if known["runs"].get(run, -1) >= batch:
                self.discard(files)
                return False
            ends = {topic: dict(own) for topic, own in known["ends"].items()}
            placed = []
            for file in sorted(files, key=lambda f: (f.topic, f.partition, f.path)):
                own = ends.setdefault(file.topic, {})
                first = own.get(str(file.partition), 0)
                placed.append([file.topic, file.partition, file.path, file.rows, first])
                own[str(file.partition)] = first + file.rows
            text = json.dumps({
                "run": run, "batch": batch, "time": time.time_ns() // 1_000_000, "files": placed, "ends": ends,
                "runs": known["runs"] | {run: batch},
            })
            if self._folder.put(self._name(number + 1), text, only_new=True):
                self._folder.put("commits/_last", str(number + 1))
                return True

    def discard(self, files: list[MessageFile]) -> None:
        for file in files:
            self._folder.remove(file.path)

    def ends(self, topic: str, number: int) -> dict[str, int]:
        return self.manifest(number)["ends"].get(topic, {})

    def number_before(self, topic: str, positions: dict[str, int]) -> int:
        """The last manifest before which no message at or after ``positions`` came, by halving."""
        low, high = 0, self.last()
        while low < high:
            middle = (low + high + 1) // 2
            if all(end <= positions.get(p, 0) for p, end in self.ends(topic, middle).items()):
                low = middle
            else:
                high = middle - 1
        return low

    def since(self, topic: str, after: int, to: int, positions: dict[str, int]) -> list["Slice"]:
        """The parts of a topic's files that manifests ``after`` + 1 to ``to`` brought, from ``positions`` on."""
        found = []
        for number in range(after + 1, to + 1):
            known = self.manifest(number)
            for name, partition, path, rows, first in known["files"]:
                skip = max(0, positions.get(str(partition), 0) - first)
                if name == topic and skip < rows:
                    found.append(Slice(path, partition, first, skip, known["time"]))
        return found

    # --- files of messages ---

    def write(self, batches: Iterator[pa.RecordBatch], partitions: int) -> list[MessageFile]:
        """Writes a task's messages, a file for each topic and partition, and names them."""
        open_files: dict[tuple[str, int], tuple[MessageFile, pq.ParquetWriter]] = {}
        waiting: dict[tuple[str, int], list[pa.Table]] = {}
        try:
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                named = rows.select(["key", "value", "at"]).cast(_FILE)
                for place, own in _places(rows, partitions):
                    if place not in open_files:
                        path = f"data/{uuid.uuid4().hex}.parquet"
                        self._folder.store.create_dir(self._folder.at("data"), recursive=True)
                        writer = pq.ParquetWriter(
                            self._folder.at(path), _FILE, compression="zstd", filesystem=self._folder.store
                        )
                        open_files[place] = (MessageFile(*place, path, 0), writer)
                    file, writer = open_files[place]
                    waiting.setdefault(place, []).append(named.take(own))
                    file.rows += len(own)
                    if sum(t.nbytes for t in waiting[place]) >= _GROUP_BYTES:
                        writer.write_table(pa.concat_tables(waiting.pop(place)))
            for place, tables in waiting.items():
                open_files[place][1].write_table(pa.concat_tables(tables))
        finally:
            for _, writer in open_files.values():
                writer.close()
        return [file for file, _ in open_files.values()]

    def read(self, part: "Slice") -> Iterator[pa.RecordBatch]:
        at = 0
        with self._folder.store.open_input_file(self._folder.at(part.path)) as file:
            for batch in pq.ParquetFile(file).iter_batches():
                begin = max(0, part.skip - at)
                if begin < batch.num_rows:
                    own = batch.slice(begin)
                    place = pa.array(range(part.first + at + begin, part.first + at + batch.num_rows), pa.int64())
                    when = own["at"].fill_null(part.time)
                    number = pa.array([part.partition] * own.num_rows, pa.int32())
                    yield pa.RecordBatch.from_arrays([own["key"], own["value"], when, place, number], schema=_ROWS)
                at += batch.num_rows


@dataclass
class Slice(InputPartition):
    """What a task reads: a file from its ``skip``-th message on."""

    path: str
    partition: int
    first: int
    skip: int
    time: int


# --- source and sink ------------------------------------------------------------------


@dataclass
class _Files(WriterCommitMessage):
    files: list[MessageFile]


class _Sink:
    def __init__(self, options: dict[str, str]):
        self._options, self._log = options, TopicLog(options["path"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _Files(self._log.write(iterator, int(self._options.get("partitions", PARTITIONS))))

    def _commit(self, messages, batch: int) -> None:
        self._log.commit(self._options["run"], batch, [f for m in messages if m for f in m.files])

    def _abort(self, messages) -> None:
        self._log.discard([f for m in messages if m for f in m.files])


class _BatchSink(_Sink, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self._commit(messages, int(self._options["batch"]))

    def abort(self, messages) -> None:
        self._abort(messages)


class _StreamSink(_Sink, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self._commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._abort(messages)


class _Source:
    def __init__(self, options: dict[str, str]):
        self._options, self._log = options, TopicLog(options["path"])
        self._topic = options["topic"]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self._log.read(partition)

    def _offset(self, number: int) -> dict:
        return {"commit": number, "positions": dict(sorted(self._log.ends(self._topic, number).items()))}


class _BatchSource(_Source, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return self._log.since(self._topic, 0, self._log.last(), {})


class _StreamSource(_Source, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        starting = self._options.get("starting", "earliest")
        if starting == "earliest":
            return {"commit": 0, "positions": {}}
        if starting == "latest":
            return self._offset(self._log.last())
        given = {str(p): int(at) for p, at in json.loads(starting).items()}
        return {"commit": self._log.number_before(self._topic, given), "positions": dict(sorted(given.items()))}

    def latestOffset(self) -> dict:
        return self._offset(self._log.last())

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return self._log.since(self._topic, start["commit"], end["commit"], start["positions"])


class TopicLogSource(DataSource):
    """Options: ``path``; to read ``topic`` and ``starting``; to write ``run``, ``partitions`` and, in batch, ``batch``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _MESSAGE

    def reader(self, schema) -> DataSourceReader:
        return _BatchSource(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamSource(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchSink(self.options)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamSink(self.options)


# --- for users ------------------------------------------------------------------------


def run_of(checkpoint: str) -> str:
    """The run a checkpoint stands for: made when the checkpoint is first used, and gone with it."""
    folder = Folder(checkpoint)
    folder.put("run", f"r{uuid.uuid4().hex}", only_new=True)
    return folder.text("run")


def read_positions(
    spark: SparkSession, root: str, topic: str, starting: str | dict[int, int] = "earliest"
) -> DataFrame:
    """A topic as a stream from ``earliest``, ``latest`` or given positions (partition to position).

    ``starting`` counts on a query's first start; after that its checkpoint holds the positions.
    A partition without a given position starts at 0.
    """
    spark.dataSource.register(TopicLogSource)
    text = starting if isinstance(starting, str) else json.dumps({str(p): at for p, at in starting.items()})
    return spark.readStream.format(FORMAT).option("topic", topic).option("starting", text).load(root)


def read_committed(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All committed messages of a topic."""
    spark.dataSource.register(TopicLogSource)
    return spark.read.format(FORMAT).option("topic", topic).load(root)


def commit_batch(messages: DataFrame, root: str, run: str, batch: int, partitions: int = PARTITIONS) -> None:
    """Adds (topic, key, value, at) messages as one batch of a run; a batch that is there already stays as it is."""
    messages.sparkSession.dataSource.register(TopicLogSource)
    options = {"run": run, "batch": str(batch), "partitions": str(partitions)}
    messages.select("topic", "key", "value", "at").write.format(FORMAT).options(**options).mode("append").save(root)
