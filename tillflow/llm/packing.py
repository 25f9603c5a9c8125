"""Best-fit packing of token sequences, online and in bounded space.

Tokenizing and packing are two passes. The first turns each text into pieces of
at most ``capacity`` ids and keeps of them only what identifies them. The second
deals the pieces by hash over tasks; each task packs its stream with a fixed
number of open bins.
"""

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import staged

CAPACITY = 1024
END_ID = 2
# Bins that may stay open in a task, and pieces sorted longest first before they are packed.
OPEN_BINS = 4096
LOOK_AHEAD = 8192
# Texts whose pieces are handed on together.
DOCS_AT_ONCE = 1024


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Token ids by a byte-level BPE.

    Reads a ``tokenizers`` JSON file and gives that library's ids without special
    tokens being added, several times as fast. An added token such as
    ``<|endoftext|>`` that stands in a text is that token, as it is there. A file
    that does anything else to a text is refused.
    """

    # How such tokenizers cut texts before merging; a fixed value.
    PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        self._refuse_others(known)
        special, letters = {x["content"]: x["id"] for x in known["added_tokens"]}, _byte_of_letter()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in known["model"]["vocab"].items() if token not in special
        }
        self._encoding = tiktoken.Encoding("bytes", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @staticmethod
    def _refuse_others(known: dict) -> None:
        cut, model = known.get("pre_tokenizer") or {}, known["model"]
        plain = (
            known.get("normalizer") is None
            and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
            and model.get("type", "BPE") == "BPE"
            and not any(model.get(name) for name in (
                "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"
            ))
            and not any(x.get(name) for x in known["added_tokens"] for name in ("single_word", "lstrip", "rstrip"))
        )
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        made = [model["vocab"][first + second] for first, second in pairs]
        if not plain or made != sorted(made):
            raise ValueError("not a plain byte-level BPE whose ids are in the order of its merges")

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode(text, allowed_special="all")


def _pieces(tokenizer: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteBpe(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part, rows = batch.slice(at, DOCS_AT_ONCE), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    tokens = np.array([*encoder.encode(text.as_py() or ""), end_id], "<u4")
                    cut = len(tokens) % capacity or min(capacity, len(tokens))
                    starts = [0, *range(cut, len(tokens), capacity)]
                    for piece, (at_id, to) in enumerate(zip(starts, [*starts[1:], len(tokens)], strict=True)):
                        rows.append((doc, piece, at_id, to - at_id, zlib.crc32(tokens[at_id:to].tobytes())))
                columns = [pa.array(c, t) for c, t in zip(
                    zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True
                )]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32"])
    return run


class OpenBins:
    """A fixed number of open bins, in a bitset keyed by free space.

    Bit f is set while some open bin has f places free, so the tightest bin for
    a piece is the lowest set bit from its length on. When too many are open, the
    fullest closes first.
    """

    def __init__(self, capacity: int, most: int):
        self._by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._bits, self._open, self._next = 0, 0, 0
        self._capacity, self._most = capacity, most

    def _take(self, free: int) -> int:
        bins = self._by_free[free]
        found = bins.pop()
        if not bins:
            self._bits ^= 1 << free
        self._open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """The number of the bin that gets the piece, and its place there."""
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            into = self._take(free)
        else:
            free, into, self._next = self._capacity, self._next, self._next + 1
        left = free - length
        if left:
            if not self._by_free[left]:
                self._bits |= 1 << left
            self._by_free[left].append(into)
            self._open += 1
            if self._open > self._most:
                self._take((self._bits & -self._bits).bit_length() - 1)
        return into, self._capacity - free


def _packer(capacity: int, open_bins: int, look_ahead: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, task = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40

        def pack(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.take(np.argsort(-rows["length"].to_numpy(), kind="stable"))
            placed = [bins.put(n) for n in rows["length"].to_pylist()]
            numbers, offsets = zip(*placed, strict=True)
            rows = rows.append_column("sequence_id", pa.array(np.array(numbers, np.int64) + task))
            yield from rows.append_column("offset", pa.array(offsets, pa.int64())).combine_chunks().to_batches()

        waiting, count = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, look_ahead):
                part = batch.slice(at, look_ahead)
                waiting.append(part)
                count += part.num_rows
                if count >= look_ahead:
                    yield from pack(pa.Table.from_batches(waiting))
                    waiting, count = [], 0
        if count:
            yield from pack(pa.Table.from_batches(waiting))
    return run


_PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) for the pieces of every text.

    A text's ids end with ``end_id``. Longer ones are cut: the remainder comes
    first, then full pieces. Null and empty texts are ``end_id`` alone.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end_id), _PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    look_ahead: int = LOOK_AHEAD,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Pieces of at most ``capacity`` ids are written, dealt by a hash of their place in
    the files over ``spark.sql.shuffle.partitions`` tasks and sorted there, so equal
    rows spread and a task that is run again packs alike. Each task sorts ``look_ahead`` pieces at a time, longest first, and
    puts each into the fullest open bin that has room; beyond ``open_bins`` open
    bins the fullest closes. Memory is bounded by these two numbers.

    Null and empty texts make one piece of ``end_id``; a very long text makes as many
    pieces as it takes, one after the other in memory. Repeated rows are packed as
    often as they come; pieces of one length go in the order they were dealt. Rows
    without an id are packed like others. Other columns aren't read. An empty table gives
    an empty result. Sequence numbers are distinct but have gaps.
    """
    pieces = staged(token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id), "pieces")
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("__place")
    dealt = pieces.select("*", place).repartition(parts, "__place").sortWithinPartitions("__place", "id", "piece")
    packed = dealt.drop("__place").mapInArrow(
        _packer(capacity, open_bins, look_ahead), f"{_PIECES}, sequence_id long, offset long"
    )
    return packed.withColumnRenamed("id", id_col)


# The pipeline and the query use this vocabulary; its folder is a parameter of the machine.
def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


