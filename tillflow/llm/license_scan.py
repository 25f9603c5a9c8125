"""License scans: which known licence texts, headers and notices a document contains.

Words are runs of letters and digits, so line breaks, comment signs, quotes and full
stops don't matter. Templates, here called notices, are partitioned by their number of shingles; for those of up to 2^c, a
text is cut into windows of 2^(c+1) shingles that overlap by half, so that a
notice, wherever it stands, lies within one window. Each window has BANDS
MinHash bands of one value. A notice of m shingles of which SHARE are present
and its window have a similarity of at least 0.8 m / (4 m + 0.2 m) = 0.19, so one
of 96 bands collides with probability 1 - 0.81 ** 96 = 1 - 2e-9. Exact containment
of the notice's shingles in the document then decides. Windows that hold no shingle of
any notice are not signed: none of their bands could lead to a match.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import common
from tillflow.llm.common import staged
from tillflow.llm.license_texts import named_templates

WIDTH = 5
SHARE_PERCENT = 80
BANDS = 96
SEED = 12
# Bits of the filter that says which shingles may belong to a notice: 1 MB, whatever the number of notices.
FILTER_BITS = 23

# Beside ASCII punctuation: U+0080 to U+00BF and U+2000 to U+206F, as UTF-8.
_MARKS = re.compile(rb"\xc2[\x80-\xbf]|\xe2\x80[\x80-\xbf]|\xe2\x81[\x80-\xaf]")
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def notices(spark: SparkSession) -> DataFrame:
    """The known licences: whole texts, file headers and sentences."""
    return spark.createDataFrame(named_templates(), "license string, text string")


def license_words(text: bytes | None) -> np.ndarray:
    """Hashes of the runs of letters and digits of a UTF-8 text, in order; punctuation counts as a blank."""
    if not text:
        return common.hashed_words(None)
    return common.hashed_words((text if text.isascii() else _MARKS.sub(b" ", text)).translate(_PLAIN))


def _size_class(count: int) -> int:
    return max(count - 1, 0).bit_length()


def _window_values(found: np.ndarray, level: int, near: np.ndarray, factors: np.ndarray) -> Iterator[np.ndarray]:
    """Signatures of the windows of a level that hold one of the places ``near``."""
    half = 1 << level
    blocks = np.unique(near // half)
    for first in np.unique(np.concatenate([blocks, np.maximum(blocks - 1, 0)])):
        yield common.signature(found[first * half : (first + 2) * half], factors)


def _scan(width: int, bits: bytes, levels: tuple[int, ...]):
    """(id, kind, level, band, h, word): kind 0 is a band of a window, kind 1 a shingle that may be a notice's.

    A window without such a shingle collides with no notice, so only windows near one are signed.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, allowed = common.odd_multipliers(BANDS, SEED), np.frombuffer(bits, np.uint8)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = common.shingles(license_words(text.as_py()), width, short=False)
                slot = found >> np.uint64(64 - FILTER_BITS)
                near = np.flatnonzero(allowed[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                if not len(near):
                    continue
                hits, at = np.unique(found[near], return_index=True)
                rows += [(doc, 1, None, None, int(h), int(near[i])) for h, i in zip(common.as_long(hits), at, strict=True)]
                for level in levels:
                    values = {
                        (band, int(v)) for own in _window_values(found, level, near, factors) for band, v in enumerate(own)
                    }
                    rows += [(doc, 0, level, band, v, None) for band, v in values]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else ((),) * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "kind", "level", "band", "h", "word"]
            )
    return run


def _prepared(width: int):
    """(license, n, level, bands, shingles) of each notice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = common.odd_multipliers(BANDS, SEED)
        for batch in batches:
            names, sizes, levels, bands, all_found = [], [], [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = np.unique(common.shingles(license_words(text.as_py()), width, short=False))
                if len(found):
                    names.append(name)
                    sizes.append(len(found))
                    levels.append(_size_class(len(found)))
                    bands.append(common.signature(found, factors).astype(np.int64).tolist())
                    all_found.append(common.as_long(found).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(levels, pa.int32()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(all_found, pa.list_(pa.int64()))],
                ["license", "n", "level", "bands", "shingles"],
            )
    return run


def _filter(prepared: DataFrame) -> tuple[bytes, tuple[int, ...]]:
    """The filter over all shingles of the notices (1 MB at most), and the levels in use (64 at most)."""
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    marks = (
        prepared.select(F.explode("shingles").alias("h")).select(F.shiftright(slot, 3).alias("byte"), (slot % 8).alias("bit"))
        .groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, cast(bit as int))")).alias("mark")).collect()
    )
    bits = bytearray(1 << (FILTER_BITS - 3))
    for row in marks:
        bits[row.byte] = row.mark
    return bytes(bits), tuple(sorted(r.level for r in prepared.select("level").distinct().collect()))


def scan(
    docs: DataFrame,
    templates: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    name_col: str = "license",
    template_col: str = "text",
    width: int = WIDTH,
    share_percent: int = SHARE_PERCENT,
) -> DataFrame:
    """(doc_id, license, n_shared, n_shingles, first_word): notices that a document contains.

    ``n_shingles`` counts the notice's distinct ``width``-word shingles, ``n_shared``
    those in the document; a pair counts if n_shared is at least the share of
    n_shingles. ``first_word`` is the place of the first shared shingle (from 0).

    Null, empty and short texts contain nothing, nor does any text contain a
    notice of fewer than ``width`` words or a null one. Rows without an id are
    left out; rows that share an id count as one text; notices of one name count
    as one notice if their texts are equal, else each counts by itself. Other
    columns aren't read. Empty tables give an empty result.

    The text is read once and never shuffled; what leaves a task are the bands
    and shingles of windows near a possible notice. Windows of long texts are
    taken one after the other.
    """
    known = staged(
        templates.select(name_col, template_col)
        .filter(F.col(name_col).isNotNull())
        .select(name_col, F.col(template_col).cast("binary"))
        .distinct()
        .mapInArrow(_prepared(width), "license string, n long, level int, bands array<long>, shingles array<long>")
        .withColumn("notice", F.xxhash64("license", "shingles")),
        "notices",
    )
    bits, levels = _filter(known)
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    found = staged(
        rows.mapInArrow(_scan(width, bits, levels), "id long, kind int, level int, band int, h long, word long"), "scan"
    )
    bands = known.select("notice", "level", F.posexplode("bands").alias("band", "h"))
    candidates = found.filter("kind = 0").join(bands, ["level", "band", "h"]).select("id", "notice").distinct()
    parts = known.select("notice", F.explode("shingles").alias("h"))
    shared = (
        found.filter("kind = 1").join(parts, "h")
        .groupBy("id", "notice").agg(F.count_distinct("h").alias("n_shared"), F.min("word").alias("first_word"))
    )
    return (
        shared.join(candidates, ["id", "notice"], "left_semi")
        .join(known.select("notice", "license", "n"), "notice")
        .filter(100 * F.col("n_shared") >= share_percent * F.col("n"))
        .select(
            F.col("id").alias(id_col), F.col("license").alias(name_col), "n_shared",
            F.col("n").alias("n_shingles"), "first_word",
        )
    )
