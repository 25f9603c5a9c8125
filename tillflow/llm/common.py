"""Staged tables, words, shingles and signatures shared by the operators of this package.

A *word* is a run of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; on
UTF-8 bytes that is what ``bytes.lower().split()`` gives.
"""

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of all word rules here: space, and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- tables in the shared folder ------------------------------------------------------


# Folders made where none is named, by application.
_made: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, one is made for the application, on a single machine only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    name = spark.sparkContext.applicationId
    if name not in _made:
        _made[name] = "file://" + tempfile.mkdtemp(prefix="tillflow-llm-")
    return _made[name]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written once to the shared folder and read back.

    Cuts the lineage so that a lost executor costs no more than the running
    step, and gives the optimizer true sizes for what follows.
    """
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


# --- text as columns ------------------------------------------------------------------


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_list(text: Column) -> Column:
    """The words of a text in order, as an array; case is kept."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def windows_of(words: Column, width: int) -> Column:
    """Every run of ``width`` words as an array of structs w0, w1, ...; empty if there are fewer."""
    n = F.greatest(F.size(words) - (width - 1), F.lit(0))
    parts = [F.slice(words, i + 1, n).alias(f"w{i}") for i in range(width)]
    return F.arrays_zip(*parts)


# --- text in tasks --------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 over an array of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A word's hash is a polynomial in its bytes mod 2^64, from running sums over the text.
_BASE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 20
_LETTERS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTERS[65:91] = _LETTERS[97:123]
_IS_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))


def _powers(base: int, count: int) -> np.ndarray:
    found = np.full(count, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


class _Tables:
    up, down = _powers(_BASE, 1 << 16), _powers(pow(_BASE, -1, 1 << 64), 1 << 16)

    @classmethod
    def reach(cls, n: int) -> None:
        if n > len(cls.up):
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def _block_words(text: bytes) -> np.ndarray:
    letters = np.frombuffer(text, np.uint8)
    _Tables.reach(len(letters))
    word = ~_IS_BLANK[letters]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_LETTERS[letters] * _Tables.up[: len(letters)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _Tables.down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, in order. Memory is bounded by a block of about 1 MB and its last word."""
    if not text:
        return np.empty(0, np.uint64)
    if len(text) <= _BLOCK:
        return _block_words(text)
    parts, at = [], 0
    while at < len(text):
        to = at + _BLOCK
        while to < len(text) and not _IS_BLANK[text[to]]:
            to += 1
        parts.append(_block_words(text[at:to]))
        at = to
    return np.concatenate(parts)


def shingles(words: np.ndarray, width: int, short: bool = True) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order.

    A shorter text is one shingle as a whole if ``short``, else it has none.
    """
    n = len(words)
    if n < width:
        if not n or not short:
            return np.empty(0, np.uint64)
        width = n
    m = n - width + 1
    total = mix(words[:m] + np.uint64(width))
    for i in range(1, width):
        total = mix(total + words[i : i + m])
    return total


def signature(found: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """MinHash values (uint32), one for each odd multiplier, of a set that isn't empty."""
    keys = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(keys), 2048):
        part = keys[at : at + 2048]
        np.minimum(least, (multipliers[:, None] * part).min(axis=1), out=least)
    return least


def odd_multipliers(count: int, seed: int) -> np.ndarray:
    drawn = np.random.default_rng(seed).integers(1 << 20, 1 << 32, count, dtype=np.uint64)
    return (drawn | np.uint64(1)).astype(np.uint32)


def as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
