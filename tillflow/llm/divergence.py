"""Divergence of sources by term counts, on hash-consed segment trees.

Term ids of a language are cut into aligned segments. Over each segment every
source has a binary tree whose leaves are its counts; nodes are consed, so equal
subtrees are one node, whatever source or place they come from. Two sources are
compared by walking both trees together; a pair of nodes that was met before
has its price already, so every distinct pair is priced once.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import staged
from tillflow.llm.ranks import ranked

MIN_DOCS = 30
SCALE = 1_000_000_000
PSEUDO_COUNT = 5
TOP_TERMS = 50
SEGMENT = 1024  # terms; a power of two
SOURCES_AT_ONCE = 32
# Distinct (language, source, term) that a task holds before it hands counts on.
HELD_TERMS = 200_000

# A term is a run of ASCII letters and of bytes from 0x80 on; A-Z are lower-cased.
_TO_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
_BLOCK = 1 << 20


# --- counts ---------------------------------------------------------------------------


def text_terms(text: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text."""
    found: Counter = Counter()
    at, plain = 0, text.translate(_TO_TERM_BYTES)
    while at < len(plain):
        to = plain.find(b" ", at + _BLOCK)
        to = len(plain) if to < 0 else to
        found.update(plain[at:to].split(b" "))
        at = to
    found.pop(b"", None)
    return found


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, n_docs), summed over the rows of the task as far as HELD_TERMS allows.

    Every group also comes with the empty term and no counts, so that none is lost.
    """
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            same = pa.array(np.zeros(len(counts) + 1, np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()).take(same), pa.array([source], pa.string()).take(same),
                    pa.array(["", *(t.decode() for t in counts)], pa.string()),
                    pa.array([0, *counts.values()], pa.int64()), pa.array([0, *(docs[t] for t in counts)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "n_docs"],
            )
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            counts, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            size -= len(counts)
            own = text_terms(text.as_buffer().to_pybytes())
            counts.update(own)
            docs.update(own.keys())
            size += len(counts)
            if size > HELD_TERMS:
                yield from given()
                size = 0
    yield from given()


def _share(count: str, total: str, vocabulary: str) -> Column:
    """1 + floor(SCALE (count + PSEUDO_COUNT) / (total + PSEUDO_COUNT vocabulary)) in whole numbers."""
    over = f"(CAST({count} + {PSEUDO_COUNT} AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0)))"
    return F.expr(f"1 + {over} div CAST({total} + {PSEUDO_COUNT} * {vocabulary} AS DECIMAL(38, 0))")


# --- trees ----------------------------------------------------------------------------


class Trees:
    """Segment trees over the rows of a matrix of counts, with one node for all equal subtrees.

    ``tops`` are the root nodes of the rows; ``children[h]`` are the left and
    right nodes of each node of level h + 1; nodes of level 0 are ``counts``.
    A place with the count -1 is beyond the vocabulary.
    """

    def __init__(self, counts: np.ndarray):
        self.counts, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            most = int(nodes.max()) + 1
            pairs, shared = np.unique(nodes[:, ::2] * most + nodes[:, 1::2], return_inverse=True)
            nodes = shared.reshape(nodes.shape[0], -1)
            self.children.append((pairs // most, pairs % most))
        self.tops = nodes[:, 0]

    def shares(self, total: int, vocabulary: int) -> np.ndarray:
        """The share of each leaf count for a source of ``total`` counts; 0 beyond the vocabulary."""
        over = total + PSEUDO_COUNT * vocabulary
        if int(self.counts[-1]) < 2**62 // SCALE:
            found = 1 + (SCALE * (self.counts + PSEUDO_COUNT)) // max(over, 1)
        else:
            found = np.array([1 + SCALE * (int(c) + PSEUDO_COUNT) // max(over, 1) for c in self.counts], np.int64)
        return np.where(self.counts < 0, 0, found)

    def differences(self, left: np.ndarray, right: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """For rows ``left[i]`` and ``right[i]``, the sum over all places of the difference of their shares.

        Both trees are walked at once, for all pairs of rows together. What a pair
        of nodes costs depends on the two rows' totals, so it is remembered for
        each pair of rows: level by level, equal node pairs become one before they
        are opened, and are priced once on the way back.
        """
        owner, a, b = np.arange(len(left)), self.tops[left], self.tops[right]
        met = []
        for lower, upper in reversed(self.children):
            n, width = len(owner), int(max(lower.max(), upper.max())) + 1
            keys = np.concatenate([(owner * width + side[a]) * width + side[b] for side in (lower, upper)])
            keys, at = np.unique(keys, return_inverse=True)
            met.append((at[:n], at[n:]))
            owner, a, b = keys // (width * width), keys // width % width, keys % width
        prices = np.abs(shares[left[owner], a] - shares[right[owner], b])
        for first, second in reversed(met):
            prices = prices[first] + prices[second]
        return prices


def _compared(segment: int):
    """Sums of one segment for all pairs of sources of two tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                alone = row["block"].as_py() == row["other"].as_py()
                tiles = [("sources", "cells")] + [("other_sources", "other_cells")] * (not alone)
                names, totals, rows = [], [], []
                vocabulary = row["vocabulary"].as_py()
                places = min(segment, vocabulary - row["segment"].as_py() * segment)
                for sources, cells in tiles:
                    own = row[sources].as_py()
                    counts = np.full((len(own), segment), -1, np.int64)
                    counts[:, : max(places, 0)] = 0
                    slots = {s["slot"]: i for i, s in enumerate(own)}
                    if row[cells].as_py():
                        filled = row[cells].values
                        slot = np.array([slots[s] for s in filled.field("slot").to_pylist()])
                        counts[slot, filled.field("at").to_numpy()] = filled.field("n").to_numpy()
                    names += [s["source"] for s in own]
                    totals += [s["total"] for s in own]
                    rows.append(counts)
                trees, n = Trees(np.concatenate(rows)), len(rows[0])
                shares = np.array([trees.shares(total, vocabulary) for total in totals])
                if alone:
                    left, right = np.triu_indices(n, 1)
                else:
                    left, right = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n, len(names)), indexing="ij"))
                if len(left):
                    values = trees.differences(left, right, shares)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["lang"].as_py()] * len(left), pa.string()),
                            pa.array(names, pa.string()).take(pa.array(left)), pa.array(names, pa.string()).take(pa.array(right)),
                            pa.array(values, pa.int64()),
                        ],
                        ["lang", "source", "item", "value"],
                    )
    return run


# --- the audit ------------------------------------------------------------------------


def _pairs(groups: DataFrame, cells: DataFrame, segment: int, sources_at_once: int) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of a language's sources."""
    slots = ranked(groups, "lang", ["source"]).select(
        "lang", "source", "total_n", "vocabulary", F.expr(f"place div {sources_at_once}").alias("block"),
        F.expr(f"place % {sources_at_once}").cast("int").alias("slot"),
        F.expr(f"(total - 1) div {sources_at_once}").alias("last_block"),
    )
    slots = staged(slots, "source-slots")
    blocks = slots.groupBy("lang", "block", "last_block", "vocabulary").agg(
        F.collect_list(F.struct("slot", "source", F.col("total_n").alias("total"))).alias("sources")
    )
    last_segment = F.greatest(F.expr(f"(vocabulary - 1) div {segment}"), F.lit(0))
    grid = blocks.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), last_segment)))
    filled = (
        cells.join(slots.select("lang", "source", "block", "slot"), ["lang", "source"])
        .groupBy("lang", "block", F.expr(f"place div {segment}").alias("segment"))
        .agg(F.collect_list(F.struct("slot", F.expr(f"place % {segment}").cast("int").alias("at"), "n")).alias("cells"))
    )
    tiles = staged(grid.join(filled, ["lang", "block", "segment"], "left"), "tiles")
    others = tiles.select(
        "lang", "segment", F.col("block").alias("other"),
        F.col("sources").alias("other_sources"), F.col("cells").alias("other_cells"),
    )
    met = tiles.withColumn("other", F.explode(F.sequence("block", "last_block"))).join(others, ["lang", "segment", "other"])
    sums = met.select(
        "lang", "block", "other", "segment", "vocabulary", "sources", "cells", "other_sources", "other_cells"
    ).mapInArrow(_compared(segment), "lang string, source string, item string, value long")
    summed = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return summed.select("lang", F.inline(both), "value")


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, segment: int = SEGMENT, sources_at_once: int = SOURCES_AT_ONCE,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far sources of a language lie apart, and by which terms.

    Part ``pair`` has, for each other source, the sum over all kept terms of the
    difference of the two shares; part ``term`` the terms whose share in the source
    is most above that in the language. Ranks start at 1, by value descending and
    item ascending; equal values thus have a fixed order.

    A term is a run of letters (A-Z in lower case) and of characters beyond ASCII.
    A language keeps the terms in at least ``min_docs`` of its rows. Null language,
    source and text are ''. Every row is a document, repeated ones too. A source
    without terms has shares as well; a language with no kept term has all pairs at
    0 and no terms. Texts are read whole, in blocks of about 1 MB, and counts of one
    text must fit a task. Other columns aren't read. An empty table has no rows.

    Counts are summed in tasks before the shuffle. A tile holds at most
    ``sources_at_once`` sources by ``segment`` terms, whatever the language, so no
    task gathers a language; tiles of one segment meet block by block.
    """
    known = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    partial = known.mapInArrow(_partial_counts, "lang string, source string, term string, n long, n_docs long")
    counts = staged(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "term-counts")
    worded = counts.filter("term <> ''")
    kept = worded.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    places = staged(
        ranked(kept.select("lang", "term", "lang_n"), "lang", ["term"]).withColumnRenamed("total", "vocabulary"), "kept-terms"
    )
    cells = staged(worded.join(places, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "place"), "cells")
    langs = places.groupBy("lang").agg(F.max("vocabulary").alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total_n"))
    groups = staged(
        counts.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .na.fill(0, ["total_n", "vocabulary", "lang_total"]),
        "groups",
    )
    pairs = _pairs(groups.drop("lang_total"), cells.select("lang", "source", "place", "n"), segment, sources_at_once)
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    p, q = _share("n", "total_n", "vocabulary"), _share("lang_n", "lang_total", "vocabulary")
    terms = (
        cells.join(groups, ["lang", "source"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value"))
        .filter("value > 0")
        .withColumn("rank", F.row_number().over(by_value))
        .filter(F.col("rank") <= top_terms)
    )
    return pairs.unionByName(terms)
