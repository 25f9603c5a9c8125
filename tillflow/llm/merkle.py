"""Merkle manifest of a dataset by butterfly exchange.

Each group's leaves stand in order and form a tree in which every FANOUT
consecutive nodes have a parent; a last run may be shorter, even one node. The
leaves are cut into aligned blocks of FANOUT ** BLOCK_LEVELS. A block finds its
own subtree root; then the blocks climb together, a level a round: in round j
aligned runs of FANOUT ** j blocks hold the same node, and each block swaps it
with the blocks that have its place in the sibling runs. Every block hashes each
of its ancestors itself, so after the last round it has the upper part of all its
proofs, and nothing has to be sent down again.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillflow.llm.common import staged

FANOUT = 3
BLOCK_LEVELS = 7  # 2187 leaves a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- digests --------------------------------------------------------------------------


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def row_digest(*fields: Column) -> Column:
    """The digest of a row: each field as its UTF-8 byte count, ``:`` and its value as text; null as ``-``."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return digest(F.concat(*parts))


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf and its proof lead to: at each level the siblings before it, the node, the siblings after it."""
    return F.aggregate(
        F.arrays_zip(before.alias("before"), after.alias("after")), leaf,
        lambda node, level: digest(F.concat(level["before"], node, level["after"])),
    )


def proof_digest(before: Column, after: Column) -> Column:
    """The digest of all siblings, level by level from the leaf up, left to right."""
    return digest(F.array_join(F.zip_with(before, after, lambda b, a: F.concat(b, a)), ""))


# --- the tree inside a block ----------------------------------------------------------


def _levels(leaves: list[str], alone: bool, height: int) -> list[list[str]]:
    """Nodes by level. A block that is its whole group stops at one node, others at ``height``."""
    found = [leaves]
    while len(found[-1]) > 1 if alone else len(found) <= height:
        last = found[-1]
        found.append([
            hashlib.sha256("".join(last[i : i + FANOUT]).encode()).hexdigest() for i in range(0, len(last), FANOUT)
        ])
    return found


def _siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    before, after = [], []
    for nodes in levels[:-1]:
        start = place - place % FANOUT
        before.append("".join(nodes[start:place]))
        after.append("".join(nodes[place + 1 : start + FANOUT]))
        place //= FANOUT
    return before, after


def _block_roots(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [
                _levels(leaves.as_py(), n.as_py() == 1, height)[-1][0]
                for leaves, n in zip(batch["leaves"], batch["n_blocks"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["grp"], batch["block"], batch["n_blocks"], pa.array(roots, pa.string())],
                ["grp", "block", "n_blocks", "node"],
            )
    return run


def _leaf_paths(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                levels = _levels(row["leaves"][0].as_py(), row["n_blocks"][0].as_py() == 1, height)
                sides = [_siblings(levels, i) for i in range(len(levels[0]))]
                upper = row["before"][0].as_py(), row["after"][0].as_py()
                before, after = (pa.array([own[k] + upper[k] for own in sides], pa.list_(pa.string())) for k in (0, 1))
                repeat = pa.array([0] * len(sides), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        row["items"].flatten(), pa.array(levels[0], pa.string()), row["subroot"].take(repeat),
                        row["root"].take(repeat), before, after,
                    ],
                    ["item", "leaf", "subroot", "root", "before", "after"],
                )
    return run


# --- places ---------------------------------------------------------------------------


def _placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, ord, leaf, item) plus ``place`` from 0 in each group, by ord, leaf and row.

    Rows are dealt by range over (grp, ord, leaf, row), so a hot group spreads
    over tasks; counts of each range give where its rows begin.
    """
    rows = staged(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    order = [F.asc_nulls_first("grp"), F.asc_nulls_first("ord"), F.asc("leaf"), F.asc("row")]
    dealt = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered-leaves")
    counts = dealt.groupBy(F.col("grp").alias("g"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("g").orderBy("p").rowsBetween(W.unboundedPreceding, -1)
    sizes = counts.select(
        "g", "p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"),
        F.sum("n").over(W.partitionBy("g")).alias("total"),
    )
    within = F.row_number().over(W.partitionBy("grp", "part").orderBy(*order[1:]))
    return (
        dealt.withColumn("own", within)
        .join(staged(sizes, "leaf-counts"), F.col("grp").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
        .select("grp", "leaf", "item", "total", (F.col("begin") + F.col("own") - 1).alias("place"))
    )


def _blocks(leaves: DataFrame, size: int) -> DataFrame:
    """One row per block of ``size`` leaves: grp, block, n_blocks, and its items and leaves in order."""
    rows = _placed(leaves).select(
        "grp", F.expr(f"place div {size}").alias("block"), F.expr(f"(total - 1) div {size} + 1").alias("n_blocks"),
        F.struct("place", "leaf", "item").alias("row"),
    )
    packed = rows.groupBy("grp", "block", "n_blocks").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return packed.select("grp", "block", "n_blocks", F.col("rows.item").alias("items"), F.col("rows.leaf").alias("leaves"))


# --- rounds ---------------------------------------------------------------------------


def _round(state: DataFrame, span: int) -> DataFrame:
    """One exchange: runs of ``span`` blocks learn their sibling runs' nodes and hash the parent.

    A block sends its node to the blocks with its place in each sibling run. Where
    the last run of a group is shorter, its blocks take turns, and where the
    receiving run is shorter, only as many send. Every block gets at most FANOUT rows.
    """
    run, place = f"block div {span}", f"block % {span}"
    first = f"(({run}) - ({run}) % {FANOUT})"
    own_size = f"least({span}, n_blocks - ({run}) * {span})"
    receivers = []
    for sibling in range(FANOUT):
        start = f"({first} + {sibling}) * {span}"
        size = f"least({span}, n_blocks - {start})"
        receivers.append(
            f"CASE WHEN {sibling} = ({run}) % {FANOUT} THEN array(block) "
            f"WHEN {place} < {size} THEN sequence({start} + {place}, {start} + {size} - 1, {own_size}) "
            "ELSE CAST(array() AS array<bigint>) END"
        )
    sent = state.withColumn("to", F.explode(F.expr(f"concat({', '.join(receivers)})")))
    own = F.col("to") == F.col("block")
    swapped = sent.groupBy("grp", F.col("to").alias("block"), "n_blocks").agg(
        F.array_sort(F.collect_list(F.struct(F.expr(f"({run}) % {FANOUT}").alias("at"), "node"))).alias("nodes"),
        F.max(F.when(own, F.struct("before", "after"))).alias("known"),
    )
    at = F.expr(f"({run}) % {FANOUT}")

    def joined(wanted) -> Column:
        return F.array_join(F.transform(F.filter("nodes", wanted), lambda x: x["node"]), "")

    return swapped.select(
        "grp", "block", "n_blocks",
        digest(joined(lambda x: F.lit(True))).alias("node"),
        F.concat("known.before", F.array(joined(lambda x: x["at"] < at))).alias("before"),
        F.concat("known.after", F.array(joined(lambda x: x["at"] > at))).alias("after"),
    )


def climb(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``leaves`` (grp, ord, leaf, item) and, for each, the group's ``subroot`` and the path to it.

    A null group is a group. Equal ``ord`` go by leaf, and equal leaves in the
    order in which they were written; null ``ord`` come first. A block of
    FANOUT ** block_levels leaves is one row; a round is one shuffle of one row
    per block and sibling. The number of rounds is the logarithm of the blocks
    of the largest group.
    """
    blocks = staged(_blocks(leaves, FANOUT**block_levels), "blocks")
    roots = blocks.select("grp", "block", "n_blocks", "leaves").mapInArrow(
        _block_roots(block_levels), f"grp {blocks.schema['grp'].dataType.simpleString()}, block long, n_blocks long, node string"
    )
    none = F.array().cast("array<string>")
    state = staged(roots.withColumns({"before": none, "after": none}), "block-roots")
    most, span = state.agg(F.max("n_blocks")).first()[0] or 0, 1
    finished = []
    while span < most:
        finished.append(state.filter(F.col("n_blocks") <= span))
        state = staged(_round(state.filter(F.col("n_blocks") > span), span), "block-nodes")
        span *= FANOUT
    for early in finished:
        state = state.unionByName(early)
    return blocks, state.select("grp", "block", F.col("node").alias("subroot"), "before", "after")


def _expanded(blocks: DataFrame, paths: DataFrame, block_levels: int) -> DataFrame:
    """Leaves with their whole proofs, from blocks and the upper parts of their paths (root, before, after)."""
    upper = paths.select(F.col("grp").alias("g"), F.col("block").alias("b"), "subroot", "root", "before", "after")
    met = blocks.join(upper, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b")))
    item = blocks.schema["items"].dataType.elementType.simpleString()
    return met.select("n_blocks", "items", "leaves", "subroot", "root", "before", "after").mapInArrow(
        _leaf_paths(block_levels),
        f"item {item}, leaf string, subroot string, root string, before array<string>, after array<string>",
    )


def manifest(
    docs: DataFrame, group_col: str = "source", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS,
    tampered: dict[str, Column] | None = None, block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per document: id, ``leaf``, ``subroot``, ``root``, ``before``, ``after`` and ``tampered_leaf``.

    A leaf is the digest of ``fields``. Leaves of a group ascend by id (null
    first) and make its subroot; subroots ascend by group (null first, bytewise)
    and make the root. ``before`` and ``after`` hold, level by level from the leaf
    to the root, the joined digests of the siblings on either side, for ``fold``.
    ``tampered`` replaces fields; the leaf of the changed row is
    ``tampered_leaf``, the same as ``leaf`` where nothing changes.

    Nulls and empty texts are distinct values; a null group is a group. Rows that
    share an id are leaves of their own, by digest; wholly equal rows have equal
    leaves in neighbouring places. Other columns aren't read. An empty table has
    no rows. A text, however long, is read once and only its digests are kept.
    """
    changed = [(tampered or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(
        F.col(group_col).alias("grp"), F.col(id_col).alias("ord"), row_digest(*[F.col(c) for c in fields]).alias("leaf"),
        F.struct(F.col(id_col).alias("id"), row_digest(*changed).alias("tampered_leaf")).alias("item"),
    )
    blocks, paths = climb(leaves, block_levels)
    groups = paths.filter("block = 0").select(
        F.lit(0).alias("grp"), F.col("grp").alias("ord"), F.col("subroot").alias("leaf"),
        F.struct(F.col("grp").alias("name")).alias("item"),
    )
    group_blocks, group_paths = climb(groups, block_levels)
    upper = _expanded(group_blocks, group_paths.withColumn("root", F.col("subroot")), block_levels)
    upper = staged(
        upper.select(
            F.col("item.name").alias("name"), "root",
            F.col("before").alias("more_before"), F.col("after").alias("more_after"),
        ),
        "group-proofs",
    )
    whole = paths.join(upper, F.col("grp").eqNullSafe(F.col("name"))).select(
        "grp", "block", "subroot", "root",
        F.concat("before", "more_before").alias("before"), F.concat("after", "more_after").alias("after"),
    )
    return _expanded(blocks, whole, block_levels).select(
        F.col("item.id").alias(id_col), "leaf", "subroot", "root", "before", "after",
        F.col("item.tampered_leaf").alias("tampered_leaf"),
    )


def verify(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Proof digests of a ``manifest``, and whether the tampered leaves still lead to the root."""
    folded = found.select(
        id_col, "leaf", "subroot", "root",
        proof_digest(F.col("before"), F.col("after")).alias("proof_sha256"),
        fold(F.col("tampered_leaf"), F.col("before"), F.col("after")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def dropped_breaks(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text without its line breaks where 2 divides the crc32 of the id as text; the text itself elsewhere."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))
