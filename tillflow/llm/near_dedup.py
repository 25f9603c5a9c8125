"""MinHash near-dedup with an LSH forest.

Every distinct shingle set gets one MinHash signature. The forest keeps TREES
sorted orders of it: order t starts at value t * STEP and goes on cyclically.
Sets with a common prefix in some order are neighbours there. How long a prefix
must be depends on the region: DEPTHS[0] values where few sets share it, the
next depth where more than REGION do, and so on, so that no region is large.
Sub-regions of a crowded region stay tied to it by their smallest members.

Candidates are verified on full sets. They come in two rounds. First each set
meets the smallest id of its region in every order. Links found so far give
components; regions that lie in one component are done. In the others, all
sets of different components are compared by a finer signature, and what may
still reach the threshold is verified too.

Going deeper parts sets that may be alike, so all sets of crowded regions are
compared a second way, which is exact: shingles get one order, common ones last,
and two sets that reach the threshold share one of their first shingles, at
places that leave enough after them. Pairs that do and aren't in one component
yet are verified. So no pair is lost by a region's size.

At similarity s a pair shares the first DEPTHS[0] values of an order with
probability s ** 2: with 16 orders a pair at 0.85 is missed with probability
(1 - 0.85 ** 2) ** 16 = 1e-9, at 0.8 with 8e-8, in crowded regions as elsewhere.
The finer signature loses a pair at the threshold with 2e-8 at most.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm import common
from tillflow.llm.common import staged

TREES = 16
VALUES = 96
STEP = 6
DEPTHS = (2, 4, 8, 16)
# Sets in a region that are compared with each other; larger regions go deeper.
REGION = 64
SEED = 20
# Values of the finer signature (one byte each), which only sets with neighbours get.
FINE_VALUES = 512
FINE_SEED = 21
# Ids of sets with neighbours are broadcast up to this number (8 bytes each); beyond it the texts are shuffled.
BROADCAST_IDS = 2_000_000
# Shingles of crowded sets that are known to be common, the most frequent ones (16 bytes each). They and the
# share of sets they are counted in decide only about the order of shingles, which any choice leaves exact.
COMMON = 1_000_000
COUNTED_SETS = 200_000
# Sets that share a first shingle and are compared in one piece; more are compared block by block.
BLOCK = 2_048
_ROUND_LIMIT = 100

_PREFIXES = ", ".join(f"k{i} long" for i in range(len(DEPTHS)))


# --- sets and signatures --------------------------------------------------------------


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = common.odd_multipliers(VALUES, SEED)
        for batch in batches:
            sizes, prints, signatures = [], [], []
            for text in batch.column(1):
                found = np.unique(common.shingles(common.hashed_words(text.as_py()), width))
                digest = xxhash.xxh3_128_digest(found.tobytes())
                sizes.append(len(found))
                prints.append(np.frombuffer(digest, np.int64))
                signatures.append(common.signature(found, factors).tobytes() if len(found) else None)
            pairs = np.array(prints, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                 pa.array(signatures, pa.binary())],
                ["id", "n", "f1", "f2", "sig"],
            )
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = common.odd_multipliers(FINE_VALUES, FINE_SEED)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [np.unique(common.shingles(common.hashed_words(t.as_py()), width)) for t in part.column(1)]
                fine = [(common.signature(x, factors) >> np.uint32(8)).astype(np.uint8).tobytes() if len(x) else None for x in sets]
                found = [common.as_long(x) for x in sets]
                flat = np.concatenate(found) if found else np.empty(0, np.int64)
                ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(fine, pa.binary())],
                    ["id", "hs", "fine"],
                )
    return run


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each set and order: hashes of its prefixes at DEPTHS."""
    order = (np.arange(TREES)[:, None] * STEP + np.arange(DEPTHS[-1])) % VALUES
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            values = np.frombuffer(b"".join(x.as_py() for x in part.column(1)), np.uint32)
            values = values.reshape(-1, VALUES)[:, order].astype(np.uint64)
            running = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), values.shape[:2])
            keys = []
            for depth in range(DEPTHS[-1]):
                running = common.mix(running + values[:, :, depth])
                if depth + 1 in DEPTHS:
                    keys.append(pa.array(common.as_long(running.reshape(-1))))
            ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), TREES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *keys], ["id", *(f"k{i}" for i in range(len(DEPTHS)))]
            )


# --- regions of the forest ---------------------------------------------------------------


def _regions(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(region, id) for all sets that have neighbours, pairs (a, b) that tie regions, and ids of crowded regions."""
    members, ties, live = [], [], rows
    for level in range(len(DEPTHS)):
        key = f"k{level}"
        counts = live.groupBy(key).agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
        if level == 0:  # most sets are alone in their region
            counts = counts.filter(F.col("size") > 1)
        counted = staged(counts, f"regions-{level}")
        live = staged(live.drop("size", "least").join(counted, key), f"neighbours-{level}")
        if level:
            ties.append(live.select(F.col("least").alias("a"), F.col("above").alias("b")))
        members.append(
            live.filter(F.col("size") <= REGION).select(F.col(key).alias("region"), "id")
        )
        live = live.filter(F.col("size") > REGION).withColumn("above", F.col("least"))
        if level == 0:
            crowded = live.select("id").distinct()
        if live.isEmpty():
            break
    # Beyond the last depth: regions of REGION sets, each with the smallest one of all.
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / REGION))
    dealt = live.select(F.xxhash64(key, part).alias("region"), "id", "least")
    members.append(dealt.select("region", "id"))
    members.append(dealt.select("region", F.col("least").alias("id")).distinct())
    regions, tied = members[0], live.select(F.col("least").alias("a"), F.col("above").alias("b"))
    for more in members[1:]:
        regions = regions.unionByName(more)
    for more in ties:
        tied = tied.unionByName(more)
    return regions, tied, crowded


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with a > b, each once."""
    return (
        pairs.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, share_percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("hs").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hs").alias("hb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - shared
    return both.filter(100 * shared >= share_percent * union).select("a", "b")


def _similar_in_region(least_share: float):
    def pairs(ids, found, signatures):
        values = np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, FINE_VALUES)
        for i in range(len(ids) - 1):
            equal = (values[i + 1 :] == values[i]).mean(axis=1)
            for j in np.flatnonzero((equal >= least_share) & (found[i + 1 :] != found[i])):
                yield ids[i], ids[i + 1 + int(j)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, ids, found, signatures = None, [], [], []
        out_a: list[int] = []
        out_b: list[int] = []

        def flush():
            for a, b in pairs(ids, np.array(found, np.int64), signatures):
                out_a.append(a)
                out_b.append(b)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for key, one, root, sig in zip(*columns, strict=True):
                if key != region:
                    flush()
                    region, ids, found, signatures = key, [], [], []
                ids.append(one)
                found.append(root)
                signatures.append(sig)
            if len(out_a) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
                out_a, out_b = [], []
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
    return run


def _least_share(share_percent: int) -> float:
    """The share of equal signature values that a pair at the threshold stays above: 5.5 deviations below it."""
    s = share_percent / 100
    return s - 5.5 * (s * (1 - s) / FINE_VALUES) ** 0.5


# --- crowded regions, exactly ---------------------------------------------------------------


def _common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of the sets, sorted, and how often each was counted."""
    share = max(1, sets.count() // COUNTED_SETS)
    counted = sets.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select(F.explode("hs").alias("shingle"))
    counted = counted.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(1, REGION // share))
    found = counted.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    shingles, n = found["shingle"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def _first_shingles(common: np.ndarray, counts: np.ndarray, share_percent: int):
    """A row for each shingle that a set must share one of: its place in the order, common shingles last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                firsts, sizes = [np.empty(0, np.int64)], []
                for values in part.column(1):
                    hs = values.values.to_numpy(zero_copy_only=False)
                    n = np.zeros(len(hs), np.int64)
                    if len(common):
                        near = np.minimum(np.searchsorted(common, hs), len(common) - 1)
                        n = np.where(common[near] == hs, counts[near], 0)
                    most = len(hs) + share_percent * len(hs) // -100 + 1
                    firsts.append(hs[np.lexsort((hs, n))][:most])
                    sizes.append(len(hs))
                lengths = [len(x) for x in firsts[1:]]
                at = [np.empty(0, np.int64), *(np.arange(n) for n in lengths)]
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts)), pa.array(ids, pa.int64()),
                     pa.array(np.repeat(sizes, lengths), pa.int32()), pa.array(np.concatenate(at), pa.int32())],
                    ["shingle", "id", "n", "at"],
                )
    return run


def _alike_by_place(share_percent: int):
    """Pairs of a group that can reach the threshold if its shingle is the first that they share."""
    def pairs(rows):
        ids, n, at, roots, blocks = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        left, several = n - at, blocks.min() < blocks.max()
        for i in range(len(ids) - 1):
            fits = np.minimum(left[i + 1 :], left[i]) * (100 + share_percent) >= share_percent * (n[i + 1 :] + n[i])
            fits &= roots[i + 1 :] != roots[i]
            if several:  # pairs within a block are compared in a group of their own
                fits &= blocks[i + 1 :] != blocks[i]
            found = ids[i + 1 :][fits]
            if len(found):
                yield np.full(len(found), ids[i]), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out, held = None, [], [], 0

        def taken():
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def flush():
            nonlocal held
            for one in pairs(rows) if rows else ():
                out.append(one)
                held += len(one[0])
                if held >= 10_000:
                    held = 0
                    yield taken()
            rows.clear()

        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != group:
                    yield from flush()
                    group = key
                rows.append(row)
        yield from flush()
        if out:
            yield taken()
    return run


def _crowded_pairs(sets: DataFrame, crowded: DataFrame, roots: DataFrame, share_percent: int) -> DataFrame:
    """All pairs (a, b) of crowded sets that may reach the threshold and are not in one component."""
    sets = staged(sets.join(crowded, "id", "left_semi").select("id", "hs"), "crowded-sets")
    common, counts = _common_shingles(sets)
    rows = sets.mapInArrow(_first_shingles(common, counts, share_percent), "shingle long, id long, n int, at int")
    rows = rows.join(roots, "id", "left").select("shingle", "id", "n", "at", F.coalesce("root", "id").alias("root"))
    rows = staged(rows, "first-shingles")
    shared = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi")
    )
    shared = staged(shared.filter("lo < hi").select("shingle", "size"), "shared-shingles")
    blocks = F.ceil(F.col("size") / BLOCK)
    met = rows.join(shared, "shingle").select("*", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).alias("block"))
    met = met.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    group = F.xxhash64("shingle", F.least("block", "other"), F.greatest("block", "other"))
    met = met.select(group.alias("group"), "id", "n", "at", "root", "block")
    pairs = met.repartition("group").sortWithinPartitions("group").mapInArrow(
        _alike_by_place(share_percent), "a long, b long"
    )
    return _distinct_pairs(pairs)


# --- components ------------------------------------------------------------------------------


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
    )
    roles = ends.groupBy("node").agg(F.sum("child").alias("children"), F.max("parent").alias("parent"))
    return roles.filter("children > 1 OR children + parent > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every node of the links (a, b) but the roots: root is the smallest node reachable.

    Large-star and small-star steps on staged tables until each node hangs at
    its root; a few steps for any shape, as each about halves the distance. The
    smallest neighbours are combined before the shuffle and joined from a staged
    table, so that a node with very many links is split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    edges = staged(edges.distinct(), "edges")
    for _ in range(_ROUND_LIMIT):
        if _is_star_forest(edges):
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(ends.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "least")
        larger = ends.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(larger.filter("u > v"), "edges")
        least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        smaller = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        edges = staged(smaller.unionByName(own).filter("u > v").distinct(), "edges")
    raise RuntimeError(f"components did not settle in {_ROUND_LIMIT} steps")


# --- the operator ---------------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    share_percent: int = 80,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Two documents are linked if 100 * |A and B| >= share_percent * |A or B| for
    their sets of distinct ``width``-word shingles; a shorter text is one
    shingle. ``component_id`` is the smallest id reachable by links, and
    ``kept`` says whether it is the document's own. Ids must be integers.

    Null and empty texts have an empty set, are linked with nothing and kept. A
    row without an id is linked with nothing: its component is null and it is
    kept. Rows that share an id are one node with the links of each of them.
    Other columns aren't read. An empty table gives an empty result.

    Equal sets are one node from the start, so copies never meet each other.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sketches = staged(
        rows.mapInArrow(_sketch(width), "id long, n long, f1 long, f2 long, sig binary"), "sketches"
    )
    nodes = sketches.filter("n > 0 AND id IS NOT NULL")
    classes = staged(
        nodes.groupBy("f1", "f2").agg(F.min("id").alias("first"), F.min_by("sig", "id").alias("sig")), "classes"
    )
    firsts = classes.select(F.col("first").alias("id"), "sig")

    regions, ties, crowded = _regions(firsts.mapInArrow(_prefix_rows, f"id long, {_PREFIXES}"))
    regions, crowded = staged(regions, "forest"), staged(crowded, "crowded")
    wanted = staged(regions.select("id").distinct(), "wanted")
    few = wanted.count() <= BROADCAST_IDS
    texts = rows.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")
    sets = staged(texts.mapInArrow(_sets(width), "id long, hs array<long>, fine binary"), "sets")

    in_region = Window.partitionBy("region")  # a few more than REGION rows at most
    firsts_met = regions.select(F.col("id").alias("a"), F.min("id").over(in_region).alias("b"))
    tried = staged(_distinct_pairs(firsts_met.unionByName(ties)), "pairs-1")
    links = staged(_verified(tried, sets, share_percent), "links-1")
    found = components(links)

    rooted = regions.join(found, "id", "left").select("region", "id", F.coalesce("root", "id").alias("root"))
    spread = rooted.select("*", F.min("root").over(in_region).alias("lo"), F.max("root").over(in_region).alias("hi"))
    signed = spread.filter("lo < hi").join(sets.select("id", "fine"), "id").select("region", "id", "root", "fine")
    pairs = (
        signed.repartition("region").sortWithinPartitions("region", "id")
        .mapInArrow(_similar_in_region(_least_share(share_percent)), "a long, b long")
    )
    pairs = staged(_distinct_pairs(pairs).join(tried, ["a", "b"], "left_anti"), "pairs-2")
    more = staged(_verified(pairs, sets, share_percent), "links-2")
    roots = found
    if not more.isEmpty():
        stars = found.select(F.col("id").alias("a"), F.col("root").alias("b"))
        roots = components(stars.unionByName(more))
    if not crowded.isEmpty():
        pairs = _crowded_pairs(sets, crowded, roots, share_percent)
        pairs = staged(pairs.join(tried, ["a", "b"], "left_anti"), "pairs-3")
        more = staged(_verified(pairs, sets, share_percent), "links-3")
        if not more.isEmpty():
            stars = roots.select(F.col("id").alias("a"), F.col("root").alias("b"))
            roots = components(stars.unionByName(more))

    same_set = sketches.join(classes, ["f1", "f2"], "left").select(
        "id", "n", F.when(F.col("n") > 0, F.coalesce("first", "id")).otherwise(F.col("id")).alias("first")
    )
    shared_id = _shared_ids(same_set, roots)
    full = same_set.join(shared_id.select(F.col("id").alias("first"), "root"), "first", "left")
    component: Column = F.when(F.col("id").isNotNull(), F.coalesce("root", "first", "id"))
    return full.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _shared_ids(same_set: DataFrame, roots: DataFrame) -> DataFrame:
    """Roots after joining classes that meet in an id with several texts; the usual case has none."""
    nodes = same_set.filter("id IS NOT NULL")
    several = nodes.groupBy("id").agg(F.min("first").alias("lo"), F.max("first").alias("hi")).filter("lo < hi")
    several = staged(several.select("id"), "shared-ids")
    if several.isEmpty():
        return roots
    meeting = staged(nodes.join(several, "id", "left_semi").select("id", "first"), "shared-ids")
    links = roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(
        meeting.select(F.col("id").alias("a"), F.col("first").alias("b"))
    )
    return components(links)


def drop_near_duplicates(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``found`` doesn't keep; rows without an id stay."""
    gone = staged(found.filter(~F.col("kept")).select(F.col(id_col).alias("__gone")).distinct(), "near-copies")
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
