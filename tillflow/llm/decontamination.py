"""Benchmark decontamination, in DataFrame functions only.

Test items are short and documents long, so the similarity of the two sets says
little; what counts is the share of the item's shingles that the document has.
Items are partitioned by size. Each item is sketched by its smallest shingle
hashes (MinHash, bottom k), with k set for its partition: a document that
contains ``share`` of an item can lack at most n - ceil(share n) shingles, so
beyond that number of sketch values one must be found; where that takes more
than SKETCH_MOST values, SKETCH_MOST leave a miss below (1 - share) ** SKETCH_MOST.
Candidates are then verified by exact containment.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import staged, windows_of

WIDTH = 5
SHARE_PERCENT = 80
SKETCH_MOST = 16  # a miss below 0.2 ** 16 = 7e-12 at a share of 0.8
# A sketch or item table of at most this many rows (16 to 24 bytes each) is broadcast;
# beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def plain_words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_rows(rows: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """(id, h) for every run of ``width`` words; repeated runs come repeatedly."""
    worded = rows.select(F.col(id_col).alias("id"), plain_words(F.col(text_col)).alias("words"))
    runs = worded.select("id", F.inline(windows_of(F.col("words"), width)))
    return runs.select("id", F.xxhash64(*[f"w{i}" for i in range(width)]).alias("h"))


def _bounded(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def sketches(item_shingles: DataFrame, share_percent: int = SHARE_PERCENT) -> DataFrame:
    """(item, n, size_class, h): the smallest hashes of each item, as many as its partition takes.

    Partition c holds the items of 2^c to 2^(c+1) - 1 shingles and takes the
    number of values that is safe for its largest size.
    """
    sized = item_shingles.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("h")).alias("hs"))
    size_class = F.floor(F.log2("n")).cast("int")
    largest = F.pow(F.lit(2.0), size_class + 1) - 1
    safe = F.floor(largest * (100 - share_percent) / 100) + 1
    k = F.least(safe, F.lit(SKETCH_MOST), F.col("n")).cast("int")
    return sized.select("item", "n", size_class.alias("size_class"), F.explode(F.slice("hs", F.lit(1), k)).alias("h"))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    share_percent: int = SHARE_PERCENT,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles) for items that a document contains.

    ``n_shingles`` counts the item's distinct shingles, ``n_shared`` those the
    document has; a pair counts if n_shared is at least the share of n_shingles.
    Items of fewer than ``width`` words have no shingle and match nothing; so do
    null texts, and rows without an id are left out. Repeated rows of an id count
    as one with the shingles of all. Columns beside id and text aren't read.
    Empty tables give an empty result.

    The text is read once, and once more for candidate documents only. An item
    that many documents contain makes one row per document, never pairs of
    documents. Sketches and item shingles are broadcast up to BROADCAST_ROWS.
    """
    item_rows = shingle_rows(items.filter(F.col(item_col).isNotNull()), item_col, item_text_col, width)
    item_shingles = staged(item_rows.select(F.col("id").alias("item"), "h").distinct(), "item-shingles")
    sketch = staged(sketches(item_shingles, share_percent), "sketches")
    known = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    found = shingle_rows(known, "__id", "__text", width).join(_bounded(sketch.select("h", "item", "n")), "h")
    candidates = staged(found.select("id", "item", "n").distinct(), "candidates")
    suspects = known.join(candidates.select(F.col("id").alias("__id")).distinct(), "__id", "left_semi")
    shared = (
        shingle_rows(suspects, "__id", "__text", width)
        .join(_bounded(item_shingles), "h")
        .select("id", "item", "h").distinct()
        .groupBy("id", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    )
    return (
        shared.join(candidates, ["id", "item"])
        .filter(100 * F.col("n_shared") >= share_percent * F.col("n"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_shared", F.col("n").alias("n_shingles"))
    )


def drop_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that ``leaks`` names; rows without an id stay."""
    leaked = staged(leaks.select(F.col(id_col).alias("__leaked")).distinct(), "leaked")
    return docs.join(leaked, F.col(id_col) == F.col("__leaked"), "left_anti")
