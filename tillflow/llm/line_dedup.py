"""Line dedup: lines that many documents share stay in one document only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import BLANKS, lower_ascii, staged

MIN_CHARS = 20
MIN_DOCS = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with the text cut to the lines that stay, plus ``n_lines`` and ``n_dropped``.

    Lines are exploded with their positions and hashed to 128 bits; distinct ids
    are counted for each hash; a hash in at least ``min_docs`` documents loses its
    lines in all of them but the one with the largest id. Positions to drop go
    back to the document, which puts the rest together in order.

    A null or empty text is one empty line. Rows without an id keep all lines
    and count for none. Rows that share an id are one document when counting,
    and each is cut by its own text. Other columns pass through; columns named
    ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.

    A frequent line spreads over tasks by document before it is counted, counts
    are combined before the shuffle, and the join of lines with the dropped
    hashes has plain shuffles on both sides, which adaptive execution splits.
    The text crosses one shuffle.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")
    )
    exploded = (
        source.filter("id IS NOT NULL")
        .select("id", "text_key", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
        .filter(F.char_length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .filter(F.char_length("key") >= min_chars)
    )
    lines = staged(
        exploded.select(
            "id", "text_key", "pos",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
        ),
        "lines",
    )
    holders = lines.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
    shared = staged(
        holders.agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "keeper"),
        "shared-lines",
    )
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .filter(F.col("id") != F.col("keeper"))
        .groupBy(F.col("id").alias("__id"), F.col("text_key").alias("__key"))
        .agg(F.collect_set("pos").alias("__drop"))
    )
    found = docs.withColumn("__text_key", F.xxhash64(text_col)).join(
        dropped, (F.col(id_col) == F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left"
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    split = found.select(
        *[F.col(c) for c in names],
        _lines(F.col(text_col)).alias("__lines"),
        F.coalesce("__drop", F.array().cast("array<int>")).alias("__drop"),
    )
    places = F.sequence(F.lit(0), F.size("__lines") - 1)
    stay = F.transform(F.array_except(places, "__drop"), lambda i: F.get("__lines", i))
    text = F.when(F.size("__drop") == 0, F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    return split.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in names],
        F.size("__lines").cast("long").alias("n_lines"),
        F.size("__drop").cast("long").alias("n_dropped"),
    )
