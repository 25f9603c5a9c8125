"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is a set of words weighted by how often they occur. For each sample number
and word a stretch r ~ Gamma(2, 1), a level c ~ Gamma(2, 1) and a shift b in [0, 1)
come from a hash, the same for every text. A word of weight w is taken at the step
t = floor(ln w / r + b), which gives ln y = r (t - b) and the key ln a = ln c - ln y - r.
The sample is the (word, t) with the least key; two texts have the same one with the
probability sum(min weights) / sum(max weights), their generalised Jaccard similarity.
A fingerprint is 16 bits of each sample, in hex.

The least key of a text of n words is Exp(n), so it lies below 40 / n but for a chance
of e^-40. A word whose key has a lower bound above that is passed over before any
logarithm is taken; the bound is made of the same draws, so it holds in every text.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import lower_ascii, staged, word_list
from tillflow.llm.ranks import ranked

SAMPLES = 48
DIGITS = 4  # of one sample
# Samples that a row of words is drawn for at once, and the bound on n times the least key.
SAMPLES_AT_ONCE = 4
MOST = 40.0


# --- weights and samples --------------------------------------------------------------


def _uniform(bits: Column, most: int) -> Column:
    """A number between 0 and 1 from a whole number below ``most``."""
    return (bits.cast("double") + 0.5) * (1.0 / most)


def _weighted(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` plus (h, w, n) for each distinct word of ``text``: its hash, its count, all counts. One row of nulls where there is none."""
    hashes = F.sort_array(F.transform(word_list(lower_ascii(F.col("text"))), lambda word: F.xxhash64(word)))
    hashed = rows.select(*keep, hashes.alias("hashes"))
    new = lambda i: (i == 0) | (F.get("hashes", i) != F.get("hashes", i - 1))
    places = F.when(F.size("hashes") > 0, F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), new))
    begun = hashed.select(*keep, "hashes", places.alias("begins"))
    ended = begun.select(
        *keep, "hashes", "begins", F.size("hashes").alias("n"),
        F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("hashes"))).alias("ends"),
    )
    words = F.zip_with("begins", "ends", lambda b, e: F.struct(F.get("hashes", b).alias("h"), (e - b).alias("w")))
    return ended.select(*keep, "n", F.inline_outer(words))


def _least_keys(words: DataFrame, keep: list[str], samples: int) -> DataFrame:
    """``keep``, the number of a run of samples, and the least keys k0, k1, ... of that run.

    A key is a long: 31 bits of ln a, then 16 of (word, t). The steps are columns
    of their own so that each is computed once.
    """
    run = range(min(SAMPLES_AT_ONCE, samples))
    low21, low32 = F.lit((1 << 21) - 1), F.lit((1 << 32) - 1)

    def each(name: str, make) -> list[Column]:
        return [make(j).alias(f"{name}{j}") for j in run]

    def at(name: str, j: int) -> Column:
        return F.col(f"{name}{j}")

    def all_of(*names: str) -> list[str]:
        return [f"{name}{j}" for name in names for j in run]

    runs = F.lit(list(range(-(-samples // len(run)))))
    drawn = words.select(
        *keep, "h", F.ln("w").alias("log_weight"), F.col("w").cast("double").alias("w"),
        (MOST * F.col("w") / F.col("n")).alias("bar"), F.explode(runs).alias("run"),
    )
    fixed = [*keep, "run", "log_weight", "w", "bar"]
    drawn = drawn.select(*fixed, *each("first", lambda j: F.xxhash64("h", F.col("run") * len(run) + j)))
    drawn = drawn.select(*fixed, *all_of("first"), *each("second", lambda j: F.xxhash64(at("first", j))))
    # r = -ln p and c = -ln q, with p and q products of two uniform numbers.
    drawn = drawn.select(
        *fixed, *all_of("second"),
        *each("p", lambda j: _uniform(at("first", j).bitwiseAND(low21), 1 << 21)
              * _uniform(F.shiftright(at("first", j), 21).bitwiseAND(low21), 1 << 21)),
        *each("q", lambda j: _uniform(at("second", j).bitwiseAND(low32), 1 << 32)
              * _uniform(F.shiftrightunsigned(at("second", j), 32), 1 << 32)),
        *each("shift", lambda j: _uniform(F.shiftrightunsigned(at("first", j), 43), 1 << 21)),
    )

    # a = c p^(1 - b) at weight 1, at least c p / w else; c >= 1 - q; p^x >= p / (x + (1 - x) p).
    def stretch(j: int) -> Column:
        p, shift = at("p", j), at("shift", j)
        within = F.when(F.col("w") == 1, p / (1 - shift + shift * p)).otherwise(p)
        return F.when((1 - at("q", j)) * within <= F.col("bar"), -F.ln(p))

    drawn = drawn.select(*fixed, *all_of("second", "q", "shift"), *each("stretch", stretch))
    drawn = drawn.select(
        *fixed, *all_of("second", "q", "shift", "stretch"),
        *each("step", lambda j: F.floor(F.col("log_weight") / at("stretch", j) + at("shift", j))),
    )
    kept_bits = F.lit((1 << 4 * DIGITS) - 1)

    def key(j: int) -> Column:
        level = F.ln(-F.ln(at("q", j))) - at("stretch", j) * (at("step", j) + 1 - at("shift", j))  # between -80 and 4
        name = (F.shiftright(at("second", j), 20) + at("step", j)).bitwiseAND(kept_bits)
        return F.when(
            at("stretch", j).isNotNull(), F.shiftleft(F.floor((level + 128) * (1 << 23)), 4 * DIGITS).bitwiseOR(name)
        )

    return drawn.groupBy(*keep, "run").agg(*[F.min(key(j)).alias(f"k{j}") for j in run])


def signed(rows: DataFrame, *keep: str, samples: int = SAMPLES) -> DataFrame:
    """``keep`` plus ``fingerprint`` of the texts of ``rows``; ``keep`` must tell rows apart. '' for a text without words.

    ``samples`` is a multiple of SAMPLES_AT_ONCE, or less. Words are counted inside
    their row, so memory is bounded by one text, and each task sends a few rows per
    text at most.
    """
    least = _least_keys(_weighted(rows, *keep), list(keep), samples)
    digits = [
        F.lpad(F.lower(F.hex(F.coalesce(F.col(c), F.lit(0)).bitwiseAND(F.lit((1 << 4 * DIGITS) - 1)))), DIGITS, "0")
        for c in least.columns if c not in (*keep, "run")
    ]
    has_words = reduce(or_, [F.col(c).isNotNull() for c in least.columns if c not in (*keep, "run")])
    parts = least.select(*keep, F.struct("run", F.when(has_words, F.concat(*digits)).otherwise("").alias("part")).alias("part"))
    whole = parts.groupBy(*keep).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select(*keep, F.array_join("parts.part", "").alias("fingerprint"))


def likeness(one: Column, other: Column, samples: int = SAMPLES) -> Column:
    """The share of samples that two fingerprints have in common: an estimate of the generalised Jaccard similarity."""
    same = F.lit(0)
    for k in range(samples):
        at = DIGITS * k + 1
        same = same + (F.substring(one, at, DIGITS) == F.substring(other, at, DIGITS)).cast("int")
    return F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(same / samples)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """(id, text, fingerprint), one row per row of ``docs``. Null texts count as empty."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    return signed(rows, "id", "row", samples=samples)


# --- edits ----------------------------------------------------------------------------


def _links(docs: DataFrame, text_hash: Column) -> DataFrame:
    """For each id the id after it (the first comes after the last), how much of it is wanted, and which row stands for it.

    Ids are dealt by range; only the ends of the ranges meet in one task.
    """
    ids = (
        docs.filter("id IS NOT NULL")
        .groupBy("id").agg(F.max(F.expr("char_length(text) div 2")).alias("wanted"), F.min(text_hash).alias("stand_in"))
    )
    placed = ranked(ids.withColumn("all", F.lit(0)), "all", ["id"])
    placed = staged(placed.select("id", "wanted", "stand_in", "place", "total"), "ids")
    before = placed.select(
        F.expr("(place + 1) % total").alias("place"), F.col("id").alias("previous"), F.col("wanted").alias("most")
    )
    return staged(placed.join(before, "place").select("id", "stand_in", "previous", "most"), "links")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Each text with the edited one, and the links between ids.

    In the edited text the last half of the code points (rounded down) is replaced
    by as many from the start of the next document, or all of it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.col(id_col).cast("long")
    # Rows without an id spread by their text; they have no place in the order.
    rows = docs.select(
        F.coalesce(own, F.xxhash64(text)).alias("key"), own.isNotNull().alias("known"), text.alias("text"),
        F.xxhash64(text).alias("text_hash"), F.monotonically_increasing_id().alias("row"),
    )
    links = _links(docs.select(own.alias("id"), text.alias("text")), F.xxhash64("text"))
    wanted = links.select(F.col("id").alias("key"), F.col("id").isNotNull().alias("known"), "stand_in", "previous", "most")
    heads = (
        rows.join(wanted, ["key", "known"])
        # One row stands for the rows of an id; said so that it is no join key, and both joins share one exchange.
        .filter(F.least("text_hash", "stand_in") == F.greatest("text_hash", "stand_in"))
        .select(
            F.col("previous").alias("key"), F.col("previous").isNotNull().alias("known"),
            F.substring("text", F.lit(1), F.col("most").cast("int")).alias("head"), "row",
        )
        .groupBy("key", "known").agg(F.min_by("head", "row").alias("head"))
    )
    length = F.char_length("text")
    half = F.expr("char_length(text) div 2").cast("int")
    changed = F.concat(F.substring("text", F.lit(1), length - half), F.substring("head", F.lit(1), half))
    met = rows.join(heads, ["key", "known"], "left").select(
        "key", "known", "row", "text_hash", length.cast("long").alias("n_chars"), "text",
        F.when(F.col("known"), changed).alias("edited"),
    )
    return met, links


def compare_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they are to the edit and to the next document.

    Null texts are empty. Ids ascend; rows that share an id are followed by the same
    next id, and where an id is the next one, the row with the smallest hash of its
    text stands for it. A row without an id has no next one: its edited text and
    both likenesses are null. A single document follows itself. Other columns aren't
    read. An empty table has no rows.

    Texts cross one shuffle, by id, and the heads of next documents another; rows
    that share an id meet in one task.
    """
    met, links = edited(docs, id_col, text_col)
    keep = ["key", "known", "row", "text_hash", "n_chars", "edited_sha256"]
    kinds = F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))
    texts = met.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keep, F.inline(kinds))
    found = signed(texts, *keep, "kind", samples=samples).groupBy(*keep).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when((F.col("kind") == 1) & F.col("known"), F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    found = staged(found, "fingerprints")
    stand_ins = found.filter("known").select("key", "text_hash", F.col("fingerprint").alias("next_fingerprint"))
    following = staged(
        links.join(stand_ins.distinct(), (F.col("id") == F.col("key")) & (F.col("stand_in") == F.col("text_hash")))
        .select(F.col("previous").alias("key"), F.lit(True).alias("known"), "next_fingerprint"),
        "next-fingerprints",
    )
    near_next = F.when(F.col("known"), likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples))
    return found.join(following, ["key", "known"], "left").select(
        F.when(F.col("known"), F.col("key")).alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"), near_next.alias("near_next"),
    )
