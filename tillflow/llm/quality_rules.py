"""Quality rules by host, in DataFrame functions only.

Each document is measured; documents that fail the base rule are counted by host;
host failure rates are shrunk with a beta prior fitted to all hosts; documents of
a host whose shrunk rate is too high go as well.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import staged, windows_of, word_list

SYMBOLS = "[^#*$%&|<>]+"  # removed to leave the symbols
REPEAT_WIDTH = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_HOST_RATE = 0.5
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def add_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus FEATURES (long) and ``base_failed``.

    Null and empty texts measure 0 throughout and fail, as they have no words.
    Columns that have these names are replaced. Only row-wise functions: no
    shuffle, and a long text is n log n. Word windows are compared by 64-bit
    hashes within one text; a text is sorted only if some window is repeated.
    """
    base = [F.col(c) for c in docs.columns if c not in (*FEATURES, "base_failed")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    worded = docs.select(
        *base,
        word_list(text).alias("__words"),
        F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )
    hashes = F.transform(
        windows_of(F.col("__words"), REPEAT_WIDTH),
        lambda w: F.xxhash64(*[w[f"w{i}"] for i in range(REPEAT_WIDTH)]),
    )
    hashed = worded.select(
        *base, "n_symbols", "n_dup_lines",
        F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        hashes.alias("__hashes"),
    )
    placed = F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    is_repeated = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    ordered = hashed.withColumn(
        "__sorted", F.when(is_repeated, F.array_sort(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    ).drop("__hashes")
    seen = F.transform(
        "__sorted",
        lambda e, i: F.when(
            (e["h"] == F.get("__sorted", i - 1)["h"]) | (e["h"] == F.get("__sorted", i + 1)["h"]), e["i"]
        ),
    )
    starts = ordered.withColumn("__starts", F.array_sort(F.filter(seen, lambda p: p.isNotNull()))).drop("__sorted")
    covered = F.aggregate(
        F.transform(
            "__starts",
            lambda p, i: F.least(
                F.lit(REPEAT_WIDTH), F.coalesce(F.get("__starts", i + 1) - p, F.lit(REPEAT_WIDTH))
            ),
        ),
        F.lit(0), lambda total, n: total + n,
    )
    measured = starts.withColumn("n_repeat_words", covered.cast("long")).drop("__starts")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return measured.select(*base, *FEATURES, failed.alias("base_failed"))


def host_rates(features: DataFrame, host_col: str = "source") -> DataFrame:
    """One row for each host: ``host_docs``, ``host_failed`` and the shrunk ``host_rate``.

    The beta prior is fitted by moments to all hosts: its mean is the overall
    rate m, and with S the sum over hosts of n (rate - m)^2, its spread phi is
    (S / (m (1 - m)) - (H - 1)) / (N - sum(n^2) / N - (H - 1)), kept between 1e-6
    and 1 - 1e-6; the prior counts for 1 / phi - 1 documents. One host, or hosts
    that all pass or all fail, take the lower end. A null host is no host and
    gives no row. Counts are combined before the shuffle, so one host may hold
    most rows; the prior is one row.
    """
    hosts = staged(
        features.filter(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("host"))
        .agg(
            F.count(F.lit(1)).alias("host_docs"),
            F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
        ),
        "hosts",
    )
    n, f = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    sums = hosts.agg(
        F.sum(n).alias("n"), F.sum(f).alias("f"), F.sum(n * n).alias("nn"),
        F.sum(f * f / n).alias("ff"), F.count(F.lit(1)).cast("double").alias("h"),
    )
    m = F.col("f") / F.col("n")
    spread = F.col("ff") - F.col("f") * F.col("f") / F.col("n")
    top = F.try_divide(spread, m * (1 - m)) - (F.col("h") - 1)
    phi = F.try_divide(top, F.col("n") - F.col("nn") / F.col("n") - (F.col("h") - 1))
    phi = F.least(F.greatest(F.coalesce(phi, F.lit(0.0)), F.lit(1e-6)), F.lit(1 - 1e-6))
    prior = sums.select(F.struct(m.alias("mean"), (1 / phi - 1).alias("weight"))).scalar()
    rate = (f + prior["mean"] * prior["weight"]) / (n + prior["weight"])
    return hosts.select("host", "host_docs", "host_failed", rate.alias("host_rate"))


def judge(
    features: DataFrame, host_col: str = "source", max_host_rate: float = MAX_HOST_RATE
) -> DataFrame:
    """``features`` plus ``kept``: false if the base rule failed or the host's shrunk rate is too high.

    Pass a staged table: it is read once for the counts and once for the verdicts.
    Documents without a host are judged by the base rule alone.
    """
    rejected = staged(
        host_rates(features, host_col).filter(F.col("host_rate") > max_host_rate)
        .select(F.col("host").alias("__host"), F.lit(True).alias("__bad")),
        "rejected-hosts",
    )
    names = [c for c in features.columns if c != "kept"]
    judged = features.select(*names).join(rejected, F.col(host_col) == F.col("__host"), "left")
    kept = ~F.col("base_failed") & F.col("__bad").isNull()
    return judged.select(*names, kept.alias("kept"))

