"""URL filters: list rules first, then a logistic regression on hashed character n-grams of host and path."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
STEPS = 400
RATE = 1.0
RIDGE = 1e-4
# The share of urls to block that is expected outside the table, whose classes are about even.
BLOCK_PRIOR = 0.15
# Rows of the labelled table that are trained on at most; the table is small by its nature.
TRAINED_ROWS = 100_000

# Rules as host and path, and what they say.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# A small labelled table. Hosts are dealt over the endings and paths below.
BLOCKED_HOSTS = (
    "spam-farm spam-links link-farm adult-x adult-videos xxx-cams casino-win casino-online mega-casino "
    "cheap-pills pills-direct buy-pills free-bets bets-now sports-bets ads-track ads-server click-ads track-pixel "
    "win-cash free-cash poker-win loan-fast"
).split()
ALLOWED_HOSTS = (
    "city-library state-university daily-news history-museum weather-report river-school garden-notes "
    "music-review open-science travel-stories cooking-class local-paper math-lessons public-health "
    "bird-watch street-photos theatre-guide the-reader northern-times water-works art-letters tion-press "
    "ther-notes thing-works station-house motion-lab"
).split()
LABELLED_PREFIXES = ("", "www.", "m.", "blog.")
LABELLED_ENDINGS = (".example.com", ".example.net", ".example.org")
LABELLED_PATHS = ("/en/12", "/fr/408", "/de/77.html", "/es/951/", "/")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for block and 0 for allow): every listed host with every prefix, with endings and paths in turn."""
    rows = []
    for label, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS)):
        for i, host in enumerate(hosts):
            for j, prefix in enumerate(LABELLED_PREFIXES):
                for k, ending in enumerate(LABELLED_ENDINGS):
                    path = LABELLED_PATHS[(i + j + k) % len(LABELLED_PATHS)]
                    rows.append((f"https://{prefix}{host}{ending}{path}", label))
    return rows


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none does.

    A rule fits its host and all subdomains where the path starts with its own.
    Of rules of one length the one with the longer host wins.
    """
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Buckets of the distinct n-grams of host and path; each knows where it comes from."""
    found = set()
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            found.update(mark + text[i : i + n] for i in range(len(text) - n + 1))
    return np.array([xxhash.xxh32_intdigest(g) % BUCKETS for g in found], np.int64)


@dataclass
class UrlModel:
    weights: np.ndarray  # one for each bucket, and the bias: a fixed size
    bias: float

    def score(self, host: str, path: str) -> float:
        """The probability of block. Host or path may be empty."""
        found = grams(host, path)
        total = self.bias + self.weights[found].sum() / max(len(found), 1) ** 0.5
        return float(1 / (1 + np.exp(-total)))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> UrlModel:
    """Fits the model to a small table of urls and labels (1 block, 0 allow).

    At most TRAINED_ROWS rows are used, in order of the url. Nulls are left out;
    without rows the model blocks nothing. The bias is moved from the table's
    share of blocked urls to BLOCK_PRIOR.
    """
    url = F.col(url_col)
    rows = (
        labelled.filter(url.isNotNull() & F.col(label_col).isNotNull())
        .select(host_of(url), path_of(url), F.col(label_col).cast("double"), url.alias("url"))
        .orderBy("url").limit(TRAINED_ROWS).collect()
    )
    weights, bias = np.zeros(BUCKETS), -1.0
    if not rows:
        return UrlModel(weights, bias)
    found = [grams(r[0], r[1]) for r in rows]
    labels = np.array([r[2] for r in rows])
    row_of = np.repeat(np.arange(len(found)), [len(x) for x in found])
    bucket_of = np.concatenate(found)
    values = np.repeat([max(len(x), 1) ** -0.5 for x in found], [len(x) for x in found])
    for _ in range(STEPS):
        total = bias + np.bincount(row_of, weights[bucket_of] * values, len(found))
        error = 1 / (1 + np.exp(-total)) - labels
        slope = np.bincount(bucket_of, error[row_of] * values, BUCKETS) / len(found)
        weights -= RATE * 20 * (slope + RIDGE * weights)
        bias -= RATE * (error.mean() + RIDGE * bias)
    here = np.clip(labels.mean(), 0.01, 0.99)
    bias += np.log(BLOCK_PRIOR / (1 - BLOCK_PRIOR)) - np.log(here / (1 - here))
    return UrlModel(weights, float(bias))


def judge(
    pages: DataFrame, model: UrlModel, url_col: str = "url", rules=RULES, block_from: float = 0.5
) -> DataFrame:
    """``pages`` plus host, path, rule, block_score and verdict (allow or block).

    The verdict is the rule's where one fits, else the model's. A null url, or
    one without ``://``, has an empty host and path, fits no rule and is scored
    as such. Columns of these names are replaced, others pass through. Row by
    row, so nothing is shuffled; the model goes to the tasks with the function
    and has a fixed size.
    """
    weights, bias = model.weights, model.bias

    @F.arrow_udf("double")
    def block_score(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        own = UrlModel(weights, bias)
        return pa.array(
            [own.score(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)], pa.float64()
        )

    names = [c for c in pages.columns if c not in ("host", "path", "rule", "block_score", "verdict")]
    url = F.col(url_col)
    parted = pages.select(*names, host_of(url).alias("host"), path_of(url).alias("path"))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    scored = parted.select("*", rule.alias("rule"), says.alias("__says"), block_score("host", "path").alias("block_score"))
    own = F.when(F.col("block_score") >= block_from, "block").otherwise("allow")
    return scored.select(*names, "host", "path", "rule", "block_score", F.coalesce("__says", own).alias("verdict"))
