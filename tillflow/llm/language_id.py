"""Language identification by multilingual mixture inference.

A language is a distribution of hashed letter trigrams. Expectation-maximisation
gives the shares of the languages that make a document's trigrams most likely;
how many languages it has is decided by penalised likelihood.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import mix

BUCKET_BITS = 15
SMOOTHING = 0.05
STEPS = 12
# What another language must add to the log-likelihood, in units of log(number of trigrams).
PENALTY = 8.0
# Languages below this share in the mixture of all are not tried in the set.
LEAST_SHARE = 0.01
# Labelled documents of a language that are learned from, about; more are thinned by a hash of the id.
LEARNED_DOCS = 4_000
HELD_OUT = 2
UNKNOWN = "und"
_BLOCK = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def has_letter(text: str | None) -> bool:
    """Whether a character of the text is alphabetic: the rule that trigrams go by as well."""
    return any(map(str.isalpha, text or ""))


class _Letters:
    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table


def trigram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the trigrams of letters and single gaps, over the whole text."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for at in range(0, len(text), _BLOCK):
        part = " " + text[at : at + _BLOCK].lower() + " "
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(_Letters.get()[points], points, 32).astype(np.uint64)
        gap = points == 32
        points = points[~(gap & np.concatenate([[False], gap[:-1]]))]
        if len(points) >= 3:
            key = points[:-2] * _FACTORS[0] + points[1:-1] * _FACTORS[1] + points[2:] * _FACTORS[2]
            counts += np.bincount((mix(key) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(counts))
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    chances: np.ndarray  # languages x buckets

    def shares(self, chances: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Shares of the languages by expectation-maximisation, and the log-likelihood."""
        share = np.full(len(chances), 1 / len(chances))
        total = counts.sum()
        for _ in range(STEPS if len(chances) > 1 else 0):
            joint = share[:, None] * chances
            share = joint @ (counts / joint.sum(axis=0)) / total
        return share, float(counts @ np.log(share @ chances))

    def mixture(self, text: str | None) -> list[tuple[str, float]]:
        """The languages of a text and their shares, largest first; none without a letter or a model."""
        if not has_letter(text) or not self.languages:
            return []
        counts = trigram_counts(text)
        seen = np.flatnonzero(counts)
        counts, chances = counts[seen].astype(float), self.chances[:, seen]
        of_all, _ = self.shares(chances, counts)
        order = np.argsort(-of_all, kind="stable")
        best, best_worth = None, -np.inf
        for size in range(1, len(order) + 1):
            if size > 1 and of_all[order[size - 1]] < LEAST_SHARE:
                break
            share, likelihood = self.shares(chances[order[:size]], counts)
            worth = likelihood - PENALTY * (size - 1) * np.log(counts.sum() + 1)
            if worth <= best_worth:
                break
            best, best_worth = share, worth
        return [
            (self.languages[order[i]], float(min(max(best[i], 0.0), 1.0))) for i in np.argsort(-best, kind="stable")
        ]

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the largest share, and that share; UNKNOWN and 0 without a letter or a model."""
        found = self.mixture(text)
        return found[0] if found else (UNKNOWN, 0.0)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of the id as text, mod 4, is HELD_OUT. False without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            own = trigram_counts(text.as_py())
            lang = lang.as_py()
            counts[lang] = counts[lang] + own if lang in counts else own
    for lang, own in counts.items():
        seen = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(own[seen], pa.int64())],
            ["lang", "bucket", "n"],
        )


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    learned_docs: int = LEARNED_DOCS,
) -> LanguageModel:
    """Learns every language that labels a document outside the held-out part.

    Documents without an id, text or language aren't learned from. Of a language
    with more than ``learned_docs`` documents about that many are used, chosen by
    a hash of the id. Counts are combined in the tasks and before the driver
    gets them: at most 2 ** BUCKET_BITS rows for each language.
    """
    known = docs.filter(
        F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col)
    ).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("at"))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    chances = np.zeros((len(languages), 1 << BUCKET_BITS))
    if not languages:
        return LanguageModel([], chances)
    bars = F.create_map(*[
        F.lit(x) for lang in languages for x in (lang, int(min(1.0, learned_docs / sizes[lang]) * (2**63 - 1024)))
    ])
    chosen = known.filter(F.col("at").bitwiseAND(F.lit(2**63 - 1)) <= bars[F.col("lang")]).select("lang", "text")
    counted = chosen.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    rows = np.array([languages.index(x) for x in found["lang"].to_pylist()], np.int64)
    chances[rows, found["bucket"].to_numpy()] = found["n"].to_numpy()
    chances += SMOOTHING
    return LanguageModel(languages, chances / chances.sum(axis=1, keepdims=True))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``languages``, ``lang_pred`` and ``score``, from the text alone.

    ``languages`` holds each language of the text and its share, largest first;
    ``lang_pred`` and ``score`` are the first of them. A null text, or one
    without a letter, has none and is UNKNOWN with score 0, as is every text if
    nothing was learned. Columns of these names are replaced, others
    pass through; repeated rows are each judged. Nothing is shuffled; the model
    has a fixed size for each language.
    """
    languages, chances = model.languages, model.chances

    @F.arrow_udf("array<struct<lang: string, share: double>>")
    def mixtures(texts: pa.Array) -> pa.Array:
        own = LanguageModel(languages, chances)
        found = [[{"lang": x, "share": share} for x, share in own.mixture(t.as_py())] for t in texts]
        return pa.array(found, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))

    names = [c for c in docs.columns if c not in ("languages", "lang_pred", "score")]
    top = F.get("languages", F.lit(0))
    return docs.select(*names, mixtures(text_col).alias("languages")).select(
        *names, "languages", F.coalesce(top["lang"], F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(top["share"], F.lit(0.0)).alias("score"),
    )
