"""The pipeline against a plain version of its stages, on the smallest tables."""

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests_llm_shared import brute_components, check_packing, plain_repeats

SF = "/root/testdata/sf0.001"


def plain_quality(docs, sources):
    failed = {}
    for doc, text in docs.items():
        words = text.encode().split()
        failed[doc] = len(words) < 10 or 100 * plain_repeats(words) > 20 * len(words)
    n = Counter(sources[d] for d in docs)
    f = Counter(sources[d] for d in docs if failed[d])
    total, bad = sum(n.values()), sum(f.values())
    m, h = bad / total, len(n)
    spread = sum(f[s] ** 2 / n[s] for s in n) - bad * bad / total
    phi = (spread / (m * (1 - m)) - (h - 1)) / (total - sum(x * x for x in n.values()) / total - (h - 1))
    weight = 1 / min(max(phi, 1e-6), 1 - 1e-6) - 1
    rejected = {s for s in n if (f[s] + m * weight) / (n[s] + weight) > 0.5}
    return {d: t for d, t in docs.items() if not failed[d] and sources[d] not in rejected}


def line_key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(docs):
    holders = {}
    for doc, text in docs.items():
        for line in text.split("\n"):
            holders.setdefault(line_key(line), set()).add(doc)
    keeper = {k: max(v) for k, v in holders.items() if len(k) >= 20 and len(v) >= 3}
    return {
        d: "\n".join(x for x in t.split("\n") if keeper.get(line_key(x), d) == d) for d, t in docs.items()
    }


def plain_leaks(docs, items):
    def runs(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    wanted = [x for x in map(runs, items) if x]
    return {d: t for d, t in docs.items() if not any(100 * len(w & runs(t)) >= 80 * len(w) for w in wanted)}


def test_stages_equal_the_plain_version(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in table.collect()}
    sources = {r.doc_id: r.source for r in table.collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, given):
        rows = spark.createDataFrame([(d, t) for d, t in given.items()], "doc_id long, text string")
        frame = table.drop("text").join(rows, "doc_id").select(*table.columns)
        found = stages[name](spark, frame, SF)
        assert found.columns == table.columns
        result = {r.doc_id: r.text for r in found.collect()}
        assert len(result) == found.count()
        return result

    docs = {d: t or "" for d, t in docs.items()}
    assert kept("quality_rules", docs) == (docs := plain_quality(docs, sources))
    assert kept("line_dedup", docs) == (docs := plain_lines(docs))
    root = brute_components(docs, 5, 80)
    assert kept("near_dedup", docs) == (docs := {d: t for d, t in docs.items() if root[d] == d})
    assert kept("decontamination", docs) == (docs := plain_leaks(docs, items))
    check_packing(docs, corpus_pipeline.run(spark, SF).collect())


def test_names_and_empty_tables(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0).withColumn("kept", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
