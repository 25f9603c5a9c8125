"""Divergence of sources, Merkle manifest and fingerprints: SQL twins, plain versions, edge cases."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from tillflow.llm import divergence, fingerprints, merkle, ranks
from tillflow.llm.oracle import SQL
from tillflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_merkle_manifest"])
def test_query_equals_sql(spark, name):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    ours = QUERIES[name](spark, SF).toPandas()
    assert len(ours) and check.tidy(ours).equals(check.tidy(sql.sql(SQL[name]).df()))


def test_ranks_of_hot_and_null_groups(spark):
    rows = [(None, 3), (None, 1), ("a", None), *[("a", 5)] * 40, ("a", 4), ("b", 1)]
    found = ranks.ranked(spark.createDataFrame(rows, "g string, x int").withColumn("place_of", F.lit(1)), "g", ["x"]).collect()
    by = {}
    for r in found:
        by.setdefault(r.g, []).append((r.place, r.x, r.total))
    assert sorted(by[None]) == [(0, 1, 2), (1, 3, 2)] and by["b"] == [(0, 1, 1)]
    assert sorted(by["a"]) == [(0, None, 42), (1, 4, 42), *[(i, 5, 42) for i in range(2, 42)]]
    assert ranks.ranked(spark.createDataFrame([], "g string, x int"), "g", ["x"]).collect() == []


# --- divergence -------------------------------------------------------------------------


def plain_terms(text):
    keep = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in text or "")
    return "".join(c.lower() if c.isascii() else c for c in keep).split(" ")


def plain_audit(rows, min_docs, top):
    counts, docs, groups = {}, {}, {}
    for _, text, lang, source, _ in rows:
        own = Counter(t for t in plain_terms(text) if t)
        counts.setdefault((lang or "", source or ""), Counter()).update(own)
        docs.setdefault(lang or "", Counter()).update(own.keys())
        groups.setdefault(lang or "", set()).add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(own, kept=kept):
            over = sum(own[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (own[t] + 5) // over for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def audit_rows(seed=3):
    rng = random.Random(seed)
    words = [f"{c}{d}" for c in "abcdéßÉ𝒳" for d in ["", "x", "Y", "zz", " "]]
    rows = [
        (i, rng.choice([" ", "\n", "1", "-"]).join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None, ""]),
         rng.choice(["s", "t", "u", None, "é"]), 1)
        for i in range(300)
    ]
    return [*rows, (1, None, "en", "empty", 1), (2, "", "xx", "a", 1), (3, "rare", "xx", "b", 1), (3, "rare", "xx", "b", 1), (None, "a ax", "en", "s", None)]


@pytest.mark.parametrize(("segment", "at_once"), [(1024, 32), (4, 2), (1, 1)])
def test_audit_equals_a_plain_version(spark, segment, at_once):
    rows = audit_rows()
    frame = spark.createDataFrame(rows, ROWS).withColumns({"term": F.lit(1), "place": F.lit(2), "n": F.lit(3)})
    found = divergence.audit(frame, min_docs=5, top_terms=7, segment=segment, sources_at_once=at_once).collect()
    assert sorted(map(tuple, found)) == plain_audit(rows, 5, 7)


def test_audit_of_nothing_and_of_large_counts(spark):
    assert divergence.audit(spark.createDataFrame([], ROWS)).collect() == []
    trees = divergence.Trees(np.array([[10**15, 0, 3, -1], [7, 10**15, 3, -1]]))
    totals = [10**15 + 3, 10**15 + 10]
    shares = np.array([trees.shares(t, 3) for t in totals])
    p = [[1 + 10**9 * (c + 5) // (t + 15) for c in row] for t, row in zip(totals, ([10**15, 0, 3], [7, 10**15, 3]), strict=True)]
    assert trees.differences(np.array([0]), np.array([1]), shares).tolist() == [sum(abs(a - b) for a, b in zip(*p, strict=True))]


def test_equal_subtrees_are_one_node():
    trees = divergence.Trees(np.tile([1, 2, 1, 2], (3, 16)))
    assert [len(lower) for lower, _ in trees.children] == [1] * 6 and len(set(trees.tops)) == 1


def test_terms_of_a_long_text():
    assert divergence.text_terms(b"Ab1cd-ab " * 400_000) == {b"ab": 800_000, b"cd": 400_000}
    assert divergence.text_terms(("é" * 1_500_000).encode()) == {("é" * 1_500_000).encode(): 1}


# --- manifest ---------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def plain_sides(levels, i):
    sides = []
    for nodes in levels[:-1]:
        start = i - i % 3
        sides.append((nodes[start:i], nodes[i + 1 : start + 3]))
        i //= 3
    return sides


def plain_manifest(rows):
    by = {}
    for row in rows:
        by.setdefault(row[3], []).append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(*r)))
    trees = {s: plain_tree([plain_leaf(*r) for r in own]) for s, own in by.items()}
    top, out = plain_tree([trees[s][-1][0] for s in names]), []
    for k, s in enumerate(names):
        for i, row in enumerate(by[s]):
            sides = plain_sides(trees[s], i) + plain_sides(top, k)
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = plain_leaf(row[0], text, *row[2:])
            for before, after in sides:
                node = sha(*before, node, *after)
            proof = sha(*(x for before, after in sides for x in before + after))
            out.append((row[0], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [7, 1, 2])
def test_manifest_equals_a_plain_version(spark, levels):
    rows = [(i * 7, f"line {i}\nmore é", "en", f"s{i % 4 if i % 3 else 0}", i) for i in range(150)]
    rows += [(None, "a\nb", None, None, None), (2, None, "en", None, 0), (2, "", "en", "", 0), (5, "x", "de", "é", 1)]
    rows += [(3, "same\n", "en", "s0", 5)] * 9 + [(9, "long\n" * 300_000, "en", "s1", 1_500_000)]
    frame = spark.createDataFrame(rows, ROWS).withColumns({"leaf": F.lit(1), "grp": F.lit(2), "root": F.lit(3)})
    found = merkle.verify(merkle.manifest(frame, tampered={"text": merkle.dropped_breaks()}, block_levels=levels))
    assert sorted(map(tuple, found.collect()), key=str) == plain_manifest(rows)


def test_manifest_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], ROWS)
    assert merkle.verify(merkle.manifest(empty)).collect() == []
    row = merkle.verify(merkle.manifest(spark.createDataFrame([(1, "a", None, None, 1)], ROWS))).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("") and row.verified


# --- fingerprints -----------------------------------------------------------------------


def words_of(text):
    return Counter((text or "").encode().lower().split())


def similarity(a, b):
    a, b = words_of(a), words_of(b)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def edit(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def test_edits_and_likeness_on_all_documents(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs)
    following = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    found = {r.doc_id: r for r in QUERIES["op13_fingerprints"](spark, SF).collect()}
    assert set(found) == set(ids)
    errors = []
    for i in ids:
        r, changed = found[i], edit(docs[i], docs[following[i]])
        assert r.n_chars == len(docs[i]) and r.edited_sha256 == sha(changed)
        agreed = [r.fingerprint[k : k + 4] == r.edited_fingerprint[k : k + 4] for k in range(0, 4 * fingerprints.SAMPLES, 4)]
        assert r.near_edited == (sum(agreed) / fingerprints.SAMPLES if r.fingerprint and r.edited_fingerprint else float(r.fingerprint == r.edited_fingerprint))
        errors += [r.near_edited - similarity(docs[i], changed), r.near_next - similarity(docs[i], docs[following[i]])]
    # 48 samples: a standard error of at most 0.072, and no bias.
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.072 and np.abs(errors).max() < 0.3


def test_weights_count(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    pairs = []
    for n in range(60):
        a = rng.choices(vocabulary, k=400, weights=range(1, 301))
        b = a[: 40 * (n % 10)] + rng.choices(vocabulary, k=400 - 40 * (n % 10))
        pairs.append((" ".join(a), " ".join(b)))
    rows = [(2 * i + k, text) for i, pair in enumerate(pairs) for k, text in enumerate(pair)]
    found = {r.id: r.fingerprint for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), samples=128).collect()}
    errors = []
    for i, (a, b) in enumerate(pairs):
        one, other = found[2 * i], found[2 * i + 1]
        errors.append(sum(one[k : k + 4] == other[k : k + 4] for k in range(0, 512, 4)) / 128 - similarity(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_fingerprint_edges(spark):
    rows = [
        (5, "a b c d"), (5, "e f g h i"), (7, None), (9, ""), (11, " \n "), (12, "é𝒳 é𝒳 É"), (12, "é𝒳 é𝒳 É"), (None, "a b c d"),
        (20, "long " * 300_000 + "A B"), (21, "B a\x0blong \t" + "LONG " * 299_999),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit("k"), "n_chars": F.lit("n"), "row": F.lit(1)})
    found = fingerprints.compare_edits(frame).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    lone = by[None][0]
    assert lone.edited_sha256 is None and lone.edited_fingerprint is None and lone.near_edited is None and lone.near_next is None
    assert lone.fingerprint in {r.fingerprint for r in by[5]}
    assert by[7][0].fingerprint == by[9][0].fingerprint == by[11][0].fingerprint == "" and by[7][0].near_next == 1.0
    assert by[11][0].edited_sha256 == sha(" \n" + "é") and by[11][0].near_edited == 0.0
    assert by[12][0] == by[12][1] and by[20][0].fingerprint == by[21][0].fingerprint and by[20][0].near_next == 1.0
    assert by[21][0].edited_sha256 in {sha(edit(rows[9][1], t)) for _, t in rows[:2]}
    assert fingerprints.compare_edits(frame.limit(0)).collect() == []
    one = fingerprints.compare_edits(spark.createDataFrame([(3, "abcd x")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == sha("abc" + "abc")
