import duckdb
import pytest
from tests_llm_shared import brute_components

import check
from tillflow.llm import near_dedup
from tillflow.llm.oracle import SQL
from tillflow.llm.queries import QUERIES


def run(frame, **more):
    rows = near_dedup.near_duplicates(frame, **({"width": 3, "share_percent": 85} | more)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)


def brute(docs, width, percent):
    roots = brute_components(dict(docs), width, percent)
    return [(d, r, r == d) for d, r in sorted(roots.items())]


def test_equals_sql(spark):
    sql = duckdb.connect()
    sql.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    ours = QUERIES["op8_near_dedup"](spark, "/root/testdata/sf0.001").toPandas()
    assert check.tidy(ours).equals(check.tidy(sql.sql(SQL["op8_near_dedup"]).df()))


@pytest.mark.parametrize(("width", "percent", "region"), [(3, 85, 64), (5, 80, 64), (3, 85, 3)])
def test_chains_of_edits_equal_brute_force(spark, monkeypatch, width, percent, region):
    """Groups whose members drift apart, so links form chains; with tiny regions every depth is used."""
    monkeypatch.setattr(near_dedup, "REGION", region)
    docs, n = [], 0
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(120)]
        for step in range(25):
            words[(step * 7) % 120] = f"g{group}e{step}"
            docs.append((n, " ".join(words)))
            n += 1
    n_first = n
    docs += [(n, "alone in the world"), (n + 1, None), (n + 2, ""), (n + 3, " \n"), (n + 4, "one two"), (n + 5, "ONE\ttwo")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = run(frame, width=width, share_percent=percent)
    assert sorted((d, root, kept) for d, _, root, kept in found) == brute(docs, width, percent)
    assert {d: n for d, n, _, _ in found if d >= n_first} == {n: 2 if width == 3 else 1, n + 1: 0, n + 2: 0, n + 3: 0, n + 4: 1, n + 5: 1}


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d", 9), (1, "a b c d", 9), (2, "a b c d", 9), (None, "a b c d", 9), (3, None, 9), (5, "x y z", 1), (5, "p q r", 1), (4, "p q r", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept long").withColumn("id", frame_id()).withColumn("sig", frame_id())
    found = near_dedup.near_duplicates(frame, width=3, share_percent=85).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in found) == sorted([
        ("1", "1", True), ("1", "1", True), ("2", "1", False), ("None", "None", True), ("3", "3", True),
        ("5", "4", False), ("5", "4", False), ("4", "4", True),
    ])
    left = near_dedup.drop_near_duplicates(frame, near_dedup.near_duplicates(frame, width=3, share_percent=85))
    assert left.columns == frame.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "1", "3", "4", "None"]


def frame_id():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_empty_table(spark):
    assert run(spark.createDataFrame([], "doc_id long, text string")) == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(3, 259)]
    found = near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()
    roots = {r.id: r.root for r in found}
    assert len(roots) == len(found) == 60 + 61
    assert {roots[i] for i in range(101, 161)} == {100}
    assert {roots[i] for i in range(200, 260)} == {3} and roots[7] == 3


def test_planted_pairs_in_a_crowded_boilerplate_group(spark, monkeypatch):
    """Several hundred sets that share most shingles at 0.796, with pairs at 0.802 that share two more."""
    monkeypatch.setattr(near_dedup, "REGION", 32)
    monkeypatch.setattr(near_dedup, "BLOCK", 100, raising=False)  # block by block as well
    shared = [f"b{i}" for i in range(502)]
    docs = [
        (n, " ".join(shared + [f"d{n}w{i}" for i in range(60)] + [f"{f'p{n % 40}' if n < 80 else f'd{n}'}e{i}" for i in range(4)]))
        for n in range(400)
    ]
    found = run(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), width=3, share_percent=80)
    expected = brute(docs, 3, 80)
    assert sum(not kept for _, _, kept in expected) == 40
    assert sorted((d, root, kept) for d, _, root, kept in found) == expected
