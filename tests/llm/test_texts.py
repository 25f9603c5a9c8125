"""Operators on lines, rules, notices and benchmark items: SQL twins, edge cases, empty tables."""

import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from tillflow.llm import common, decontamination, license_scan, license_texts, line_dedup, quality_rules
from tillflow.llm.oracle import SQL
from tillflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ["op1_line_dedup", "op2_license_scan", "op3_decontamination", "op4_quality_rules", "op6_warc"])
def test_query_equals_sql(spark, sql, name):
    ours = QUERIES[name](spark, SF).toPandas()
    assert check.tidy(ours).equals(check.tidy(sql.sql(SQL[name]).df()))


def test_word_hashes_follow_words_only():
    a, b, c, d = common.hashed_words("Foo bar\x0bfoo \t FOOÉ".encode())
    assert a == c and len({a, b, d}) == 3
    long = " ".join(f"w{i}" for i in range(300_000)).encode()
    assert (common.hashed_words(long)[-5:] == common.hashed_words(b"w299995 w299996 w299997 w299998 w299999")).all()
    assert len(common.hashed_words(None)) == len(common.hashed_words(b" \n")) == 0


# --- line dedup ---------------------------------------------------------------------


def lines_of(frame, **more):
    rows = line_dedup.dedup_lines(frame, **more).collect()
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in rows), key=str)


def test_shared_lines_stay_with_the_largest_id(spark):
    shared = "a line that many documents share"
    rows = [
        (1, f"one\n{shared}\n{shared}"), (2, f"  {shared.upper()}\t\nshort"), (3, f"{shared}\nx\n{shared}"),
        (4, "É line in only two documents\nx"), (5, "é line in only two documents\nx"), (6, None), (7, ""), (8, "\n"),
        (None, shared),
    ]
    assert lines_of(spark.createDataFrame(rows, DOCS)) == sorted([
        (1, "one", 3, 2), (2, "short", 2, 1), (3, f"{shared}\nx\n{shared}", 3, 0),
        (4, rows[3][1], 2, 0), (5, rows[4][1], 2, 0), (6, None, 1, 0), (7, "", 1, 0), (8, "\n", 2, 0), (None, shared, 1, 0),
    ], key=str)


def test_repeated_rows_are_one_document(spark):
    text = "the very same line in each of these"
    rows = [(1, text), (1, text), (1, text + "\nmore"), (2, text)]
    assert [r[3] for r in lines_of(spark.createDataFrame(rows, DOCS))] == [0, 0, 0, 0]
    found = lines_of(spark.createDataFrame([*rows, (3, text)], DOCS))
    assert found == sorted([(1, "", 1, 1), (1, "", 1, 1), (1, "more", 2, 1), (2, "", 1, 1), (3, text, 1, 0)], key=str)


def test_line_dedup_keeps_other_columns_and_takes_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a", 5, "b")], f"{DOCS}, pos int, h1 string")
    assert line_dedup.dedup_lines(frame).columns == ["doc_id", "text", "pos", "h1", "n_lines", "n_dropped"]
    assert lines_of(frame.limit(0)) == []


# --- quality rules -----------------------------------------------------------------------


def repeated(words, width=5):
    runs = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    return len({j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + width)})


@pytest.mark.parametrize("text", [
    None, "", " \n\t ", "a b", "a b c d e a b c d e f", "x " * 40, "a b c d e f " * 3 + "tail " + "q r s t u " * 2,
    "# one\n\n# one\n \n |x| <y>", "É é ß\x85 a\x0bb",
])
def test_features(spark, text):
    row = quality_rules.add_features(spark.createDataFrame([(1, text)], DOCS)).first()
    words = [w.decode() for w in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().strip()]
    assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
    assert row.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
    assert row.n_dup_lines == len(lines) - len(set(lines))
    assert row.n_repeat_words == repeated(words)
    assert row.base_failed == (len(words) < 10 or 100 * repeated(words) > 20 * len(words))


def test_a_bad_host_loses_its_good_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "bad", "a" if i % 10 else good) for i in range(60)]
    rows += [(100 + i, f"host{i % 7}", good) for i in range(70)] + [(200, "small", "a"), (201, "small", good), (300, None, good)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("host", F.lit(1))
    judged = {r.doc_id: r for r in quality_rules.judge(common.staged(quality_rules.add_features(frame), "t")).collect()}
    assert len(judged) == len(rows) and not judged[0].kept and not judged[0].base_failed
    assert all(judged[i].kept for i in range(100, 170)) and judged[201].kept and judged[300].kept


def test_rules_take_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert quality_rules.judge(quality_rules.add_features(empty)).collect() == []


# --- notices and benchmark items ------------------------------------------------------------


def test_notices_are_found_anywhere(spark):
    filler = " ".join(f"w{i}" for i in range(3000))
    known = license_texts.named_templates()
    rows = [(i, f"{filler} {text.upper()} {filler}") for i, (_, text) in enumerate(known)]
    rows += [(50, "\n".join(t for _, t in known)), (51, None), (52, ""), (53, "licensed under"), (None, known[0][1])]
    frame = spark.createDataFrame(rows, DOCS).withColumn("license", F.lit("clash"))
    found = {(r.doc_id, r.license): r for r in license_scan.scan(frame, license_scan.notices(spark)).collect()}
    assert {(i, n) for i, (n, _) in enumerate(known)} | {(50, n) for n, _ in known} <= set(found)
    assert not {51, 52, 53} & {doc for doc, _ in found} and found[(0, known[0][0])].first_word == 3000
    assert license_scan.scan(frame.limit(0), license_scan.notices(spark)).collect() == []
    assert license_scan.scan(frame, license_scan.notices(spark).limit(0)).collect() == []


def licenses_in(spark, *texts):
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), DOCS), license_scan.notices(spark)).collect()
    return [{"/".join(r.license.split("/")[:2]) for r in rows if r.doc_id == i} for i in range(len(texts))]


def test_licences_as_they_stand_in_files(spark):
    """Whole texts and headers, as comments, with other quotes and line breaks; and sentences in other words."""
    texts = {f"{a}/{b}": t for a, b, t in license_texts.TEMPLATES if b != "notice"}
    comment = lambda t: "\n".join(f" * {line}" for line in textwrap.wrap(t, 60))
    curly = lambda t: t.replace('"', "\u201d").replace("'", "\u2019")
    found = licenses_in(spark, *[f"x{i} code\n/*\n{comment(curly(t))}\n*/ more" for i, t in enumerate(texts.values())])
    assert all(name in own for name, own in zip(texts, found, strict=True))
    assert licenses_in(
        spark, "Released under the MIT License", "It is released under the MIT license, see file.",
        "This is licensed under the MIT License.", "\u201cLicensed under the Apache License \u2013 Version 2.0\u201d",
        "licensed\nunder CC BY-NC 4.0", "the MIT campus and its license plates", "under the license of the city",
    ) == [{"MIT/notice"}, {"MIT/notice"}, {"MIT/notice"}, {"Apache-2.0/notice"}, {"CC-BY-NC-4.0/notice"}, set(), set()]


def test_a_changed_name_in_a_licence_still_matches(spark):
    bsd = next(t for a, b, t in license_texts.TEMPLATES if (a, b) == ("BSD-3-Clause", "text"))
    changed = bsd.replace("the copyright holder nor", "Example University nor").replace("COPYRIGHT HOLDERS", "REGENTS")
    assert {"BSD-3-Clause/text", "BSD-2-Clause/text"} == licenses_in(spark, changed)[0]
    assert licenses_in(spark, bsd[: len(bsd) // 2]) == [set()]


def test_notices_with_edits_and_large_templates(spark):
    words = [f"t{i}" for i in range(400)]
    templates = [("long", " ".join(words)), ("short", "one two"), (None, "a b c d e f")]
    near = words[:200] + ["edit"] + words[201:]
    rows = [(1, " ".join(["x"] * 777 + near + ["y"] * 500)), (2, " ".join(words[:200])), (3, "one two a b c d e f")]
    found = license_scan.scan(
        spark.createDataFrame(rows, DOCS), spark.createDataFrame(templates, "license string, text string")
    ).collect()
    assert [(r.doc_id, r.license, r.n_shared, r.n_shingles) for r in found] == [(1, "long", 391, 396)]


def test_leaks_of_all_sizes(spark):
    items = [(n, " ".join(f"i{n}w{j}" for j in range(n))) for n in (3, 5, 6, 12, 40, 90, 400)]
    filler = " ".join(f"f{j}" for j in range(2000))
    rows = [(n, f"{filler}\n{text.upper()}! {filler}") for n, text in items]
    rows += [(1000 + n, " ".join(text.split()[: n // 2])) for n, text in items] + [(1, None), (2, ""), (None, items[3][1])]
    frame = spark.createDataFrame(rows, DOCS).withColumn("item_id", F.lit(7)).withColumn("h", F.lit(7))
    tests = spark.createDataFrame([*items, (None, "a b c d e f"), (8, None), (9, "")], "item_id long, text string")
    leaks = decontamination.find_leaks(frame, tests)
    assert sorted((r.doc_id, r.item_id) for r in leaks.collect()) == [(n, n) for n, _ in items if n >= 5]
    left = decontamination.drop_leaks(frame, leaks)
    assert left.count() == len(rows) - 6 and left.columns == frame.columns
    assert decontamination.find_leaks(frame.limit(0), tests).collect() == []
    assert decontamination.find_leaks(frame, tests.limit(0)).collect() == []


def test_leaks_beyond_the_broadcast_bound(spark, monkeypatch):
    found = QUERIES["op3_decontamination"](spark, SF).collect()
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert sorted(QUERIES["op3_decontamination"](spark, SF).collect()) == sorted(found)
