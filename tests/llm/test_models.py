"""Packing, url filter, archives, classifier and language identification."""

import gzip
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_shared import check_packing, tokenizer

from tillflow.llm import common, language_id, packing, quality_classifier, url_filter, warc
from tillflow.llm.queries import QUERIES

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


# --- packing ----------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b\n \n c ", "it's I'LL 12é \u3000 a\x85b", "x <|endoftext|> y", "<|endoftext|>", " <|endoftext|><|endoftext|> ", "a  <|endoftext|>  b <|endoftext", "\x1c \x1d a"])
def test_ids_are_those_of_the_tokenizer(text):
    assert [*packing.ByteBpe(packing.tokenizer_path()).encode(text), 2] == [*tokenizer().encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}},
])
def test_other_tokenizers_are_refused(tmp_path, change):
    with open(packing.tokenizer_path()) as file:
        known = json.load(file) | change
    (tmp_path / "other.json").write_text(json.dumps(known))
    with pytest.raises(ValueError):
        packing.ByteBpe(str(tmp_path / "other.json"))


def test_merges_in_another_order_are_refused(tmp_path):
    with open(packing.tokenizer_path()) as file:
        known = json.load(file)
    known["model"]["merges"].reverse()
    (tmp_path / "other.json").write_text(json.dumps(known))
    with pytest.raises(ValueError):
        packing.ByteBpe(str(tmp_path / "other.json"))


def test_equal_rows_spread_over_the_tasks(spark):
    frame = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = packing.pack(frame, packing.tokenizer_path()).groupBy(F.shiftright("sequence_id", 40)).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == 8 and max(r["count"] for r in rows) < 2 * 3000 / 8


def test_packing_of_all_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bins, ids = check_packing(docs, QUERIES["op9_packing"](spark, SF).collect())
    assert bins <= 1.08 * ids / 1024 + 4


def test_packing_edges(spark):
    docs = {1: None, 2: "", 3: "a " * 1023, 4: "a " * 5000, 5: " ", 6: "b"}
    frame = spark.createDataFrame(list(docs.items()), DOCS).withColumn("length", F.lit("clash"))
    check_packing(docs, packing.pack(frame, packing.tokenizer_path()).collect())
    check_packing(docs, packing.pack(frame, packing.tokenizer_path(), open_bins=1, look_ahead=2).collect())
    assert packing.pack(frame.limit(0), packing.tokenizer_path()).collect() == []
    twice = packing.pack(spark.createDataFrame([(None, "a"), (7, "b"), (7, "b")], DOCS), packing.tokenizer_path())
    assert sorted(str(r.doc_id) for r in twice.collect()) == ["7", "7", "None"]


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 1)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (0, 6), (2, 0)]  # bin 1 was the fullest and closed


# --- url filter --------------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[: min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])]
    path = rest[len(host) :]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fits = [
        (len(h + p), h + p, v) for h, p, v in url_filter.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def test_urls_equal_brute_force(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{LARGER}/pages.parquet").collect()}
    found = QUERIES["op5_url_filter"](spark, LARGER).collect()
    assert len(found) == len(pages)
    for r in found:
        rule, says = plain_rule(*plain_parts(pages[r.page_id]))
        assert (r.host, r.path, r.rule) == (*plain_parts(pages[r.page_id]), rule)
        bad = any(b in r.host for b in url_filter.BLOCKED_HOSTS)
        assert r.verdict == (says or ("block" if bad else "allow")), r


def test_url_edges(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme/en/"), (4, "a://b://C.com/x?y"), (5, "http://WWW.Example.com/en/1#z"),
        (6, "http://x.example.com/en/"), (7, "http://example.com?en/"), (8, "https://net/es/1"), (9, "x\n://É.NET/fr/"),
        (10, "http://notnet/es/"), (11, "http://a.com/" + "p" * 100_000),
    ]
    model = url_filter.train(spark.createDataFrame(url_filter.labelled_urls(), "url string, label int"))
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    found = {r.page_id: r for r in url_filter.judge(frame, model).collect()}
    for page, url in rows:
        host, path = plain_parts(url)
        assert (found[page].host, found[page].path, found[page].rule) == (host, path, plain_rule(host, path)[0])
    assert found[5].verdict == "allow" and found[6].verdict == "block" and found[1].verdict == "allow"
    assert url_filter.judge(frame.limit(0), model).collect() == []
    assert url_filter.train(spark.createDataFrame([], "url string, label int")).score("a.com", "/") < 0.5


# --- archives --------------------------------------------------------------------------


def test_archive_round_trip(spark):
    rows = [(1, "http://a/ü", "<p>é\r\n\r\nWARC/1.1</p>"), (2, None, None), (3, "http://b\r\nX: y", "<p>é\r\n\r\nWARC/1.1</p>"),
            (4, "c", ""), (5, "d", "x" * 3_000_000), (None, "e", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    path = common.new_path(spark, "test-warc")
    warc.write_warc(warc.page_records(frame), path)
    found = {r.record_id: r for r in warc.read_warc(spark, path, payload=True).collect()}
    assert len(found) == 6
    for page, url, html in rows:
        r = found[f"<urn:page:{page}>" if page is not None else None]
        want = (html or "").encode()
        assert r.payload_bytes == len(want) and r.payload_digest == warc.base32_digest(want)
        assert r.record_type == ("revisit" if page in (3, 4) else "response")
        assert bytes(r.payload) == (want if r.record_type == "response" else b"")
        assert r.target_uri == (" ".join(url.splitlines()) if url else url)
    assert found["<urn:page:3>"].refers_to == "<urn:page:1>" and found["<urn:page:4>"].refers_to == "<urn:page:2>"
    part = warc.read_warc(spark, path).filter("record_type = 'revisit' AND target_uri IN ('c', 'zzz')")
    assert [(r.record_id, r.payload) for r in part.collect()] == [("<urn:page:4>", None)]
    assert "zzz" not in part._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    empty = common.new_path(spark, "test-warc")
    warc.write_warc(warc.page_records(frame.limit(0)), empty)
    assert warc.read_warc(spark, empty).collect() == []


def test_reads_plain_archives_and_split_ones(spark, tmp_path, monkeypatch):
    records = [warc.record_bytes({"record_type": "response", "record_id": f"<urn:page:{i}>", "payload": b"\n" * i}) for i in range(5)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    found = warc.read_warc(spark, f"file://{tmp_path}", payload=True)
    assert sorted((r.record_id, len(r.payload)) for r in found.collect()) == sorted([(f"<urn:page:{i}>", i) for i in range(5)] * 2)


# --- classifier and languages -----------------------------------------------------------------


def test_classifier_against_labels(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").filter("quality IS NOT NULL")
    found = QUERIES["op7_quality_classifier"](spark, LARGER)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").collect()
    right = sum(r.kept == bool(r.quality) for r in rows) / len(rows)
    kept = sum(r.kept for r in rows if r.quality) / sum(bool(r.quality) for r in rows)
    assert right > 0.9 and kept > 0.95, (right, kept)


def test_classifier_edges(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (4, "x" * 300_000), (4, "x" * 300_000)], DOCS)
    model = quality_classifier.train(frame)
    rows = quality_classifier.classify(frame.withColumn("score", F.lit("clash")), model).collect()
    assert len(rows) == 5 and [r.kept for r in rows if not r.text] == [False, False]
    empty = quality_classifier.train(frame.limit(0))
    assert quality_classifier.classify(frame.limit(0), empty).collect() == []


def test_labeller_accuracies_are_found():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    right = np.linspace(0.65, 0.95, quality_classifier.LABELLERS)
    cast = np.where(rng.random((20_000, len(right))) < right, truth[:, None], ~truth[:, None]).astype(int)
    cast[rng.random(cast.shape) < 0.3] = quality_classifier.NONE
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    model = quality_classifier.estimate(patterns, counts.astype(float))
    assert abs(model.good - 0.7) < 0.03
    assert np.abs(model.chances[:, 1, 1] - right).max() < 0.03


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    found = QUERIES["op10_language_id"](spark, LARGER).join(docs, "doc_id").collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out and r.lang is not None]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_language_mixtures_and_edges(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.train(docs)
    by_lang = {r.lang: r.text for r in docs.filter("n_chars > 3000").collect() if r.lang in ("en", "de")}
    mixed = by_lang["en"][:2000] + "\n" + by_lang["de"][:1000]
    assert model.predict(mixed)[0] == "en" and 0.5 < model.predict(mixed)[1] < 0.85
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "123 .!"), (4, "é"), (None, "the and of that")], DOCS)
    frame = frame.withColumn("score", F.lit("clash"))
    found = language_id.identify(frame, model).collect()
    assert [r.lang_pred for r in found[:3]] == ["und"] * 3 and found[3].lang_pred in model.languages
    assert language_id.identify(frame.limit(0), model).collect() == []
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(frame, nothing).collect()} == {"und"}


def test_all_languages_of_a_mixture(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = language_id.train(docs)
    by_lang = {r.lang: r.text for r in docs.filter("n_chars > 3000").collect() if r.lang in ("en", "de")}
    frame = spark.createDataFrame([(1, by_lang["en"][:2000] + "\n" + by_lang["de"][:1000]), (2, "123"), (3, None)], DOCS)
    mixed, *others = language_id.identify(frame.withColumn("languages", F.lit("clash")), model).collect()
    assert [x.lang for x in mixed.languages] == ["en", "de"]
    assert abs(sum(x.share for x in mixed.languages) - 1) < 1e-6
    assert (mixed.lang_pred, mixed.score) == tuple(mixed.languages[0])
    assert [(r.languages, r.lang_pred, r.score) for r in others] == [([], "und", 0.0)] * 2


def test_filters_that_exclude_each_other_pass_no_record():
    from pyspark.sql.datasource import EqualTo, IsNotNull

    reader = warc._Reader("", False)
    kind = ("record_type",)
    assert list(reader.pushFilters([IsNotNull(kind)])) == [IsNotNull(kind)]
    assert reader._passes({"record_type": "revisit"}) and not reader._passes({"record_type": None})
    assert not list(reader.pushFilters([EqualTo(kind, "response"), EqualTo(kind, "revisit")]))
    assert not any(reader._passes({"record_type": x}) for x in ("response", "revisit", None))


@pytest.mark.parametrize("text", ["²", "½ ①", "Ⅷ", "12 _-", "\u0301", " \n "])
def test_no_letter_means_no_language(text):
    model = language_id.LanguageModel(["en"], np.full((1, 1 << language_id.BUCKET_BITS), 1.0 / (1 << language_id.BUCKET_BITS)))
    with np.errstate(all="raise"):
        assert model.predict(text) == ("und", 0.0)
        assert model.predict(text + "ª")[0] == "en"


def test_language_of_a_very_long_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    text = docs.filter("lang = 'fr' AND n_chars > 500").first().text
    assert model.predict((text + " ") * (3_000_000 // len(text)))[0] == "fr"
