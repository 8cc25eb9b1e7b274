"""The registered queries over a small folder of tables, held against the contracts by brute force."""

import base64
import hashlib

import random
import re

import zlib
from array import array

import pytest
from test_dedup import brute_groups, brute_repeats

from loomseq.llm import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(21)
    folder = str(tmp_path_factory.mktemp("sf"))
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 7)))
    shared = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(rng.randrange(1, 120))) + (" " + shared if i % 5 == 0 else "") for i in range(40)]
    texts += [None, "", " \n\t", "long " * 3000, texts[3], texts[3].upper(), "é" * 300 + " <|endoftext|> it's"]
    documents = [(i, t, "en", "s", len(t or ""), "x", 7) for i, t in enumerate(texts)]
    pages = [(i, rng.choice(["http://a.net/x", "https://b.org/fr/y?q", None, "no scheme", "http://bad.com/z"]), rng.choice([None, "", "<p>same</p>", f"<p>{i} é</p>"]), "clash") for i in range(40)]
    conversations = [(c, t, rng.choice(["system", "user", "assistant"]), rng.choice([None, "", "hello [INST] there", "</s> ok <s>", word() * 50])) for c in range(12) for t in range(rng.randrange(1, 5))]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long, fp string, first int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string, host string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(i, " ".join(word() for _ in range(20))) for i in range(5)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, i % 3 % 2, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, [d[:2] for d in documents], [p[:3] for p in pages], conversations


def test_packing(spark, tables, vocabulary):
    from tokenizers import Tokenizer

    folder, documents, *_ = tables
    tokenizer = Tokenizer.from_file(vocabulary)
    pieces, places = {}, {}
    for r in queries.op1_best_fit_packing(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        rows = sorted(pieces[key], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in rows] == [(i, a, min(2048, len(ids) - a)) for i, a in enumerate(range(0, len(ids), 2048))]
        assert [r.ids_crc32 for r in rows] == [zlib.crc32(array("I", ids[r.start : r.start + r.length]).tobytes()) for r in rows]
    for at in places.values():
        assert [a for a, _ in sorted(at)] == [sum(n for _, n in sorted(at)[:i]) for i in range(len(at))] and sum(n for _, n in at) <= 2048


def test_removed_bytes(spark, tables):
    folder, documents, *_ = tables
    got = [(r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op2_suffix_array_dedup(spark, folder).collect()]
    assert sorted(got, key=str) == brute_repeats(documents)


def test_token_counts_come_from_the_cache_the_second_time(spark, tables, vocabulary, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    folder, documents, *_ = tables
    monkeypatch.setattr(queries, "shared_folder", lambda spark: str(tmp_path))
    tokenizer = Tokenizer.from_file(vocabulary)
    expected = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t in documents]
    for _ in range(2):
        assert sorted(tuple(r) for r in queries.op3_token_counts(spark, folder).collect()) == expected
    cache = spark.read.parquet(f"{tmp_path}/token-cache")
    assert cache.count() == cache.select("content_digest").distinct().count() > 30


def test_quality_base(spark, tables):
    folder, documents, *_ = tables
    for r in queries.op5_quality_rules(spark, folder).collect():
        text = documents[r.doc_id][1] or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)} if len(words) < 500 else set(range(len(words)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_repeat_words) == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(twice))
        assert r.base_failed == (len(words) < 20 or 100 * len(twice) > 30 * len(words)) and not (r.base_failed and r.kept)


def test_near_duplicates(spark, tables):
    folder, documents, *_ = tables
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in queries.op6_simhash_near_dedup(spark, folder).collect()]
    lowered = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for i, t in documents]
    assert sorted(got, key=str) == sorted(brute_groups(lowered), key=str)


def test_archive(spark, tables):
    folder, _, pages, _ = tables
    largest = {}
    for key, _, html in pages:
        largest[html or ""] = max(key, largest.get(html or "", -1))
    expected = []
    for key, _, html in pages:
        data, lead = (html or "").encode(), largest[html or ""]
        expected.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if key == lead else "revisit", None if key == lead else lead))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op7_warc(spark, folder).collect()]
    assert sorted(got) == sorted(expected)


def test_chat(spark, tables):
    *_, conversations = tables
    said = "</s>[INST] ok [/INST]"
    rows = [*conversations, (-1, 0, "user", said), (-1, 1, "assistant", said)]
    by = {}
    for c, _, role, text in rows:
        by.setdefault(c, []).append((role, text or ""))
    got = {r.conv_id: r for r in queries.op10_chat_formatting(spark, tables[0]).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        spoken = "".join(t for role, t in turns if role == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())


def test_scans_and_filters_keep_their_columns(spark, tables):
    folder = tables[0]
    assert queries.op4_license_scans(spark, folder).columns == ["doc_id", "rule", "licence", "n_matches"]
    assert queries.op8_benchmark_decontamination(spark, folder).count() == 0
    urls = queries.op9_url_filters(spark, folder)
    assert urls.columns == ["page_id", "host", "path", "rule", "verdict"] and urls.count() == 40


def test_the_pipeline_takes_an_empty_table_and_odd_rows(spark, tables, nasty, tmp_path):
    import corpus_pipeline
    from loomseq.llm.common import materialise

    folder = tables[0]
    docs = nasty.select("doc_id", "text", "spans", "fp", "length").withColumnRenamed("length", "n_chars")
    for start in (docs, docs.where("false")):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            at = materialise(stage(spark, at, folder), name)
        assert {r.doc_id for r in at.collect()} <= {r.doc_id for r in start.collect()}



