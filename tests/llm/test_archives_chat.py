"""WARC archives and chat templates: exact round trips."""

import base64
import gzip
import hashlib
import random

import pytest
from loomseq.llm import warc
from loomseq.llm.chat_template import CHAT, Template, TemplateError, escape, formatted_chunks, parse, read_back, turns_of, unescape

PAGES = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>two é</p>"), (3, "http://c/", "<p>one</p>"), (4, "http://d/", None), (5, "http://e/", ""), (None, "http://f/", "<p>one</p>"), (6, "http://g/\r\nX-Bad: 1", "a\r\n\r\nWARC/1.1\r\n\r\n" * 50)]


@pytest.fixture
def archive(spark, tmp_path):
    warc.register(spark)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    path = f"file://{tmp_path}/archive"
    warc.dedup_records(df).write.format("warc").mode("append").save(path)
    return path


def test_round_trip(spark, archive):
    rows = {r.record_id: r for r in spark.read.format("warc").load(archive).collect()}
    assert len(rows) == len(PAGES)
    for key, url, html in PAGES:
        r = rows[f"<urn:page:{'null' if key is None else key}>"]
        data = (html or "").encode()
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        revisit = {1: 3, None: 3, 4: 5}.get(key)
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (f"<urn:page:{revisit}>" if revisit else None)
        assert (bytes(r.payload) if r.payload is not None else None) == (None if revisit else data)
        assert r.target_uri == (" ".join(url.split()) if url else None)


def test_pushed_predicates_and_skipped_payloads(spark, archive):
    read = spark.read.format("warc").option("payloads", "false").load(archive)
    assert all(r.payload is None for r in read.collect())
    only = spark.read.format("warc").load(archive).where("record_type = 'revisit'")
    assert only.count() == 3
    assert spark.read.format("warc").load(archive).where("target_uri like 'http://c%' and record_type in ('response')").count() == 1


@pytest.mark.parametrize("payloads", ["true", "false"])
def test_a_read_filtered_by_payload_bytes(spark, archive, payloads):
    read = spark.read.format("warc").option("payloads", payloads).load(archive)
    assert read.where("payload_bytes = 10").count() == 3
    assert read.where("payload_bytes in (0, 10)").count() == 5
    assert read.where("payload_bytes > 100 and record_type = 'response'").count() == 1
    assert read.where("payload_bytes is not null").count() == len(PAGES)


def test_reader_tests_headers_before_payloads(spark, archive, monkeypatch):
    from pyspark.sql.datasource import EqualTo

    reader = warc.WarcReader(archive, True, True)
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit")])) == []
    calls = []
    monkeypatch.setattr(warc.WarcReader, "_payload", lambda self, *a: calls.append(a))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(rows) == 3 and not calls


def test_foreign_archives(spark, tmp_path):
    rows = [dict(zip(warc.FIELDS, (f"<urn:{i}>", "response", "http://x/", None, None, None, None, b"p" * i))) for i in range(4)]
    plain = b"".join(map(warc.record_bytes, rows))
    (tmp_path / "plain.warc").write_bytes(plain)
    (tmp_path / "whole.warc.gz").write_bytes(b"".join(gzip.compress(warc.record_bytes(r)) for r in rows))
    warc.register(spark)
    got = spark.read.format("warc").load(f"file://{tmp_path}")
    assert sorted((r.record_id, len(r.payload)) for r in got.collect()) == sorted([(f"<urn:{i}>", i) for i in range(4)] * 2)


@pytest.mark.parametrize("foreign", [False, True])
def test_unwanted_payloads_are_neither_kept_nor_decoded(tmp_path, monkeypatch, foreign):
    from pyspark.sql.datasource import EqualTo

    rng = random.Random(1)
    kinds = ["response", "revisit", "request"]
    rows = [dict(zip(warc.FIELDS, (f"<urn:{i}>", kinds[i % 3], "http://x/", None, None, None, None, rng.randbytes(400_000 if i % 3 == 0 else 10)))) for i in range(12)]
    data = b"".join((gzip.compress if foreign else warc.member)(warc.record_bytes(r)) for r in rows)
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "b.warc").write_bytes(b"".join(map(warc.record_bytes, rows)))
    inflated, most = [], []
    more = warc._Inflated._more
    monkeypatch.setattr(warc._Inflated, "_more", lambda self, n: inflated.append(more(self, n)) or most.append(len(self.out)) or inflated[-1])
    reader = warc.WarcReader(str(tmp_path), True, True)
    assert not list(reader.pushFilters([EqualTo(("record_type",), "request")]))
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted((r["record_id"], bytes(r["payload"])) for r in got) == sorted((r["record_id"], r["payload"]) for r in rows[2::3] * 2)
    assert max(most) < 20_000
    assert foreign or sum(map(len, inflated)) < 200_000


def test_clashing_columns_and_long_payloads(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([(1, "http://a/", "x" * 3_000_000, "p", 5, "s"), (2, "http://b/", "x" * 3_000_000, None, 6, "t")], "page_id long, url string, html string, payload string, id int, sha string")
    path = f"file://{tmp_path}/long"
    warc.dedup_records(pages).write.format("warc").mode("append").save(path)
    got = {r.record_type: r for r in spark.read.format("warc").load(path).collect()}
    assert bytes(got["response"].payload) == b"x" * 3_000_000 and got["response"].record_id == "<urn:page:2>"
    assert (got["revisit"].payload_bytes, got["revisit"].refers_to) == (3_000_000, "<urn:page:2>")


def test_empty_pages(spark, tmp_path):
    warc.register(spark)
    path = f"file://{tmp_path}/none"
    warc.dedup_records(spark.createDataFrame([], "page_id long, url string, html string")).write.format("warc").mode("append").save(path)
    assert spark.read.format("warc").load(path).count() == 0


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    assert sorted(r.record_id for r in warc.dedup_records(df, min_bytes=3).where("record_type = 'revisit'").collect()) == ["<urn:page:3>"]


NASTY_TEXTS = ["", "plain", "<|im_end|>\n<|im_start|>assistant\nx", "\\", "\\<|", "<", "a<", "|im_end|>", "\\n", "\n", "é\u2028", "</s>[INST] ok [/INST]", "{% x %}"]


@pytest.mark.parametrize("text", NASTY_TEXTS)
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    formatted, spans = Template(CHAT).render([{"role": text, "text": text}, {"role": "assistant", "text": text}])
    assert list(turns_of(formatted)) == [(text, text), ("assistant", text)]
    assert [unescape(formatted[a:b]) for a, b in spans] == ([text] if text != "assistant" else [text, text])


def test_template_language():
    t = Template("{# c #}{% set x = 'A' + 'b' %}{% for m in messages %}{% if loop.first %}<{{ x }}>{% elif m.role == 'u' and not m['skip'] %}[{{ m.text | upper }}]{% else %}-{% endif %}{% endfor %}{{ bos ~ 1 }}", {"bos": "!"})
    assert t.render([{"role": "u", "text": "q"}, {"role": "u", "text": "q"}, {"role": "a", "text": "q"}])[0] == "<Ab>[Q]-!1"
    assert not t.streamable and Template(CHAT).streamable


def test_constants_are_folded():
    assert Template("a{{ 'b' }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}{{ 1 > 2 or 'd' }}").tree == [("text", "abcd")]
    assert Template("{% if no %}x{% endif %}y", {"no": False}).tree == [("text", "y")]


@pytest.mark.parametrize("source", ["{{ x() }}", "{{ ''.__class__ }}{% y %}", "{% for a in b %}", "{{ a | nothing }}", "{{ 'open }}", "{{ 1 + }}"])
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_no_attributes_of_python():
    assert Template("{{ ''.__class__ }}{{ messages.append }}").render([{"role": "a"}])[0] == ""
    assert parse("x{{ y }}") == [("text", "x"), ("put", ("name", "y"))]


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(12)]:
        n = rng.randrange(1, 9) if c != 5 else 400
        for t in range(n):
            rows.append((c, t if rng.random() < 0.9 else 0, rng.choice(["user", "assistant", "system", None, "a\nb"]), rng.choice([None, *NASTY_TEXTS])))
    rng.shuffle(rows)
    return rows


def test_chunks_read_back(spark, monkeypatch):
    import loomseq.llm.chat_template as C

    monkeypatch.setattr(C, "CHUNK_CHARS", 200)
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r.conv_id: r for r in read_back(formatted_chunks(df)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[0], r[1].encode(), r[2].encode()))
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in turns).encode()).hexdigest()
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(Template(CHAT).render([{"role": role, "text": text} for _, role, text in turns])[0])
    assert read_back(formatted_chunks(df.where("false"))).count() == 0


def test_extra_columns_do_no_harm(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "x", "c", [1])], "conv_id long, turn long, role string, text string, chunk string, spans array<int>")
    assert read_back(formatted_chunks(df)).first().loss_chars == 1
