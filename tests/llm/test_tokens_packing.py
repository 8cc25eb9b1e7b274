"""Packing and token counts against the library itself."""

import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from loomseq.llm.packing import Bins, pack_documents, sequences
from loomseq.llm.token_counts import token_counts
from loomseq.llm.tokens import tokenizer
from tokenizers import Tokenizer


def library_ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def encoded(path, texts):
    flat, bounds = tokenizer(path).encode(pa.array(texts))
    return [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_words_give_the_librarys_ids(vocabulary):
    rng = random.Random(5)
    letters = "aBé×ÑÉß1 .,'<|>…́\n\xa0\x1c-_!xŐœİΣ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["", "<|endoftext|>hi <|startoftext|>there<|ENDOFTEXT|>", "it's WE'RE d'r 'S", "ÀÉÎ «Çà».. a1b2,c3 A_b-c 12.5%", "x" * 5000, "a." * 3000]
    library = Tokenizer.from_file(vocabulary)
    assert encoded(vocabulary, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_see_whole_texts(name):
    texts = ["Hello  world\n again", "", "a b"]
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        expected = [library_ids(path, t) for t in texts]
    else:
        import sentencepiece

        expected = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)
    assert encoded(path, texts) == expected


def check_packing(rows, texts, vocabulary, size):
    library = Tokenizer.from_file(vocabulary)
    expected = []
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), size)):
            part = np.array(ids[start : start + size], "<u4")
            expected.append((key, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: (r[0] is None, *((-1 if x is None else x) for x in r))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(expected, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


@pytest.mark.parametrize("size", [16, 2048])
def test_packs_every_piece_without_gaps(spark, nasty, vocabulary, size):
    texts = [(r.doc_id, r.text) for r in nasty.collect()]
    rows = pack_documents(nasty, vocabulary, sequence_tokens=size).collect()
    n = check_packing(rows, texts, vocabulary, size)
    assert n <= 2 * sum(r.length for r in rows) / size + 1


def test_sequences_hold_the_ids(spark, nasty, vocabulary):
    packed = pack_documents(nasty, vocabulary, sequence_tokens=64, with_ids=True)
    whole = sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.length for r in whole)
    assert sum(r.length for r in whole) == sum(r.length for r in packed.collect())


def test_empty_table(empty, vocabulary, spark, tmp_path):
    assert pack_documents(empty, vocabulary).count() == 0
    assert token_counts(empty, vocabulary, f"file://{tmp_path}/cache").count() == 0


def test_best_fit_takes_the_fullest_that_fits_and_closes_the_fullest():
    bins = Bins(10, 2, 0)
    assert bins.place(6) == (0, 0)
    assert bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # fills sequence 1 to the end
    assert bins.place(8) == (2, 0)
    assert bins.place(5) == (3, 0)  # two are open: sequence 2, the fullest, closes
    assert bins.place(2) == (0, 6)
    assert bins.place(2) == (0, 8)
    assert bins.place(5) == (3, 5)
    assert bins.place(10) == (4, 0) and bins.open == 0


def test_counts_and_cache(spark, nasty, vocabulary, tmp_path):
    cache = f"file://{tmp_path}/{uuid.uuid4().hex}"
    library = Tokenizer.from_file(vocabulary)
    expected = sorted((str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in nasty.collect())
    for _ in range(2):  # the second time all from the cache
        got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts(nasty, vocabulary, cache).collect())
        assert got == expected
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("content_digest").distinct().count() == 6


def test_another_tokenizer_does_not_meet_the_cache(spark, nasty, vocabulary, tmp_path):
    cache = f"file://{tmp_path}/shared"
    token_counts(nasty, vocabulary, cache).count()
    other = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(other)
    got = {r.doc_id: r.n_tokens for r in token_counts(nasty, other, cache).collect()}
    assert got[8] == len(library.encode("ab " * 4000, add_special_tokens=False).ids)
    assert got[3] == 0
