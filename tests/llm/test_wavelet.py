import binascii
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grantlake.llm import wavelet as V

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [0, 1, 5, 300, 49407, 70000])
def test_round_trip_access_count_and_lookup(monkeypatch, top):
    monkeypatch.setattr(V, "BLOCK_BITS", 64)
    rng = random.Random(top)
    ids = [rng.randrange(top + 1) for _ in range(403)]
    counts = np.array([0, 100, 303])
    shard = V.Shard(V.build(np.array(ids, np.uint32), [5, None, 7], counts))
    assert shard.tokens().tolist() == ids and shard.documents()[0] == [5, None, 7] and shard.documents()[1].tolist() == [0, 100, 303]
    assert [shard.access(i) for i in range(0, 403, 7)] == ids[::7]
    for t in {*ids[:20], top + 1, 1 << 20}:
        where = [i for i, x in enumerate(ids) if x == t]
        assert shard.count(t) == len(where) and shard.count(t, 50, 333) == sum(50 <= i < 333 for i in where)
        assert [shard.occurrence(t, k) for k in range(len(where))] == where
        with pytest.raises(IndexError):
            shard.occurrence(t, len(where))


def test_empty_shard():
    shard = V.Shard(V.build(np.zeros(0, np.uint32), [], np.zeros(0)))
    assert shard.tokens().tolist() == [] and shard.count(3) == 0


TEXTS = [None, "", " ", "Hello  World\n\nit's 12 o'clock", "é é ́x", "a<|endoftext|>b <|startoftext|>", "日本  x y\x1cz", "ÀÉ ß 'LL can't", "word " * 3000, "\r\n\t.", "x" * 5000]


def test_encoder_equals_the_library():
    tokenizer = Tokenizer.from_file(PATH)
    encoder = V.Encoder(PATH)
    assert encoder.by_stretch
    for _ in range(2):
        ids, counts = encoder.encode(TEXTS)
        want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_encoder_equals_the_library_on_random_texts():
    rng = random.Random(5)
    signs = ["a", "B", "é", "É", "ü", "Ü", "×", "÷", "ÿ", "ª", "µ", "e\u0301", "\u0338", "'", "s", "t", "'S", "re", "1", "٣", "½", "-", *".,?!;:", " ", "\n", "\u00a0", "\u2003", "ß", "İ", "Σ", "ς", "日"]
    signs += ["<|endoftext|>", "<|EndOfText|>", "<|", "|>", "\0", "🙂", "\u200d", "«", "»", "\x0b", "\x85", "ﬁ", "word" * 70]
    encoder = V.Encoder(PATH)
    assert encoder.parts and encoder.plain
    for _ in range(1500):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3)]
        ids, counts = encoder.encode(texts)
        want = [[*e.ids, 1] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w], texts


def test_encoder_with_colliding_slots_and_a_full_table(monkeypatch):
    monkeypatch.setattr(V.Encoder, "MOST", 40)
    monkeypatch.setattr(V, "_hashes", lambda raw, begins, ends, real=V._hashes: real(raw, begins, ends) & np.array([[3], [~0 & (1 << 64) - 1]], np.uint64))
    encoder, rng = V.Encoder(PATH), random.Random(1)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 3))) for _ in range(30))]
        assert encoder.encode(texts)[0].tolist() == [*encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids, 1]


def test_tokenizers_that_keep_blanks_are_encoded_text_by_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = V.Encoder(path)
    assert not encoder.by_stretch
    ids, _ = encoder.encode(["a b"])
    assert ids.tolist() == [*Tokenizer.from_file(path).encode("a b", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("shard_tokens", [1 << 22, 50])
def test_documents_read_back_in_order(spark, shard_tokens):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(i * 37 % 101, t, "x") for i, t in enumerate(TEXTS * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(5)
    got = V.encode_documents(docs, PATH, shard_tokens=shard_tokens).collect()
    want, start = {}, 0
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want[d] = (start, len(ids), binascii.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(rows)


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "b"), (2, "a"), (2, "a c"), (None, None)], "doc_id long, text string")
    got = V.encode_documents(docs, PATH).collect()
    assert sorted(r.start for r in got) == sorted({r.start for r in got}) and sorted(r.n_tokens for r in got) == [1, 2, 2, 3]
    assert max(r.start for r in got if r.doc_id is None) < min(r.start for r in got if r.doc_id == 2)
    assert V.encode_documents(docs.limit(0), PATH).count() == 0
