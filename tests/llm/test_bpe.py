"""The streaming encoder and decoder against the library, and an exact round trip."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataflow.llm.bpe import BLOCK, Decoder, Encoder, encode_decode, pieces
from strataflow.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def model():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return file.read()


def _texts(vocabulary):
    rng = random.Random(7)
    plain = [t.replace("</w>", "") for t in vocabulary if t.isascii()]
    alphabets = ["ab", "aeinrst", "é中日a", "0!?'.-", "'srevldmt! ", "ΣΑ İKſ \x85 \x1c\x00x"]
    yield from ["", " ", "<|endoftext|>", "a<|endoftext|><|startoftext|>b <", "😀😀 a'LL I'M", "é"]
    for _ in range(150):
        yield "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([3, 40, 3000])))
        yield "".join(rng.choice(plain) for _ in range(rng.choice([3, 30, 600])))


def test_ids_and_text_equal_the_library(library, model):
    encoder, decoder = Encoder(model), Decoder(model)
    texts = list(_texts(library.get_vocab()))
    flat, at = encoder.encode_batch(texts)
    for text, lo, hi in zip(texts, at[:-1], at[1:]):
        expected = library.encode(text, add_special_tokens=False).ids
        assert flat[lo:hi].tolist() == expected
        assert decoder.joined(flat[lo:hi]).decode() == library.decode(expected, skip_special_tokens=False)


def test_stream_holds_a_bounded_buffer_and_emits_early(library, model):
    encoder = Encoder(model)
    word = "".join(random.Random(3).choice("abcdeinrst") for _ in range(6000))
    taken = 0

    def source():
        nonlocal taken
        for byte in word.encode():
            taken += 1
            yield byte

    out, stream = [], encoder.merges.stream(source())
    emitted = 0
    for token in stream:
        emitted += encoder.merges.widths[token]
        assert taken - emitted <= encoder.merges.lookahead + 2 * BLOCK
        out.append(token)
    assert out == library.encode(word, add_special_tokens=False).ids


def test_incremental_decoder_restores_bytes(model):
    encoder, decoder = Encoder(model), Decoder(model)
    text = "naïve 中日 😀 abc"
    ids = encoder.encode(text).tolist()
    parts = [decoder.feed(i) for i in ids] + [decoder.flush()]
    assert "".join(parts) == text + " "
    assert "�" not in "".join(parts)


def test_cases(spark, model):
    rows = [(1, None), (2, ""), (None, "abc"), (3, "abc"), (3, "abc"), (4, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(0))
    got = encode_decode(df, tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, r.decoded[:10]) for r in got) == [
        (0, "abc</w>"), (1, ""), (2, ""), (3, "abc</w>"), (3, "abc</w>"), (4, got[-1].decoded[:10])
    ]
    assert encode_decode(df.limit(0), tokenizer_path()).count() == 0


def test_query_over_the_whole_table(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_bpe_transducer"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_are_encoded_like_the_whole(model, library):
    rng = random.Random(7)
    bits = ["a", "Σ", "é", "e\u0301", " ", "  ", "\n", "'s", "'", "don't", "3", "日本", "<", "|", "😀", "word", "\u00a0", " \u0301", "x" * 40]
    encoder = Encoder(model)
    for _ in range(60):
        text = "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(200)))
        cut = list(pieces(text, rng.randrange(1, 30)))
        assert "".join(cut) == text
        ids = np.concatenate([encoder.encode(p) for p in cut])
        assert ids.tolist() == encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert list(pieces("x" * 50, 10)) == ["x" * 50] and list(pieces("")) == [""]


def test_memory_follows_a_piece_not_the_text(model):
    encoder = Encoder(model)
    peak = {}
    for n in (1, 8):
        text = "some plain words that come again and again, " * (n * 24_000)
        encoder.encode(text[:1000])
        tracemalloc.start()
        held = sum(len(encoder.encode(p)) for p in pieces(text))
        peak[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert held > n * 24_000 * 8
    assert peak[8] < 1.3 * peak[1]


def test_long_texts_beside_short_ones(spark, library):
    long = "the quick brown fox isn't here, 42 times! " * 30_000
    rows = [(1, "abc"), (2, long), (3, "def ghi"), (4, None), (5, long + "é")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in encode_decode(df, tokenizer_path()).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
