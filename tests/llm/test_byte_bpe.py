import hashlib
import random

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from asiento.llm import byte_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
CODEC = B.codec(PATH, PATTERN)
WHOLE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=CODEC.ranks, special_tokens={})


def chunks(text, stride, overlap):
    parts = [(at, text[at : at + stride + overlap]) for at in range(0, len(text), stride)]
    return [(at, part, CODEC.ends(part)) for at, part in parts]


@given(st.text(alphabet="ab 1'\n\té!?s ", min_size=1, max_size=120), st.integers(1, 9), st.integers(1, 6))
@settings(max_examples=400, deadline=None)
def test_stitched_is_whole(text, stride, overlap):
    assert B.stitch(CODEC, chunks(text, stride, overlap)) == CODEC.pieces(text)


def test_pieces_longer_than_overlap_and_chunk():
    text = "a" * 500 + " " * 300 + "b c  d" * 40 + "\n" * 77 + "9" * 200 + "!?" * 99
    for stride, overlap in ((10, 3), (64, 16), (150, 40), (1000, 10)):
        assert B.stitch(CODEC, chunks(text, stride, overlap)) == CODEC.pieces(text)


def test_table_against_tiktoken(spark):
    rng = random.Random(2)
    texts = [None, "", " ", "It's 42 <|endoftext|> été…\n\n  x", "🙂🙃" * 50, "z" * 3000]
    texts += [" ".join(rng.choice(["word", "naïve", "1234", "--", "don't", "\n"]) for _ in range(n)) for n in (1, 50, 900, 5000)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, texts[4], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for stride, overlap in ((64, 8), (1000, 50), (B.STRIDE, B.OVERLAP)):
        tokens = B.tokenize(docs, PATH, PATTERN, stride=stride, overlap=overlap)
        got = sorted(((r.doc_id, tuple(r.ids)) for r in tokens.collect()), key=str)
        assert got == sorted(((i, tuple(WHOLE.encode_ordinary(t or ""))) for i, t, _ in rows), key=str)
    for r in tokens.collect():
        text = texts[4 if r.doc_id is None else r.doc_id] or ""
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() and r.n_tokens == len(r.ids)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert B.tokenize(docs, PATH, PATTERN).collect() == []


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 5)
    text = " ".join(f"w{i}" for i in range(50))
    for _ in range(3):
        assert CODEC.encode_pieces(CODEC.pieces(text)) == WHOLE.encode_ordinary(text)
        assert len(CODEC._ids) <= 5 + 99


@given(st.text(alphabet="'revlt s!\n", min_size=1, max_size=120), st.integers(1, 9), st.integers(1, 6))
@settings(max_examples=400, deadline=None)
def test_stitched_is_whole_with_contractions(text, stride, overlap):
    assert B.stitch(CODEC, chunks(text, stride, overlap)) == CODEC.pieces(text)


def test_contraction_across_the_end_of_a_chunk():
    for word in ("they're", "they've", "they'll"):
        for before in range(B.STRIDE + B.OVERLAP - 9, B.STRIDE + B.OVERLAP + 2):
            text = "a" * before + " " + word + " so" * 50
            assert B.stitch(CODEC, chunks(text, B.STRIDE, B.OVERLAP)) == CODEC.pieces(text)
