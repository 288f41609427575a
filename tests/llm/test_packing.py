"""Packed sequences against whole texts through the tokenizer."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from asiento.llm import packing
from asiento.llm.packing import Packer, Piece, merge_windows

FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(FILE[0])
    found.encode_special_tokens = True
    return found


def run(spark, docs, partitions=3, **options):
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, start int, ids string")
    return packing.pack_documents(df.repartition(partitions), *FILE, **options).collect()


def ids_of(row):
    return np.frombuffer(bytes(row.ids), "<u4").tolist()


def documents(rows):
    """Ids of each document from its pieces; documents with one id must have one row each."""
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.start, ids_of(r), r.doc_tokens))
    out = {}
    for id_, pieces in found.items():
        ids = []
        for start, part, total in sorted(pieces):
            assert start == len(ids) and part
            ids += part
        assert all(total == len(ids) for *_, total in pieces)
        out[id_] = ids
    return out


def padding(rows, size):
    """Padding, after a check that sequences have no gaps and no more than ``size`` ids."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, len(r.ids) // 4))
    lost = 0
    for pieces in sequences.values():
        n = 0
        for offset, length in sorted(pieces):
            assert offset == n
            n += length
        assert 0 < n <= size
        lost += 0 if n & (n - 1) == 0 else size - n
    return lost


TEXTS = ["a", "", None, "Hello world's end.", "x" * 700, "déjà vu  \n\n two  spaces ", "<|endoftext|>", "word " * 9000, "日本" * 40]


@pytest.mark.parametrize("partitions, fan_in", [(1, 32), (7, 2), (9, 3)])
def test_every_id_once(spark, tokenizer, partitions, fan_in):
    docs = [(i, TEXTS[i % len(TEXTS)]) for i in range(120)]
    rows = run(spark, docs, partitions, fan_in=fan_in, windows=4)
    found = documents(rows)
    assert len(found) == len(docs)
    for id_, text in docs:
        assert found[id_] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    padding(rows, packing.WINDOW)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\tA'srevlé中²1.,_-<|endoftext> \x85\x1c½🙂́", max_size=40))
def test_ids_are_those_of_the_tokenizer(tokenizer, text):
    ids = np.frombuffer(packing.encoder(*FILE).encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_little_padding(spark):
    random.seed(2)
    docs = [(i, "the " * random.randint(1, 1500)) for i in range(3000)]
    rows = run(spark, docs, 4)
    total = sum(len(r.ids) // 4 for r in rows)
    assert padding(rows, packing.WINDOW) < 0.01 * total
    short = sum(r.start == 0 and r.doc_tokens <= packing.WINDOW for r in rows)
    whole = sum(len(r.ids) // 4 == r.doc_tokens for r in rows)
    assert whole >= short - 4 * packing.OPEN_WINDOWS  # a window left open is cut once at most


def test_leftovers_alone_need_no_padding(spark):
    rows = run(spark, [(1, "a b c"), (2, "d e"), (3, "f")], 3)
    assert padding(rows, packing.WINDOW) == 0 and sum(len(r.ids) // 4 for r in rows) == 9


def test_null_and_repeated_ids(spark):
    rows = run(spark, [(None, "a"), (None, "b"), (1, "same"), (1, "same")], 1)
    assert sum(r.doc_id is None for r in rows) >= 2
    assert sum(len(r.ids) // 4 for r in rows if r.doc_id == 1) == 4


def test_empty_table_and_no_end(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, ""), (2, None)], end=None) == []
    assert [r.doc_id for r in run(spark, [(1, ""), (2, "a")], end=None)] == [2]


def piece(n):
    return Piece(n, 0, bytes(4 * n), n)


def test_best_fit_and_the_fullest_goes():
    packer = Packer(10, 2)
    lengths = lambda windows: [[p.n for p in w] for w in windows]
    assert lengths(packer.place(piece(6))) == [] and lengths(packer.place(piece(7))) == []
    assert lengths(packer.place(piece(3))) == [[7, 3]]  # fits best into the room of 3
    assert lengths(packer.place(piece(8))) == []
    assert lengths(packer.place(piece(5))) == [[8]]  # none has the room: the fullest goes
    assert lengths(packer.left()) == [[6], [5]]


@given(st.lists(st.lists(st.integers(1, 10), min_size=1, max_size=3), max_size=8), st.booleans())
def test_merged_windows(lengths, last):
    windows = [[piece(n) for n in window] for window in lengths]
    found = list(merge_windows(windows, 10, last))
    totals = [sum(p.n for p in window) for _, window in found]
    assert sum(totals) == sum(map(sum, lengths))
    closed = [n for (open_, _), n in zip(found, totals, strict=True) if not open_]
    if last:
        assert len(closed) == len(totals) and all(n == 10 or n & (n - 1) == 0 for n in totals)
    else:
        assert all(n == 10 for n in closed) and len(totals) - len(closed) <= 1
