import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from asiento.llm import decontaminate as D


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def similarity(a, b, k=5):
    a, b = (Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1)) for x in (a, b))
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def slow_leaks(text, items, k=5):
    """Best similarity of item-sized passages, for each item that reaches 0.8."""
    t, found = text.split(), {}
    for number, item in items:
        i = item.split()
        if len(i) < k or len(t) < k:
            continue
        best = max(similarity(t[max(a, 0) : a + len(i)], i) for a in range(-4, max(1, len(t) - k + 1)) if a + len(i) >= k)
        if best >= 0.8:
            found[number] = best
    return found


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([5, 7, 11, 18, 24, 30, 37, 44, 52, 59, 140, 300])]
    return items + [(50, "too short to tell"), (51, ""), (52, None)]


def test_windows_of_all_alignments_are_found(bench):
    rng, built = random.Random(4), D.build_benchmark([i for i, _ in bench], [t for _, t in bench])
    texts, wanted = [], []
    for number, item in bench[:12]:
        for before in range(12):
            texts.append(" ".join([*words(rng, before), item, *words(rng, 40)]))
            wanted.append(number)
    found = D.leaks_of(pa.array(texts), built, 0.8, 11)
    assert [[leak["item_id"] for leak in leaks] for leaks in found] == [[number] for number in wanted]
    assert [leaks[0]["first_word"] for leaks in found] == [before for _ in range(12) for before in range(12)]
    assert all(leaks[0]["similarity"] == 1.0 for leaks in found)


def test_against_brute_force_with_edits(bench):
    rng, built = random.Random(5), D.build_benchmark([i for i, _ in bench], [t for _, t in bench])
    texts = []
    for _ in range(300):
        number, item = bench[rng.randrange(12)]
        passage = item.split()
        for _ in range(rng.randrange(3)):
            passage[rng.randrange(len(passage))] = "edited"
        if rng.random() < 0.3:
            passage = passage[rng.randrange(4) :]
        texts.append(" ".join([*words(rng, rng.randrange(50)), *passage, *words(rng, rng.randrange(50))]))
    wanted = [slow_leaks(t, [x for x in bench if x[1]]) for t in texts]
    found = D.leaks_of(pa.array(texts), built, 0.8, 11)
    n = sum(map(len, wanted))
    hits = sum(leak["item_id"] in w for leaks, w in zip(found, wanted, strict=True) for leak in leaks)
    assert hits == sum(map(len, found)), "nothing below the similarity"
    assert hits >= 0.97 * n > 100


def test_prints_within_the_radius_share_a_block_table(bench):
    rng = np.random.default_rng(6)
    size = D.build_benchmark([0], [bench[9][1]]).sizes[0]
    for _ in range(500):
        flips = rng.choice(64, 11, replace=False)
        value = np.array([size.prints[0] ^ np.uint64(sum(1 << int(b) for b in flips))], np.uint64)
        assert any(table[block] for table, block in zip(size.tables, value.view(np.uint16), strict=True))


def test_running_counts_wrap_around():
    h = np.random.default_rng(7).integers(0, 1 << 63, 5000, dtype=np.uint64)
    for size in (1, 2, 17, 255, 256, 700):
        got = D.window_prints(h, size, 3)
        for i in (0, 100, len(got) - 1):
            bits = np.unpackbits(h[3 * i : 3 * i + size].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
            assert got[i] == np.packbits(2 * bits > size).view(np.uint64)[0] or size % 2 == 0
            assert got[i] == np.packbits(bits > size // 2).view(np.uint64)[0]


def test_table_nulls_repeats_clashing_columns_and_slices(spark, bench):
    item = bench[5][1]
    long = " ".join(words(random.Random(8), 60_000)) + " " + item
    rows = [(1, item, "a", 1), (1, item, "a", 1), (None, item.upper(), None, None), (3, None, "b", 2), (4, "", "b", 2), (5, long, "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaks string, item_id int")
    items = spark.createDataFrame(bench, "item_id long, text string")
    for slice_bytes in (1 << 20, 500):
        found = D.find_leaks(docs, items, slice_bytes=slice_bytes)
        assert found.columns == [*docs.columns, "leaks_2"]
        got = sorted((r.doc_id or 0, [x.item_id for x in r.leaks_2]) for r in found.collect())
        assert got == [(0, [5]), (1, [5]), (1, [5]), (3, []), (4, []), (5, [5])]
    assert sorted(r.doc_id for r in D.drop_contaminated(docs, items).collect()) == [3, 4]
    assert D.drop_contaminated(docs, items.limit(0)).count() == 6
    assert D.find_leaks(docs.limit(0), items).collect() == []


def slow_best(text, item, k=5):
    """Best similarity of all passages of all lengths."""
    t, i = text.split(), item.split()
    return max(similarity(t[a:z], i) for a in range(len(t) - k + 1) for z in range(a + k, min(len(t), a + 2 * len(i)) + 1))


def test_shortened_and_shifted_copies_against_all_passages(bench):
    rng, some = random.Random(9), [x for x in bench[3:10]]
    built = D.build_benchmark([i for i, _ in bench], [t for _, t in bench])
    texts, wanted, cut = [], [], []
    for _ in range(60):
        number, item = some[rng.randrange(len(some))]
        passage = item.split()
        kind = rng.randrange(3)
        if kind == 0:
            n = rng.randrange(1 + (len(passage) - 4) // 5)
            left = rng.randrange(n + 1)
            passage = passage[left : len(passage) - (n - left)]
        elif kind == 1:
            at = rng.randrange(len(passage))
            passage[at:at] = words(rng, rng.randrange(1, 4))
        else:
            at = rng.randrange(len(passage))
            del passage[at : at + rng.randrange(1, 4)]
        texts.append(" ".join([*words(rng, rng.randrange(20)), *passage, *words(rng, rng.randrange(20))]))
        wanted.append({number: v} if (v := slow_best(texts[-1], item)) >= 0.8 else {})
        cut.append(kind == 0)
    found = [{leak["item_id"]: leak["similarity"] for leak in x} for x in D.leaks_of(pa.array(texts), built, 0.8, 11, any_length=True)]
    assert all(abs(w.get(i, 0) - v) < 1e-9 for f, w in zip(found, wanted, strict=True) for i, v in f.items())
    assert all(f.keys() == w.keys() for f, w, whole in zip(found, wanted, cut, strict=True) if whole), "runs are always found"
    print("found", sum(map(len, found)), "of", sum(map(len, wanted)))
    assert sum(map(len, found)) >= 0.97 * sum(map(len, wanted)) > 20


def test_first_words_of_an_item_within_a_longer_text():
    rng = random.Random(10)
    item = words(rng, 50)
    built = D.build_benchmark([1], [" ".join(item)])
    for before in range(12):
        text = " ".join([*words(rng, before), *item[:42], *words(rng, 60)])
        (leak,) = D.leaks_of(pa.array([text]), built, 0.8, 11, any_length=True)[0]
        assert abs(leak["similarity"] - 38 / 46) < 1e-9 and leak["first_word"] == before
