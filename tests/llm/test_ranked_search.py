"""Search through document FP-trees against scores of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from asiento.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=50):
    counts = [(id_, Counter(terms(text))) for id_, text in docs]
    counts = [(id_, c) for id_, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    found = []
    for item, text in items:
        scored = []
        for id_, c in counts:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scored.append((-score, id_ is None, id_))
        scored = sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:top]
        found.extend((item, rank, id_, -score) for rank, (score, _, id_) in enumerate(scored, 1))
    return sorted(found, key=str)


def run(spark, docs, items, **options):
    docs = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, item_id string, rank int").repartition(3)
    items = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in ranked_search.search(docs, items, **options).collect()), key=str)


def random_docs(random, n, words, most=30):
    share = np.arange(1, len(words) + 1) ** -1.0
    return [(i, " ".join(random.choice(words, random.integers(0, most), p=share / share.sum()))) for i in range(n)]


@pytest.mark.parametrize("leaf, entries", [(1, 1 << 20), (4, 200), (16, 1 << 20), (256, 500)])
def test_like_all_scores(spark, leaf, entries):
    random = np.random.default_rng(leaf)
    words = [f"w{i}" for i in range(60)]
    docs, items = random_docs(random, 400, words), random_docs(random, 12, words, 9)
    assert run(spark, docs, items, leaf=leaf, tree_entries=entries, top=7) == brute(docs, items, 7)


def test_groups_and_slices_of_items(spark, monkeypatch):
    random = np.random.default_rng(9)
    words = [f"w{i}" for i in range(200)]
    docs, items = random_docs(random, 200, words), random_docs(random, 20, words, 12)
    monkeypatch.setattr(ranked_search, "GROUP_TERMS", 20)
    assert run(spark, docs, items, leaf=8, item_bytes=300) == brute(docs, items)


def test_equal_documents_go_by_id(spark):
    docs = [(i, "to be or not to be") for i in range(300, 0, -1)] + [(1000, "to go")]
    found = run(spark, docs, [(5, "be")], leaf=16)
    assert found == brute(docs, [(5, "be")]) and {r[2] for r in found} == set(range(1, 51))


def test_text_rules(spark):
    docs = [
        (1, None), (2, ""), (3, "..., !"), (4, "Ärger ÄRGER arger"), (5, "a-b c_d e'f"), (6, "x1 1x  日本語 x1"), (7, "İstanbul A\x7fB"),
    ]
    items = [(1, "ärger Ärger"), (2, "B c D"), (3, "日本語"), (4, None), (5, "--"), (6, "istanbul a b İSTANBUL"), (7, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items)


def test_nulls_and_repeated_rows(spark):
    docs = [(1, "red blue"), (1, "red blue"), (None, "red blue"), (2, "red"), (3, "green")]
    items = [(1, "red"), (1, "red"), (None, "blue")]
    found = run(spark, docs, items)
    assert found == brute(docs, items) and len([r for r in found if r[0] == 1]) == 8


def test_very_long_texts(spark):
    long = "q" * 5000
    other = long[1024:2048] + long[:1024] + long[2048:] + "r"
    docs = [(1, f"word {long} " + "filler " * 100_000), (2, f"{other} word"), (3, "word")]
    items = [(1, f"{long} word"), (2, other)]
    assert run(spark, docs, items) == brute(docs, items)


def test_different_words_of_one_hash(spark):
    """Hashes repeat after 1,024 bytes; the letters decide."""
    a, b = "a" * 1024 + "b" * 1024, "b" * 1024 + "a" * 1024
    docs, items = [(1, a), (2, b), (3, "c")], [(1, a), (2, b)]
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == []


def test_bounds_leave_documents_out(monkeypatch):
    """A good match found first closes most of the trie."""
    random = np.random.default_rng(3)
    n = 4000
    lengths = random.integers(1, 6, n)
    lists = [np.sort(random.choice(40, k, replace=False)) for k in lengths]
    tree = ranked_search.Tree(
        np.arange(n), np.full(n, 60), np.cumsum(lengths), np.concatenate(lists), np.ones(lengths.sum(), np.int64), leaf=8
    )
    item, best = ranked_search.Item(0, np.array([3, 9]), np.array([500, 2000])), {0: ranked_search.Best(5)}
    scored = []
    add = ranked_search.Best.add
    monkeypatch.setattr(ranked_search.Best, "add", lambda self, s, i: (scored.append(len(i)), add(self, s, i))[1])
    tree.search([item], best)
    assert sum(scored) < n / 4
    both = [i for i in range(n) if {3, 9} <= set(lists[i].tolist())]
    assert best[0].ids.tolist() == both[:5]
