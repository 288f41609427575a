import numpy as np
import pytest
import xxhash

from asiento.llm import simhash_dedup as S
from asiento.llm.common import components


def slow_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=4):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize(
    "text", ["", " \n\t", "One", "a b c", "A b c É é\n\vd  e f A b c d", "x y " * 500, "ein Ö und ß " + "z" * 70_000]
)
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == slow_print(text)


def test_fingerprint_of_a_text_longer_than_a_block(monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(3000))
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "_HASH_BLOCK", 100)
    assert S.fingerprint(text.encode()) == whole == slow_print(text)


def test_keys_are_codewords_within_four_bits():
    keys = S.codeword_keys(np.random.default_rng(0).integers(0, 1 << 23, 2000))
    assert set((keys >= 0).sum(axis=1)) == {1, 6}


def test_words_two_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(S.codeword_keys(words), S.codeword_keys(other), strict=True):
        assert set(a[a >= 0]) & set(b[b >= 0])


def test_prints_four_bits_apart_share_a_join_key():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 500, dtype=np.uint64)
    for value in prints:
        flips = rng.choice(64, 4, replace=False)
        other = np.array([value ^ np.uint64(sum(1 << int(b) for b in flips))], np.uint64)
        assert set(S.golay_keys(np.array([value]))[0]) & set(S.golay_keys(other)[0])


def prints_near(rng, groups, size):
    out = []
    for _ in range(groups):
        value = int(rng.integers(0, 1 << 62))
        for _ in range(size):
            value ^= sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 4), replace=False))
            out.append(value)
    return out


@pytest.mark.parametrize(("groups", "size", "key_block"), [(30, 5, 4096), (2, 60, 4096), (2, 60, 8)])
def test_links_connect_what_pairs_connect(spark, groups, size, key_block):
    prints = sorted(set(prints_near(np.random.default_rng(size), groups, size)))
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    links = [(r.a, r.b) for r in S.print_links(df, key_block=key_block).distinct().collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links) or key_block == 8 or size == 60
    assert {p for link in links for p in link} <= set(prints)
    wanted = slow_components(prints)
    roots = {r.node: r.component for r in components(spark.createDataFrame(links or [(0, 0)], "a long, b long")).collect()}
    assert [roots.get(p, p) for p in prints] == [prints[i] for i in wanted]


def test_rows_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [
        (5, text, 1, "x"), (2, text.upper(), 1, "x"), (2, text, 1, "x"), (9, None, None, None), (7, "", 1, "x"),
        (None, text, 1, "x"), (None, "alone and lost", 1, "x"), (4, "quite another text", 1, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print int, kept string")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect() if r.doc_id)
    assert [x[1:] for x in got] == [(2, 2), (2, 2), (4, 4), (5, 2), (7, 7), (9, 7)]
    nameless = {(r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect() if r.doc_id is None}
    assert {c for _, c in nameless} == {2, None}
    kept = S.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 2, 4, 7]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).collect() == [] and S.keep_representatives(docs).collect() == []


def test_more_bits_than_the_keys_hold_for(spark):
    with pytest.raises(ValueError, match="at most 4"):
        S.print_links(spark.createDataFrame([(1,)], "print long"), max_bits=5)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 180)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_key_of_many_fingerprints_is_never_whole_in_a_task(spark, monkeypatch):
    rng = np.random.default_rng(9)
    prints = sorted({int(x) << 44 for x in rng.integers(0, 1 << 19, 6000)})  # the two lower segments are the same
    sizes = spark.sparkContext.accumulator(0)
    roots = S._roots

    def counted(values, max_bits):
        if len(values) > 1500:
            sizes.add(1)
        return roots(values, max_bits)

    monkeypatch.setattr(S, "_roots", counted)
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    found = {r.node: r.component for r in components(S.print_links(df, key_block=500)).collect()}
    assert {found.get(p, p) for p in prints} == {prints[0]} and sizes.value == 0
    S.print_links(df).count()
    assert sizes.value > 0


def test_repeated_ids_and_many_dropped_rows(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(i, text, "s") for i in range(40)] + [(100, "one of its kind", "s")] * 3 + [(0, text, "s"), (None, text, "s")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string")
    plain = S.exclude_in_place
    for options in ({}, {"max_bytes": -1}):
        monkeypatch.setattr(S, "exclude_in_place", lambda a, b, keys, options=options: plain(a, b, keys, **options))
        got = sorted((r.doc_id is None, r.doc_id) for r in S.keep_representatives(docs).collect())
        assert got == [(False, 0), (False, 100), (True, None)]
