"""Long lists of phrases: the index against plain search."""

import inspect
import random

import pytest
from pyspark.sql import functions as F

import asiento as A
from asiento.operators import joins
from asiento.operators import phrases as phrases_module
from asiento.operators.filters import CHAINED
from asiento.operators.joins import exclude_in_place


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, body string").repartition(3)


def table(spark, phrases):
    return spark.createDataFrame([(p, "x") for p in phrases], "phrase string, gram string")


def held(values, phrases):
    lower = [p.lower() for p in phrases if p is not None]
    return {i for i, v in enumerate(values) if any(p in (v or "").lower() for p in lower)}


def kept(df):
    return sorted(r.id for r in df.collect())


def random_words(rng, n, letters="abcdeé ", most=12):
    return ["".join(rng.choices(letters, k=rng.randint(1, most))) for _ in range(n)]


@pytest.mark.parametrize("max_bytes", [1 << 26, 3000])
def test_like_plain_search(spark, max_bytes):
    rng = random.Random(3)
    values = random_words(rng, 300, most=60) + [None, "", "ABCDE", "abc\nde abc", "\U0001f642abc"]
    phrases = random_words(rng, 150) + [None, "AB", "C\nD", "\U0001f642a", "é"]
    found = A.find_phrases(texts(spark, values), table(spark, phrases), ["id"], "body", max_bytes=max_bytes).distinct()
    lower = {p.lower() for p in phrases if p is not None}
    assert {(r.id, r.phrase) for r in found.collect()} == {
        (i, p) for i, v in enumerate(values) for p in lower if p in (v or "").lower()
    }
    left = A.exclude_phrase_table(texts(spark, values), table(spark, phrases), "body", max_bytes=max_bytes)
    assert kept(left) == sorted(set(range(len(values))) - held(values, phrases)) and left.columns == ["id", "body"]


def test_a_hundred_thousand_phrases(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(3000)]
    values = [" ".join(rng.choices(words, k=80)) for _ in range(400)]
    phrases = list({" ".join(rng.choices(words, k=2)) for _ in range(120_000)})[:100_000]
    phrases += [values[i][7:30].upper() for i in range(0, 400, 9)]
    left = A.exclude_phrases(texts(spark, values), table(spark, phrases), "body")
    pairs = {p.lower() for p in phrases}
    expected = {
        i for i, v in enumerate(values) if any(f"{a} {b}" in pairs for a, b in zip(v.split(), v.split()[1:])) or v[7:30] in pairs
    }
    expected |= held([v if i not in expected else None for i, v in enumerate(values)], phrases[100_000:])
    assert 45 < len(expected) < 400 and set(range(400)) - set(kept(left)) >= expected
    # Phrases need not begin with a word: what else went must hold one.
    assert set(range(400)) - set(kept(left)) == held(values, phrases)


def test_long_lists_do_not_nest(spark):
    phrases = [f"word{i} " for i in range(1000)]
    assert len(phrases) > CHAINED
    assert kept(A.exclude_phrases(texts(spark, ["a WORD77 b", "a word77", None]), phrases, "body")) == [1, 2]


def test_empty_tables_and_phrases(spark):
    values = ["a", None, ""]
    assert kept(A.exclude_phrases(texts(spark, values), table(spark, []), "body")) == [0, 1, 2]
    assert kept(A.exclude_phrases(texts(spark, values), table(spark, [None]), "body")) == [0, 1, 2]
    assert kept(A.exclude_phrases(texts(spark, values), table(spark, ["", "b"]), "body")) == []
    assert kept(A.exclude_phrases(texts(spark, []), table(spark, ["a"]), "body")) == []


def test_very_long_text(spark):
    long = "x" * 500_000 + "needle in" + "y" * 500_000
    assert kept(A.exclude_phrases(texts(spark, [long, "x" * 100]), table(spark, ["NEEDLE IN", "zz"]), "body")) == [1]


@pytest.mark.parametrize("max_bytes, max_slots", [(1 << 20, 1 << 20), (0, 1 << 20), (0, 64)])
def test_excluded_keys(spark, max_bytes, max_slots):
    left = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 500, 7).toDF("k")
    found = exclude_in_place(left, right, ["k"], max_bytes, max_slots)
    assert sorted(r.v for r in found.collect()) == [i for i in range(2000) if i % 500 % 7]


def test_texts_are_not_shuffled(spark, plan):
    found = A.find_phrases(texts(spark, ["abc"]).coalesce(1), table(spark, ["ab", "zzzzzzzz"]), ["id"], "body")
    executed = plan(found)
    assert "BroadcastHashJoin" in executed and "hashpartitioning" not in executed
    assert joins.BROADCAST_BYTES == 64 << 20


def test_slices_look_only_at_texts_that_are_left(spark, monkeypatch):
    looked_at, hits = [], phrases_module._hits

    def counted(df, *rest):
        looked_at.append(df.count())
        return hits(df, *rest)

    monkeypatch.setattr(phrases_module, "_hits", counted)
    values = [f"text {i} of many words" for i in range(50)] + [f"other {i}" for i in range(10)]
    left = A.exclude_phrase_table(texts(spark, values), table(spark, ["many w", "any wo", "of man", "qqqqqq", "zz zz zz"]), "body", max_bytes=60)
    assert kept(left) == list(range(50, 60))
    assert len(looked_at) > 2 and looked_at[0] == 60 and looked_at[-1] == 10


def test_the_driver_builds_small_tables():
    assert phrases_module.SLICE_BYTES <= 8 << 20
    for function in (A.find_phrases, A.exclude_phrase_table):
        assert inspect.signature(function).parameters["max_bytes"].default == phrases_module.SLICE_BYTES


def test_one_row_of_a_phrase_is_shuffled(spark, plan):
    phrases = phrases_module.phrase_table(table(spark, ["some long phrase", "b", "\U0001f642abc defg"]))
    index = phrases_module.phrase_index(phrases, texts(spark, ["some text", None]), "body")
    assert "SortMergeJoin" not in plan(index) and "SortAggregate" not in plan(index)
    found = {r.phrase: (r.length, r.gram) for r in index.collect()}
    assert set(found) == {"some long phrase", "b", "\U0001f642abc defg"} and found["b"] == (1, "b")
    assert all(gram in phrase and len(gram) == min(6, len(phrase)) for phrase, (_, gram) in found.items())


def test_passes_do_not_grow_with_the_phrases(spark, monkeypatch):
    rng = random.Random(11)
    values = random_words(rng, 60, most=900) + ["", None, "Σ\U0001f642abc" * 80]
    phrases = [p for p in random_words(rng, 400, most=14) if len(p) > 4] + [values[0][200:500], values[1][100:228], "\U0001f642ABCσ\U0001f642", "zz" * 100]
    passes, hits = [], phrases_module._hits
    monkeypatch.setattr(phrases_module, "_hits", lambda *given: passes.append(given) or hits(*given))
    left = A.exclude_phrase_table(texts(spark, values), table(spark, phrases), "body", max_bytes=2000)
    assert kept(left) == sorted(set(range(len(values))) - held(values, phrases)) and 5 < left.count() < 50
    assert len(passes) == 4  # beginnings, whole texts, the rest of the phrases, phrases longer than a piece


def test_pieces_hold_every_run(spark):
    text = "".join(random.Random(2).choices("abcé\U0001f642\n", k=500))
    found = spark.createDataFrame([(text,), ("ab",), ("",)], "t string").select(phrases_module.pieces("t", 40, 12).alias("p")).collect()
    assert {text[i : i + 12] for i in range(489)} <= {p[i : i + 12] for p in found[0].p for i in range(len(p))}
    assert max(map(len, found[0].p)) == 51 and [r.p for r in found[1:]] == [["ab"], []]
