import random

import numpy as np
import pyarrow as pa
import pytest

from asiento.llm import language_model as M


def sentences(rng, n):
    """A language in which the next word mostly follows from the last."""
    words = [f"w{i}" for i in range(40)]
    out, at = [], 0
    for _ in range(n):
        at = (at * 7 + 3) % 40 if rng.random() < 0.9 else rng.randrange(40)
        out.append(words[at])
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(sentences(rng, 300))) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()


def test_real_order_beats_shuffled_order(spark, docs):
    rng = random.Random(2)
    rows = []
    for i in range(30):
        words = sentences(rng, 200)
        rows.append((i, " ".join(words), " ".join(rng.sample(words, len(words)))))
    fresh = spark.createDataFrame(rows, "doc_id long, text string, other string")
    scores = [
        {r.doc_id: r.mean_log_probability for r in M.score_documents(fresh, column, every=1, rounds=4, training=docs.withColumnRenamed("text", column)).collect()}
        for column in ("text", "other")
    ]
    better = sum(scores[0][i] > scores[1][i] + 0.3 for i in scores[0])
    assert better == 30
    uniform = -np.log(40)
    assert np.mean(list(scores[0].values())) > uniform + 0.5


def test_gradient_of_the_network():
    rng = np.random.default_rng(3)
    network = M.Network.start(np.ones(12))
    around, unit = rng.integers(0, 13, (4, 5)), rng.integers(0, 12, 5)

    def loss(flat):
        return -network.with_values(flat).log_probabilities(around, unit).mean()

    flat = network.flat()
    learned = network.with_values(flat)
    learned.learn(around, unit, 1.0)
    gradient = flat - learned.flat()
    for at in rng.choice(len(flat), 40, replace=False):
        step = np.zeros(len(flat))
        step[at] = 1e-2
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-2 - gradient[at]) < 2e-3


def test_vocabulary_counts_all_words(spark, docs):
    counts = {r.word: r.n for r in M.count_words(docs).collect()}
    assert len(counts) == 40 and sum(counts.values()) == 200 * 300
    vocabulary = M.build_vocabulary(M.count_words(docs))
    assert vocabulary.counts.sum() == 200 * 300 and len(vocabulary.words) == 40


def test_probabilities_of_words_sum_to_one(spark, monkeypatch):
    rows = [(1, " ".join(f"x{i} " * (1 + i % 5) for i in range(500)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(M, "KEPT_WORDS", 200)
    counts = M.count_words(df)
    vocabulary = M.build_vocabulary(counts)
    h = np.array([r.word for r in counts.collect()]).view(np.uint64)
    unit, share = vocabulary.lookup(h)
    total = np.bincount(unit, np.exp(share), vocabulary.units)
    first = len(vocabulary.counts) - M.GROUPS
    assert np.allclose(total[:first], 1)
    # What is missing from one is kept for an unseen word.
    unseen = np.exp(vocabulary.rest[first:])
    assert np.allclose(total[first:] + unseen, 1)


def test_context_stops_at_the_ends_of_a_text():
    around = M._around(np.array([1, 2, 3, 4]), np.array([0, 0, 1, 1]), 9)
    assert around.tolist() == [[9, 9, 9, 9], [9, 1, 9, 3], [2, 9, 4, 9], [9, 9, 9, 9]]


def test_table(spark, docs):
    rows = [(1, None, 1.0), (2, "", 2.0), (None, "w1 w2", None), (4, "w1 w2", 1.0), (4, "w1 w2", 1.0), (5, "w1 " * 200_000, 1.0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_words double")
    out = M.score_documents(odd, training=docs)
    assert out.columns == [*odd.columns, "n_words_2", "log_probability", "mean_log_probability"]
    got = {r.doc_id: (r.n_words_2, r.log_probability, r.mean_log_probability) for r in out.collect()}
    assert got[1] == got[2] == (0, 0.0, None) and got[None] == got[4] and got[5][0] == 200_000
    assert got[4][1] < 0 and np.isclose(got[4][2], got[4][1] / 2)
    assert M.score_documents(odd.limit(0)).collect() == []
    assert all(r.log_probability == 0 for r in M.score_documents(odd.limit(2)).collect())


def test_scores_do_not_depend_on_the_batch(spark, docs):
    vocabulary = M.build_vocabulary(M.count_words(docs))
    network = M.Network.start(vocabulary.counts)
    texts = [r.text for r in docs.limit(5).collect()]
    _, together = M.score_texts(pa.array(texts), network, vocabulary)
    apart = [M.score_texts(pa.array([t]), network, vocabulary)[1][0] for t in texts]
    assert np.allclose(together, apart)


def test_scores_do_not_depend_on_the_kept_words(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"x{int(rng.paretovariate(0.5))}" for _ in range(9000)]
    rows = [(i % 50, " ".join(words[30 * i : 30 * i + 30]) or None, "a") for i in range(310)]
    table = spark.createDataFrame(rows, "doc_id long, text string, row string")
    other = spark.createDataFrame([(1, "x1 x900 new new x7"), (2, "x55 x55"), (3, None)], "doc_id long, text string")
    seen = {r.word: r.n for r in M.count_words(table).collect()}
    assert len(seen) > 400 and sum(n > 1 for n in sorted(seen.values(), reverse=True)[150:]) > 50
    monkeypatch.setattr(M, "FREQUENT", 20)

    def scores(kept, docs, training, heavy=1_000_000):
        monkeypatch.setattr(M, "KEPT_WORDS", kept)
        monkeypatch.setattr("asiento.operators.joins.heavy_key_join.__defaults__", ("inner", heavy))
        out = M.score_documents(docs, training=training, rounds=0)
        assert out.columns == [*docs.columns, "n_words", "log_probability", "mean_log_probability"]
        key = lambda r: (r.doc_id, r.text or "", r.n_words)
        return [(*key(r), r.log_probability, r.mean_log_probability) for r in sorted(out.collect(), key=key)]

    for docs, training, heavy in ((table, None, 1_000_000), (other, table, 1_000_000), (other, table, 1)):
        some, all_ = scores(150, docs, training, heavy), scores(100_000, docs, training)
        assert [r[:3] for r in some] == [r[:3] for r in all_]
        for a, b in zip(some, all_, strict=True):
            assert np.isclose(a[3], b[3]) and (a[4] is None) == (b[4] is None) and (a[4] is None or np.isclose(a[4], b[4]))


def topical(rng, n, kinds, of_kind):
    """Thousands of words, the kind of each mostly following from the kind of the last."""
    out, at = [], 0
    for _ in range(n):
        at = (at * 7 + 3) % kinds if rng.random() < 0.9 else rng.randrange(kinds)
        out.append(f"k{at}x{int(of_kind * rng.random() ** 1.5)}")
    return out


def test_order_of_thousands_of_words_counts_as_set_for_production(spark):
    rng = random.Random(7)
    texts = [topical(rng, 400, 20, 150) for _ in range(2000)]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    assert len({word for t in texts for word in t}) == 3000
    fresh = [topical(rng, 200, 20, 150) for _ in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(fresh)] + [(100 + i, " ".join(rng.sample(t, 200))) for i, t in enumerate(fresh)]
    got = M.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), training=table).collect()
    scores = {r.doc_id: r.mean_log_probability for r in got}
    gaps = [scores[i] - scores[100 + i] for i in range(30)]
    print("gap of real to shuffled order", np.mean(gaps), min(gaps))
    assert min(gaps) > 1.0


def test_every_position_trains_once():
    h = np.random.default_rng(8).integers(0, 1 << 63, 1000, dtype=np.uint64)
    rounds = [M.chosen_positions(h, M.EVERY, number) for number in range(M.ROUNDS)]
    assert sorted(np.concatenate(rounds).tolist()) == list(range(1000))
    assert len(M.chosen_positions(h, 1, 3)) == 1000


def test_scores_do_not_depend_on_the_partitions(spark, monkeypatch):
    rng = random.Random(11)
    monkeypatch.setattr(M, "SHARD_WORDS", 9000)
    rows = [(i % 90, " ".join(sentences(rng, rng.randrange(300))), "x") for i in range(300)] + [(5, "w1 w2 w9", "x")] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string, units string")

    def scores(partitions):
        found = M.score_documents(table.repartition(partitions)).collect()
        return sorted((r.doc_id, r.text, r.log_probability) for r in found)

    one = scores(1)
    for partitions in (4, 16):
        for a, b in zip(one, scores(partitions), strict=True):
            assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-6 * (1 + abs(a[2]))


def test_scores_against_a_plain_softmax(spark, docs):
    """Word by word: class, unit in the class, share in the unit."""
    vocabulary = M.build_vocabulary(M.count_words(docs))
    rng = np.random.default_rng(4)
    network = M.Network.start(vocabulary.counts)
    network = network.with_values(network.flat() + rng.normal(0, 0.2, len(network.flat())))
    texts = [r.text for r in docs.limit(3).collect()] + ["w3", "", "w3 unseen w7"]
    _, found = M.score_texts(pa.array(texts), network, vocabulary)

    def softmax(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    for text, got in zip(texts, found, strict=True):
        data = np.frombuffer(text.encode(), np.uint8)
        unit, share = vocabulary.lookup(M.hashed_words(data, np.array([0, len(data)])).hash)
        total = share.sum()
        for i, u in enumerate(unit):
            around = [unit[i + k] if 0 <= i + k < len(unit) else vocabulary.units for k in M.SIDES]
            hidden = np.tanh(sum(network.embedding[a] @ w for a, w in zip(around, network.hidden, strict=True)) + network.hidden_bias)
            total += np.log(softmax(hidden @ network.classes + network.class_bias)[u // M.CLASS])
            total += np.log(softmax(hidden @ network.output[u // M.CLASS] + network.output_bias[u // M.CLASS])[u % M.CLASS])
        assert np.isclose(got, total, rtol=1e-5)
