"""Toxicity by non-negative positive-unlabelled learning (operator 9).

Confirmed toxic examples are the positives, unlabelled text the rest. A linear classifier on words and
leading bytes of words is trained in numpy with the class-prior-corrected, non-negative risk estimator:
prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, hashed_words, map_batches, small_batches, stored, text_blocks

#: Bounds of the training sample: confirmed toxic texts and unlabelled texts.
POSITIVES, UNLABELLED = 3000, 9000
#: Hashes kept, those that set positives apart most clearly; a kept one's least z-score, and how many times
#: as frequent in positives it is at least.
FEATURES, LEAST_Z, LEAST_LIFT = 512, 4.0, 2.0
#: A feature is that a hash occurs so many times at least.
LEVELS = (1, 2, 4)
#: Besides whole words, features are the first bytes of longer words.
PREFIXES = (4, 5, 6)
#: Weight decay; it also keeps the unbounded logistic loss from chasing the sample.
DECAY = 3e-4
#: A text is called toxic from this score on.
THRESHOLD = 0.7


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted hashes, weights by level and hash, and the intercept; about 16 KB."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        for doc, feature in present_features(texts, self.features):
            np.add.at(out, doc, self.weights[feature])
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def present_features(texts: pa.Array, features: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (index of the text, index of the feature), each once, for sorted hashes.

    Features are numbered by hash within levels: index of the level * number of hashes + index of the hash.
    """
    if not len(features):
        return
    mask = np.zeros(1 << 16, dtype=bool)
    mask[features & np.uint64(0xFFFF)] = True
    for first, _, data, offsets in text_blocks(texts):
        words = hashed_words(data, offsets, PREFIXES)
        found = []
        for h in (words.hash, *words.prefixes):
            at = np.flatnonzero(mask[h & np.uint64(0xFFFF)])
            i = np.searchsorted(features, h[at])
            i[i == len(features)] = 0
            hit = features[i] == h[at]
            found.append(words.doc[at[hit]] * len(features) + i[hit])
        pairs, times = np.unique(np.concatenate(found), return_counts=True)
        for number, level in enumerate(LEVELS):
            reached = pairs[times >= level]
            yield first + reached // len(features), number * len(features) + reached % len(features)


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``feature, in_positive, in_unlabelled``: number of texts of each kind (column y) with a feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_blocks(batch.column(0)):
                words = hashed_words(data, offsets, PREFIXES)
                doc = np.tile(words.doc, 1 + len(PREFIXES))
                pairs = np.zeros(len(doc), dtype=[("h", np.uint64), ("doc", np.int64)])
                pairs["h"], pairs["doc"] = np.concatenate([words.hash, *words.prefixes]), doc
                pairs = np.unique(pairs[pairs["h"] != 0])
                features, index = np.unique(pairs["h"], return_inverse=True)
                label = y[first:last][pairs["doc"]]
                counts = [np.bincount(index, label == k, len(features)).astype(np.int64) for k in (1, 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(features.view(np.int64)), *map(pa.array, counts)], ["feature", "p", "u"]
                )

    parts = small_batches(sample.select("text", "y")).mapInArrow(count, "feature long, p long, u long")
    return parts.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _train(
    x: np.ndarray, n_positive: np.ndarray, n_unlabelled: np.ndarray, prior: float, steps: int = 1500
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the non-negative risk with the logistic loss (Adam, whole batches).

    ``x`` holds the different feature rows, ``n_positive`` and ``n_unlabelled`` how often each occurs.
    """
    x = np.column_stack([x, np.ones(len(x))])
    p, u = n_positive / n_positive.sum(), n_unlabelled / n_unlabelled.sum()
    w = np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        z = np.clip(x @ w, -30, 30)
        s = 1 / (1 + np.exp(-z))
        negative_part = (u - prior * p) @ np.logaddexp(0, z)
        toward_negative = (u - prior * p) * s
        # An estimate below zero, which no risk can be, is over-fitted: only the positives count.
        slope = prior * p * (s - 1) + (toward_negative if negative_part >= 0 else 0)
        gradient = x.T @ slope
        gradient[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.03 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Callable[[Column], Column],
    id_column: str = "doc_id",
    text: str = "text",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> ToxicityModel:
    """Train on the rows for which ``usable``, a condition on the id, holds.

    Positives are rows that ``labels`` (id, toxic) marks 1; unlabelled are all usable rows, whatever
    their label. Both are sampled by a hash of the id down to about the stated bounds. The class prior is
    the toxic share of the usable labels. Without any toxic label the model gives every text score 0.
    Labels that are null, and ids that are null, are not used.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.filter("id is not null").filter(usable(F.col("id")))
    known = known.filter("id is not null and toxic is not null").filter(usable(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    n = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    if not n["n"] or not n["p"]:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    prior = min(max(n["p"] / n["n"], 1e-4), 0.9)
    share_p = min(1.0, positives / n["p"])
    share_u = min(1.0, unlabelled / max(1, rows.count()))
    ticket = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6
    marked = known.filter("toxic = 1").filter(ticket < share_p).select("id")
    # About `positives` ids of eight bytes by construction, so the side is bounded.
    # Of rows that share an id one is taken: an id may be on a third of all rows.
    toxic = rows.join(F.broadcast(marked), "id", "left_semi").dropDuplicates(["id"]).select("text", F.lit(1).alias("y"))
    ticket = F.pmod(F.xxhash64("id", F.lit("u")), F.lit(1_000_000)) / 1e6
    unknown = rows.filter(ticket < share_u).dropDuplicates(["id"]).select("text", F.lit(0).alias("y"))
    sample = stored(toxic.unionByName(unknown), "sample")
    sizes = {row["y"]: row["count"] for row in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    n_p, n_u = float(sizes[1]), float(sizes[0])
    p, u = F.col("p") / n_p, F.col("u") / n_u
    z = (p - u) / F.sqrt(p * (1 - p) / n_p + u * (1 - u) / n_u + F.lit(1e-4) / n_u)
    clear = _feature_counts(sample).filter(p >= LEAST_LIFT * u)
    best = clear.select("feature", z.alias("z")).filter(F.col("z") >= LEAST_Z)
    best = best.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()
    features = np.sort(np.array([row["feature"] for row in best], dtype=np.int64).view(np.uint64))

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists: list[list[int]] = [[] for _ in range(batch.num_rows)]
        for docs_, found in present_features(batch.column(0), features):
            for doc, feature in zip(docs_.tolist(), found.tolist(), strict=True):
                lists[doc].append(feature)
        yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), batch.column(1)], ["x", "y"])

    encoded = map_batches(sample, encode, "x array<int>, y int").collect()  # the bounded sample
    rows_, first, seen = {}, [], []
    for row in encoded:
        key = tuple(row["x"])
        if rows_.setdefault(key, len(rows_)) == len(first):
            first.append(key)
            seen.append([0, 0])
        seen[rows_[key]][row["y"]] += 1
    seen = np.array(seen)
    x = np.zeros((len(first), len(LEVELS) * len(features)))
    for row, key in zip(x, first, strict=True):
        row[list(key)] = 1
    weights, intercept = _train(x, seen[:, 1], seen[:, 0], prior)
    return ToxicityModel(features, weights, intercept)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a further column ``score`` (0 to 1) of every whole text; a null text is empty.

    All other columns pass through; if ``score`` is taken, score_2 is used, and so on.
    """
    name = free_name(docs.columns, score)
    at = [c.lower() for c in docs.columns].index(text.lower())

    def add(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(model.scores(batch.column(at)))], [*docs_names, name]
        )

    docs_names = docs.columns
    schema = docs.select("*", F.lit(0.0).alias(name)).schema
    return map_batches(docs, add, schema)
