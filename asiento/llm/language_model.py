"""Masked pseudo-likelihood of documents (operator 5).

A small network predicts every word from the two words on either side of it, so from both sides; a
document's score is the sum of the log-probabilities of its words, each given the others around it. The
network reads and predicts units: the most frequent words, and groups by frequency of all others. Units are
in order of frequency and cut into classes; a class is predicted, and then a unit within it.
Within a group a word's probability is its share of the corpus counts: those of the most frequent words are
sent to the tasks, all others are joined from the stored table of counts.

Counts cover all documents. Texts are read once more, to units that are stored. The network is trained in numpy on
shards of the documents, in each round on another ``EVERY``-th position of all of them, and the shards' networks are
averaged by Spark, round by round. There are as many rounds as that, so each position trains once. Shards
come from hashes of the rows, not from partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.common import free_name, hashed_words, map_batches, small_batches, stored, text_blocks
from asiento.operators.joins import heavy_key_join

#: Frequent words that are units of their own, groups of the others, words whose counts are sent to the tasks.
#: A group has as many words as all before it; the last one has all others, also those that are not kept.
FREQUENT, GROUPS, KEPT_WORDS = 4096, 3, 50_000
SIDES = (-2, -1, 1, 2)
#: Sizes of an embedding and of the hidden layer, units of a class.
WIDTH, HIDDEN, CLASS = 8, 24, 64
#: Training: rounds over the documents, share of positions in a round, size of a gradient step, its step.
ROUNDS, EVERY, BATCH, STEP = 2, 2, 2048, 0.1
#: Words of a shard, which is trained in order.
SHARD_WORDS = 2_000_000
#: Words whose neighbours are looked up, and words that are scored, at a time.
_BLOCK, _STEP = 1 << 15, 1 << 13
#: Logits below this need no scaling.
_LARGE = 60.0


@dataclass
class Vocabulary:
    words: np.ndarray  # sorted hashes of the kept words
    unit: np.ndarray  # unit of each
    log_share: np.ndarray  # log of its share of the unit's corpus count
    rest: np.ndarray  # by unit: log share of any word that is not kept
    counts: np.ndarray  # by unit: corpus count
    whole: bool  # whether every word of the corpus is kept

    @property
    def units(self) -> int:
        return len(self.counts)

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit and log share of words."""
        return self.lookup_found(*self.find(h))

    def lookup_found(self, at: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = np.where(known, self.unit[at] if len(self.words) else 0, self.units - 1)
        share = np.where(known, self.log_share[at] if len(self.words) else 0.0, self.rest[unit])
        return unit, share

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words are among the kept ones, and whether they are."""
        at = np.searchsorted(self.words, h)
        at[at == len(self.words)] = 0
        return at, self.words[at] == h if len(self.words) else np.zeros(len(h), dtype=bool)


def group_of(rank: np.ndarray, first: int) -> np.ndarray:
    """Unit of kept words by their rank among all words; the first ``first`` are units of their own."""
    group = np.log2(np.maximum(rank, FREQUENT) // FREQUENT).astype(np.int64)
    return np.where(rank < first, rank, first + np.minimum(group, GROUPS - 1))


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, n``: corpus counts of all words of all documents; a task adds up before the shuffle."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, data, offsets in text_blocks(batch.column(0)):
            words, n = np.unique(hashed_words(data, offsets).hash, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return map_batches(docs.select(text), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame) -> Vocabulary:
    """The kept words (at most ``KEPT_WORDS``) and the sums of each group over all other words."""
    top = counts.orderBy(F.desc("n"), "word").limit(KEPT_WORDS).collect()
    words = np.array([row["word"] for row in top], dtype=np.int64).view(np.uint64)
    n = np.array([row["n"] for row in top], dtype=np.float64)
    frequent = min(FREQUENT, len(words))
    unit, last = group_of(np.arange(len(words)), frequent), frequent + GROUPS - 1
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("types")).first()
    mass = np.bincount(unit, n, last + 1)
    others, types = (sums["n"] or 0) - n.sum(), sums["types"] - len(words)
    mass[last] += others
    # An unseen word counts as one occurrence more of the last group; a word not kept has the mean count of both.
    rest = np.where(mass > 0, -np.inf, 0.0)
    rest[last] = np.log((others + 1) / (types + 1) / (mass[last] + 1))
    order = np.argsort(words)
    share = np.where(np.arange(len(words)) < frequent, 0.0, np.log(n / (mass[unit] + (unit == last))))
    return Vocabulary(words[order], unit[order], share[order], rest, mass, types == 0)


@dataclass
class Network:
    """Embeddings of units (the last one: beyond the text), hidden layer, layers of classes and of their units."""

    embedding: np.ndarray
    hidden: np.ndarray  # (sides, WIDTH, HIDDEN)
    hidden_bias: np.ndarray
    classes: np.ndarray  # (HIDDEN, classes)
    class_bias: np.ndarray
    output: np.ndarray  # (classes, HIDDEN, CLASS)
    output_bias: np.ndarray  # (classes, CLASS)

    @staticmethod
    def start(counts: np.ndarray) -> Network:
        rng, units = np.random.default_rng(5), len(counts)
        n = -(-units // CLASS)
        padded = np.zeros(n * CLASS)
        padded[:units] = counts + 1
        padded = padded.reshape(n, CLASS)
        with np.errstate(divide="ignore"):  # places beyond the last unit are never predicted
            within = np.maximum(np.log(padded / padded.sum(axis=1, keepdims=True)), -1e4)
        return Network(
            rng.normal(0, 0.3, (units + 1, WIDTH)), rng.normal(0, 0.3, (len(SIDES), WIDTH, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, 0.1, (HIDDEN, n)), np.log(padded.sum(axis=1) / padded.sum()),
            rng.normal(0, 0.1, (n, HIDDEN, CLASS)), within,
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.hidden, self.hidden_bias, self.classes, self.class_bias, self.output, self.output_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_values(self, flat: np.ndarray) -> Network:
        out, at = [], 0
        for part in self.parts():
            out.append(flat[at : at + part.size].reshape(part.shape).copy())
            at += part.size
        return Network(*out)

    def inward(self) -> np.ndarray:
        """What each unit on each side adds to the hidden layer."""
        return np.matmul(self.embedding, self.hidden).astype(np.float32)

    def log_probabilities(self, around: np.ndarray, unit: np.ndarray, tables: np.ndarray | None = None) -> np.ndarray:
        """Log-probability of each unit given the units around it (one row per side). ``tables`` is ``inward()``."""
        order, classes, runs = _by_class(unit)
        around, unit = around[:, order], unit[order]
        tables = self.inward() if tables is None else tables
        hidden = tables[0].take(around[0], axis=0, mode="clip")
        for side in range(1, len(SIDES)):
            hidden += tables[side].take(around[side], axis=0, mode="clip")
        hidden_bias, class_weights, class_bias, output, output_bias = (p.astype(np.float32, copy=False) for p in self.parts()[2:])
        hidden += hidden_bias
        np.tanh(hidden, out=hidden)
        logits = hidden @ class_weights
        logits += class_bias
        within = np.empty((len(unit), CLASS), np.float32)
        for c, first, last in runs:
            np.dot(hidden[first:last], output[c], out=within[first:last])
            within[first:last] += output_bias[c]
        out = np.empty(len(unit))
        out[order] = _chosen(logits, classes) + _chosen(within, unit % CLASS)
        return out

    def learn(self, around: np.ndarray, unit: np.ndarray, step: float, past: list[np.ndarray] | None = None) -> None:
        """One step down the gradient of the cross entropy; each weight's by its ``past`` squares, if given."""
        for k, (weights, slope) in enumerate(zip(self.parts(), self._slopes(around, unit), strict=True)):
            if past is not None:
                past[k] += slope**2
                scale = np.sqrt(past[k])
                scale += 1e-9
                slope /= scale
            slope *= step
            weights -= slope

    def _slopes(self, around: np.ndarray, unit: np.ndarray) -> list[np.ndarray]:
        """Mean gradient of the cross entropy, by part."""
        n, kind = len(unit), self.embedding.dtype.type
        order, classes, runs = _by_class(unit)
        around, unit = around.T[order], unit[order]
        flat = self.embedding.take(around, axis=0, mode="clip").reshape(n, -1)
        hidden = np.tanh(flat @ self.hidden.reshape(-1, HIDDEN) + self.hidden_bias)
        p = hidden @ self.classes
        p += self.class_bias
        p = _errors(p, classes)
        p *= kind(1 / n)
        back = p @ self.classes.T
        q = np.empty((n, CLASS), hidden.dtype)
        for c, first, last in runs:
            np.dot(hidden[first:last], self.output[c], out=q[first:last])
            q[first:last] += self.output_bias[c]
        q = _errors(q, unit % CLASS)
        q *= kind(1 / n)
        output, output_bias = np.zeros_like(self.output), np.zeros_like(self.output_bias)
        inner_back, ones = np.empty_like(back), np.ones(n, back.dtype)
        for c, first, last in runs:
            own = q[first:last]
            np.dot(hidden[first:last].T, own, out=output[c])
            np.dot(own, self.output[c].T, out=inner_back[first:last])
            np.dot(ones[first:last], own, out=output_bias[c])
        back += inner_back
        back *= 1 - hidden**2
        inward = (back @ self.hidden.reshape(-1, HIDDEN).T).reshape(-1, WIDTH)
        sides, embedding = around.ravel().astype(np.intp), np.zeros_like(self.embedding)
        for k, column in enumerate(np.ascontiguousarray(inward.T)):
            embedding[:, k] = np.bincount(sides, column, len(embedding))
        inner = (flat.T @ back).reshape(self.hidden.shape)
        return [embedding, inner, back.sum(axis=0), hidden.T @ p, p.sum(axis=0), output, output_bias]


def _by_class(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """The order that puts units of a class together, their classes in it, and (class, first, last + 1) of each."""
    classes = (unit // CLASS).astype(np.int16)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    first = np.flatnonzero(np.diff(classes, prepend=-1))
    last = np.append(first[1:], len(classes))[: len(first)]
    return order, classes, list(zip(classes[first].tolist(), first.tolist(), last.tolist(), strict=True))


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What exp is taken of less than each logit, by row (0 where none is large), and the sums of the exps.

    ``logits`` are overwritten by the exps.
    """
    ones = np.ones(logits.shape[1], logits.dtype)  # a product with them is faster than a sum
    if logits.size and logits.max() < _LARGE:
        kept = logits.copy()
        np.exp(logits, out=logits)
        sums = logits @ ones
        if sums.min() > 1e-20:
            return np.zeros(1, logits.dtype), sums
        logits[:] = kept
    top = logits.max(axis=1)
    logits -= top[:, None]
    np.exp(logits, out=logits)
    return top, logits @ ones


def _chosen(logits: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Log of the softmax at one place of each row; ``logits`` are overwritten."""
    chosen = logits[np.arange(len(which)), which].astype(np.float64)
    top, sums = _exponentials(logits)
    return chosen - top - np.log(sums.astype(np.float64))


def _errors(logits: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Softmax less one at the right place of each row; ``logits`` are overwritten."""
    _, sums = _exponentials(logits)
    logits /= sums[:, None]
    logits[np.arange(len(which)), which] -= 1
    return logits


def _around(unit: np.ndarray, doc: np.ndarray, beyond: int) -> np.ndarray:
    """Units at the four sides of each word; ``beyond`` outside its text."""
    out = np.full((len(SIDES), len(unit)), beyond, dtype=np.int32)
    for row, side in zip(out, SIDES, strict=True):
        k = abs(side)
        if k < len(unit):
            here, there = (slice(k, None), slice(None, -k)) if side < 0 else (slice(None, -k), slice(k, None))
            row[here] = np.where(doc[here] == doc[there], unit[there], beyond)
    return out


def chosen_positions(h: np.ndarray, every: int, number: int) -> np.ndarray:
    """Positions that train in a round: those of one residue; ``every`` rounds have each position once."""
    residue = (h + np.arange(len(h), dtype=np.uint64)) % np.uint64(every)
    return np.flatnonzero(residue == np.uint64(number % every))


def encode_texts(
    texts: pa.Array, vocabulary: Vocabulary, others: list | None = None
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Units of each text as bytes (16 bits each), their number, and the summed log shares of the words.

    Words that are not kept count as the mean of their group. If a list ``others`` is given, they count as
    seen once, and it gets ``(text, word, times)`` arrays of them: times * log(corpus count) is missing.
    """
    n, total, units = np.zeros(len(texts), np.int64), np.zeros(len(texts)), [b""]
    for first, last, data, offsets in text_blocks(texts):
        found = hashed_words(data, offsets)
        at, known = vocabulary.find(found.hash)
        unit, share = vocabulary.lookup_found(at, known)
        if others is not None:
            other = np.flatnonzero(~known)
            share[other] = -np.log(vocabulary.counts[unit[other]] + 1)
            order = other[np.lexsort((found.hash[other], found.doc[other]))]
            h, doc = found.hash[order], found.doc[order]
            new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))[: len(h)])
            others.append((doc[new] + first, h[new], np.diff(np.append(new, len(h)))))
        units.append(unit.astype("<i2").tobytes())
        n[first:last] += np.bincount(found.doc, minlength=last - first)
        total[first:last] += np.bincount(found.doc, share, last - first)
    ends = np.append(0, 2 * np.cumsum(n)).astype(np.int64)
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(units))])
    return packed.cast(pa.binary()), n, total


def _unit_blocks(units: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units of successive texts, and the number of the text of each, about ``_BLOCK`` at a time."""
    parts, size = [], 0
    for packed in units:
        parts.append(np.frombuffer(packed, "<i2"))
        size += len(parts[-1])
        if size >= _BLOCK:
            yield np.concatenate(parts).astype(np.int64), np.repeat(np.arange(len(parts)), list(map(len, parts)))
            parts, size = [], 0
    if size:
        yield np.concatenate(parts).astype(np.int64), np.repeat(np.arange(len(parts)), list(map(len, parts)))


def score_units(packed: pa.Array, network: Network, beyond: int) -> np.ndarray:
    """Summed log-probability of the units of each text."""
    lengths = np.array([len(p.as_buffer()) // 2 for p in packed], np.int64)
    values, tables = [np.zeros(0)], network.inward()
    for unit, doc in _unit_blocks(p.as_buffer() for p in packed):
        around = _around(unit, doc, beyond)
        for at in range(0, len(unit), _STEP):
            part = slice(at, at + _STEP)
            values.append(network.log_probabilities(around[:, part], unit[part], tables))
    sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), np.concatenate(values), len(lengths))
    return sums.astype(np.float64)  # without any unit they are whole numbers


def train_network(encoded: DataFrame, vocabulary: Vocabulary, words: int, rounds: int = ROUNDS, every: int = EVERY) -> Network:
    """The mean, by positions, of networks trained on the shards of ``encoded`` (``shard, place, units``), round by round.

    Shards are as many as the words ask for, and what lies in them and in what order comes from the rows
    themselves: the network is the same however the table is partitioned.
    """
    network = Network.start(vocabulary.counts)
    spark = encoded.sparkSession
    shards = max(1, round(words / SHARD_WORDS))
    dealt = encoded.select(F.pmod("shard", F.lit(shards)).alias("shard"), "place", "units")
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((network, vocabulary.units))  # about 1 MB, whatever the corpus

        def learn(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            first, beyond = shared.value
            total, seen = np.zeros(len(first.flat())), 0
            rows = ((shard, packed.as_buffer()) for b in batches for shard, packed in zip(b.column(0).to_pylist(), b.column(1), strict=True))
            for _, of_shard in groupby(rows, key=itemgetter(0)):
                own, trained = first.with_values(first.flat().astype(np.float32)), 0
                past = [np.zeros_like(part) for part in own.parts()]
                for unit, doc in _unit_blocks(packed for _, packed in of_shard):
                    around = _around(unit, doc, beyond)
                    chosen = chosen_positions(unit.astype(np.uint64), every, number)
                    for at in range(0, len(chosen), BATCH):
                        part = chosen[at : at + BATCH]
                        own.learn(around[:, part], unit[part], STEP, past)
                    trained += len(chosen)
                total += trained * own.flat().astype(np.float64)
                seen += trained
            for at in range(0, len(total) if seen else 0, 1 << 14):
                part = total[at : at + (1 << 14)]
                columns = np.arange(at, at + len(part), dtype=np.int32), part, np.full(len(part), seen)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["at", "value", "n"])

        ordered = small_batches(dealt.repartition("shard").sortWithinPartitions("shard", "place").select("shard", "units"))
        parts = ordered.mapInArrow(learn, "at int, value double, n long")
        mean = parts.groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value"))
        rows = mean.toArrow()  # as many rows as the network has weights
        if len(rows):
            values = np.zeros(len(rows))
            values[rows["at"].to_numpy()] = rows["value"].to_numpy()
            network = network.with_values(values)
    return network


def score_texts(texts: pa.Array, network: Network, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and summed log-probability of each text; words not kept count as the mean of their group."""
    packed, n, share = encode_texts(texts, vocabulary)
    return n, score_units(packed, network, vocabulary.units) + share


def _encoded(docs: DataFrame, vocabulary: Vocabulary, text: str, names: dict[str, str]) -> DataFrame:
    """``docs`` with the units of each text, what places it in a shard, and the words that are not kept; stored."""
    at = [c.lower() for c in docs.columns].index(text.lower())
    hashed = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind]
    # Copies of a text differ in another column, as a rule, and are spread.
    marked = docs.withColumns({names["shard"]: F.xxhash64(*hashed), names["place"]: F.xxhash64(F.lit(1), *hashed)})
    marked = marked.withColumn(names["row"], F.monotonically_increasing_id())
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    given = marked.columns
    added = [names[k] for k in ("units", "n", "share", "others")]

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found: list = []
        units, n, share = encode_texts(batch.column(at), shared.value, None if shared.value.whole else found)
        doc, h, times = map(np.concatenate, zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
        values = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), pa.array(times)], ["word", "times"])
        others = pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32), values)
        yield pa.RecordBatch.from_arrays([*batch.columns, units, pa.array(n), pa.array(share), others], [*given, *added])

    kinds = ("binary", "long", "double", "array<struct<word:bigint,times:bigint>>")
    schema = marked.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in zip(added, kinds, strict=True)]).schema
    return stored(map_batches(marked, encode, schema), "encoded")


def score_documents(
    docs: DataFrame, text: str = "text", rounds: int = ROUNDS, every: int = EVERY, training: DataFrame | None = None
) -> DataFrame:
    """``docs`` with ``n_words``, ``log_probability`` (the sum) and ``mean_log_probability`` of each text.

    The model is fitted on ``training``, by default ``docs`` itself, and is the same however that is
    partitioned. Words are runs of ASCII letters and digits (case-insensitive) and of other non-ASCII
    characters. A text without a word has the sum 0 and a null mean; a null text is empty; repeated rows count
    as often as they come; no rows give no rows. All columns pass through; names that are taken get a number.
    """
    corpus = docs if training is None else training
    counts = stored(count_words(corpus, text), "word_counts")
    vocabulary = build_vocabulary(counts)
    results = {name: free_name(docs.columns, name) for name in ("n_words", "log_probability", "mean_log_probability")}

    def names_beside(columns: list[str]) -> dict[str, str]:
        inner = ("shard", "place", "row", "units", "n", "share", "others")
        return {name: free_name([*columns, *results.values()], name) for name in inner}

    names = names_beside(docs.columns)
    encoded = _encoded(docs, vocabulary, text, names)
    if training is None:
        learned, of = encoded, names
    else:
        of = names_beside(training.columns)
        learned = _encoded(training, vocabulary, text, of)
    learned = learned.select(F.col(of["shard"]).alias("shard"), F.col(of["place"]).alias("place"), F.col(of["units"]).alias("units"))
    network = train_network(learned, vocabulary, int(vocabulary.counts.sum()), rounds, every)
    network = network.with_values(network.flat().astype(np.float32))
    shared = docs.sparkSession.sparkContext.broadcast((network, vocabulary.units))
    n, total, mean = results.values()
    given = [*docs.columns, names["row"], names["n"], names["share"]]
    at = len(given)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sums = score_units(batch.column(at), *shared.value)
        yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(sums)], [*given, total])

    wanted = encoded.select(*given, names["units"])
    scored = map_batches(wanted, score, encoded.select(*given, F.lit(None).cast("double").alias(total)).schema)
    scored = scored.withColumn(total, F.col(total) + F.col(names["share"])).withColumnRenamed(names["n"], n)
    if not vocabulary.whole:
        words = encoded.select(F.col(names["row"]).alias("row"), F.inline(names["others"]))
        scored = _with_other_words(scored, words, counts, names["row"], total, training is not None)
    return scored.select(*docs.columns, n, total, F.when(F.col(n) > 0, F.col(total) / F.col(n)).alias(mean))


def _with_other_words(scored: DataFrame, words: DataFrame, counts: DataFrame, row: str, total: str, foreign: bool) -> DataFrame:
    """``total`` with times * log(corpus count) of the words that are not kept; a word seen once adds nothing.

    Such a word has at most one ``KEPT_WORDS``-th of the corpus; only one of ``foreign`` texts can be hot.
    """
    seen = counts.filter("n > 1")
    if foreign:
        joined = heavy_key_join(words, seen, ["word"], words.groupBy("word").agg(F.count("*").alias("n")))
    else:
        joined = words.join(seen, "word")
    sums = joined.groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("missing"))
    names = [row, *scored.columns]
    key, missing = free_name(names, "key"), free_name(names, "missing")
    both = scored.join(sums.select(F.col("row").alias(key), F.col("missing").alias(missing)), F.col(row) == F.col(key), "left")
    return both.withColumn(total, F.col(total) + F.coalesce(missing, F.lit(0.0)))
