"""Ranked lexical search of many items over all documents, by document FP-trees (operator 12).

Documents are reduced to the terms that any item asks for. A task sorts the terms of each document from the
most frequent to the rarest, so that documents with the same leading terms share a path of a trie, down to
subtrees of a few documents (leaves). A node holds, over the documents below it, the largest tf of each term
and the smallest length norm m. As the score of a term grows with tf and falls with m, they give an upper
bound for all documents below. Each item goes through the trie depth first, best bound first, and leaves out
what cannot reach its best documents so far; what is left is scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.common import _IS_WORD, _LOWER, _POWERS, map_batches, mix, stored, text_blocks, text_bytes

TOP = 50
#: Documents of a leaf, and entries (document, term) of one trie.
LEAF, TREE_ENTRIES = 256, 1 << 21
#: Distinct terms of the items that go through a trie together: their maxima are a dense table.
GROUP_TERMS = 4096
#: Bytes of items sent to the tasks at a time.
ITEM_BYTES = 4 << 20
#: Ways the best documents of an item are merged before they meet.
SPREAD = 64
_NO_ID = np.iinfo(np.int64).max


class Spans(NamedTuple):
    """Terms of several texts, in order: first byte, length in bytes, text, hash."""

    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def term_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Runs of ASCII letters (capitals as small ones), digits and all characters beyond ASCII."""
    word = _IS_WORD[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] |= word[inner]
    at = np.flatnonzero(word)
    first = np.flatnonzero(begins[at])
    if not len(first):
        nothing = np.zeros(0, np.int64)
        return Spans(nothing, nothing, nothing, nothing.astype(np.uint64))
    length = np.diff(np.append(first, len(at)))
    within = np.arange(len(at)) - np.repeat(first, length)
    values = (_LOWER[data[at]].astype(np.uint64) + np.uint64(1)) * _POWERS[within & 1023]
    start = at[first]
    return Spans(start, length, np.searchsorted(offsets, start, "right") - 1, mix(np.add.reduceat(values, first)))


class Terms:
    """The terms of the items: found by hash, and compared byte by byte."""

    def __init__(self, terms: Sequence[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        offsets = np.append(0, np.cumsum([len(t) for t in terms], dtype=np.int64))
        hashes = term_spans(data, offsets).hash
        order = np.argsort(hashes, kind="stable")
        self._hash, self._term = hashes[order], order
        self._repeats = int(np.unique(hashes, return_counts=True)[1].max(initial=0))
        self._data, self._start, self._length = data, offsets[:-1], np.diff(offsets)

    def __len__(self) -> int:
        return len(self._term)

    def find(self, data: np.ndarray, spans: Spans) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the spans that are terms of the items, and the term of each."""
        found, terms = [], []
        place = np.searchsorted(self._hash, spans.hash)
        for k in range(self._repeats):  # once, but for different terms of one hash
            at = np.flatnonzero(place + k < len(self))
            at = at[self._hash[place[at] + k] == spans.hash[at]]
            term = self._term[place[at] + k]
            same = spans.length[at] == self._length[term]
            at, term = at[same], term[same]
            right = np.zeros(len(at), bool)
            for length in np.unique(self._length[term]).tolist():
                some, step = np.flatnonzero(self._length[term] == length), max(1, (1 << 20) // length)
                for part in (some[first : first + step] for first in range(0, len(some), step)):
                    letters = np.arange(length)
                    here = _LOWER[data[spans.start[at[part]][:, None] + letters]]
                    right[part] = (here == self._data[self._start[term[part]][:, None] + letters]).all(axis=1)
            found.append(at[right])
            terms.append(term[right])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(terms)


class Item(NamedTuple):
    """An item's row, its terms and their weights."""

    row: int
    terms: np.ndarray
    weights: np.ndarray


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return np.where(tf > 0, (1_000_000_000 * tf) // np.maximum(1000 * tf + 20 * m, 1), 0)


class Best:
    """The best documents of an item so far: score falling, then id rising."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def open_to(self, bound: int, least_id: int) -> bool:
        """Whether a document of that score and id would be among them."""
        if bound <= 0:
            return False
        if len(self.ids) < self.top:
            return True
        return bound > self.scores[-1] or bound == self.scores[-1] and least_id < self.ids[-1]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = self.scores[-1] if len(self.ids) == self.top else 1
        good = scores >= least
        scores, ids = np.append(self.scores, scores[good]), np.append(self.ids, ids[good])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


class Tree:
    """FP-tree of documents: ``terms`` are frequency ranks (0 is the most frequent), rising in each document."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tf: np.ndarray, leaf: int = LEAF):
        lengths = np.diff(np.append(0, ends))
        keys, packed = [], terms.astype(">u4").tobytes()
        for first, last in zip((4 * (ends - lengths)).tolist(), (4 * ends).tolist(), strict=True):
            keys.append(packed[first:last])
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
        self.ids, self.m, lengths = ids[order], m[order], lengths[order]
        starts = (ends - np.diff(np.append(0, ends)))[order]
        entry = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        self._doc, self._term, self._tf = np.repeat(np.arange(len(order)), lengths), terms[entry], tf[entry]
        self._first = np.cumsum(lengths) - lengths
        self._lengths = lengths
        self._grow(leaf)

    def _grow(self, leaf: int) -> None:
        """Nodes as ranges of the sorted documents: the root is 0, a node comes before its children."""
        self.begin, self.end, self.children = [0], [len(self.ids)], [[]]
        level = [0] if len(self.ids) > leaf else []
        depth = 0
        while level:
            deeper = []
            for node in level:
                a, b = self.begin[node], self.end[node]
                longer = self._lengths[a:b] > depth
                term = np.full(b - a, -1, np.int64)  # documents that end here come first
                term[longer] = self._term[self._first[a:b][longer] + depth]
                cuts = np.append(np.flatnonzero(np.diff(term, prepend=-2)), b - a) + a
                low = cuts[0]
                for left, right in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    large = right - left > leaf
                    if low < left and (large or right - low > leaf):  # light siblings share a leaf
                        self._add(node, int(low), left)
                        low = left
                    if large:
                        child = self._add(node, left, right)
                        if term[left - a] >= 0:
                            deeper.append(child)
                        low = right
                if low < b:
                    self._add(node, int(low), b)
            level, depth = deeper, depth + 1
        self.leaves = sorted((node for node, below in enumerate(self.children) if not below), key=self.begin.__getitem__)
        cuts = np.array([self.begin[node] for node in self.leaves])
        self._leaf_m = np.minimum.reduceat(self.m, cuts)
        self._leaf_id = np.minimum.reduceat(self.ids, cuts)
        place = {self.begin[node]: n for n, node in enumerate(self.leaves)} | {len(self.ids): len(self.leaves)}
        # The leaves below a node, and its smallest m and id.
        self.span = [(place[a], place[b]) for a, b in zip(self.begin, self.end, strict=True)]
        self.least_m = np.array([self._leaf_m[a:b].min() for a, b in self.span])
        self.least_id = [int(self._leaf_id[a:b].min()) for a, b in self.span]
        self._leaf_of = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(self.ids))))

    def _add(self, parent: int, begin: int, end: int) -> int:
        self.begin.append(begin)
        self.end.append(end)
        self.children.append([])
        self.children[parent].append(len(self.begin) - 1)
        return len(self.begin) - 1

    def search(self, items: Sequence[Item], best: dict[int, Best]) -> None:
        """Improve ``best`` (by row) for a group of items."""
        if not len(self.ids):
            return
        asked = np.unique(np.concatenate([item.terms for item in items]))
        column = np.full(max(int(asked[-1]), int(self._term.max(initial=0))) + 1, -1, np.int64)
        column[asked] = np.arange(len(asked))
        mine = np.flatnonzero(column[self._term] >= 0)
        doc, term, tf = self._doc[mine], column[self._term[mine]], self._tf[mine]
        key = self._leaf_of[doc] * len(asked) + term
        order = np.argsort(key, kind="stable")
        key, doc, tf = key[order], doc[order], tf[order]
        gains = _gain(tf, self.m[doc])
        # Largest tf of each term below each leaf, and below each node.
        highest = np.zeros(len(self.leaves) * len(asked), np.int64)
        if len(key):
            cuts = np.flatnonzero(np.diff(key, prepend=-1))
            highest[key[cuts]] = np.maximum.reduceat(tf, cuts)
        highest = highest.reshape(len(self.leaves), -1)
        maxima = np.stack([highest[a:b].max(axis=0) for a, b in self.span])
        for item in items:
            at = column[item.terms]
            bounds = (_gain(maxima[:, at], self.least_m[:, None]) @ item.weights).tolist()
            self._descend(item, at, bounds, best[item.row], key, doc, gains, len(asked))

    def _descend(self, item, at, bounds, best, key, doc, gains, width) -> None:
        stack = [0]
        while stack:
            node = stack.pop()
            if not best.open_to(bounds[node], self.least_id[node]):
                continue
            below = self.children[node]
            if below:
                stack.extend(sorted(below, key=bounds.__getitem__))  # the best bound comes off first
                continue
            wanted = self.span[node][0] * width + at
            first, last = np.searchsorted(key, wanted), np.searchsorted(key, wanted, "right")
            n = last - first
            entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            a, b = self.begin[node], self.end[node]
            # Sums of integers below 2^53: exact.
            scores = np.bincount(doc[entry] - a, np.repeat(item.weights, n) * gains[entry], b - a).astype(np.int64)
            best.add(scores, self.ids[a:b])


def restricted_vectors(docs: DataFrame, terms: Terms, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: n counts all its terms, the lists those asked for."""

    def vectors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for first, last, data, offsets in text_blocks(batch.column(1)):
            spans = term_spans(data, offsets)
            n = np.bincount(spans.doc, minlength=last - first)
            at, term = terms.find(data, spans)
            pair, tf = np.unique(spans.doc[at] * max(1, len(terms)) + term, return_counts=True)
            doc = pair // max(1, len(terms))
            ends = np.append(0, np.cumsum(np.bincount(doc, minlength=last - first))).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32)))
                for v in (pair - doc * max(1, len(terms)), tf)
            ]
            rows = pa.RecordBatch.from_arrays([ids.slice(first, last - first), pa.array(n), *lists], ["id", "n", "terms", "tfs"])
            yield rows.filter(pa.array(n > 0))

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return map_batches(rows, vectors, "id long, n long, terms array<int>, tfs array<int>")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    leaf: int = LEAF,
    tree_entries: int = TREE_ENTRIES,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``item_column, rank, id_column, score``: the ``top`` documents of each item with a score above 0.

    Terms are runs of ASCII letters and digits (A-Z lowered) and characters beyond ASCII, over whole texts.
    With N documents that have a term, L terms in all of them, n in a document, df the documents that hold a
    term: its weight is floor(1000 ln((2 N + 2) / (2 df + 1))), a document's m is 50 + (50 n N) div L, its
    score the sum of weight * ((10^9 tf) div (1000 tf + 20 m)) over the different terms of the item. Equal
    scores go by id.

    Null and empty texts have no terms: such documents count for nothing, such items have no rows, nor have
    items whose terms are in no document. Each row of items is ranked by itself, also if it shares its id or
    text with others or the id is null; document rows that share an id are ranked each, those with a null id
    come last among equals. Further columns are ignored; no documents or no items give no rows.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_column).cast("long").alias("item"), F.coalesce(item_text, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    slices = max(1, -(-size // item_bytes))
    result, totals = None, None
    for number in range(slices):  # each slice of items is sent to the tasks alone
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == number).collect()
        rows = sorted(((r.item, r.text) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        found = _item_terms([text for _, text in rows])
        terms = sorted({term for row in found for term in row})
        vectors = stored(restricted_vectors(docs, Terms(terms), id_column, text), "vectors")
        if totals is None:
            totals = vectors.agg(F.count("*"), F.sum("n")).first()
        if not totals[0] or not terms:
            continue
        best = stored(_best(vectors, found, terms, totals[0], totals[1], top, leaf, tree_entries), f"best_{number}")
        ids = pa.table({"row": pa.array(range(len(rows)), pa.int32()), "item": pa.array([r[0] for r in rows], pa.int64())})
        named = best.join(F.broadcast(spark.createDataFrame(ids)), "row").select("item", "rank", "id", "score")
        result = named if result is None else result.unionByName(named)
    if result is None:
        result = spark.createDataFrame([], "item long, rank int, id long, score long")
    id_ = F.when(F.col("id") != _NO_ID, F.col("id"))
    return result.select(F.col("item").alias(item_column), "rank", id_.alias(id_column), "score")


def _item_terms(texts: list[str]) -> list[set[bytes]]:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    spans, lowered = term_spans(data, offsets), _LOWER[data].tobytes()
    found: list[set[bytes]] = [set() for _ in texts]
    for start, length, doc in zip(spans.start.tolist(), spans.length.tolist(), spans.doc.tolist(), strict=True):
        found[doc].add(lowered[start : start + length])
    return found


def _best(
    vectors: DataFrame, found: list[set[bytes]], terms: list[bytes], n_docs: int, n_terms: int, top: int, leaf: int, tree_entries: int
) -> DataFrame:
    """``row, rank, id, score`` of one slice of items."""
    df = np.zeros(len(terms), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # terms of the items
        df[term] = n
    rank = np.empty(len(terms), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    weights, index = term_weights(n_docs, df), {term: n for n, term in enumerate(terms)}
    groups, asked = [[]], set()
    for row, of_row in enumerate(found):
        own = np.array(sorted(index[term] for term in of_row), np.int64)
        own = own[(weights[own] > 0) & (df[own] > 0)]
        if not len(own):
            continue
        if groups[-1] and len(asked | set(own.tolist())) > GROUP_TERMS:
            groups.append([])
            asked = set()
        asked.update(own.tolist())
        groups[-1].append(Item(row, rank[own], weights[own]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item.row: Best(top) for group in groups for item in group}
        for tree in _trees(batches, rank, n_docs, n_terms, leaf, tree_entries):
            for group in groups:
                if group:
                    tree.search(group, best)
        for row, b in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(b.ids), pa.int32()), pa.array(b.ids), pa.array(b.scores)], ["row", "id", "score"]
            )

    each = vectors.filter(F.size("terms") > 0).mapInArrow(run, "row int, id long, score long")
    each = each.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    order = [F.desc("score"), "id"]
    for keys in (["row", "part"], ["row"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        each = each.withColumn("rank", place).filter(F.col("rank") <= top)
    return each.select("row", "rank", "id", "score")


def _trees(
    batches: Iterator[pa.RecordBatch], rank: np.ndarray, n_docs: int, n_terms: int, leaf: int, tree_entries: int
) -> Iterator[Tree]:
    """Tries over runs of a task's documents."""
    parts, entries = [], 0
    for batch in batches:
        for first in range(0, batch.num_rows, 1024):
            part = batch.slice(first, 1024)
            parts.append(part)
            entries += len(part.column(2).flatten())
            if entries >= tree_entries:
                yield _tree(parts, rank, n_docs, n_terms, leaf)
                parts, entries = [], 0
    if parts:
        yield _tree(parts, rank, n_docs, n_terms, leaf)


def _tree(parts: list[pa.RecordBatch], rank: np.ndarray, n_docs: int, n_terms: int, leaf: int) -> Tree:
    table = pa.Table.from_batches(parts).combine_chunks()
    ids = table["id"].fill_null(_NO_ID).to_numpy()
    n = table["n"].to_numpy()
    terms = table["terms"].combine_chunks()
    lengths = terms.value_lengths().to_numpy()
    term, tf = rank[terms.flatten().to_numpy()], table["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(ids)), lengths)
    order = np.lexsort((term, doc))
    return Tree(ids, 50 + (50 * n * n_docs) // n_terms, np.cumsum(lengths), term[order], tf[order], leaf)
