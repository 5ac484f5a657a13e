"""Ranked lexical search as exact inner products over sparse ball trees.

A document's entry for a term is the term's weight times its damped frequency,
a whole number, so a score is the inner product of an item's term counts and the
document's entries.  Items are taken in blocks of bounded vocabulary; only terms
of the block are kept of a document.  A task fills shards of bounded size with
the documents it reads, without a shuffle, builds a ball tree over each and
searches it for every item.  No row of a node exceeds the inner product with the
centroid plus either the item's length times the radius, or the sum of the radii
along the item's own terms, whichever is less: most radius lies in terms that an
item does not have.  Subtrees whose bound is below the item's k-th score are never
looked into, the rest is taken best first, and leaves are scored in 64-bit
integers.  Bounds are real numbers, rounded up by more than they can err.
A first search over a bounded sample of documents gives every item a score that
k documents reach; all shards start from it.

Defined results: a null or empty text has no term and is never found; terms are
folded in ASCII only; repeated rows are documents each; a repeated item is asked
once per distinct text; equal scores go to the smaller id, null ids last; items
without terms find nothing; very long texts are read piece by piece; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Container, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.session import materialise

SHARD_ROWS = 8_192
SHARD_ENTRIES = 1 << 21
LEAF = 64
SEED_ROWS = 8_192
# terms that the items of a block have at most, unless one item has more
BLOCK_TERMS = 1 << 14
# entries of all centroids of a tree at most, unless one vocabulary is larger
CENTROID_ENTRIES = 1 << 22
_SLICE = 1 << 20
_PIECE = 1 << 20

# letters and digits of ASCII and all bytes beyond it are parts of terms
_FOLD = bytes(
    code + 32 if 0x41 <= code <= 0x5A else code if code >= 0x80 or chr(code).isalnum() else 0x20 for code in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length; terms are never cut."""
    begin = 0
    while begin < len(text):
        folded = text[begin : begin + _PIECE].translate(_FOLD)
        end = begin + len(folded)
        if end < len(text) and folded[-1] != 0x20:
            # up to the last separator, or, inside a giant term, to its end
            last = folded.rfind(b" ")
            if last >= 0:
                folded, end = folded[:last], begin + last + 1
            else:
                rest = text[end:].translate(_FOLD)
                stop = rest.find(b" ")
                folded, end = folded + (rest if stop < 0 else rest[:stop]), len(text) if stop < 0 else end + stop
        yield folded.split()
        begin = end


def _counted(text: bytes, vocabulary: Container[bytes]) -> tuple[int, Counter[bytes]]:
    """How many terms a text has, and how often those of the vocabulary occur."""
    n, counts = 0, Counter()
    for terms in terms_of(text):
        n += len(terms)
        counts.update(filter(vocabulary.__contains__, terms))
    return n, counts


def _texts(column: pa.Array) -> Iterator[bytes]:
    for part in slices(column, _SLICE):
        yield from part.cast(pa.large_binary()).to_pylist()


class SparseBallTree:
    """Nested halves of sparse non-negative integer rows, with sparse rows kept in the order of the leaves."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF):
        """Row ``i`` has entries ``starts[i]`` up to ``starts[i + 1]``, at least one."""
        self.starts, self.columns, self.values = starts, columns, values
        self.width, n = width, len(starts) - 1
        self.leaf = max(leaf, -(-4 * n * width // CENTROID_ENTRIES))
        self.order = np.arange(n)
        self.nodes: list[tuple[int, int, int, int]] = []
        centroids: list[np.ndarray] = []
        self.radii: list[float] = []
        self._real = values.astype(np.float64)
        self._squares = np.add.reduceat(self._real**2, starts[:-1]) if n else np.zeros(0)
        if n:
            self._build(centroids)
            picked, at = self._entries(self.order)
            self.columns, self.values, self.starts = columns[picked], values[picked], at
        # by term, so that an item reads the rows of its own terms
        self.centroids = np.array(centroids).T.copy() if centroids else np.zeros((width, 0))
        self.radius = np.array(self.radii)
        self.axis_radius = self._farthest() - self.centroids
        del self._real, self._squares

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of ``rows``, and where each row begins among them."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        at = np.concatenate([[0], np.cumsum(sizes)])
        return np.arange(at[-1]) + np.repeat(self.starts[rows] - at[:-1], sizes), at

    def _node(self, begin: int, end: int, centroids: list[np.ndarray]) -> tuple[int, np.ndarray]:
        """A new node and its rows' squared distances from its centroid, never too small."""
        rows = self.order[begin:end]
        picked, at = self._entries(rows)
        columns, values = self.columns[picked], self._real[picked]
        centre = np.bincount(columns, values, self.width) / len(rows)
        apart = self._apart(columns, values, at, rows, centre)
        centroids.append(centre)
        self.radii.append(float(np.sqrt(apart.max())))
        self.nodes.append((begin, end, -1, -1))
        return len(self.nodes) - 1, apart

    def _apart(self, columns: np.ndarray, values: np.ndarray, at: np.ndarray, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        inner = np.add.reduceat(values * point[columns], at[:-1])
        own, other = self._squares[rows], point @ point
        return np.maximum(own - 2 * inner + other, 0) + 1e-9 * (own + other)

    def _farthest(self) -> np.ndarray:
        """The largest entry of each term in each node; children come after their parents."""
        largest = np.zeros((len(self.nodes), self.width))
        for node in range(len(self.nodes) - 1, -1, -1):
            begin, end, left, right = self.nodes[node]
            if left >= 0:
                np.maximum(largest[left], largest[right], out=largest[node])
            else:
                inside = slice(self.starts[begin], self.starts[end])
                np.maximum.at(largest[node], self.columns[inside], self.values[inside].astype(np.float64))
        return largest.T

    def _build(self, centroids: list[np.ndarray]) -> None:
        """Split at the median along the line between two far rows, until leaves are small."""
        todo = [self._node(0, len(self.order), centroids)]
        while todo:
            node, apart = todo.pop()
            begin, end, *_ = self.nodes[node]
            if end - begin <= self.leaf:
                continue
            rows = self.order[begin:end]
            picked, at = self._entries(rows)
            columns, values = self.columns[picked], self._real[picked]

            def dense(i: int) -> np.ndarray:
                point = np.zeros(self.width)
                point[columns[at[i] : at[i + 1]]] = values[at[i] : at[i + 1]]
                return point

            one = dense(int(apart.argmax()))
            other = dense(int(self._apart(columns, values, at, rows, one).argmax()))
            along = np.add.reduceat(values * (other - one)[columns], at[:-1])
            half = (end - begin) // 2
            self.order[begin:end] = rows[np.argpartition(along, half)]
            left, right = self._node(begin, begin + half, centroids), self._node(begin + half, end, centroids)
            self.nodes[node] = (begin, end, left[0], right[0])
            todo += [left, right]

    def search(self, terms: np.ndarray, counts: np.ndarray, ids: list[int], k: int, floor: int) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) of at least ``floor`` and 1; equal scores by smaller id."""
        if not self.nodes or not len(terms):
            return []
        floor = max(floor, 1)
        real = counts.astype(np.float64)
        beyond = np.minimum(np.sqrt(real @ real) * self.radius, real @ self.axis_radius[terms])
        bounds = (real @ self.centroids[terms] + beyond) * (1 + 1e-9) + 1
        asked = np.zeros(self.width, np.int64)
        asked[terms] = counts
        kept: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor:
                break
            begin, end, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= floor:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            first, last = self.starts[begin], self.starts[end]
            products = asked[self.columns[first:last]] * self.values[first:last]
            scores = np.add.reduceat(products, self.starts[begin:end] - first)
            for place in np.flatnonzero(scores >= floor):
                entry = (int(scores[place]), -ids[self.order[begin + place]])
                if len(kept) < k:
                    heapq.heappush(kept, entry)
                elif entry > kept[0]:
                    heapq.heapreplace(kept, entry)
                if len(kept) == k:
                    floor = max(floor, kept[0][0])
        return [(score, -row_id) for score, row_id in sorted(kept, reverse=True)]


# stands for a null id, behind all others
_NO_ID = 1 << 63


class _Block:
    """Items with their terms as places in a sorted vocabulary."""

    def __init__(self, items: pa.Table):
        self.ids = items["item_id"].to_pylist()
        counted = [Counter(t for part in terms_of(text.encode()) for t in part) for text in items["text"].to_pylist()]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
        self.items = [
            (np.array([self.vocabulary[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for c in counted
        ]


def _vectors(docs: DataFrame, doc_id: str, text: str, vocabulary) -> DataFrame:
    """Documents with a term: id, number of terms, and the block's terms with their frequencies; written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            totals, terms, often, ends = [], [], [], [0]
            for one in _texts(batch.column(1)):
                n, counts = _counted(one, known)
                totals.append(n)
                terms += [known[t] for t in counts]
                often += counts.values()
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, t)) for v, t in ((terms, pa.int32()), (often, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), *lists], ["doc_id", "n", "terms", "often"])

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = read.mapInArrow(count, "doc_id long, n long, terms array<int>, often array<long>")
    return materialise(counted.where("n > 0"), "lexical-vectors")


def _weights(vectors: DataFrame, n_documents: int, width: int) -> np.ndarray:
    """The whole-number weight of each of the block's terms, from its document frequency."""
    found = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    frequency = np.zeros(width, np.int64)
    frequency[found["term"].to_numpy()] = found["count"].to_numpy()
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def _shards(batches: Iterator[pa.RecordBatch], shard_rows: int) -> Iterator[pa.Table]:
    """Rows in tables of bounded size; a batch is cut where it fills one."""
    held, rows, entries = [], 0, 0
    for batch in batches:
        sizes = np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))
        begin = 0
        while begin < len(batch):
            before = int(sizes[begin - 1]) if begin else 0
            room = int(np.searchsorted(sizes, before + SHARD_ENTRIES - entries, "right"))
            end = min(max(room, begin + (not held)), begin + shard_rows - rows, len(batch))
            held.append(batch.slice(begin, end - begin))
            rows, entries = rows + end - begin, entries + int(sizes[end - 1]) - before if end > begin else entries
            if end < len(batch) or rows >= shard_rows:
                yield pa.Table.from_batches(held)
                held, rows, entries = [], 0, 0
            begin = end
    if held:
        yield pa.Table.from_batches(held)


def _searched(vectors: DataFrame, block, weights: np.ndarray, totals: tuple[int, int], floors: np.ndarray, k: int, shard_rows: int) -> DataFrame:
    """Each task's best documents per item: item (its place in the block), doc_id, score."""
    n_documents, all_terms = totals

    def entries(shard: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows that hold an entry, and the entries: weight times damped frequency."""
        lists = shard["terms"].combine_chunks()
        columns = lists.flatten().to_numpy()
        often = shard["often"].combine_chunks().flatten().to_numpy()
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        n = np.repeat(shard["n"].to_numpy(), sizes)
        length = 75 + 25 * n * n_documents // all_terms
        values = weights[columns] * (1_000_000_000 * often // (1000 * often + 12 * length))
        full = np.flatnonzero(sizes)
        return full, np.concatenate([[0], np.cumsum(sizes[full])]), columns, values

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = block.value
        for shard in _shards(batches, shard_rows):
            full, starts, columns, values = entries(shard)
            tree = SparseBallTree(starts, columns, values, len(weights))
            ids = [_NO_ID if i is None else i for i in shard["doc_id"].take(pa.array(full)).to_pylist()]
            found: list[tuple[int, int | None, int]] = []
            for item, (terms, counts) in enumerate(asked):
                best = tree.search(terms, counts, ids, k, int(floors[item]))
                found += [(item, None if i == _NO_ID else i, score) for score, i in best]
            listed = list(zip(*found, strict=True)) or [[]] * 3
            arrays = [pa.array(c, t) for c, t in zip(listed, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return vectors.mapInArrow(search, "item int, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _of_block(docs: DataFrame, items: pa.Table, k: int, doc_id: str, text: str, shard_rows: int) -> DataFrame:
    spark = docs.sparkSession
    block = _Block(items)
    vectors = _vectors(docs, doc_id, text, spark.sparkContext.broadcast(block.vocabulary))
    totals = tuple(int(x or 0) for x in vectors.agg(F.count("*"), F.sum("n")).first())
    asked = spark.sparkContext.broadcast(block.items)
    weights = _weights(vectors, totals[0], len(block.vocabulary))

    def search(rows: DataFrame, floors: np.ndarray) -> DataFrame:
        return _best(_searched(rows, asked, weights, totals, floors, k, shard_rows), k)

    floors = np.zeros(len(block.items), np.int64)
    if totals[0] > SEED_ROWS:
        # by the row's place in the written table: no row is favoured, and copies are spread
        share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)) < int((1 << 30) * SEED_ROWS / totals[0])
        reached = search(vectors.where(share).repartition(1), floors).where(F.col("rank") == k).select("item", "score").toArrow()
        floors[reached["item"].to_numpy()] = reached["score"].to_numpy()
    best = search(vectors, floors)
    names = spark.createDataFrame(pa.table({"_item": pa.array(range(len(block.ids)), pa.int32()), "item_id": pa.array(block.ids, pa.int64())}))
    named = best.join(F.broadcast(names), F.col("item") == F.col("_item"))
    return named.select("item_id", "rank", "doc_id", "score")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_rows: int = SHARD_ROWS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its ``k`` best documents with a score above 0: item_id, rank (from 1), doc_id, score.

    Documents are read once per block of items.  The driver holds one block: its
    items, its vocabulary with document frequencies, and one score per item.
    """
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct()
    # a term and its separator take two bytes or more
    n_terms = asked.agg(F.sum(F.ceil(F.octet_length("text") / 6))).first()[0] or 0
    blocks = max(1, -(-int(n_terms) // block_terms))
    in_block: Column = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    asked = materialise(asked.withColumn("_block", in_block), "lexical-items") if blocks > 1 else asked.withColumn("_block", in_block)
    parts = []
    for number in range(blocks):
        found = _of_block(docs, asked.where(F.col("_block") == number).drop("_block").toArrow(), k, doc_id, text, shard_rows)
        parts.append(materialise(found, "lexical-found") if blocks > 1 else found)
    return reduce(DataFrame.unionByName, parts)
