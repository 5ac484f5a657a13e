"""MinHash near-duplicates with tensored banding, verified on full shingle sets.

Two small collections of half keys are made of a few minhashes each.  A table's
key is a pair of half keys, one from either collection, so ``halves`` squared
tables cost only ``2 * halves * rows`` minhash functions, about the root of
what independent tables would cost.

Equal sets are one class, known by a digest; only classes go on.  Bucket
members are compared first with the most connected member they meet, then,
outside a bucket's main component, with its 16 most connected, and at last with
all others.  Exact bounds leave out pairs that cannot be linked: a link needs
enough shingles that other nodes have too, and, in large buckets, enough
frequent ones or a rare one in common.  So a large group of near copies is
settled by few comparisons and no bucket is expanded into all its pairs, but
every pair of a bucket is either compared or ruled out.  Pairs are confirmed on
the texts' own shingles.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text with fewer words than a shingle is one
shingle; rows with one id and different texts count as one document; rows with
a null id are linked with nothing and kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_SPACE_CLASS, mixed, slices, utf8, word_bounds, word_hashes
from tidemark.session import materialise

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
ROWS = 3
LEAST_RECALL = 0.999
# partners that every bucket's members are compared with before shingle frequencies narrow the rest
CENTRAL = 16
# shingles of at most so many nodes are looked at one by one
RARE = 8
SEED = 10
_SLICE = 1 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_TO_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}
_WORD = re.compile(NOT_SPACE_CLASS + "+")


def halves_for(percent: int, rows: int, recall: float = LEAST_RECALL) -> int:
    """The least number of half keys per collection that find a pair at the threshold with ``recall``."""
    meet, halves = (percent / 100) ** rows, 1
    while (1 - (1 - meet) ** halves) ** 2 < recall:
        halves += 1
    return halves


@cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    return random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, n, np.uint64)


def shingle_set(text: str, n: int) -> frozenset[str]:
    """The full shingle set of a text, as strings."""
    words = _WORD.findall(text.translate(_TO_LOWER))
    if len(words) < n:
        return frozenset([" ".join(words)]) if words else frozenset()
    return frozenset(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))


def _shingle_hashes(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of all texts, and each text's first, with the count as last entry."""
    body, offsets = utf8(texts)
    starts, ends, first_word = word_bounds(_SPACES[body], offsets)
    words = word_hashes(_LOWER[body], starts, ends) if len(starts) else np.zeros(0, np.uint64)
    n_words = np.diff(first_word)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    position = np.arange(len(words))
    last = np.repeat(first_word[1:], n_words)
    rolled = np.zeros(len(words), np.uint64)
    for k in range(n):
        inside = position + k < last
        rolled = mixed(rolled * np.uint64(3) + np.where(inside, padded[k : k + len(words)], np.uint64(k)))
    short = np.repeat(n_words < n, n_words)
    begins = np.zeros(len(words), bool)
    begins[first_word[:-1][n_words > 0]] = True
    kept = (position + n <= last) | (short & begins)
    counts = np.where(n_words >= n, n_words - n + 1, np.minimum(n_words, 1))
    return rolled[kept], np.concatenate([[0], np.cumsum(counts)])


def signatures(texts: pa.Array, n: int, rows: int, halves: int) -> pa.Array:
    """Per text: set size, digest of the set, and its half keys of both collections."""
    scale, shift = _functions(2 * halves * rows)
    sizes, digests, keys = [], [], []
    for part in slices(texts, _SLICE):
        hashes, first = _shingle_hashes(part, n)
        minima = np.zeros((2 * halves * rows, len(part)), np.uint64)
        full = np.flatnonzero(np.diff(first))
        if len(full):
            for k in range(len(scale)):
                value = (hashes * scale[k] + shift[k]).view(np.uint32)[1::2]
                minima[k, full] = np.minimum.reduceat(value, first[:-1][full])
        half_keys = np.zeros((2 * halves, len(part)), np.uint64)
        for k in range(rows):
            half_keys = mixed(half_keys + minima[k::rows])
        keys.append(half_keys.T.view(np.int64))
        for i in range(len(part)):
            own = np.unique(hashes[first[i] : first[i + 1]])
            sizes.append(len(own))
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
    flat = np.ascontiguousarray(np.concatenate(keys)).ravel() if keys else np.zeros(0, np.int64)
    ends = np.arange(0, len(flat) + 1, 2 * halves)
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), listed], ["n", "digest", "keys"])


def _described(docs: DataFrame, doc_id: str, text: str, n: int, rows: int, halves: int) -> DataFrame:
    """Per row its id, set size, digest and half keys: narrow, written once."""

    @F.arrow_udf("struct<n:bigint,digest:binary,keys:array<bigint>>")
    def describe(texts: pa.Array) -> pa.Array:
        return signatures(texts, n, rows, halves)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), describe(F.col(text)).alias("set"))
    return materialise(narrow.select("doc_id", "set.*"), "near-described")


def _shared_buckets(classes: DataFrame, halves: int) -> DataFrame:
    """Rows (bucket, table, node, n) of buckets with several classes.

    Buckets are counted before rows meet, so a hot one is combined in every
    task, and the join of two written tables can be split.
    """
    tables = F.sequence(F.lit(0), F.lit(halves - 1))
    pairs = F.flatten(
        F.transform(tables, lambda i: F.transform(tables, lambda j: F.xxhash64(i, j, F.get("keys", i), F.get("keys", j + halves))))
    )
    keyed = classes.select("node", "n", F.posexplode(pairs).alias("table", "bucket"))
    return materialise(_several(keyed, "near-counts"), "near-shared")


def _several(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` of buckets with several of them, with ``members``."""
    counts = rows.groupBy(F.col("bucket").alias("_bucket")).agg(F.count("*").alias("members")).where("members > 1")
    return rows.join(materialise(counts, label), F.col("bucket") == F.col("_bucket")).drop("_bucket")


def _shingle_rows(texts: DataFrame, n: int) -> DataFrame:
    """(node, shingle) of every distinct shingle, as 64-bit hashes."""

    @F.arrow_udf("array<bigint>")
    def hashes(column: pa.Array) -> pa.Array:
        rows = []
        for part in slices(column, _SLICE):
            found, first = _shingle_hashes(part, n)
            rows += [np.unique(found[first[i] : first[i + 1]]).view(np.int64) for i in range(len(part))]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))

    return texts.select("node", F.explode(hashes("text")).alias("shingle"))


def _compared(shared: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of ``shared`` that may have a link, with ``members``, ``weight``, ``common`` and ``keys``.

    ``common`` counts the shingles that another node of the shared buckets has
    too.  A link needs 85 of 100 shingles to be such (or what ``percent``
    says), so texts with too many shingles of their own are out, exactly.
    Nodes of several classes or texts are kept: their shingles are not one set's.
    ``weight``, a node's neighbours in all its buckets, tells a group's centre.
    """
    several = [rows.groupBy(F.col("node").alias("_node")).count().where("count > 1").select("_node") for rows in (classes, texts)]
    ambiguous = materialise(several[0].unionByName(several[1]).distinct(), "near-ambiguous")
    once = _shingle_rows(texts, n).groupBy("shingle").agg(F.count("*").alias("nodes"), F.min("node").alias("node")).where("nodes = 1")
    own = once.groupBy("node").agg(F.count("*").alias("own")).join(ambiguous, F.col("node") == F.col("_node"), "left_anti")
    own = materialise(own.select(F.col("node").alias("_node"), "own"), "near-own")
    counted = shared.drop("members").join(own, F.col("node") == F.col("_node"), "left").withColumn(
        "common", F.col("n") - F.coalesce("own", F.lit(0))
    )
    possible = materialise(counted.where(100 * F.col("common") >= percent * F.col("n")).drop("_node", "own"), "near-possible")
    rows = materialise(_several(possible, "near-counts"), "near-several")
    weights = rows.groupBy(F.col("node").alias("_node")).agg(F.sum("members").alias("weight"))
    about = weights.join(
        classes.select(F.col("node").alias("_class"), "keys").join(ambiguous, F.col("_class") == F.col("_node"), "left_anti"),
        F.col("_node") == F.col("_class"),
        "left",
    ).drop("_class")
    return materialise(rows.join(materialise(about, "near-weights"), F.col("node") == F.col("_node")).drop("_node"), "near-buckets")


def _enough(percent: int, ours: str = "common", theirs: str = "their_common", extra: Column | None = None) -> Column:
    """Whether the shingles that two sets can have in common suffice: ``both / (n + n' - both)`` reaches the threshold."""
    both = F.least(ours, theirs) + (extra if extra is not None else F.lit(0))
    return (100 + percent) * both >= percent * (F.col("n") + F.col("their_n"))


def _first_met(halves: int) -> Column:
    """Whether a bucket's table is the first in which its two members meet, so that a pair comes up once.

    A table is a pair of half keys: its first meeting has the first equal half key of either collection.
    """

    def is_first(begin: int, place: Column) -> Column:
        same = F.zip_with(F.slice("keys", begin, halves), F.slice("their_keys", begin, halves), lambda a, b: a == b)
        return F.array_position(same, True) == place + 1

    i, j = F.floor(F.col("table") / halves), F.col("table") % halves
    return F.col("keys").isNull() | F.col("their_keys").isNull() | (is_first(1, i) & is_first(halves + 1, j))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _first_pairs(buckets: DataFrame, percent: int) -> DataFrame:
    """Each node with the most connected node it shares a bucket with."""
    hubs = buckets.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.max(F.struct("weight", F.col("node").alias("hub"), F.col("n").alias("their_n"), F.col("common").alias("their_common"))).alias("best")
    )
    hubs = materialise(hubs.select("_bucket", "best.*").withColumnRenamed("weight", "hub_weight"), "near-hubs")
    met = buckets.join(hubs, (F.col("bucket") == F.col("_bucket")) & (F.col("node") != F.col("hub")) & _enough(percent))
    best = met.groupBy("node").agg(F.max(F.struct("hub_weight", "hub"))["hub"].alias("hub"))
    return best.select(*_ordered("node", "hub")).distinct()


def _open(buckets: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """Rows of buckets with more than ``least`` members that lie in several components.

    ``component`` is the row's, ``main`` that of the bucket's most connected
    member: of two members not linked yet, one at least is outside ``main``.
    """
    rows = buckets.where(F.col("members") > least)
    known = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    placed = rows.join(known, F.col("node") == F.col("_node"), "left").withColumn("component", F.coalesce("_component", "node"))
    placed = materialise(placed.drop("_node", "_component"), "near-placed")
    several = placed.groupBy(F.col("bucket").alias("_bucket")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.struct("weight", "component"))["component"].alias("main")
    )
    several = materialise(several.where("low <> high").select("_bucket", "main"), "near-open-buckets")
    return materialise(placed.join(several, F.col("bucket") == F.col("_bucket")).drop("_bucket"), "near-open")


def _met(rows: DataFrame, partners: DataFrame, percent: int, halves: int) -> DataFrame:
    """Pairs of members outside the main component with ``partners`` of another component, where a link is possible."""
    others = materialise(
        partners.select(
            F.col("bucket").alias("_bucket"),
            F.col("node").alias("partner"),
            *[F.col(c).alias(f"their_{c}") for c in ("n", "common", "component", "keys")],
        ),
        "near-partners",
    )
    both = (F.col("bucket") == F.col("_bucket")) & (F.col("component") != F.col("their_component")) & _enough(percent)
    met = rows.where("component <> main").join(others, both & _first_met(halves))
    return met.select(*_ordered("node", "partner")).distinct()


def _central_pairs(rows: DataFrame, percent: int, halves: int) -> DataFrame:
    """Pairs with the most connected members of every bucket; the rank's limit applies before a bucket's rows meet."""
    rank = F.row_number().over(W.partitionBy("bucket").orderBy(F.col("weight").desc(), "node"))
    return _met(rows, rows.withColumn("rank", rank).where(F.col("rank") <= CENTRAL), percent, halves)


def _other_pairs(rows: DataFrame, texts: DataFrame, n: int, percent: int, halves: int) -> DataFrame:
    """All further pairs of a bucket that can be linked.

    Two sets that have no rare shingle in common have only frequent ones in
    common, so counting the frequent ones of each bounds what they share.
    Pairs with a rare shingle in common are found by it; there are few.
    """
    nodes = rows.select(F.col("node").alias("_node")).distinct()
    found = materialise(_shingle_rows(texts.join(nodes, F.col("node") == F.col("_node"), "left_semi"), n), "near-shingles")
    counts = found.groupBy(F.col("shingle").alias("_shingle")).agg(F.count("*").alias("nodes")).where(F.col("nodes") <= RARE)
    rare = materialise(
        found.join(materialise(counts, "near-rare"), F.col("shingle") == F.col("_shingle")).drop("_shingle"), "near-rare-rows"
    )
    about = rows.groupBy("node").agg(
        *[F.max(c).alias(c) for c in ("n", "component", "common")], F.max(F.col("component") != F.col("main")).alias("asks")
    )
    single = found.groupBy("node").agg(F.count("*").alias("all"))
    few = rare.groupBy(F.col("node").alias("_node")).agg(F.count("*").alias("few"))
    frequent = single.join(few, F.col("node") == F.col("_node"), "left").select(
        F.col("node").alias("_node"), (F.col("all") - F.coalesce("few", F.lit(0))).alias("frequent")
    )
    about = materialise(
        about.join(frequent, F.col("node") == F.col("_node")).drop("_node").withColumn("common", F.least("common", "frequent")).drop("frequent"),
        "near-about",
    )
    known = about.select(F.col("node").alias("_node"), F.col("common").alias("_common"))
    by_bucket = rows.join(known, F.col("node") == F.col("_node")).withColumn("common", F.col("_common")).drop("_node", "_common")
    by_bucket = materialise(by_bucket.where(100 * F.col("common") >= percent * F.col("n")), "near-frequent")
    left = rare.where("nodes > 1").join(about.where("asks"), "node").select("node", "shingle", "n", "component", "common")
    right = rare.where("nodes > 1").join(about, "node").select(
        F.col("node").alias("partner"), F.col("shingle").alias("_shingle"), *[F.col(c).alias(f"their_{c}") for c in ("n", "component", "common")]
    )
    meeting = left.join(right, (F.col("shingle") == F.col("_shingle")) & (F.col("component") != F.col("their_component")))
    tallied = meeting.groupBy("node", "partner", "n", "their_n", "common", "their_common").agg(F.count("*").alias("rare"))
    by_rare = tallied.where(_enough(percent, extra=F.col("rare"))).select(*_ordered("node", "partner"))
    return _met(by_bucket, by_bucket, percent, halves).unionByName(by_rare).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_set = None, frozenset()
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                own = right.as_py()
                if own != last_text:
                    last_text, last_set = own, shingle_set(own, n)
                other = shingle_set(left.as_py(), n)
                both = len(last_set & other)
                linked.append(both > 0 and 100 * both >= percent * (len(last_set) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("node").alias("_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("_b"), F.col("text").alias("text_b"))
    with_texts = (
        pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b")).select("a", "b", "text_a", "text_b")
    )
    return with_texts.mapInArrow(verify, "a long, b long").distinct()


def components(links: DataFrame, label: str = "near-labels") -> DataFrame:
    """The smallest reachable node of every node in ``links`` (a, b), as (node, component).

    Every round takes the least label among a node and its neighbours, then the
    label of that label; each is written, so a lost executor costs one round.
    """
    both = materialise(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-edges"
    )
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), label
    )
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        offered = both.join(near, "b").groupBy(F.col("a").alias("_node")).agg(F.min("near").alias("offer"))
        met = labels.join(offered, F.col("node") == F.col("_node")).select(
            "node", "component", F.least("component", "offer").alias("next")
        )
        jump = labels.select(F.col("node").alias("_next"), F.col("component").alias("far"))
        jumped = met.join(jump, F.col("next") == F.col("_next"), "left").select(
            "node", F.coalesce("far", "next").alias("component"), (F.coalesce("far", "next") != F.col("component")).alias("changed")
        )
        following = materialise(jumped, label)
        labels = following.select("node", "component")
        if following.where("changed").isEmpty():
            return labels


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after ``links`` are added to those in ``labels``."""
    if labels is None:
        return components(links)
    known = labels.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    lifted = links
    for side in ("a", "b"):
        lifted = lifted.join(known, F.col(side) == F.col("_n"), "left").withColumn(side, F.coalesce("_c", side)).drop("_n", "_c")
    upper = components(lifted.where("a <> b")).withColumnsRenamed({"node": "_n", "component": "_c"})
    moved = labels.join(upper, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    # nodes that had no component so far
    added = upper.join(labels, F.col("_n") == F.col("node"), "left_anti").select(F.col("_n").alias("node"), F.col("_c").alias("component"))
    return materialise(moved.unionByName(added), "near-merged")


def _class_links(rows: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id but not a text."""
    spread = rows.groupBy("doc_id").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    return rows.join(spread.select(F.col("doc_id").alias("_id"), "first"), F.col("doc_id") == F.col("_id")).where(
        "node <> first"
    ).select(F.col("first").alias("a"), F.col("node").alias("b"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = SIMILAR_PERCENT,
    rows: int = ROWS,
    halves: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id it is linked with), kept."""
    halves = halves or halves_for(percent, rows)
    described = _described(docs, doc_id, text, shingle_words, rows, halves)
    linkable = described.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = linkable.groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "n", "keys"), "doc_id").alias("one"),
        F.count("*").alias("copies"),
    )
    classes = materialise(classes.select("digest", "copies", "one.*").withColumnRenamed("doc_id", "node"), "near-classes")
    shared = _shared_buckets(classes.select("node", "n", "keys"), halves)
    texts = _texts_of(docs, doc_id, text, shared)
    buckets = _compared(shared, classes, texts, shingle_words, percent)

    asked = materialise(_first_pairs(buckets, percent), "near-pairs")
    labels = _merged(None, materialise(_confirmed(asked, texts, shingle_words, percent), "near-links"))
    labels = _asked_again(_central_pairs(_open(buckets, labels, 1), percent, halves), asked, labels, texts, shingle_words, percent)
    if not buckets.where(F.col("members") > CENTRAL).isEmpty():
        rows = _open(buckets, labels, CENTRAL)
        if not rows.isEmpty():
            labels = _asked_again(_other_pairs(rows, texts, shingle_words, percent, halves), asked, labels, texts, shingle_words, percent)
    return _answer(described, classes, labels)


def _texts_of(docs: DataFrame, doc_id: str, text: str, shared: DataFrame) -> DataFrame:
    """The texts (node, text) of all nodes in shared buckets; only their ids go to the documents."""
    wanted = materialise(shared.select(F.col("node").alias("_doc")).distinct(), "near-wanted")
    found = docs.select(F.col(doc_id).cast("long").alias("node"), F.col(text).alias("text"))
    texts = materialise(found.join(wanted, F.col("node") == F.col("_doc"), "left_semi"), "near-texts")
    if texts.groupBy("node").count().where("count > 1").isEmpty():
        return texts
    return materialise(texts.dropDuplicates(["node", "text"]), "near-texts")


def _asked_again(pairs: DataFrame, asked: DataFrame, labels: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The components after ``pairs`` not in ``asked`` are confirmed and added."""
    fresh = materialise(pairs.join(asked, ["a", "b"], "left_anti"), "near-pairs")
    if fresh.isEmpty():
        return labels
    links = materialise(_confirmed(fresh, texts, n, percent), "near-links")
    return labels if links.isEmpty() else _merged(labels, links)


def _answer(described: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Components of classes brought back to rows: a class of one row by its own id, others by their digest."""
    # written, so that Spark knows its size and can split the rows of a large class
    many = materialise(classes.where("copies > 1").select(F.col("digest").alias("_digest"), "node"), "near-many")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    rows = described.select("doc_id", "n", "digest").join(many, linked & (F.col("digest") == F.col("_digest")), "left")
    rows = materialise(rows.select("doc_id", "n", F.coalesce("node", "doc_id").alias("node")), "near-rows")
    same_id = materialise(_class_links(rows.where(linked)), "near-same-id")
    if not same_id.isEmpty():
        labels = _merged(labels, same_id)
    known = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    placed = rows.join(known, linked & (F.col("node") == F.col("_node")), "left")
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_component", "node").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id; of rows with that id, one."""
    marked = near_duplicates(docs, doc_id, text, **settings)
    gone = materialise(marked.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    kept = docs.join(gone, F.col(doc_id) == F.col("_gone"), "left_anti")
    repeated = marked.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1")
    repeated = materialise(repeated.select(F.col("doc_id").alias("_twice")), "near-twice")
    if repeated.isEmpty():
        return kept
    twice = F.col(doc_id) == F.col("_twice")
    return kept.join(repeated, twice, "left_anti").unionByName(kept.join(repeated, twice, "left_semi").dropDuplicates([doc_id]))
