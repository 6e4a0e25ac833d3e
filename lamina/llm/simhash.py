"""SimHash near-duplicates, found with vantage-point trees.

Distinct fingerprints are dealt to the leaves of a small tree: each node has a
vantage fingerprint and a radius, and a fingerprint goes to the inner or outer
side by its Hamming distance to the vantage point.  By the triangle inequality
two fingerprints within ``radius`` of each other differ by at most that in this
distance; so those that lie just outside a boundary are also sent across as
queries, and every linked pair meets in one leaf.  Every level of the tree adds
copies, so it stops at ``MOST_LEAVES``.  What is then still too much for a task
is dealt on, within its leaf, by leading bits of its four 16-bit quarters: of
two fingerprints that differ in three bits at most, one quarter is equal.  So a
fingerprint has four times the tree's copies at most, whatever the table's
size.  Each cell is searched by a tree of the same kind and yields a spanning
forest of its links, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.graph import connected
from lamina.llm.shared import shuffle_width, stage, text_slices, texts_of

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Leaves of the tree that deals fingerprints to tasks; beyond, quarters divide the leaves.
MOST_LEAVES = 32
QUARTERS, QUARTER = RADIUS + 1, 64 // (RADIUS + 1)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The majority bits of the shingles' XXH64, as an unsigned number; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0] + [e + 1 for e in ends[:-1]]
    if n >= shingle:
        ends = ends[shingle - 1 :]
    else:
        starts, ends = [0], [len(joined)]
    votes, digest, k = np.zeros(64, dtype=np.int64), xxhash.xxh64_digest, len(ends)
    for i in range(0, k, 1 << 17):
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[i : i + (1 << 17)], ends[i : i + (1 << 17)])])  # noqa: B905
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(votes * 2 > k).tobytes(), "big")


def with_fingerprint(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and fp (the text's 64 bits as a signed long), a row for each document; null text counts as empty."""
    own = docs.select(*dict.fromkeys([*columns, "text"]))
    schema = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in columns) + ", fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                fps = np.array([fingerprint(t.encode()) for t in texts.slice(lo, hi - lo).to_pylist()], dtype=np.uint64)
                kept = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in columns]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(fps.view(np.int64))], names=[*columns, "fp"])

    return own.mapInArrow(run, schema)


def distance(fps: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(point))


def cut(fps: np.ndarray, radius: int) -> tuple[int, int] | None:
    """A vantage point and a boundary with few fingerprints just outside it and many on both sides, or None."""
    best, n = None, len(fps)
    for point in fps[np.linspace(0, n - 1, 6).astype(np.int64)].tolist():
        within = np.cumsum(np.bincount(distance(fps, point), minlength=65 + radius))
        for mu in range(64):
            inner = within[mu]
            if not 0.25 * n <= inner <= 0.75 * n:
                continue
            cost = (within[mu + radius] - inner) / min(inner, n - inner)
            if best is None or cost < best[0]:
                best = (cost, point, mu)
    return best[1:] if best else None


def grow(sample: np.ndarray, leaves: int, radius: int = RADIUS) -> tuple:
    """A tree as nested (point, boundary, inner, outer), with numbers as leaves."""
    number = iter(range(1 << 31))

    def node(fps: np.ndarray, share: int) -> tuple | int:
        found = cut(fps, radius) if share > 1 and len(fps) >= 8 else None
        if not found:
            return next(number)
        near = distance(fps, found[0]) <= found[1]
        return (*found, node(fps[near], share // 2), node(fps[~near], share - share // 2))

    return node(sample, leaves)


def deal(tree: tuple | int, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, at home) of each place that each fingerprint goes to."""
    out: list[tuple[np.ndarray, int, np.ndarray]] = []

    def down(node: tuple | int, rows: np.ndarray, home: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, int):
            out.append((rows, node, home))
            return
        point, mu, inner, outer = node
        d = distance(fps[rows], point).astype(np.int64)
        near = np.where(home, d <= mu, d <= mu + radius)
        across = home & (d > mu) & (d <= mu + radius)
        down(inner, np.concatenate([rows[near], rows[across]]), np.concatenate([home[near], np.zeros(across.sum(), bool)]))
        far = np.where(home, d > mu, d > mu - radius)
        down(outer, rows[far], home[far])

    down(tree, np.arange(len(fps)), np.ones(len(fps), bool))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    return np.concatenate([r for r, _, _ in out]), np.concatenate([np.full(len(r), k) for r, k, _ in out]), np.concatenate([h for _, _, h in out])


class Forest:
    """Union-find over numbers, many links at a time; a root is the smallest of its tree."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def flatten(self) -> None:
        while not np.array_equal(nxt := self.up[self.up], self.up):
            self.up = nxt

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            self.flatten()
            a, b = self.up[a], self.up[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            a, b = low[low != high], high[low != high]
            np.minimum.at(self.up, b, a)


def search(fps: np.ndarray, home: np.ndarray, radius: int = RADIUS, leaf: int = 512) -> np.ndarray:
    """Joins all pairs within ``radius`` of which one at least is at home; returns each fingerprint's root.

    Memory: one block of ``leaf`` rows against a slice of the others at a time.
    """
    forest = Forest(len(fps))

    def compare(rows: np.ndarray, others: np.ndarray) -> None:
        for i in range(0, len(rows), leaf):
            for j in range(0, len(others), 8192):
                a, b = np.nonzero(np.bitwise_count(fps[rows[i : i + leaf], None] ^ fps[None, others[j : j + 8192]]) <= radius)
                forest.link(rows[i + a], others[j + b])

    todo = [(np.flatnonzero(home), np.flatnonzero(~home))]
    while todo:
        rows, queries = todo.pop()
        found = cut(fps[rows], radius) if len(rows) > leaf else None
        if found:
            point, mu = found
            d, q = distance(fps[rows], point), distance(fps[queries], point).astype(np.int64)
            inner, outer = rows[d <= mu], rows[d > mu]
            todo.append((inner, np.concatenate([queries[q <= mu + radius], rows[(d > mu) & (d <= mu + radius)]])))
            todo.append((outer, queries[q > mu - radius]))
        elif len(rows):
            compare(rows, rows)
            compare(rows, queries)
    forest.flatten()
    return forest.up


def cells(tree: tuple | int, bits: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, at home) of each place that each fingerprint goes to: its leaves, divided by ``bits`` bits of each quarter."""
    row, leaf, home = deal(tree, fps)
    if not bits:
        return row, leaf, home
    parts = [fps[row] >> np.uint64(QUARTER * q) & np.uint64((1 << QUARTER) - 1) for q in range(QUARTERS)]
    cell = np.concatenate([(leaf * QUARTERS + q << bits) + (p >> np.uint64(QUARTER - bits)).astype(np.int64) for q, p in enumerate(parts)])
    return np.tile(row, QUARTERS), cell, np.tile(home, QUARTERS)


def links(distinct: DataFrame, leaf_size: int = 16_384, sample_per_leaf: int = 256) -> DataFrame:
    """``a, b``: a spanning forest, cell by cell, of the links among distinct fingerprints (column fp).

    The tree of leaves is made on the driver from a sample by hash of about
    ``sample_per_leaf`` fingerprints a leaf, some thousands in all; it decides
    where pairs meet, not which are found.  A group of near copies, however
    large, has few distinct fingerprints: 43,745 lie within 3 bits of one.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    leaves = min(MOST_LEAVES, max(1, -(-n // leaf_size)))
    bits = min(QUARTER, max(0, int(np.ceil(np.log2(max(1, n) / (leaves * leaf_size))))))
    sample = np.empty(0, np.uint64)
    if leaves > 1:
        some = F.pmod(F.xxhash64("fp"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, sample_per_leaf * leaves / n))
        sample = np.sort(distinct.where(some).select("fp").toArrow().column("fp").to_numpy()).view(np.uint64)
    tree = grow(sample, leaves)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).view(np.uint64)
            row, cell, home = cells(tree, bits, fps)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(fps[row].view(np.int64)), pa.array(home)], names=["cell", "fp", "home"])

    def joined(tab):  # Spark takes the kind of function from its annotations; it has none
        fps = np.asarray(tab.column("fp")).view(np.uint64)
        roots = search(fps, np.asarray(tab.column("home")))
        linked = np.flatnonzero(roots != np.arange(len(fps)))
        return pa.table({"a": fps[roots[linked]].view(np.int64), "b": fps[linked].view(np.int64)})

    placed = distinct.select("fp").mapInArrow(dealt, "cell long, fp long, home boolean")
    return placed.repartition(shuffle_width(spark), "cell").groupBy("cell").applyInArrow(joined, "a long, b long")


def near_duplicates(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, fp, component_id, root`` and the columns ``carry`` for each document.

    component_id is the smallest doc_id that links lead to, root the smallest
    fingerprint (as a signed number).  Documents without
    words have fingerprint 0 and link like others.  Rows with null doc_id keep
    it, and take part; a component of only such rows has a null id.  Repeated
    rows come out as often as they went in; an empty table gives none.
    """
    own = stage(with_fingerprint(docs, ["doc_id", *carry]), "fingerprints")
    least = stage(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = connected(links(least)).select(F.col("node").alias("fp"), "root")
    placed = least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stage(placed, "roots")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(placed.select("fp", "root").join(smallest, "root"), "fp", "left").select("doc_id", "fp", "component_id", "root", *carry)


def hexadecimal(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
