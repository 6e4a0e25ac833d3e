"""Token counts that follow edits.

A document's text is cut into runs of pre-tokens, the leaves of a segment tree
whose nodes hold characters and tokens below them.  An edit finds its leaves by
the character sums, re-encodes these and the leaf on either side (where the
changed text could join other pre-tokens), and updates the sums above them.

Trees are kept: :func:`plant` encodes every document once and writes its leaves'
sums beside its text; :func:`edited` takes such a table and edits, encodes only
the leaves that the edits touch, and gives the next version of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.bpe import BatchEncoder, vocabulary
from lamina.llm.shared import stage, text_slices, texts_of

LEAF = 256  # characters in a leaf, about


def cuts(text: str, leaf: int = LEAF) -> list[int]:
    """Ends of the leaves.  A cut comes before a space between two characters that are neither white space.

    There every pre-tokenization ends a token, whatever follows; so leaves'
    counts add up to the text's.  Without such a place a leaf is longer.
    """
    out, at, n = [], 0, len(text)
    while n - at > leaf:
        at = text.find(" ", at + leaf)
        while 0 <= at and (text[at - 1].isspace() or at + 1 >= n or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        out.append(at)
    return [*out, n]


def pieces(text: str, leaf: int = LEAF) -> list[str]:
    ends = cuts(text, leaf)
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Tree:
    """Sums over leaves in a binary layout: node i has children 2i and 2i + 1, leaves begin at ``width``."""

    def __init__(self, text: str, count, leaf: int = LEAF, kept: tuple[list[int], list[int]] | None = None):
        """``kept``: characters and tokens of each leaf, of a tree that was made before; then nothing is encoded."""
        self.count, self.leaf = count, leaf
        self.encoded = 0  # leaves encoded since the tree was made
        if kept is None:
            self.texts = pieces(text, leaf)
            self._sums(count(self.texts))
        else:
            ends = np.cumsum(kept[0]).tolist()
            self.texts = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            self._sums(kept[1])

    def _sums(self, tokens: list[int]) -> None:
        self.width = 1 << max(0, len(self.texts) - 1).bit_length()
        pad = [0] * (self.width - len(self.texts))
        self.chars = [0] * self.width + [len(t) for t in self.texts] + pad
        self.tokens = [0] * self.width + list(tokens) + pad
        for i in range(self.width - 1, 0, -1):
            self._up(i)

    def _up(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at``, and where in it."""
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    def edit(self, start: int, removed: int, inserted: str) -> None:
        """Replaces ``removed`` characters at ``start``; both are held within the text."""
        start = min(max(start, 0), self.chars[1])
        end = min(start + max(removed, 0), self.chars[1])
        (a, x), (b, y) = self.find(start), self.find(end)
        lo, hi = max(0, a - 1), min(len(self.texts) - 1, b + 1)
        lead, tail = "".join(self.texts[lo:a]) + self.texts[a][:x], self.texts[b][y:] + "".join(self.texts[b + 1 : hi + 1])
        new = lead + inserted + tail
        fresh = pieces(new, self.leaf)
        tokens = self.count(fresh)
        self.encoded += len(fresh)
        if len(fresh) == hi - lo + 1:
            for i, (t, n) in enumerate(zip(fresh, tokens, strict=True)):
                self.texts[lo + i], at = t, self.width + lo + i
                self.chars[at], self.tokens[at] = len(t), n
                while at > 1:
                    at //= 2
                    self._up(at)
        else:  # another number of leaves: sums anew, tokens of other leaves as they were
            old = self.tokens[self.width : self.width + len(self.texts)]
            self.texts[lo : hi + 1] = fresh
            self._sums(old[:lo] + list(tokens) + old[hi + 1 :])

    @property
    def text(self) -> str:
        return "".join(self.texts)

    @property
    def leaves(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of each leaf: what is kept of a tree."""
        n = len(self.texts)
        return self.chars[self.width : self.width + n], self.tokens[self.width : self.width + n]


KEPT = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>"


def plant(docs: DataFrame, path: str) -> DataFrame:
    """Encodes all documents and writes ``doc_id, text, leaf_chars, leaf_tokens`` into the shared folder.

    Null text counts as empty and has one empty leaf.  Repeated rows are rows
    of their own; an empty table gives an empty one.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(vocabulary(path))
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                own = texts.slice(lo, hi - lo)
                cut = [pieces(t) for t in own.to_pylist()]
                # All leaves of a slice are encoded together, equal ones once.
                leaves = pa.array([p for x in cut for p in x], pa.large_string()).dictionary_encode()
                once = np.diff(encoder.encode(leaves.dictionary)[1])
                tokens = once[leaves.indices.to_numpy()].astype(np.int32)
                chars = pc.utf8_length(leaves.dictionary).to_numpy()[leaves.indices.to_numpy()].astype(np.int32)
                at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in cut])]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), own.cast(pa.string()), *(pa.ListArray.from_arrays(at, pa.array(x)) for x in (chars, tokens))], names=["doc_id", "text", "leaf_chars", "leaf_tokens"])

    return stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, KEPT), "trees")


def with_edits(trees: DataFrame, edits: DataFrame, most: int = 32 << 20) -> DataFrame:
    """``trees`` with the array ``edits`` from a table of ``doc_id, number, start, removed, inserted``.

    A document's edits apply by number; null doc_ids have none.  The table of
    edits is broadcast if its own bytes are at most ``most``; else both sides
    are shuffled.
    """
    edit = F.struct("number", F.col("start").cast("int").alias("start"), F.col("removed").cast("int").alias("removed"), "inserted")
    lists = edits.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.sort_array(F.collect_list(edit)).alias("edits"))
    lists = stage(lists.select("doc_id", F.transform("edits", lambda e: F.struct(e["start"].alias("start"), e["removed"].alias("removed"), e["inserted"].alias("inserted"))).alias("edits")), "edits")
    size = lists.agg(F.sum(F.size("edits") * 24 + F.aggregate("edits", F.lit(0), lambda n, e: n + F.coalesce(F.octet_length(e["inserted"]), F.lit(0)))).alias("n")).first().n or 0
    return trees.join(F.broadcast(lists) if size <= most else lists, "doc_id", "left")


COUNTS = "doc_id long, n_tokens long, edited_tokens long, edited_chars long, leaves long, encoded_leaves long"


def edited(trees: DataFrame, path: str) -> DataFrame:
    """The counts of :func:`edited_counts` and the next version of the trees (``text, leaf_chars, leaf_tokens``).

    ``trees``: what :func:`plant` or this function gave, with ``edits``, an
    array of (start, removed, inserted) that apply one after the other, each to
    the text as it then is; null edits count as none.  Edits lie in their
    document's row; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(vocabulary(path))
        count = lambda ts: [encoder.count(t) for t in ts]
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                encoder.known.room()
                rows = []
                for text, chars, tokens, edits in zip(texts.slice(lo, hi - lo).to_pylist(), *(batch.column(i).slice(lo, hi - lo).to_pylist() for i in (2, 3, 4)), strict=True):
                    before = sum(tokens)
                    if not edits:
                        rows.append((before, before, sum(chars), len(chars), 0, text, chars, tokens))
                        continue
                    tree = Tree(text, count, kept=(chars, tokens))
                    for x in edits:
                        tree.edit(x["start"] or 0, x["removed"] or 0, x["inserted"] or "")
                    rows.append((before, tree.total, tree.chars[1], len(chars), tree.encoded, tree.text, *tree.leaves))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string()), *(pa.array(c, pa.list_(pa.int32())) for c in columns[6:])],
                    names=["doc_id", "n_tokens", "edited_tokens", "edited_chars", "leaves", "encoded_leaves", "text", "leaf_chars", "leaf_tokens"],
                )

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens", "edits").mapInArrow(run, COUNTS + ", text string, leaf_chars array<int>, leaf_tokens array<int>")


def edited_counts(trees: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, edited_tokens, edited_chars, leaves, encoded_leaves`` of all documents.

    Documents without edits are summed from what is kept; their texts aren't
    looked at.
    """
    some = F.coalesce(F.size("edits") > 0, F.lit(False))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x)
    still = trees.where(~some).select("doc_id", total("leaf_tokens").alias("n_tokens"), total("leaf_tokens").alias("edited_tokens"), total("leaf_chars").alias("edited_chars"), F.size("leaf_chars").cast("long").alias("leaves"), F.lit(0).cast("long").alias("encoded_leaves"))
    return edited(trees.where(some), path).select(*still.columns).unionAll(still)


def standard_edits(trees: DataFrame) -> DataFrame:
    """Three edits of each document: a word put into its middle, five characters off its start, a sentence at its end."""
    size = F.aggregate("leaf_chars", F.lit(0), lambda n, x: n + x)
    edit = lambda start, removed, inserted: F.struct(start.cast("int").alias("start"), F.lit(removed).alias("removed"), F.lit(inserted).alias("inserted"))
    return trees.withColumn("edits", F.array(edit(F.floor(size / 2), 0, " edited"), edit(F.lit(0), 5, ""), edit(F.lit(1 << 30), 0, "\nThis line was added.")))
