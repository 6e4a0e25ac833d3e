"""Benchmark decontamination with a BM25 index and block-max WAND.

Test items are the indexed documents; every passage of every training text is a
query.  A term's weight in an item is its BM25 contribution as a share of the
item's score for its own text, so an item's threshold is the same share for all.
A passage whose terms' upper bounds sum below it is skipped; then blocks of
items whose block maxima sum below it are skipped; only what remains is scored.
The bounds are never too low, so that exactly the pairs at or above the
threshold come out.  Each such pair is verified: how much of the item, as
five-word shingles, stands in the text.  How much of its question and of its
answer does is reported beside it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import Cache, distinct_sorted, gather, stage, text_slices, texts_of
from lamina.llm.toxicity import coded_words

K1, B = 1.2, 0.75
SHINGLE, OVERLAP, SHARE = 5, 0.8, 0.7
#: Item text in one broadcast set of indexes; larger benchmarks are searched in so many rounds.
ROUND_BYTES = 4 << 20
#: Items of up to so many words, and of up to each fourfold of it, have indexes of their own, with passages of a fitting length.
SHORT = 64
STRIP = ".,;:!?\"'()[]{}<>*_|&%$#"


def fold(word: str) -> str:
    """A word without punctuation around it, in one case: the same for items and texts.

    Full case folding joins, say, both small sigmas and sharp s with ss; a
    dotted capital I becomes a plain i.
    """
    return word.strip(STRIP).casefold().replace("\u0307", "")


def folded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Row offsets, codes and distinct words; A-Z are folded at once, which leaves fewer words to :func:`fold`."""
    return coded_words(pc.ascii_lower(texts), lower=False)


def words_of(text: str) -> list[str]:
    _, codes, words = folded_words(pa.array([text], pa.large_string()))
    folded = [fold(w) for w in words]
    return [folded[c] for c in codes.tolist() if folded[c]]


def parts(text: str) -> tuple[list[str], list[str]]:
    """Question and answer of an item: its last sentence is the answer, if another comes before it.

    Either takes in words of the other where it would be shorter than a shingle.
    """
    pieces = [p for p in re.split(r"(?<=[.?!])\s+|\n+", text.strip()) if words_of(p)]
    if len(pieces) < 2:
        return words_of(text), []
    words, n = words_of(text), len(words_of(pieces[-1]))
    return words[: max(SHINGLE, len(words) - n)], words[-max(SHINGLE, n) :]


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if not words:
        return set()
    return {tuple(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


class Statistics:
    """What BM25 takes from the whole benchmark: its items, in how many of them each term stands, and their mean length."""

    def __init__(self, items: int, df: dict[str, int], mean: float):
        self.items, self.df, self.mean = items, df, max(mean, 1e-9)

    def weight(self, term: str) -> float:
        return float(np.log(1 + (self.items - self.df[term] + 0.5) / (self.df[term] + 0.5)))


def statistics_of(words: list[list[str]]) -> Statistics:
    return Statistics(len(words), Counter(t for w in words for t in set(w)), sum(map(len, words)) / max(1, len(words)))


class Index:
    """Inverted lists of items in blocks, with each block's largest contribution of each term.

    ``terms`` numbers the terms, which several indexes may share.  Items keep
    their text only; their shingles are made when one is to be verified.
    """

    def __init__(self, items: list[tuple[int, str]], block: int = 16, statistics: Statistics | None = None, terms: dict[str, int] | None = None):
        own = [(i, t, words_of(t)) for i, t in items]
        own = sorted(((i, t, w) for i, t, w in own if w), key=lambda x: (len(x[2]), x[0], x[1]))
        self.items = [(i, t) for i, t, _ in own]
        self.block, n = block, len(own)
        self.longest = max((len(w) for _, _, w in own), default=1)
        known = statistics or statistics_of([w for _, _, w in own])
        self.terms = terms if terms is not None else {t: k for k, t in enumerate(sorted({t for _, _, w in own for t in w}))}
        postings = defaultdict(list)
        for k, (_, _, w) in enumerate(own):
            tf = Counter(w)
            score = {t: known.weight(t) * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / known.mean)) for t, c in tf.items()}
            total = sum(score.values())
            for t, s in score.items():
                postings[self.terms[t]].append((k, s / total))
        lists = [postings.get(t, []) for t in range(len(self.terms))]
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        self.item = np.array([k for x in lists for k, _ in x], dtype=np.int64)
        self.share = np.array([s for x in lists for _, s in x])
        self.most = np.array([max((s for _, s in x), default=0.0) for x in lists] + [0.0])
        # Block maxima, as lists by term: sorted by (term, block).
        blocks = -(-n // block) if n else 0
        term = np.repeat(np.arange(len(lists)), np.diff(self.at))
        key, inverse = np.unique(term * max(1, blocks) + self.item // block, return_inverse=True)
        best = np.zeros(len(key))
        np.maximum.at(best, inverse, self.share)
        self.block_of, self.block_most = key % max(1, blocks), best
        self.block_at = np.searchsorted(key // max(1, blocks), np.arange(len(lists) + 1))
        self.blocks = blocks

    def shingles_of(self, number: int) -> tuple[set, set, set]:
        """Shingles of the whole item, of its question and of its answer."""
        text = self.items[number][1]
        return tuple(map(shingles, (words_of(text), *parts(text))))

    def search(self, terms: np.ndarray, at: np.ndarray, share: float = SHARE) -> list[tuple[int, int, float]]:
        """(passage, item, score) at or above ``share`` for passages of distinct terms ``terms[at[i]:at[i + 1]]``."""
        bound = np.add.reduceat(np.append(self.most[terms], 0.0), at[:-1]) * (np.diff(at) > 0)
        live = np.flatnonzero(bound >= share - 1e-9)
        out: list[tuple[int, int, float]] = []
        for i in range(0, len(live), 2048):  # so many passages at once that memory stays small
            out += self._blocks(live[i : i + 2048], terms, at, share)
        return out

    def _blocks(self, passages: np.ndarray, terms: np.ndarray, at: np.ndarray, share: float) -> list[tuple[int, int, float]]:
        """Bounds every block for the passages, then scores the items of those blocks that may hold one."""
        own, ends = gather(passages, terms, at)
        passage = np.repeat(np.arange(len(passages)), np.diff(ends))
        entry, ends = gather(own, np.arange(len(self.block_of)), self.block_at)
        cell = np.repeat(passage, np.diff(ends)) * self.blocks + self.block_of[entry]
        sums = np.bincount(cell, weights=self.block_most[entry], minlength=len(passages) * self.blocks)
        alive = sums >= share - 1e-9
        some = np.flatnonzero(alive.reshape(len(passages), self.blocks).any(axis=1))
        if not len(some):
            return []
        keep = np.isin(passage, some)
        own, passage = own[keep], passage[keep]
        entry, ends = gather(own, np.arange(len(self.item)), self.at)
        passage, item = np.repeat(passage, np.diff(ends)), self.item[entry]
        keep = alive[passage * self.blocks + item // self.block]
        pair, inverse = np.unique(passage[keep] * len(self.items) + item[keep], return_inverse=True)
        score = np.bincount(inverse, weights=self.share[entry[keep]], minlength=len(pair))
        found = score >= share - 1e-9
        return [(int(passages[p // len(self.items)]), int(p % len(self.items)), float(v)) for p, v in zip(pair[found].tolist(), score[found].tolist(), strict=True)]


class Indexes:
    """The indexes of one round: one for each class of item lengths, over the same numbering of terms.

    A passage is at least as long as the items that it is held against, and not
    much longer; so one long item doesn't blunt the bounds of short ones.
    """

    def __init__(self, items: list[tuple[int, str]], statistics: Statistics | None = None):
        words = [words_of(t) for _, t in items]
        self.terms = {t: k for k, t in enumerate(sorted({t for w in words for t in w}))}
        statistics = statistics or statistics_of([w for w in words if w])
        classes = defaultdict(list)
        for x, w in zip(items, words, strict=True):
            if w:
                classes[max(0, int(np.ceil(np.log(len(w) / SHORT) / np.log(4))))].append(x)
        self.classes = [Index(own, statistics=statistics, terms=self.terms) for _, own in sorted(classes.items())]


def leaks_in(indexes: Indexes, texts: pa.Array, known: Cache) -> list[tuple[int, int, float, float, float]]:
    """(row, item_id, score, question overlap, answer overlap) of verified pairs."""
    if not indexes.classes:
        return []
    offsets, codes, words = folded_words(texts)
    known.room()
    numbers, terms = list(map(known.get, words)), indexes.terms.get
    for i, n in enumerate(numbers):
        if n is None:
            w = words[i]
            f = w if w.isascii() and w.isalpha() else fold(w)
            numbers[i] = known[w] = terms(f, -1) if f else -2
    term = np.array(numbers or [-1], dtype=np.int64)[codes]
    # What is no word at all takes no place.
    some = term > -2
    offsets = np.concatenate([[0], np.cumsum(some)])[offsets]
    term = term[some]
    out: list[tuple[int, int, float, float, float]] = []
    for index in indexes.classes:
        out += _verified(index, texts, _candidates(index, offsets, term))
    return out


def _candidates(index: Index, offsets: np.ndarray, term: np.ndarray) -> dict[tuple[int, int], float]:
    """Best score of each (row, item number) at or above the threshold in some passage."""
    # Passages overlap by half, so that an item's whole text stands in one.
    half = max(32, index.longest)
    size = np.diff(offsets)
    place = np.arange(len(term)) - np.repeat(offsets[:-1], size)
    row = np.repeat(np.arange(len(size)), size)
    seen = term >= 0
    first = np.concatenate([[0], np.cumsum(-(-np.maximum(size, 1) // half))])  # passages of each row; passage p of a row covers halves p and p + 1
    chunk = first[row[seen]] + place[seen] // half
    again = place[seen] // half > 0
    passage = np.concatenate([chunk, chunk[again] - 1])
    every = np.concatenate([term[seen], term[seen][again]])
    # A cheap bound first, with repeats: most passages end here.
    total = np.bincount(passage, weights=index.most[every], minlength=first[-1])
    live = total[passage] >= SHARE - 1e-9
    key = distinct_sorted(passage[live] * len(index.most) + every[live])
    numbers, starts = np.unique(key // len(index.most), return_index=True)
    best: dict[tuple[int, int], float] = {}
    if len(numbers):
        for p, item, score in index.search(key % len(index.most), np.append(starts, len(key))):
            r = int(np.searchsorted(first, numbers[p], side="right")) - 1
            best[r, item] = max(score, best.get((r, item), 0.0))
    return best


def _verified(index: Index, texts: pa.Array, best: dict[tuple[int, int], float]) -> list[tuple[int, int, float, float, float]]:
    out, held, words, shown = [], -1, [], set()
    items: dict[int, tuple[set, set, set]] = {}
    for (r, item), score in sorted(best.items()):
        if r != held:
            held, words = r, words_of(texts[r].as_py())
            shown = shingles(words)
        if item not in items:
            items[item] = index.shingles_of(item)
        whole, question, answer = items[item]
        part = [len(x & shown) / len(x) if x else 1.0 for x in (whole, question, answer)]
        if len(next(iter(whole))) < SHINGLE:  # shorter than a shingle: as a run of words
            part = [float(f" {' '.join(next(iter(whole)))} " in f" {' '.join(words)} ")] * 3
        # The whole item decides; a short part may be one shingle, which any edit takes, so parts are evidence only.
        if part[0] >= OVERLAP:
            out.append((r, index.items[item][0], score, part[1], part[2]))
    return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [words_of(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(w) for w in lists], pa.int64()), pa.array([sorted(set(w)) for w in lists], pa.list_(pa.string()))], names=["item_id", "text", "words", "terms"])


def benchmark_rounds(benchmark: DataFrame) -> Iterator[Indexes]:
    """Indexes of about ROUND_BYTES of item text each, which together hold all items.

    Counts of items and terms and the mean length are those of the whole
    benchmark in every round, so that scores don't depend on the rounds.
    """
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).distinct()
    items = stage(own.mapInArrow(_terms, "item_id long, text string, words long, terms array<string>").where("words > 0"), "items")
    about = items.agg(F.count("*").alias("n"), F.avg("words").alias("mean"), F.sum(F.octet_length("text")).alias("bytes")).first()
    rounds = max(1, -(-(about.bytes or 0) // ROUND_BYTES))
    df = stage(items.select(F.explode("terms").alias("term")).groupBy("term").count(), "terms")
    for k in range(rounds):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k)
        counts = df.join(some.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
        rows = sorted(some.select("item_id", "text").collect(), key=lambda r: (r.item_id is None, r.item_id, r.text))
        yield Indexes([(r.item_id, r.text) for r in rows], Statistics(about.n, {r.term: r["count"] for r in counts.collect()}, about.mean or 0.0))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` of every text that holds an item.

    Texts and items that are null or without words take no part, so an empty
    table on either side gives no rows.  Repeated documents repeat their rows;
    equal rows of the benchmark count once; an item's id may be null.
    """
    out = None
    for indexes in benchmark_rounds(benchmark):
        own = docs.select("doc_id", "text").mapInArrow(_searcher(indexes), "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
        out = own if out is None else out.unionAll(own)
    return out


def _searcher(indexes: Indexes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Cache(400_000)
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                found = leaks_in(indexes, texts.slice(lo, hi - lo), known)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array([x[0] for x in found], pa.int64())),
                        pa.array([x[1] for x in found], pa.int64()),
                        *(pa.array([x[k] for x in found], pa.float64()) for k in (2, 3, 4)),
                    ],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

    return run


def clean(docs: DataFrame, benchmark: DataFrame, columns: list[str]) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    schema = docs.select(*columns).schema
    out = docs.select(*columns)
    for indexes in benchmark_rounds(benchmark):
        out = out.mapInArrow(_filter(indexes, columns), schema)
    return out


def _filter(indexes: Indexes, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Cache(400_000)
        for batch in batches:
            texts = texts_of(batch)
            keep = np.ones(len(texts), dtype=bool)
            for lo, hi in text_slices(texts):
                keep[[lo + x[0] for x in leaks_in(indexes, texts.slice(lo, hi - lo), known)]] = False
            yield batch.filter(pa.array(keep))

    return run
