"""Toxicity scores from subword-bag embeddings under a linear softmax.

A word's vector is the mean of its character n-gram vectors, a document's the
mean of its distinct words' vectors; embeddings and softmax weights are trained jointly.
A misspelling that was never seen shares most n-grams with what was.  As all is
linear before the softmax, a word adds a fixed amount to a document's score, so
scoring works out each distinct word once for a batch.

What few training texts hold teaches nothing about others: an n-gram bucket that
fewer than ``least`` of them have keeps a zero vector.  Training and scoring are
thus one and the same function of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import Cache, distinct_sorted, gather, text_slices, texts_of

BUCKETS, WIDTH, GRAMS, SCALE = 1 << 17, 8, (3, 4, 5), 100.0
THRESHOLD = 0.3


def coded_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Row offsets, codes and distinct words of (lower-cased,) white-space-separated texts."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts) if lower else texts)
    # Leading and trailing white space gives empty pieces; they count as no words.
    flat = lists.values
    some = np.asarray(pc.greater(pc.binary_length(flat), 0))
    offsets = np.concatenate([[0], np.cumsum(some)])[np.asarray(lists.offsets, dtype=np.int64)]
    coded = flat.filter(pa.array(some)).dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def distinct(offsets: np.ndarray, codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with each word of a text once, so that a word said over and over weighs no more than another."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pair = distinct_sorted(row * max(1, words) + codes)
    return np.searchsorted(pair, np.arange(len(offsets)) * max(1, words)), pair % max(1, words)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all words' n-grams, and each word's offsets into them; every word has one at least."""
    bare = [f"<{w.strip('.,;:!?\"()[]')}>" for w in words]
    size = np.array([len(b) for b in bare], dtype=np.int64)
    points = np.frombuffer("".join(bare).encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(bare)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(points))  # characters up to the word's end
    found, owner = [], []
    h = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        h = h[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        h ^= h >> np.uint64(29)
        # Shorter words than the shortest n-gram are a gram of their own.
        ok = left[: len(h)] >= n if n in GRAMS else (left[: len(h)] == n) & (size[word[: len(h)]] == n)
        found.append((h[ok] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(BUCKETS))
        owner.append(word[: len(h)][ok])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found).astype(np.int64)[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(bare)))])


def run_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of so many values; 0 for an empty one."""
    sums = np.add.reduceat(np.append(values, 0.0), np.minimum(np.cumsum(counts) - counts, len(values)))
    return np.where(counts > 0, sums, 0.0)


def run_means(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean of each run; 0 for an empty one."""
    counts = np.diff(offsets)
    return run_sums(values, counts) / np.maximum(counts, 1)


@dataclass(frozen=True)
class Model:
    """``gram`` is each bucket's embedding times the softmax weights (class 1 less class 0)."""

    gram: np.ndarray
    bias: float

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        ids, at = grams(words)
        return run_means(self.gram[ids].astype(np.float64), at)

    def score(self, texts: pa.Array, known: Cache | None = None) -> np.ndarray:
        offsets, codes, words = coded_words(texts)
        offsets, codes = distinct(offsets, codes, len(words))
        known = Cache() if known is None else known
        known.room()
        fresh = [w for w in words if w not in known]
        for i in range(0, len(fresh), 50_000):
            some = fresh[i : i + 50_000]
            known.update(zip(some, self.words(some).tolist(), strict=True))
        value = np.array([known[w] for w in words] or [0.0])
        logit = SCALE * run_means(value[codes], offsets) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -40, 40)))


def bags(texts: list[str], some: int = 256) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Each text's distinct words: offsets, word numbers, and the words that they number.  So many texts at a time."""
    number: dict[str, int] = {}
    sizes, found = [np.zeros(1, np.int64)], [np.empty(0, np.int32)]
    for i in range(0, len(texts), some):
        offsets, codes, words = coded_words(pa.array(texts[i : i + some], pa.large_string()))
        offsets, codes = distinct(offsets, codes, len(words))
        own = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int32)
        sizes.append(np.diff(offsets))
        found.append(own[codes] if len(own) else found[0])
    return np.cumsum(np.concatenate(sizes)), np.concatenate(found), list(number)


def texts_of_buckets(offsets: np.ndarray, word: np.ndarray, ids: np.ndarray, at: np.ndarray, texts: int = 64) -> np.ndarray:
    """In how many texts each bucket stands; however many words of a text have it, that counts once.  So many texts at a time."""
    out = np.zeros(BUCKETS, dtype=np.int64)
    for i in range(0, len(offsets) - 1, texts):
        own = offsets[i : i + texts + 1]
        bucket, ends = gather(word[own[0] : own[-1]], ids, at)
        doc = np.repeat(np.repeat(np.arange(len(own) - 1), np.diff(own)), np.diff(ends))
        out += np.bincount(distinct_sorted(doc * BUCKETS + bucket) % BUCKETS, minlength=BUCKETS)
    return out


def train(texts: list[str], labels: np.ndarray, prior: float, least: int = 3, steps: int = 150, rate: float = 0.1, shrink: float = 1e-2, decay: float = 3e-4, seed: int = 1) -> Model:
    """Full-batch Adam on embeddings and softmax weights together, with a group penalty on embeddings.

    ``prior``: the share of label 1 among all labelled rows.  The bias is
    moved from the sample's share to it.  ``least``: texts that a bucket must
    stand in to get a vector, whatever the sample's size.
    """
    y = np.asarray(labels, dtype=np.float64)
    base = min(max(prior, 1e-4), 1 - 1e-4)
    if not 0 < y.mean() < 1 if len(y) else True:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(base / (1 - base))))
    offsets, word, words = bags(texts)
    if not words:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(base / (1 - base))))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(offsets))
    weight = 1 / np.maximum(np.diff(offsets), 1)[doc]
    parts = [(x.astype(np.int32), np.diff(y)) for x, y in (grams(words[i : i + 20_000]) for i in range(0, len(words), 20_000))]  # so that memory stays small
    ids, sizes = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
    at = np.concatenate([[0], np.cumsum(sizes)])
    rare = texts_of_buckets(offsets, word, ids, at) < least
    # Zero vectors add nothing to a word's mean, but count in its size; only the others are held and trained.
    active = np.flatnonzero(~rare)
    place = (np.cumsum(~rare) - 1).astype(np.int32)
    parts = [(place[i[~rare[i]]], np.add.reduceat(~rare[i], np.cumsum(n) - n, dtype=np.int64)) for i, n in parts]  # every word has an n-gram
    ends = np.cumsum([len(n) for _, n in parts])
    del ids, at
    rng = np.random.default_rng(seed)
    e, w, b = rng.normal(0, 0.01, (len(active), WIDTH)), rng.normal(0, 0.5, (WIDTH, 2)), np.log(y.mean() / (1 - y.mean()))
    me, ve, mw, vw, mb, vb = np.zeros_like(e), np.zeros_like(e), np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        u = w[:, 1] - w[:, 0]
        value = e @ u
        of_word = np.concatenate([run_sums(value[i], n) for i, n in parts]) / sizes
        z = SCALE * np.bincount(doc, weights=weight * of_word[word], minlength=len(texts)) + b
        delta = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)  # of class 1; class 0 has its negative
        by_word = np.bincount(word, weights=weight * delta[doc], minlength=len(words)) / sizes
        pull = SCALE * sum(np.bincount(i, weights=np.repeat(by_word[end - len(n) : end], n), minlength=len(active)) for (i, n), end in zip(parts, ends.tolist(), strict=True))
        ge, gw, gb = np.outer(pull, u) + decay * e, np.outer(e.T @ pull, [-1.0, 1.0]) + decay * w, delta.sum()
        lr = rate * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        me, ve = 0.9 * me + 0.1 * ge, 0.999 * ve + 0.001 * ge * ge
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        e -= lr * 0.1 * me / (np.sqrt(ve) + 1e-8)
        # A vector that its gradient doesn't hold up falls to 0, as a group: common n-grams must not add noise.
        size = np.sqrt((e * e).sum(axis=1, keepdims=True))
        e *= np.maximum(0.0, 1.0 - shrink / np.maximum(size, 1e-12))
        w -= lr * mw / (np.sqrt(vw) + 1e-8)
        b -= lr * mb / (np.sqrt(vb) + 1e-8)
    shift = np.log(base / (1 - base)) - np.log(y.mean() / (1 - y.mean()))
    gram = np.zeros(BUCKETS, np.float32)
    gram[active] = e @ (w[:, 1] - w[:, 0])
    return Model(gram, float(b + shift))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, most_bytes: int = 1 << 15) -> Model:
    """Trains on a bounded sample of labelled rows that aren't held out.

    The bound: ``per_class`` documents of each label, by a hash of doc_id, of
    texts up to ``most_bytes`` each (96 MB on each class at most).  The prior
    counts all labelled rows.  A doc_id with several labels counts as its
    largest, one with several texts as the first of these by their hash; null
    labels, texts and ids count as none.  Without labels of both classes, or
    without documents, every score is the prior.
    """
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    if not counts:
        return train([], np.empty(0), 0.0)
    ids = None
    for label in (0, 1):
        some = own.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        ids = some if ids is None else ids.unionAll(some)
    text = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
    found = text.join(F.broadcast(ids), "doc_id")  # 2 * per_class ids are broadcast at most
    # However often a sampled id comes, one text of it goes to the driver.
    rows = found.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("x")).select("doc_id", "toxic", "x.text").collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], np.array([r.toxic for r in rows]), counts.get(1, 0) / sum(counts.values()))


def scored(docs: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """``score`` (0 to 1) and ``predicted`` beside ``columns`` (doc_id, if none are named); null text counts as empty."""
    columns = columns or ["doc_id"]
    kept = docs.select(*dict.fromkeys([*columns, "text"]))
    fields = [kept.schema[c] for c in columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Cache(400_000)
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                score = model.score(texts.slice(lo, hi - lo), known)
                own = [batch.column(batch.schema.get_field_index(c)).slice(lo, hi - lo) for c in columns]
                yield pa.RecordBatch.from_arrays([*own, pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=[*columns, "score", "predicted"])

    return kept.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Null text counts as empty, which scores as its bias says; a null doc_id is
    not held out.  Repeated rows come out as often as they went in.
    """
    out = scored(docs, fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")
