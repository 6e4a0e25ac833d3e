"""Token ids as binary blocks in Simple-8b coding.

A block holds whole documents:

    magic "S8B1", 4 bytes | documents, ids, words, escapes: uint64 each
    doc_id int64 and null mark uint8 of each document
    end of each document, in ids: uint64        (the block's offsets)
    words: uint64 each
    escapes: uint64 each

all little-endian.  A word's high four bits are a selector that says how many
values of how many bits stand in the low 60.  Selector 0 is an escape: its low
bits are an index into the escapes, for a value of more than 60 bits.  Nothing
in a block is read value by value: all words of a selector unpack at once.
"""

from __future__ import annotations

import functools
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.shared import gather, split_coded, stage, text_slices, texts_of

MAGIC = b"S8B1"
#: Fixed by the coding: values in a word and bits of each, by selector from 1 on.
LAYOUT = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of ``values`` (uint64); each word takes as many values as fit."""
    v = np.asarray(values, dtype=np.uint64)
    n = len(v)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    choice = np.zeros(n, dtype=np.uint8)  # by position: the selector of a word that starts here
    for s in range(len(LAYOUT), 0, -1):
        count, bits = LAYOUT[s - 1]
        fits = v < np.uint64(1 << bits)
        if count > 1:
            at = np.flatnonzero(fits)
            if not len(at):
                break  # fewer bits fit nowhere either
            # How far each fitting value's run goes; the tail may be short, as it is padded.
            breaks = np.flatnonzero(np.diff(at) != 1)
            ends = np.repeat(np.append(at[breaks], at[-1]) + 1, np.diff(np.concatenate([[0], breaks + 1, [len(at)]])))
            choice[at[(ends - at >= count) | (ends == n)]] = s
        else:
            choice[fits] = s
    step = np.array([1] + [c for c, _ in LAYOUT])[choice].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts)
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([v, np.zeros(60, np.uint64)])
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        if s == 0:
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
            continue
        count, bits = LAYOUT[s - 1]
        for k in range(count):
            words[rows] |= padded[starts[rows] + k] << np.uint64(k * bits)
    return words, v[starts[chosen == 0]]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values that ``words`` hold."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1] + [c for c, _ in LAYOUT])[chosen]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    for s in np.unique(chosen).tolist():
        rows = np.flatnonzero(chosen == s)
        if s == 0:
            out[starts[rows]] = escapes[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        count, bits = LAYOUT[s - 1]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[starts[rows] + k] = words[rows] >> np.uint64(k * bits) & mask
    return out[:n]


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    ends = np.cumsum([len(x) for x in ids]).astype("<u8")
    words, escapes = pack(np.concatenate(ids) if ids else np.empty(0, np.uint64))
    head = np.array([len(ids), ends[-1] if len(ids) else 0, len(words), len(escapes)], dtype="<u8")
    names = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    marks = np.array([d is None for d in doc_ids], dtype=np.uint8)
    return b"".join([MAGIC, head.tobytes(), names.tobytes(), marks.tobytes(), ends.tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def read_block(block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, the offset of each document's ids (one more than documents), all ids."""
    if block[:4] != MAGIC:
        raise ValueError("not a Simple-8b block")
    docs, n, n_words, n_escapes = (int(x) for x in np.frombuffer(block, "<u8", 4, 4))
    at = 36
    names = np.frombuffer(block, "<i8", docs, at)
    at += 8 * docs
    marks = np.frombuffer(block, np.uint8, docs, at)
    at += docs
    ends = np.frombuffer(block, "<u8", docs, at).astype(np.int64)
    at += 8 * docs
    words = np.frombuffer(block, "<u8", n_words, at)
    escapes = np.frombuffer(block, "<u8", n_escapes, at + 8 * n_words)
    return [None if m else d for d, m in zip(names.tolist(), marks.tolist(), strict=True)], np.concatenate([[0], ends]), unpack(words, escapes, n)


#: A Latin-1 letter beside one of these marks is always a boundary of pre-tokens: such letters stay one letter under any normalization,
#: and the apostrophe, which begins contractions, isn't among the marks.
LETTER, MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])", r"([.,;:!?&%#$\-()\"])"
CONTROL = "<|"


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each distinct piece only once.

    The vocabulary's own rules make this exact: white space separates words and
    is dropped, so a text's ids are those of its space-separated pieces, one
    after the other, and a space may be put in where a run of letters meets
    punctuation.  Letters are lower-cased, so that may happen before.  Control
    strings are matched in the text as it is; texts that could hold one are
    split at white space only, and go to the library unchanged.
    """

    def __init__(self, path: str, most: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was known before; together they are bounded, and what is in use stays
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(self.library.get_vocab().values()) + 1, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    @staticmethod
    def spaced(texts: pa.Array) -> pa.Array:
        """Texts with the same ids, and fewer distinct pieces between their spaces."""
        texts = pc.replace_substring(texts, "\n", " ")
        plain = pc.ascii_lower(texts)
        for pattern in (LETTER + MARK, MARK + LETTER):
            plain = pc.replace_substring_regex(plain, pattern, r"\1 \2")
        return pc.if_else(pc.match_substring(texts, CONTROL), texts, plain)

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces that aren't known."""
        # A word of letters gives one run of tokens, which only its last token ends; so many words can share a call.
        words, others = [], []
        for p in pieces:
            alone = p.isascii() and p.isalpha() or unicodedata.normalize("NFC", p).lower().isalpha() and p.isalpha()
            (words if alone else others).append(p)
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            joined = [" ".join(some[k : k + 16]) for k in range(0, len(some), 16)]
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(joined, add_special_tokens=False)])
            raw, stops = ids.tobytes(), (np.flatnonzero(self.last[ids]) * 4 + 4).tolist()
            self.known.update(zip(some, map(raw.__getitem__, map(slice, [0, *stops[:-1]], stops)), strict=True))
        for i in range(0, len(others), 4096):
            some = others[i : i + 4096]
            for p, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self.known[p] = np.array(e.ids, dtype=np.uint32).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as uint32, and each text's offsets into them."""
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        offsets, codes, pieces = split_coded(self.spaced(texts))
        runs = list(map(self.known.get, pieces))
        gaps = [i for i, r in enumerate(runs) if r is None]
        fresh = []
        for i in gaps:
            p = pieces[i]
            if (r := self.older.get(p)) is None:
                fresh.append(p)
            else:
                self.known[p] = r
        self.learn(fresh)
        for i in gaps:
            runs[i] = self.known[pieces[i]]
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)) // 4)])
        ids, ends = gather(codes, np.frombuffer(b"".join(runs), dtype=np.uint32), starts)
        return ids, ends[offsets]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


#: A sample of so many doc_ids a shard sets the shards' bounds, of at most this many shards: 8 MB on the driver.
SAMPLED, MOST_SHARDS = 64, 1 << 14
NO_ID = -(1 << 63)  # stands for a null doc_id, which comes before all others


def shard_bounds(docs: DataFrame, shard_documents: int) -> np.ndarray:
    """Ascending doc_ids that end the shards but the last; an id that fills several shards comes several times.

    From a sample of rows, so that an id weighs as much as it has rows.
    """
    total = docs.count()
    shards = min(MOST_SHARDS, max(1, -(-total // shard_documents)))
    if shards == 1:
        return np.empty(0, np.int64)
    share = min(1.0, SAMPLED * shards / total)
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id")).sample(share, seed=11).toArrow().column("id").to_numpy()
    return np.quantile(np.sort(ids), np.arange(1, shards) / shards, method="lower") if len(ids) else np.empty(0, np.int64)


def write_token_blocks(docs: DataFrame, path: str, end_id: int = 1, block_ids: int = 1 << 18, shard_documents: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Encodes ``docs`` and writes blocks in ascending doc_id order.

    Returns the written files as ``shard, block, first_id, n_ids, payload`` and
    the shards' starts as ``shard, start``.  Null doc_ids come first; documents
    of one doc_id follow each other, within a shard in the order of their ids'
    bytes.  Each document, also one with null or empty text, ends with
    ``end_id``.  An empty table gives no blocks.

    The text is read once and never shuffled: what moves is each document's
    ids, to the shard of its doc_id range, one shard to a task.  The rows of a
    doc_id that fills several shards are dealt to these in turn.  Beyond
    ``MOST_SHARDS`` shards, they grow instead.  A document longer than a block
    is a block of its own.
    """
    cuts = shard_bounds(docs, shard_documents)
    shards = len(cuts) + 1

    width = np.uint16 if len(encoder(path).last) <= 1 << 16 else np.uint32  # what a vocabulary's ids need on their way

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, turn = encoder(path), 0
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts, 16 << 20):
                ids, at = enc.encode(texts.slice(lo, hi - lo))
                name = batch.column(0).slice(lo, hi - lo)
                key = np.asarray(pc.fill_null(name, NO_ID))
                shard, last = (np.searchsorted(cuts, key, side=x) for x in ("left", "right"))
                shard += (turn + np.arange(len(key))) % (last - shard + 1)
                turn += len(key)
                ids = ids.astype(width)
                runs = [ids[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), name, pa.array(runs, pa.binary())], names=["shard", "doc_id", "ids"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by shard and doc_id; a shard lies in one partition."""
        names: list[int | None] = []
        held: list[np.ndarray] = []
        n = first = number = 0
        shard = -1

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([write_block(names, held)], pa.binary())], names=["shard", "block", "first_id", "n_ids", "payload"])

        for batch in batches:
            for s, d, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = np.append(np.frombuffer(raw, width).astype(np.uint64), np.uint64(end_id))
                if held and (s != shard or n + len(own) > block_ids):
                    yield block()
                    first, number, n, names, held = first + n, number + 1, 0, [], []
                if s != shard:
                    shard, first, number = s, 0, 0
                names.append(d)
                held.append(own)
                n += len(own)
        if held:
            yield block()

    sent = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(packed, "shard int, doc_id long, ids binary")
    written = stage(
        sent.repartitionById(shards, "shard").sortWithinPartitions("shard", "doc_id", "ids").mapInArrow(blocks, "shard int, block long, first_id long, n_ids long, payload binary"),
        "tokens",
    )
    sizes = written.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    starts = sizes.select("shard", (F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("start"))
    return written, starts


def read_token_blocks(written: DataFrame, starts: DataFrame) -> DataFrame:
    """Reads the files back: ``doc_id, start, n_tokens, ids_crc32, shard, block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, b, first, payload in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                names, at, ids = read_block(payload)
                raw = ids.astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s] * len(names), pa.int32()),
                        pa.array([b] * len(names), pa.int64()),
                        pa.array(names, pa.int64()),
                        pa.array(first + at[:-1]),
                        pa.array(np.diff(at)),
                        pa.array([zlib.crc32(raw[x:y].tobytes()) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.int64()),
                    ],
                    names=["shard", "block", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    rows = written.select("shard", "block", "first_id", "payload").mapInArrow(run, "shard int, block long, doc_id long, local long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "shard").select("doc_id", (F.col("start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "shard", "block")


def token_files(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    return read_token_blocks(*write_token_blocks(docs, path, end_id))
