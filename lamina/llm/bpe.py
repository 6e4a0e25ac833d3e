"""Byte-level BPE encoding by backtracking, decoding by an offset table.

The encoder looks up the longest vocabulary entry at a position in an
Aho-Corasick automaton and accepts it only if it may follow the token before:
two tokens are compatible if BPE, given their joined bytes, would return just
these two.  If no compatible token leads on, it steps back.  Each (position,
token) is tried once, so the work is linear in the text, and the result is that
of applying the merges by rank.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from lamina.llm.shared import Cache, gather, split_coded, text_slices, texts_of

#: Fixed: the pre-tokenization pattern of this vocabulary.
PRETOKEN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: White space on both sides of a space (or before it, at the end): there a cut before the space could change a run's tokens.
#: Every character that any of the libraries counts as white space stands in the class.
UNSAFE = r"[\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}] ([\s\p{Z}\x{0b}\x{85}\x{1c}-\x{1f}]|\z)"


def byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary file: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(more))
        more += b not in plain
    return out


class ByteBpe:
    """One vocabulary file of the tokenizers library (byte-level, no normalizer).

    ``encode(text)`` equals that library's ids with add_special_tokens=False;
    special tokens' strings in a text become their ids, as there.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        raw = {k: bytes(to_byte[c] for c in k) for k in spec["model"]["vocab"]}
        ids = {raw[k]: i for k, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for b, i in ids.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.sizes = [len(b) for b in self.bytes]
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        # By rank: a merge's rank orders its result among all; single bytes come before any.
        self.rank = [0] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for n, (a, b) in enumerate(spec["model"]["merges"]):
            a, b = ids[raw[a]], ids[raw[b]]
            whole = ids[self.bytes[a] + self.bytes[b]]
            self.merged[a, b] = n
            if self.parts[whole] is None and len(self.bytes[whole]) > 1:
                self.parts[whole], self.rank[whole] = (a, b), n + 1
        self.automaton = ahocorasick.Automaton()
        for b, i in ids.items():
            if len(b) == 1 or self.parts[i]:
                self.automaton.add_word(b.decode("latin-1"), (len(b) - 1, i))
        self.automaton.make_automaton()
        self.ids = ids
        self.shorter: dict[int, int] = {}
        self.pairs = Cache(1_000_000)

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        if (found := self.shorter.get(token)) is None:
            b = self.bytes[token]
            found = next((self.ids[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in self.ids), -1)
            self.shorter[token] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart when they stand side by side.

        Undoes merges on the two sides of the seam, the latest first.  At each
        step a merge across the seam that comes before the merge undone last
        would have been applied instead.
        """
        a, b, limit, good = left, right, 1 << 60, True
        while True:
            if (n := self.merged.get((a, b))) is not None and n + 1 < limit:
                good = False
                break
            # The later of the two merges is undone; of equal ones the right side's, as BPE merges from the left.
            if self.parts[a] and (not self.parts[b] or self.rank[a] > self.rank[b]):
                limit, a = self.rank[a], self.parts[a][1]
            elif self.parts[b]:
                limit, b = self.rank[b] + 1, self.parts[b][0]
            else:
                break
        self.pairs.room()
        self.pairs[left << 20 | right] = good
        return good

    def encode_pretoken(self, word: str) -> list[int]:
        """Ids of one pre-token, given as Latin-1 characters that stand for its bytes."""
        if (whole := self.ids.get(word.encode("latin-1"))) is not None and (len(word) == 1 or self.parts[whole]):
            return [whole]
        sizes, known, size = self.sizes, self.pairs.get, len(word)
        longest = [0] * size  # by start; matches come by end, so the longest of a start comes last
        for end, (before, i) in self.automaton.iter(word):
            longest[end - before] = i
        out: list[int] = []
        ends = bytearray(b"\x01") * (size + 1)  # positions not yet known to be dead ends
        at, token, last = 0, longest[0], -1
        while True:
            n = at + sizes[token]
            if ends[n]:
                good = last < 0 or known(last << 20 | token)
                if good is None:
                    good = self.compatible(last, token)
                if good:
                    out.append(token)
                    if n == size:
                        return out
                    at, last, token = n, token, longest[n]
                    continue
            token = self.prefix(token)
            while token < 0:  # no token leads on from here
                ends[at] = 0
                token = out.pop()
                at -= sizes[token]
                last = out[-1] if out else -1
                token = self.prefix(token)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.special_at.split(text) if self.special_at else [text]:
            if part in self.special:
                out.append(self.special[part])
            else:
                for word in PRETOKEN.findall(part):
                    out += self.encode_pretoken(word.encode().decode("latin-1"))
        return out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes that ``ids`` stand for, gathered through the offset table."""
        return gather(ids, self.blob, self.offsets)[0].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    """One copy for each Python worker."""
    return ByteBpe(path)


#: Stands at every cut of a text; texts that hold it themselves aren't cut.
CUT = "\x1f"
#: A Latin-1 letter beside one of these marks is always a boundary of pre-tokens; the apostrophe, which begins contractions, isn't among them.
LETTER, MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}])", r"([.,;:!?&%#$()\"])"


class BatchEncoder:
    """Encodes many texts at once: each distinct piece of a batch only once.

    A text is cut before its spaces and between letters and punctuation.  Such a
    cut always falls between two pre-tokens, except within runs of white space;
    texts with these runs are encoded whole.
    """

    def __init__(self, bpe: ByteBpe, most: int = 600_000):
        self.bpe, self.known = bpe, Cache(most)

    def ids_of(self, piece: str) -> bytes:
        """Ids of a piece, by way of its pre-tokens, which are what is kept."""
        if piece.isalpha() or (piece[:1] == " " and piece[1:].isalpha()):  # one pre-token
            return self.learnt(piece)
        if self.bpe.special_at and self.bpe.special_at.search(piece):
            return np.array(self.bpe.encode(piece), dtype=np.uint32).tobytes()
        return self.ids_of_words(PRETOKEN.findall(piece))

    def learnt(self, word: str) -> bytes:
        found = np.array(self.bpe.encode_pretoken(word.encode().decode("latin-1")), dtype=np.uint32).tobytes()
        if len(word) <= 64:
            self.known[word] = found
        return found

    def ids_of_words(self, words: list[str]) -> bytes:
        known = self.known.get
        return b"".join([known(w) or self.learnt(w) for w in words])  # no word is without ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts as uint32, and each text's offsets into them."""
        self.known.room()
        unsafe = pc.or_(pc.match_substring_regex(texts, UNSAFE), pc.match_substring(texts, CUT))
        whole = np.flatnonzero(np.asarray(unsafe))
        marked = pc.replace_substring(texts, " ", CUT + " ")
        for pattern in (LETTER + MARK, MARK + LETTER):
            marked = pc.replace_substring_regex(marked, pattern, rf"\1{CUT}\2")
        # A text that isn't cut is an empty one here, whose only piece gets the whole text's ids.
        offsets, codes, pieces = split_coded(pc.if_else(unsafe, pa.scalar("", texts.type), marked), CUT)
        # Most pieces are one pre-token each; known ones need no more than a look-up.
        runs = list(map(self.known.get, pieces))
        for i, r in enumerate(runs):
            if r is None:
                runs[i] = self.ids_of(pieces[i])
        if len(whole):
            codes = codes.astype(np.int64)
            codes[offsets[whole]] = np.arange(len(whole)) + len(runs)
            runs += [self.ids_of(texts[i].as_py()) for i in whole.tolist()]
        starts = np.concatenate([[0], np.cumsum([len(r) // 4 for r in runs], dtype=np.int64)])
        ids, ends = gather(codes, np.frombuffer(b"".join(runs), dtype=np.uint32), starts)
        return ids, ends[offsets]

    def count(self, text: str) -> int:
        """Tokens of one text, by the same kept pre-tokens."""
        if self.bpe.special_at and self.bpe.special_at.search(text):
            return len(self.bpe.encode(text))
        return len(self.ids_of_words(PRETOKEN.findall(text))) // 4


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Ids of each text: ``doc_id, n_tokens, ids`` (little-endian uint32 as binary) and the decoded text's digests.

    Null text counts as empty: no ids, the digest of nothing.  Repeated rows and
    repeated or null doc_ids come out as often as they went in.  No shuffle: one
    pass, memory bounded by a slice of texts and a cache of fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        encoder = BatchEncoder(bpe)
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                ids, at = encoder.encode(texts.slice(lo, hi - lo))
                own = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                plain = [bpe.decode_bytes(x) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(at)),
                        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own]),
                        pa.array([hashlib.sha256(b.decode("utf-8", errors="replace").encode()).hexdigest() for b in plain]),
                        pa.array([len(b) for b in plain], pa.int64()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_bytes"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_bytes long")


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """Ids of each text as an array, for callers that want the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(vocabulary(path))
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                ids, at = encoder.encode(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ``doc_id, ids`` rows; a null list is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bpe.decode(np.array(x or [], dtype=np.int64)) for x in lists], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
