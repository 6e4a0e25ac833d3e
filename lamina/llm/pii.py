"""Personal data by weak supervision.

Base patterns find e-mail and IP addresses, card and phone numbers; their spans
stay whatever follows.  Looser patterns propose more spans.  On every span four
labelers vote yes, no or nothing: its format, a gazetteer (domain endings,
issuers' number ranges and lengths, dialling codes, address blocks), its
checksum or range, and the words around it.  Expectation-maximisation estimates
how far each labeler is to be trusted, from the votes alone, and its posteriors
train a logistic span classifier.  That one doesn't see the votes but the span
and its neighbours: checksum, separators, groups and digits, the characters on
either side, and the word before in one of ``WORDS`` buckets.  It decides on
the proposed spans.

Votes and features of a span are one short pattern string; what is learnt rests
on the counts of these patterns over all documents.  Their number is bounded by
what votes and features can say, and is some thousands in practice.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import zlib
from bisect import bisect, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.shared import text_slices, texts_of

KINDS = ("email", "ip", "card", "phone")
LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# No match begins within a run of digits: where one that starts with the run fails, so would every later start.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Proposals: spelled-out addresses; numbers that lack the plus or the checksum.
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?:at|AT|@) ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:[\[(] ?(?:dot|DOT) ?[\])]|\.) ?[A-Za-z0-9-]{1,63}){1,8}")
NATIONAL = re.compile(r"(?:\+[0-9]{1,3} )?\(?[0-9]{3,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}")
GROUPED = re.compile(r"[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{16}")
ANY = r"[0-9@]|[\[(] ?(at|AT) ?[\])]"
CUES = {
    "email": {"email", "e-mail", "mail", "contact", "write", "courriel", "correo", "schreiben"},
    "ip": {"ip", "host", "server", "address", "login", "adresse", "servidor"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "amex", "payment", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "fax", "mobile", "cell", "telefon", "anruf", "appelez", "llame", "whatsapp"},
}
AGAINST = {"version", "v", "isbn", "doi", "page", "pages", "figure", "table", "order", "invoice", "build", "release"}
#: Fixed values, public: generic domain endings and common national ones.
ENDINGS = set("com org net edu gov mil int info biz name pro mobi app dev io ai co me tv cc xyz online site shop tech cloud ac ad ae ar at au be bg br ca ch cl cn cz de dk ee es eu fi fr gr hk hr hu id ie il in is it jp kr lt lu lv mx my nl no nz pe ph pl pt ro rs ru se sg si sk th tr tw ua uk us vn za".split())
#: Fixed values, public: lowest and highest leading digits of card issuers, and the lengths of their numbers.
ISSUERS = (("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("6011", "6011", (16, 17, 18, 19)), ("644", "649", (16, 17, 18, 19)), ("65", "65", (16, 17, 18, 19)), ("3528", "3589", (16, 17, 18, 19)), ("300", "305", (14, 15, 16, 17, 18, 19)), ("36", "36", (14, 15, 16, 17, 18, 19)), ("38", "39", (16, 17, 18, 19)), ("62", "62", (16, 17, 18, 19)), ("50", "50", (16, 17, 18, 19)), ("56", "58", (16, 17, 18, 19)))
#: Fixed values, public: dialling codes of one and two digits; what begins like the last ones has three.
DIALLED = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
DIALLED_THREE = set("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
#: Buckets of the word before a span.
WORDS = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start; each kind leftmost, without overlap."""
    out = []
    at, a = 0, text.find("@")
    while a >= 0:
        # The local part is the whole run of its characters before the @.
        head = text[max(at, a - 256) : a]
        start = len(head.rstrip(LOCAL))
        if not start and len(head) < a - at:
            head = text[at:a]
            start = len(head.rstrip(LOCAL))
        m = DOMAIN.match(text, a + 1) if start < len(head) else None
        if m:
            out.append((0, a - (len(head) - start), m.end()))
            at = m.end()
        else:
            at = a + 1
        a = text.find("@", at)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    a = text.find("+")
    while a >= 0:
        m = PHONE.match(text, a)
        if m and 8 <= len(digits_of(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
        a = text.find("+", m.end() if m else a + 1)
    return out


def proposals(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the looser patterns that touch no base span and no proposal before them."""
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    out, proposed = [], []  # what is proposed never overlaps, so that its neighbours by place tell
    for kind, pattern in ((0, SPELLED), (2, GROUPED), (3, NATIONAL)):
        for m in pattern.finditer(text):
            s, e = m.span()
            i = int(np.searchsorted(starts, s, side="right"))
            if (i and taken[i - 1][1] > s) or (i < len(taken) and taken[i][0] < e):
                continue
            i = bisect(proposed, (s, e))
            if (i and proposed[i - 1][1] > s) or (i < len(proposed) and proposed[i][0] < e):
                continue
            if kind != 0 and (text[s - 1 : s].isalnum() or text[e : e + 1].isalnum()):
                continue
            out.append((kind, s, e))
            insort(proposed, (s, e))
    return out


def issued(digits: str) -> bool:
    return any(low <= digits[: len(low)] <= high and len(digits) in sizes for low, high, sizes in ISSUERS)


def dialled(digits: str) -> bool:
    return digits[:1] in DIALLED or digits[:2] in DIALLED or (digits[:2] in DIALLED_THREE and len(digits) > 3)


def block_vote(span: str) -> str:
    """Whether an address block is one that hosts have; blocks for special use say no, private ones nothing."""
    try:
        ip = ipaddress.ip_address(span)
    except ValueError:  # zeros in front, say
        return "-"
    return "y" if ip.is_global else "-" if ip.is_private and not ip.is_unspecified else "n"


def kind_of(character: str) -> str:
    """a letter, digit, white space, the text's end, or another character."""
    return "e" if not character else "a" if character.isalpha() else "d" if character.isdigit() else "s" if character.isspace() else "o"


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> str:
    """The span's kind, the labelers' votes (y, n or -: format, gazetteer, check, context), then the classifier's features."""
    span, digits = text[start:end], digits_of(text[start:end])
    apart = set(re.findall(r"[ .()\[\]-]", span))
    form = "y" if strict else "n" if kind == 3 and "(" not in apart and len(apart) > 1 else "-"
    known, check = "-", "-"
    if kind == 0:
        known = "y" if re.split(r"[^A-Za-z0-9-]+", span.rstrip(") ]"))[-1].lower() in ENDINGS else "n"
        check = "y" if any(c.isalpha() for c in span[:2]) else "-"
    elif kind == 1:
        known = block_vote(span)
        check = "n" if text[start - 1 : start] in ("v", "V") or text[end : end + 1] == "." and text[end + 1 : end + 2].isdigit() else "-"
    elif kind == 2:
        known = "y" if issued(digits) else "n"
        check = "y" if luhn(digits) else "n"
    else:
        known = ("y" if dialled(digits) else "n") if span[0] == "+" else "-"
        check = "y" if 8 <= len(digits) <= 15 and len(set(digits)) > 2 else "n"
    before = re.findall(r"[a-z-]+", text[max(0, start - 48) : start].lower()[-48:])
    context = "y" if set(before) & CUES[KINDS[kind]] else "n" if set(before) & AGAINST else "-"
    shape = "b" if apart & {"(", "["} else "x" if len(apart) > 1 else next(iter(apart), "p")
    groups = min(9, len(re.findall(r"[0-9]+", span)))
    word = zlib.crc32(before[-1].encode()) % WORDS if before else WORDS
    return f"{kind}{form}{known}{check}{context}{shape}{groups}{min(len(digits), 20) // 4}{kind_of(text[start - 1 : start] if start else '')}{kind_of(text[end : end + 1])}{word:02d}"


def scan(texts: pa.Array) -> Iterator[tuple[str, list, list]]:
    """Each text with its base spans and, with their patterns, its proposals."""
    some = np.asarray(pc.match_substring_regex(texts, ANY))
    for text, any_here in zip(texts.to_pylist(), some.tolist(), strict=True):
        if not any_here:
            yield text, [], []
            continue
        base = base_spans(text)
        yield text, base, [(k, s, e, votes(text, k, s, e, False)) for k, s, e in proposals(text, base)]


def pattern_counts(docs: DataFrame) -> DataFrame:
    """``pattern, n``: spans of each vote pattern in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, int] = {}
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                for text, base, more in scan(texts.slice(lo, hi - lo)):
                    for p in [votes(text, k, s, e, True) for k, s, e in base] + [x[3] for x in more]:
                        counts[p] = counts.get(p, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"])

    return docs.select("text").mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def reliabilities(patterns: list[str], n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior that a span of each pattern is personal data, by expectation-maximisation for each kind.

    Each labeler has a rate of yes, no and nothing in either class; votes are
    independent given the class.  One pseudo-count of a labeler that is right
    four times in five keeps the classes apart.
    """
    out = np.zeros(len(patterns))
    for kind in range(len(KINDS)):
        rows = [i for i, p in enumerate(patterns) if p[0] == str(kind)]
        if not rows:
            continue
        vote = np.array([["yn-".index(c) for c in patterns[i][1:5]] for i in rows])
        w = n[rows].astype(float)
        post = np.array([0.5 + 0.1 * ((v == 0).sum() - (v == 1).sum()) for v in vote])
        prior = np.array([[0.2, 0.7, 1.0], [0.7, 0.2, 1.0]])  # of votes yes, no, nothing; by class
        for _ in range(rounds):
            logs = np.zeros((2, len(rows)))
            for c, share in ((0, 1 - post), (1, post)):
                logs[c] = np.log((w * share).sum() + 1)
                for j in range(vote.shape[1]):
                    rate = np.bincount(vote[:, j], weights=w * share, minlength=3) + prior[c]
                    logs[c] += np.log(rate / rate.sum())[vote[:, j]]
            new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -40, 40)))
            if np.abs(new - post).max() < 1e-9:
                break
            post = new
        out[rows] = post
    return out


def features(pattern: str) -> list[str]:
    """What the classifier sees of a pattern: all but the votes, save the check, which is a fact of the span."""
    kind = pattern[0]
    seen = [pattern[3], *pattern[5:10], pattern[10:]]
    return [kind, *(f"{kind}{i}{x}" for i, x in enumerate(seen))]


def classify(patterns: list[str], n: np.ndarray, target: np.ndarray, steps: int = 300, decay: float = 1e-2) -> np.ndarray:
    """Probabilities of a logistic classifier fitted to ``target``, weighted by the counts' logarithms."""
    if not patterns:
        return np.empty(0)
    own = [features(p) for p in patterns]
    number = {f: i for i, f in enumerate(sorted({f for x in own for f in x}))}
    at, size = np.array([[number[f] for f in x] for x in own]), len(number)  # as many active features in every row
    w, weight = np.zeros(size), np.log1p(n)
    weight = weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w[at].sum(1), -40, 40)))
        curve, h = weight * np.maximum(p * (1 - p), 1e-3), decay * np.eye(size)
        for i in range(at.shape[1]):
            for j in range(at.shape[1]):
                h += np.bincount(at[:, i] * size + at[:, j], weights=curve, minlength=size * size).reshape(size, size)
        slope = decay * w
        for i in range(at.shape[1]):
            slope += np.bincount(at[:, i], weights=weight * (p - target), minlength=size)
        step = np.linalg.solve(h, slope)
        w -= 0.5 * step
        if np.abs(step).max() < 1e-6:
            break
    return 1 / (1 + np.exp(-np.clip(w[at].sum(1), -40, 40)))


def accepted_patterns(docs: DataFrame) -> set[str]:
    """The patterns of proposals that the classifier takes; learnt from all documents' counts."""
    rows = sorted(pattern_counts(docs).collect())  # as many as votes and features can make, not as documents
    patterns, n = [r.pattern for r in rows], np.array([r.n for r in rows], dtype=float)
    if not patterns:
        return set()
    p = classify(patterns, n, reliabilities(patterns, n))
    return {x for x, y in zip(patterns, p.tolist(), strict=True) if y >= 0.5}


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame) -> DataFrame:
    """Spans of each document; offsets count code points, ends exclusive.

    Null text counts as empty.  Repeated rows come out as often as they went in;
    an empty table gives none.
    """
    good = accepted_patterns(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for lo, hi in text_slices(texts):
                rows = []
                for _, base, more in scan(texts.slice(lo, hi - lo)):
                    kinds = [k for k, _, _ in base]
                    every = sorted(base + [x[:3] for x in more if x[3] in good])
                    rows.append((*(kinds.count(k) for k in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
                columns = [list(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` without a character of any span; spans that overlap go together, with each of their kinds' names once."""
    out, at, i = [], 0, 0
    own = sorted((s, e, k) for k, s, e in spans)
    while i < len(own):
        start, end, kinds = own[i][0], own[i][1], []
        while i < len(own) and (own[i][0] < end or own[i][0] == start):
            end = max(end, own[i][1])
            if own[i][2] not in kinds:
                kinds.append(own[i][2])
            i += 1
        out += [text[at:start], *(f"[{KINDS[k].upper()}]" for k in kinds)]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents with masked texts; null text stays null, n_chars follows the text."""
    good = accepted_patterns(docs)
    own = docs.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, was = texts_of(batch), batch.column(columns.index("text"))
            for lo, hi in text_slices(texts):
                new = [mask(text, base + [x[:3] for x in more if x[3] in good]) for text, base, more in scan(texts.slice(lo, hi - lo))]
                new = pc.if_else(pc.is_valid(was.slice(lo, hi - lo)), pa.array(new, pa.string()), pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(i).slice(lo, hi - lo) for i, c in enumerate(columns)], names=columns)

    out = own.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(own.schema["n_chars"].dataType)) if "n_chars" in columns else out
