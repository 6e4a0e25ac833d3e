"""Chats, shards, leaks, personal data and toxicity on small fixtures."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import chat, decontaminate, pii, shards, toxicity

from .conftest import ODD, large

TURN = "conv_id long, turn long, role string, text string"


def test_escape_is_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<s>", "\\", "\\\\</s>", "<\\s>", "[\\INST]", "a < b [c]", "<<SYS>>x<</SYS>>", "<|im_start|>", "<|reserved_special_token_0|>", "<|EOT|>", "", "\n", "é\\n漢", "<</s>s>", "[[INST]INST]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>|<\|[A-Za-z0-9_]+\|>", r.e), r.e


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] x \\"), (1, 2, None, None), (1, 3, "assistant", ""), (2, 5, "assistant", "only\n"), (3, 1, "user", "a"), (3, 1, "user", "a"), (3, 1, "system", "</s>"), (None, 0, "user", "lost"), (None, 3, "assistant", "found"), (4, 0, "we\nird</s>", "<s>")]
    rows += [(9, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(70)]
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.chain(spark.createDataFrame(rows, TURN)))).collect()}
    assert set(got) == {1, 2, 3, 4, 9, None}
    for c, r in got.items():
        own = sorted([x for x in rows if x[0] == c], key=lambda x: (x[1], x[2] or "", x[3] or ""))
        told = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        learnt = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(own), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert chat.digests(chat.formatted(chat.chain(spark.createDataFrame([], TURN)))).count() == 0


def test_mask_covers_the_text(spark):
    rows = [(1, 0, "user", "héllo"), (1, 1, "assistant", "wörld </s>")]
    r = chat.formatted(chat.chain(spark.createDataFrame(rows, TURN))).first()
    assert sum(x.skip + x.take + x.rest for x in r.loss_runs) == len(r.formatted)
    assert r.formatted.count("</s>") == 2 and r.formatted.count("<s>") == 2


def brute_paths(nodes, keep):
    parent = {n: p for n, p, _ in nodes}
    score = {n: s or 0.0 for n, _, s in nodes}
    parent = {n: p if p in parent and p != n else None for n, p in parent.items()}
    for n in sorted(parent):  # the smallest of a circle loses its parent
        seen, at = [n], parent[n]
        while at is not None and at not in seen:
            seen.append(at)
            at = parent[at]
        if at == n and n == min(seen):
            parent[n] = None
    leaves = set(parent) - {p for p in parent.values() if p is not None}
    found = {}
    for leaf in leaves:
        path = [leaf]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        found[leaf] = (-sum(score[n] for n in path), leaf, path[::-1])
    return [p for _, _, p in sorted(found.values())[:keep]]


@pytest.mark.parametrize("keep", [1, 3])
def test_reply_trees(spark, keep):
    r, rows, want = random.Random(keep), [], {}
    for c in range(12):
        nodes = [(i, None if i == 0 else r.randrange(max(0, i - r.randint(1, 30)), i), r.choice([None, 0.5, 1.0, -2.0])) for i in range(r.randint(1, 60))]
        if c == 3:
            nodes.append((500, 499, 50.0))  # its parent is missing
        if c == 4:
            nodes += [(600, 600, 9.0), (601, 600, 1.0)]  # a reply to itself
        if c == 5:
            nodes += [(700 + i, 700 + (i + 3) % 7, 1.0) for i in range(7)] + [(800, 703, 2.0), (801, 800, None)]  # a circle, and what hangs on it
        if c == 6:
            nodes = [(5, 6, 1.0), (6, 5, 1.0)]
        want[c] = brute_paths(nodes, keep)
        rows += [(c, n, p, "user", f"{n}", s) for n, p, s in nodes]
    df = spark.createDataFrame(rows, "conv_id long, node int, parent int, role string, text string, score double")
    got = {}
    for x in chat.chosen_paths(chat.keyed(df), keep).collect():
        got.setdefault((x.conv, x.path), []).append((x.depth, x.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {(c, i + 1): p for c, ps in want.items() for i, p in enumerate(ps)}


def test_repeated_nodes_count_once(spark):
    kind = "conv_id long, node int, parent int, role string, text string, score double, conv int, path string"
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 0.0, 7, "x") for i in range(8)]
    again = [*rows, rows[3], rows[3], (1, 4, 3, "user", "t4 too", 0.0, 7, "x"), (1, None, 2, "user", "no node", 5.0, 7, "x")]
    one = chat.formatted(spark.createDataFrame(rows, kind)).select("conv_id", "formatted").collect()
    assert chat.formatted(spark.createDataFrame(again, kind)).select("conv_id", "formatted").collect() == one


def test_long_conversations_and_texts(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "word " * (20_000 if i == 7 else 3)) for i in range(1500)] + [(2, 0, "assistant", "x" * 300_000)]
    df = spark.createDataFrame([(*x, "clash", 1.0) for x in rows], TURN + ", formatted string, score double")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.chain(df))).collect()}
    assert got[1].n_turns == 1500 and got[2].loss_chars == 300_000
    assert got[1].loss_sha256 == hashlib.sha256("".join(x[3] for x in rows[:1500] if x[2] == "assistant").encode()).hexdigest()


def test_shards(spark, make):
    rows = [(i, "x" * (i % 50)) for i in range(2000)] + [(5, None), (5, "again"), (None, "é"), (None, None)] + [(7, "copy")] * 300
    got = shards.sharded(make(rows), 40).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(20 <= len({x.doc_id for x in got if x.shard == s}) <= 90 for s in range(40))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    assert shards.sharded(make([]), 40).count() == 0


def test_descent_is_that_of_plain_python(spark):
    tree = shards.tree_of([1.0 + i % 3 for i in range(23)], added=2)
    keys = list(range(300))
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.s for r in shards.placed(df, "k", tree, "s").collect()}
    # Every hash that some row could need, from Spark; the choices in plain Python.
    hashes = {}

    def ask(level, parent, children):
        for c in range(children):
            for r in df.select("k", F.xxhash64("k", F.lit(level), parent, F.lit(c)).alias("h")).collect():
                hashes[r.k, level, str(parent), c] = ((r.h % 2**64) >> 11) + 0.5

    ask("region", F.lit(0), len(tree))
    for g, region in enumerate(tree):
        ask("rack", F.lit(g), len(region))
        for q, rack in enumerate(region):
            ask("shard", F.struct(F.lit(g), F.lit(q)), len(rack))

    def least(k, level, parent, weights):
        draws = [(-np.log(hashes[k, level, str(parent), c] / 2**53) / w, c) for c, w in enumerate(weights) if w > 0]
        return min(draws)[1]

    for k in keys:
        g = least(k, "region", F.lit(0), [sum(w for rack in region for _, w in rack) for region in tree])
        q = least(k, "rack", F.lit(g), [sum(w for _, w in rack) for rack in tree[g]])
        assert got[k] == tree[g][q][least(k, "shard", F.struct(F.lit(g), F.lit(q)), [w for _, w in tree[g][q]])][0]


def test_weights_move_only_what_changes(spark):
    df = spark.range(6000).withColumnRenamed("id", "k")
    weights = [1.0] * 43
    heavier = [*weights]
    heavier[7] = 3.0
    out = df
    for name, tree in {"a": shards.tree_of(weights), "b": shards.tree_of(heavier), "c": shards.tree_of([*weights, 1.0], added=1), "d": shards.tree_of([*weights, 1.0, 2.0], added=2)}.items():
        out = shards.placed(out, "k", tree, name)
    rows = out.collect()
    region, rack = (lambda s: s // 20), (lambda s: s // 5)
    # Region 0 and in it rack 1 hold the change: rows come into them, or move within them.
    assert all(r.a == r.b or region(r.b) == 0 for r in rows)
    assert all(r.a == r.b or region(r.a) != 0 or rack(r.b) == 1 for r in rows)
    assert all(r.a == r.b or rack(r.a) != 1 or r.b == 7 for r in rows)
    assert all(r.a == r.c or r.c == 43 for r in rows) and all(r.c == r.d or r.d == 44 for r in rows)
    assert abs(sum(r.b == 7 for r in rows) / len(rows) - 3 / 45) < 0.02 and abs(sum(r.d == 44 for r in rows) / len(rows) - 2 / 46) < 0.02
    lighter = [0.0 if i == 2 else 1.0 for i in range(43)]
    gone = shards.placed(shards.placed(df, "k", shards.tree_of(weights), "a"), "k", shards.tree_of(lighter), "b").collect()
    assert all(r.b != 2 and (r.a == r.b or region(r.a) == 0) for r in gone)
    with pytest.raises(ValueError, match="weight"):
        shards.placed(df, "k", shards.tree_of([0.0, 0.0]), "a")


def passage(r, n):
    return " ".join(r.choice("abcdefghij") + r.choice("klmnopqrst") + str(r.randrange(30)) for _ in range(n))


def test_leaks(spark, make):
    r = random.Random(8)
    items = [(i, passage(r, 12) + ". " + passage(r, r.randint(2, 30)) + ".") for i in range(60)] + [(90, None), (91, ""), (92, "..."), (93, "what is?"), (0, None)]
    docs = [(i, passage(r, r.choice([3, 40, 900]))) for i in range(60)]
    docs += [(100 + i, passage(r, 200) + " " + items[i][1] + " " + passage(r, 500)) for i in range(20)]
    docs += [(200, items[5][1].upper()), (201, items[5][1] + " " + items[6][1]), (202, " ".join(items[7][1].split()[:8])), (203, None), (204, "")]
    long = next(i for i, t in items if len(t.split()) >= 36)
    edited = items[long][1].split()
    edited[len(edited) // 2] = "changed"  # takes five of its shingles
    docs += [(205, passage(r, 90) + " " + " ".join(edited))]
    docs += [(300, docs[61][1]), (300, docs[61][1]), (None, items[3][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(x.doc_id), x.item_id) for x in decontaminate.leaks(make(docs), bench).collect())
    want = []
    for d, t in docs:
        shown = decontaminate.shingles(decontaminate.words_of(t or ""))
        for i, text in items:
            whole = decontaminate.shingles(decontaminate.words_of(text or ""))
            if text and len(decontaminate.words_of(text)) >= 5 and len(whole & shown) / len(whole) >= 0.8:
                want.append((str(d), i))
    assert got == sorted(want) and ("205", long) in got
    kept = sorted(str(x.doc_id) for x in decontaminate.clean(make(docs), bench, ["doc_id", "text"]).collect())
    assert kept == sorted(str(d) for d, _ in docs if str(d) not in {g[0] for g in got})
    assert decontaminate.leaks(make([]), bench).count() == 0
    assert decontaminate.leaks(make(docs), bench.where("false")).count() == 0


def test_leaks_with_an_edited_or_cut_answer(spark, make):
    r = random.Random(11)
    items = [(i, passage(r, 30) + ". " + passage(r, 1 + i % 6) + ".") for i in range(24)]
    docs = []
    for i, t in items:
        words = t.split()
        docs += [(i, passage(r, 40) + " " + " ".join([*words[:-1], "changed."]) + " " + passage(r, 40)), (100 + i, " ".join(words[:-1])), (200 + i, " ".join(words[: len(words) // 2]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(make(docs), bench).collect()
    assert sorted((x.doc_id, x.item_id) for x in got) == sorted((k + i, i) for i, _ in items for k in (0, 100))
    # Where the answer is one shingle, an edit leaves nothing of it.
    assert {x.answer_overlap for x in got if x.doc_id % 100 % 6 < 5} == {0.0} and all(x.question_overlap > 0.8 for x in got)
    assert sorted(x.doc_id for x in decontaminate.clean(make(docs), bench, ["doc_id", "text"]).collect()) == [200 + i for i, _ in items]


def test_wand_is_exact(monkeypatch):
    r = random.Random(9)
    items = [(i, passage(r, r.randint(5, 40))) for i in range(100)]
    index = decontaminate.Index(items, block=8)
    passages = [decontaminate.words_of(passage(r, 60)) for _ in range(50)] + [decontaminate.words_of(items[i][1] + " " + passage(r, 20)) for i in range(0, 100, 3)]
    lists = [sorted({index.terms[w] for w in p if w in index.terms}) for p in passages]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    for share in (0.2, 0.7):
        got = {(p, i): s for p, i, s in index.search(np.array([t for x in lists for t in x], dtype=np.int64), at, share)}
        for p, terms in enumerate(lists):
            score = np.zeros(len(index.items))
            for t in terms:
                score[index.item[index.at[t] : index.at[t + 1]]] += index.share[index.at[t] : index.at[t + 1]]
            for i in range(len(score)):
                if abs(score[i] - share) > 1e-9:
                    assert (score[i] > share) == ((p, i) in got)
                    assert (p, i) not in got or abs(got[p, i] - score[i]) < 1e-12


def test_several_rounds(spark, make, monkeypatch):
    monkeypatch.setattr(decontaminate, "ROUND_BYTES", 700)
    r = random.Random(10)
    items = [(i, passage(r, 20)) for i in range(30)]
    docs = [(i, passage(r, 30) + " " + items[i][1]) for i in range(30)] + [(99, passage(r, 50))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((x.doc_id, x.item_id) for x in decontaminate.leaks(make(docs), bench).collect()) == [(i, i) for i in range(30)]
    assert [x.doc_id for x in decontaminate.clean(make(docs), bench, ["doc_id", "text"]).collect()] == [99]


def test_case_of_other_alphabets(spark, make):
    texts = ["Ο Οδυσσέας και ο Πρίαμος είναι ήρωες των επών της αρχαίας Ελλάδος ως γνωστόν", "İstanbul ve İzmir büyük şehirlerdir ve İstanbul daha da büyüktür bilindiği gibi", "Die Straße ist groß und weiß wie der Fluß im Süden des Landes heißt"]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = [(10 * i + k, "some words before " + t) for i, x in enumerate(texts) for k, t in enumerate((x, x.upper(), x.lower(), x.swapcase()))]
    got = sorted((x.doc_id, x.item_id) for x in decontaminate.leaks(make(docs), bench).collect())
    assert got == [(d, d // 10) for d, _ in docs]


def test_long_items_and_punctuation(spark, make):
    r = random.Random(12)
    items = [(0, passage(r, 3000)), (1, passage(r, 12)), (2, passage(r, 300)), (3, passage(r, 70))]
    docs = [(i, passage(r, 700) + " " + t.replace(" ", " ... ") + " " + passage(r, 700)) for i, t in items] + [(9, passage(r, 5000))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((x.doc_id, x.item_id) for x in decontaminate.leaks(make(docs), bench.selectExpr("*", "1 as score")).collect()) == [(i, i) for i in range(4)]


def test_rounds_score_alike(spark, make, monkeypatch):
    r = random.Random(13)
    items = [(i, passage(r, r.randint(6, 90))) for i in range(40)]
    docs = make([(i, passage(r, 30) + " " + t) for i, t in items])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted((x.doc_id, x.item_id, round(x.score, 9)) for x in decontaminate.leaks(docs, bench).collect())
    monkeypatch.setattr(decontaminate, "ROUND_BYTES", 1500)
    assert sorted((x.doc_id, x.item_id, round(x.score, 9)) for x in decontaminate.leaks(docs, bench).collect()) == whole


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(d[::-1])) % 10 == 0
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, (p, good) in enumerate(kinds) for m in re.finditer(p, text) if good(m.group())]


def test_base_spans():
    r = random.Random(3)
    parts = [*"ab1290@.@.-+ (%_)", "4111111111111111", "1.2.3.4", "a@b.c", "255", "256", "+1 555", "٣", "é", "00000"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 24)))
        assert pii.base_spans(text) == brute_spans(text), text


PERSONAL = ["write to ann.b@mail.example.com now", "call +1 (555) 201-9988 today", "card 4111 1111 1111 1111 ok", "host 10.20.30.40 up", "+1 (269) 555-3296 4524132264652876 both", "ann [at] example [dot] com", "tel (555) 201-9988", "nothing here", "version 1.2.3", None, "", "x@y", "999.1.1.1", "٣٣٣ 🙂 a@b.cd"]


def test_proposals_never_overlap():
    for n in (8, 9, 20, 300):
        text = "; ".join(["1234 5678 9012 3456"] * n)  # fails Luhn
        assert pii.base_spans(text) == []
        found = pii.proposals(text, [])
        assert [k for k, _, _ in found] == [2] * n, n
    r = random.Random(4)
    parts = ["1234 5678 9012 3456", "(555) 201-9988", "a [at] b [dot] com", "555-201-9988", "x", "12"]
    for _ in range(300):
        text = " ".join(r.choice(parts) for _ in range(40))
        spans = sorted((s, e) for _, s, e in pii.proposals(text, []))
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)), text


def test_masking_leaves_nothing_of_a_span():
    assert pii.mask("a@b.4111 1111 1111 1111 z", pii.base_spans("a@b.4111 1111 1111 1111 z")) == "[EMAIL][CARD] z"
    r = random.Random(6)
    parts = [*"ab1290@.@.-+ (%_)", "4111111111111111", "4111 1111 1111 1111", "1.2.3.4", "a@b.c", "255", "+1 555 201 9988"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 24)))
        spans = pii.base_spans(text)
        spans += [x for x in pii.proposals(text, spans)]
        hidden = set().union(*(range(s, e) for _, s, e in spans))
        kept = "".join(c for i, c in enumerate(text) if i not in hidden)
        assert re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "", pii.mask(text, spans)) == kept, text


def test_classifier_sees_no_votes():
    assert pii.features("0yyyyp12ao07") == pii.features("0nnynp12ao07")
    assert pii.issued("4111111111111111") and not pii.issued("9111111111111111") and pii.dialled("15552019988") and pii.dialled("353861234567") and not pii.dialled("999")
    target = np.array([1.0, 0.0])
    p = pii.classify(["2-yy-p42aa10", "2-nn-p42aa10"], np.array([50.0, 50.0]), target)
    assert p[0] > 0.5 > p[1]
    assert len(pii.classify([], np.empty(0), np.empty(0))) == 0


def test_find(spark, make):
    rows = [(i, t) for i, t in enumerate(PERSONAL)] + [(100 + i, t) for i, t in enumerate(ODD)] + [(0, PERSONAL[0]), (None, PERSONAL[1])]
    got = pii.find(make(rows)).collect()
    assert len(got) == len(rows)
    have = sorted((str(x.doc_id), x.n_email, x.n_ip, x.n_card, x.n_phone, x.base_sha256) for x in got)
    want = []
    for i, t in rows:
        base = brute_spans(t or "")
        n = [sum(k == j for k, _, _ in base) for j in range(4)]
        want.append((str(i), *n, hashlib.sha256(",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base).encode()).hexdigest()))
    assert have == sorted(want)
    for x in got:
        if x.doc_id is not None and x.doc_id < 100:
            base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in brute_spans(PERSONAL[x.doc_id] or ""))
            assert {b for b in base.split(",") if b} <= set(x.spans.split(","))
    both = next(x for x in got if x.doc_id == 4)
    assert both.spans == "card:18:34,phone:0:17"  # neither is a base match: together they have too many digits
    assert pii.find(make([])).count() == 0


def test_redact(spark, make):
    out = {r.doc_id: r for r in pii.redact(make(list(enumerate(PERSONAL))), ["doc_id", "text", "lang", "n_chars"]).collect()}
    assert out[0].text == "write to [EMAIL] now" and out[0].n_chars == len(out[0].text)
    assert out[1].text == "call [PHONE] today" and out[2].text == "card [CARD] ok" and out[3].text == "host [IP] up"
    assert out[4].text == "[PHONE] [CARD] both"
    assert out[7].text == PERSONAL[7] and out[9].text is None and out[9].n_chars is None


def test_labelers_are_weighed():
    # Two labelers agree on what is true, one votes at random.
    r = random.Random(2)
    votes, truth = {}, {}
    for _ in range(4000):
        yes = r.random() < 0.5
        vote = [("y" if yes else "n") if r.random() < q else ("n" if yes else "y") for q in (0.95, 0.9, 0.9, 0.5)]
        p = "0" + "".join(vote) + "p0"
        votes[p] = votes.get(p, 0) + 1
        truth.setdefault(p, []).append(yes)
    names = list(votes)
    post = pii.reliabilities(names, np.array([votes[p] for p in names], float))
    good = sum(votes[p] for p, q in zip(names, post, strict=True) if (q >= 0.5) == (np.mean(truth[p]) >= 0.5))
    assert good / 4000 > 0.97
    assert pii.reliabilities([], np.empty(0)).tolist() == []


def test_toxicity(spark, make):
    r = random.Random(1)
    mild = [f"w{c}{d}" for c in "abcdefgh" for d in "klmnop"]
    bad = ["grumblefest", "zonkhead", "vexlump"]
    rows, labels = [], []
    for i in range(1600):
        words = [r.choice(mild) for _ in range(r.randint(20, 80))]
        toxic = r.random() < 0.2
        if toxic:
            for _ in range(max(1, len(words) // 25)):
                stem = r.choice(bad)
                words.insert(r.randrange(len(words)), stem + r.choice(["", "s", "ed", "x" + str(i % 7)]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame([*labels, (3, 1, None), (None, 0, 1), (99_999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = [*rows, (50_000, None), (50_001, ""), (50_002, "word " * 20_000), (None, "wak"), (3, rows[3][1])]
    got = toxicity.toxicity(make(docs), table).collect()
    assert len(got) == len(docs)
    truth = {i: t for i, _, t in labels}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got if x.doc_id is not None)
    assert np.mean([x.predicted == truth[x.doc_id] for x in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got)
    assert {x.predicted for x in got if x.doc_id in (50_000, 50_001)} == {0}
    model = toxicity.fit(make(docs), table)
    unseen = " ".join([*mild[:20], "zonkheadery"])
    score = model.score(large([unseen, " ".join(mild[:20])]))
    assert score[0] > score[1]


def naive_grams(word):
    bare = f"<{word.strip('.,;:!?\"()[]')}>"
    out = []
    for n in range(1, max(toxicity.GRAMS) + 1):
        for i in range(len(bare) - n + 1):
            if n in toxicity.GRAMS or (i == 0 and len(bare) == n):
                h = 0
                for k in range(n):
                    h = (h * 0x9E3779B97F4A7C15 + ord(bare[i + k]) + k + 1) % 2**64
                    h ^= h >> 29
                out.append((h * 0xBF58476D1CE4E5B9 % 2**64 >> 40) % toxicity.BUCKETS)
    return out


def naive_words(text):
    return sorted(set(text.lower().split()))


def naive_train(texts, y, least, steps, rate, shrink, decay):
    """The same training with loops over texts, words and n-grams."""
    bags = [[naive_grams(w) for w in naive_words(t)] for t in texts]
    seen = {}
    for bag in bags:
        for g in {g for word in bag for g in word}:
            seen[g] = seen.get(g, 0) + 1
    active = sorted(g for g, n in seen.items() if n >= least)
    rng = np.random.default_rng(1)
    e = {g: v for g, v in zip(active, rng.normal(0, 0.01, (len(active), toxicity.WIDTH)), strict=True)}
    w, b = rng.normal(0, 0.5, (toxicity.WIDTH, 2)), np.log(np.mean(y) / (1 - np.mean(y)))
    zero = np.zeros(toxicity.WIDTH)
    me, ve, mw, vw, mb, vb = {g: zero for g in active}, {g: zero for g in active}, w * 0, w * 0, 0.0, 0.0
    for t in range(1, steps + 1):
        u = w[:, 1] - w[:, 0]
        hidden = [np.mean([np.mean([e.get(g, zero) for g in word], axis=0) for word in bag], axis=0) if bag else zero for bag in bags]
        delta = [(1 / (1 + np.exp(-(toxicity.SCALE * h @ u + b))) - k) / len(y) for h, k in zip(hidden, y, strict=True)]
        ge = {g: decay * e[g] for g in active}
        for bag, d in zip(bags, delta, strict=True):
            for word in bag:
                for g in word:
                    if g in e:
                        ge[g] = ge[g] + toxicity.SCALE * d * u / len(bag) / len(word)
        gu = toxicity.SCALE * sum((d * h for d, h in zip(delta, hidden, strict=True)), zero)
        gw, gb = np.outer(gu, [-1.0, 1.0]) + decay * w, sum(delta)
        lr = rate * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        for g in active:
            me[g], ve[g] = 0.9 * me[g] + 0.1 * ge[g], 0.999 * ve[g] + 0.001 * ge[g] ** 2
            e[g] = e[g] - lr * 0.1 * me[g] / (np.sqrt(ve[g]) + 1e-8)
            e[g] = e[g] * max(0.0, 1 - shrink / max(np.sqrt((e[g] ** 2).sum()), 1e-12))
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w, b = w - lr * mw / (np.sqrt(vw) + 1e-8), b - lr * mb / (np.sqrt(vb) + 1e-8)
    return {g: e[g] @ (w[:, 1] - w[:, 0]) for g in active}, b


def test_toxicity_is_that_of_plain_loops():
    r = random.Random(5)
    words = ["zonk", "zonked", "zonks", "mild", "milder", "a", "of", "the", "(the)", "é", "漢字", "thing,", "Things!"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 9))) for _ in range(14)]
    y = np.array([float("zonk" in t) for t in texts])
    assert all(sorted(toxicity.grams([w])[0].tolist()) == sorted(naive_grams(w)) for w in [*words, "", "x", "longer-word"])
    how = {"least": 2, "steps": 4, "rate": 0.1, "shrink": 1e-3, "decay": 3e-4}
    model = toxicity.train(texts, y, y.mean(), **how)
    gram, bias = naive_train(texts, y, **how)
    assert np.allclose([model.gram[g] for g in gram], list(gram.values()), rtol=1e-5, atol=1e-9) and abs(model.bias - bias) < 1e-9
    assert np.flatnonzero(model.gram).tolist() == sorted(g for g, v in gram.items() if v)
    new = [*texts, "unseen words zonkery", "", "zonk zonk zonk", "\t lead"]
    mean = lambda xs: float(np.mean(xs)) if xs else 0.0
    want = [1 / (1 + np.exp(-(toxicity.SCALE * mean([mean([gram.get(g, 0.0) for g in naive_grams(w)]) for w in naive_words(t)]) + bias))) for t in new]
    assert np.allclose(model.score(large(new)), want, rtol=1e-4)


def test_a_labelled_id_of_many_texts_counts_once(spark, make):
    rows = [(i, f"word{i} text") for i in range(40)] + [(7, f"copy {k % 5} of seven") for k in range(300)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    kept, toxicity.train = toxicity.train, lambda texts, y, prior, **k: seen.append((texts, y)) or kept(texts, y, prior, **k)
    try:
        toxicity.fit(make(rows), labels)
    finally:
        toxicity.train = kept
    assert len(seen[0][0]) == len(seen[0][1]) == len([i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2])


def test_toxicity_without_labels(spark, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [x.predicted for x in toxicity.toxicity(make([(1, "text")]), none).collect()] == [0]
    assert toxicity.toxicity(make([]), none).count() == 0


def test_grams_cover_short_words():
    ids, at = toxicity.grams(["", "a", "ab", "abcdef"])
    assert (np.diff(at) >= 1).all() and len(ids) == at[-1]
