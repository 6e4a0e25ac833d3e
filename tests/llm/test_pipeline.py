"""The pipeline's stages against brute force, and what the contract says of it."""

import random

import corpus_pipeline
import pytest

from lamina.llm import pii, registry, toxicity

from .test_near import brute_fingerprint, components


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnpr"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randint(30, 120))) for i in range(500)]
    toxic = {i for i in range(0, 500, 6)}
    rows = [(i, t + " zonkhead grumblefest zonkheads" if i in toxic else t) for i, t in rows]
    item = text(25) + ". " + text(10) + "."
    rows += [(600, rows[1][1]), (601, rows[1][1]), (602, text(50) + " " + item + " " + text(50)), (603, text(40) + " ann.b@mail.example.com " + text(40)), (604, None), (605, ""), (1, rows[1][1]), (7, text(60)), (None, text(60)), (None, text(70))]
    at = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(500)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), rows, toxic


def test_stages(spark, corpus):
    at, rows, toxic = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet").selectExpr("*", "1 as fp", "2.0d as score")
    civil = corpus_pipeline.keep_civil(spark, docs, at)
    assert civil.columns == corpus_pipeline.COLUMNS
    model = toxicity.fit(docs, spark.read.parquet(f"{at}/labels.parquet"))
    scores = {(r.doc_id, i) for i, r in enumerate(toxicity.scored(docs, model).collect()) if r.predicted == 0}
    assert civil.count() == len(scores)
    assert len({r.doc_id for r in civil.collect()} & toxic) <= 0.05 * len(toxic)

    single = corpus_pipeline.keep_one_of_near_copies(spark, docs, at)
    assert single.columns == corpus_pipeline.COLUMNS
    fps = [brute_fingerprint(t or "") for _, t in rows]
    n = len(rows)
    group = components(n, [(a, b) for a in range(n) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    got = [(r.doc_id, r.text) for r in single.collect()]
    assert len(got) == len(set(group))
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    assert sorted(str(i) for i, _ in got) == sorted(str(least.get(g)) for g in set(group))

    shuffled = docs.repartition(3).cache()  # no scan whose rows have places
    assert sorted(str(r.doc_id) for r in corpus_pipeline.keep_one_of_near_copies(spark, shuffled, at).collect()) == sorted(str(i) for i, _ in got)

    clean = corpus_pipeline.keep_uncontaminated(spark, docs, at)
    assert clean.columns == corpus_pipeline.COLUMNS
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, _ in rows if i != 602)

    masked = corpus_pipeline.mask_personal_data(spark, docs, at)
    assert masked.columns == corpus_pipeline.COLUMNS and masked.count() == n
    assert "[EMAIL]" in masked.where("doc_id = 603").first().text


def test_many_dropped_rows_are_joined_by_a_shuffle(spark, corpus, monkeypatch):
    at, rows, _ = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    want = sorted(map(str, corpus_pipeline.keep_one_of_near_copies(spark, docs, at).collect()))
    monkeypatch.setattr(corpus_pipeline, "MOST_ADDRESSES", 0)
    assert sorted(map(str, corpus_pipeline.keep_one_of_near_copies(spark, docs, at).collect())) == want


def test_run(spark, corpus):
    at, rows, toxic = corpus
    out = corpus_pipeline.run(spark, at)
    ids = {r.doc_id for r in out.collect()}
    assert not ids & {600, 601, 602} and 603 in ids and {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, corpus, tmp_path):
    at, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{at}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = registry.queries()
    assert [n.split("_")[0] for n in names][:10] == [f"op{i}" for i in range(1, 11)] and "pipeline" in names
    assert set(registry.oracle_sql()) <= set(names)
    assert pii.KINDS == ("email", "ip", "card", "phone")
