import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from openends.llm import linear, packing, quality, toxicity
from openends.llm.common import hashed_sample, tokenizer_path, unique
from openends.llm.queries import QUERIES

INSULTS = ["grumbleface", "snotbag", "dimwhit"]


def clean_words(rng, n):
    return [rng.choice("river stone cloud house garden letter winter people music paper".split())
            + rng.choice(["", "s", "es", ","]) for _ in range(n)]


@pytest.fixture(scope="module")
def labelled(spark):
    """Documents of which a third are toxic and a quarter are shouting junk, nearly all labelled."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(600):
        words = clean_words(rng, rng.randint(20, 200))
        toxic, junk = i % 3 == 0, i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        text = " ".join(words)
        if junk:
            text = " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "en", f"src{i % 7}", len(text)))
        if i % 10:
            labels.append((i, int(not junk), int(toxic)))
    labels += [(5, None, None), (10_000, 1, 1), (None, 0, 0), labels[0]]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_marginals_match_all_paths():
    rng = np.random.default_rng(4)
    emission, transition = rng.normal(size=(3, 6)), rng.normal(size=(2, 2))
    lengths = np.array([6, 3, 1])
    got, moves = toxicity.marginals(emission, lengths, transition)
    expected_moves = np.zeros((2, 2))
    for i, n in enumerate(lengths):
        total, toxic = 0.0, np.zeros(6)
        counted = np.zeros((2, 2))
        for path in np.ndindex(*[2] * n):
            score = sum(emission[i, t] for t in range(n) if path[t])
            score += sum(transition[path[t], path[t + 1]] for t in range(n - 1))
            weight = np.exp(score)
            total += weight
            for t in range(n):
                toxic[t] += weight * path[t]
            for t in range(n - 1):
                counted[path[t], path[t + 1]] += weight
        assert np.allclose(got[i], toxic / total)
        expected_moves += counted / total
    assert np.allclose(moves, expected_moves)


def test_toxic_documents_are_found_and_spans_point_at_them(labelled):
    docs, labels = labelled
    rows = toxicity.toxicity(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) == 600
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        for span in r.spans:
            words = r.text[span.start : span.end].lower().replace("!", "").replace(",", "").split()
            assert set(words) <= set(INSULTS)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == int(r.doc_id % 3 == 0) for r in held) / len(held)
    assert right >= 0.97


def test_held_out_labels_change_nothing(labelled):
    docs, labels = labelled
    other = labels.withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    got = [
        {r.doc_id: r.score for r in toxicity.toxicity(docs, marks).collect()} for marks in (labels, other)
    ]
    assert got[0] == got[1]


def test_ids_and_sites_do_not_move_a_toxicity_score(spark, labelled):
    docs, labels = labelled
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    extra = spark.createDataFrame([(5_000 + i, "stone snotbag river") for i in range(3)], "doc_id long, text string")
    rows = toxicity.toxicity(moved.select("doc_id", "text").unionByName(extra), labels).collect()
    same = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert {r.doc_id: r.score for r in rows if r.doc_id < 5_000} == same
    assert len({r.score for r in rows if r.doc_id >= 5_000}) == 1


def test_quality_keeps_clean_and_rejects_junk(labelled):
    docs, labels = labelled
    rows = quality.quality(docs, labels).collect()
    assert {r.doc_id for r in rows if not r.kept} == set(range(0, 600, 4))


def test_sparse_sites_shrink_towards_all(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(400):
        site = "bad" if i < 150 else "good" if i < 398 else f"new{i}"
        junk = rng.random() < (0.8 if site == "bad" else 0.02)
        text = " ".join(clean_words(rng, 40))
        docs.append((i, text.upper().replace(" ", "!! ") if junk else text, "en", site))
        labels.append((i, int(not junk)))
    rows = quality.quality(
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
    ).collect()
    share = {r.host: r.path_share for r in rows}
    overall = sum(r.evidence for r in rows) / len(rows)
    assert share["bad"] < 0.4 and share["good"] > 0.9
    assert abs(share["new398"] - overall) < 0.12


def test_quality_shares_match_plain_arithmetic(labelled):
    docs, labels = labelled
    rows = quality.quality(docs, labels).collect()
    for r in rows:
        assert 0 < r.host_share < 1 and 0 < r.path_share < 1
        logit = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
        overall = sum(x.evidence for x in rows) / len(rows)
        expected = linear.sigmoid(np.array(logit(r.evidence) + logit(r.path_share) - logit(overall)))
        assert r.score == pytest.approx(float(expected), abs=1e-6)


def test_odd_documents_are_judged(spark, odd_docs, odd_texts, labelled):
    _, labels = labelled
    none = labels.limit(0)
    for marks in (labels, none):
        judged = quality.quality(odd_docs, marks).collect()
        scored = toxicity.toxicity(odd_docs, marks).collect()
        assert {r.doc_id for r in judged} == {r.doc_id for r in scored} == set(odd_texts)
    assert all(r.kept for r in judged) and all(r.score == 0 for r in scored)


def test_nothing_to_judge(no_docs, labelled):
    assert quality.quality(no_docs, labelled[1]).count() == 0
    assert toxicity.toxicity(no_docs, labelled[1]).count() == 0


def test_logistic_regression_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 2 * x[:, 1] > 0).astype(float)
    w = linear.fit(x, y)
    assert ((linear.scores(x, w) > 0) == (y == 1)).mean() > 0.98


def test_stages_take_effect_and_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        kept = {r.doc_id: r.text or "" for r in after.collect()}
        assert len(kept) == after.count() and set(kept.items()) <= set(before.items())
        if name == "exact_dedup":
            assert len(kept) == len({corpus_lower(t) for t in before.values()})
        if name == "quality":
            bad = {i for i in before if i in labels and labels[i].quality == 0}
            assert not bad & set(kept) and len(kept) > 0.7 * len(before)
        sizes.append(len(kept))
        before, docs = kept, spark.createDataFrame(after.collect(), after.schema)
    assert sizes == sorted(sizes, reverse=True)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.collect()} == set(before)


def corpus_lower(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def test_the_run_is_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    by_piece = {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in rows}
    assert by_piece == {(r.doc_id, r.piece): (r.length, r.ids_crc32) for r in docs.collect()}


def test_stages_take_odd_documents(spark, odd_docs, odd_texts, sf_dir):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(odd_texts)


def test_unique_keeps_the_greatest_of_a_key(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (1, None, "y"), (None, "c", "z")], "doc_id int, text string, o string")
    assert [tuple(r) for r in unique(rows).collect()] == [(1, "b", "x")]


def test_unique_takes_the_text_first_and_any_column(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(
        [(1, "aa", "zz top", 1), (1, "zz", "aa bottom", 2), (2, "b", "x", 3)], "doc_id int, lang string, text string, n int"
    ).withColumn("a.b", F.create_map(F.lit("k"), "n"))
    got = {r.doc_id: (r.text, r["a.b"]) for r in unique(rows).collect()}
    assert got == {1: ("zz top", {"k": 1}), 2: ("x", {"k": 3})}


def test_stages_take_names_with_dots_and_empty_tables(spark, odd_docs, no_docs, sf_dir):
    from pyspark.sql import functions as F

    docs = odd_docs.withColumn("a.b", F.lit(1))
    out = corpus_pipeline.exact_copies(spark, docs, sf_dir)
    assert out.columns == docs.columns and out.count()
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_every_operator_has_its_query(spark, sf_dir):
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    path = tokenizer_path("word_bpe_49k.json")
    whole = packing.pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, 2048)
    got = QUERIES["op6_packing"](spark, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, whole.select(key).collect()))


def test_samples_are_bounded_and_depend_on_keys_only(spark):
    rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
    chosen = [
        {r.doc_id for r in hashed_sample(rows.repartition(n), "doc_id", 1_000).collect()} for n in (2, 5)
    ]
    assert chosen[0] == chosen[1] and 850 < len(chosen[0]) < 1_150
    assert hashed_sample(rows, "doc_id", 50_000).count() == 50_000


def test_chains_of_a_text_are_one_chain():
    rng = np.random.default_rng(4)
    names = [f"w{i}" for i in range(50)]
    weights = {f"=w{i}": float(x) for i, x in enumerate(rng.normal(size=50))}
    field = toxicity.Field(weights, -0.3, np.array([[1.5, -1.5], [-1.5, 1.5]]))
    docs = [[str(w) for w in rng.choice(names, n)] for n in (127, 0, 128, 129, 700, 1, 256, 3_000)]
    emissions = toxicity.Emissions(field)
    got = toxicity.document_evidence(emissions, field, docs)[1]
    for words, p in zip(docs, got, strict=True):
        if words:
            scores = np.array([[emissions[w] for w in words]])
            whole = toxicity.marginals(scores, np.array([len(words)]), field.transition)[0][0]
            assert np.allclose(p, whole)


def test_spans_are_offsets_of_the_text_itself(spark, monkeypatch):
    field = toxicity.Field({"=bad": 20.0}, -10.0, np.zeros((2, 2)))
    field.calibration = toxicity.linear.fit(np.random.default_rng(0).normal(size=(9, 6)), np.arange(9) % 2.0, ridge=0.1)
    monkeypatch.setattr(toxicity, "fit_field", lambda *_: field)
    text = "\u0130\u0130 \u0130x BAD words"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    [row] = toxicity.toxicity(df, labels).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["BAD"]
