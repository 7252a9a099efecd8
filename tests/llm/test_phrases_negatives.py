"""Collocations and hard negatives against plain counterparts."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from openends.llm import hard_negatives, phrases


def plain_collocations(rows, least, covered=50, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang, data = "und" if lang is None else lang, (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", data):
            words = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = set()
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [f[q] for q in f if len(q) == 3 and f[q] >= least and len(p) == 2 and p in (q[:2], q[1:])]
            if not any(100 * x >= covered * a for x in longer):
                found.append((-score, -a, b" ".join(p), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.add((lang, rank, phrase.decode(), a, l, r, total[lang], -score))
    return out


def collocations(df, **more):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return {tuple(r) for r in phrases.collocations(df, **more).select(columns).collect()}


def sayings(rng, n):
    words = ["the", "The", "sea", "É", "éa", "red", "wine", "日本", "x", "of", "new", "york", "city", "\x1c", "a\x00b"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "; ", "!?"]
    made = []
    for i in range(n):
        parts = [rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 40))]
        parts += [rng.choice(["new york city ", "red wine ", "new york. city "])] * rng.randint(0, 3)
        made.append((i, "".join(parts), rng.choice(["en", "en", "de", None, ""])))
    return made


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_plain_counts(spark, monkeypatch, small):
    if small:  # many flushes, texts cut in the middle, more shards
        monkeypatch.setattr(phrases, "SHARD_BYTES", 500)
    rows = sayings(random.Random(small), 300)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    expected = plain_collocations([(lang, text) for _, text, lang in rows], 10)
    assert len(expected) > 40 and collocations(df) == expected
    assert collocations(df, top=3) == {r for r in expected if r[1] <= 3}


def test_texts_that_are_counted_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice("ab c. d e, f".split()) for _ in range(5_000))
    whole = phrases.Counter(3)
    words = text.encode().translate(phrases._CLEAN).replace(b"\xff", b" \xff ").split()
    whole.add("en", whole.vocabulary.ids(words), 0)
    cut = phrases.Counter(3)
    for at in range(0, len(words), 37):
        before = words[max(0, at - 2) : at]
        cut.add("en", cut.vocabulary.ids(before + words[at : at + 37]), len(before))
    assert list(whole.runs(1)) == list(cut.runs(1))


def test_keys_too_wide_for_a_long(spark, monkeypatch):
    monkeypatch.setattr(phrases, "KEY_BITS", 1)
    rows = sayings(random.Random(9), 100)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert collocations(df, least=4) == plain_collocations([(lang, text) for _, text, lang in rows], 4)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(10**14 + 7, 3 * 10**14 + 1, 2 * 10**14 + 9), (999_999_999_999_999, 999_999_999_999_999, 10**14), (10, 10, 10)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [x[0] for x in df.select(phrases._exact_score("a", "l", "r")).collect()]
    assert got == [10**6 * a * a // (left * right) for a, left, right in rows]


def test_odd_documents_and_empty_tables(spark, odd_docs, odd_texts, no_docs):
    assert collocations(no_docs) == set()
    langs = {r.doc_id: r.lang for r in odd_docs.filter("lang is not null").collect()}
    expected = plain_collocations([(langs.get(i), t) for i, t in odd_texts.items()], 5)
    assert collocations(odd_docs, least=5) == expected
    empty = spark.createDataFrame([(1, None, None), (2, "", "en")], "doc_id long, text string, lang string")
    assert collocations(empty) == set()


def plain_negatives(rows, step, count=5, keep=lambda i: i % 10 == 0):
    table = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v):
            continue
        table[i] = (label, [int(np.floor(256 * float(x))) for x in v])
    out = set()
    for a, (label, v) in table.items():
        if not keep(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, (_, w) in table.items() if i != a)
        same = [(s, i) for s, i in scored if table[i][0] == label][:count]
        for s, p in same:
            other = [(t, i) for t, i in scored if table[i][0] != label and 80 * -s <= 100 * -t <= 100 * -s][:count]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(other, 1)}
    return out


@pytest.mark.parametrize("kind", ["spread", "clustered", "equal"])
def test_negatives_equal_all_scores(spark, monkeypatch, kind):
    for name, value in {"SEED_ROWS": 20, "CELL_ROWS": 10, "BLOCK_ROWS": 7, "BLOCK_ANCHORS": 3}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(len(kind))
    centres = rng.normal(size=(6, 8)) * 3
    rows = []
    for i in range(400):
        noise = rng.normal(size=8) * (0.2 if kind == "clustered" else 1.0)
        v = (centres[rng.integers(6)] if kind == "clustered" else 0) + noise
        v = np.round(v * (0 if kind == "equal" and i % 3 else 1), 3) + (0.5 if kind == "equal" else 0)
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(4)) if i % 50 else 9))
    rows += [(None, rows[0][1], 1), (1_000, None, 1), (1_010, [float("nan")] * 8, 1), (1_020, [None] + [1.0] * 7, 1)]
    rows += [(1_030, [float("inf")] + [1.0] * 7, 2), (1_040, [1.0] * 7, 2), (1_050, [1.0] * 8, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cell", F.lit("x"))
    got = hard_negatives.hard_negatives(df.repartition(4), F.col("vec_id") % 10 == 0, dim=8)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain_negatives(rows, 10)
    assert expected and {tuple(r) for r in got.select(columns).collect()} == expected


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, [1.0] * 64, 1), (100, [1.0] * 64, 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 100 == 0).count() == 0


def test_the_heap_visits_cells_by_falling_bounds():
    rng = np.random.default_rng(3)
    rows = rng.integers(-50, 50, (500, 8))
    c1, c2 = (hard_negatives.codebook(h.astype(float), 6) for h in (rows[:, :4], rows[:, 4:]))
    (a, d1), (b, d2) = hard_negatives.nearest(rows[:, :4], c1), hard_negatives.nearest(rows[:, 4:], c2)
    radii = [np.array([d[c == i].max(initial=0) for i in range(6)]) for c, d in ((a, d1), (b, d2))]
    sizes = np.zeros((6, 6), int)
    np.add.at(sizes, (a, b), 1)
    index = hard_negatives.Index((c1, c2), tuple(radii), sizes)
    anchor = rng.integers(-50, 50, 8)
    found = list(index.cells(anchor))
    assert [x[0] for x in found] == sorted((x[0] for x in found), reverse=True)
    assert sum(x[2] for x in found) == 500 and len({x[1] for x in found}) == len(found) == (sizes > 0).sum()
    bound = {cell: b for b, cell, _ in found}
    assert all(rows[i] @ anchor <= bound[a[i] * 6 + b[i]] for i in range(500))
