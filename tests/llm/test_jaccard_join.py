"""The set-similarity join against plain sets and union-find."""

import random

import numpy as np
import pytest

from openends.llm import jaccard_join
from openends.llm.jaccard_join import jaccard_groups


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_groups(texts, percent=80):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}
    ids = sorted(texts)
    for i in ids:
        for j in ids:
            if j < i and sets[i] and sets[j] and root[i] != root[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    low, high = sorted((root[i], root[j]))
                    root = {k: low if r == high else r for k, r in root.items()}
    return {i: (len(sets[i]), root[i]) for i in texts}


def groups(docs, **more):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(docs, **more).collect()}


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(parts)


@pytest.fixture
def tiny(monkeypatch):
    """Every limit so small that all ways are taken: hot tokens, many shards, several blocks."""
    limits = {"FREQUENT": 3, "SHARD_TOKENS": 200, "BLOCK_SETS": 5, "BLOCK_TOKENS": 2_000}
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)


def family(rng, size, members, least, most):
    words = [f"f{rng.randrange(10**6)}w{rng.randrange(2_000)}" for _ in range(size)]
    out = []
    for n in range(members):
        copy, at = list(words), rng.randrange(size - most)
        copy[at : at + rng.randint(least, most)] = [f"c{n}x{i}x{rng.random()}" for i in range(most)]
        out.append(" ".join(copy))
    return out


def mixed_texts(rng):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rng, 200, 30, 13, 24) + family(rng, 60, 12, 1, 3) + family(rng, 120, 20, 5, 16)
    for n in range(25):
        own = " ".join(f"o{n}x{i}" for i in range(rng.randint(5, 60)))
        texts.append(passage + " " + own)
    texts += [f"short {n % 4}" for n in range(9)] + ["", None, " \n", "a b c d e", "A b c d E", "a b c d e f"]
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_plain_union_find(spark, seed):
    texts = mixed_texts(random.Random(seed))
    assert groups(frame(spark, texts)) == plain_groups(texts)


def test_small_limits_change_nothing(spark, tiny):
    texts = mixed_texts(random.Random(3))
    assert groups(frame(spark, texts, 5)) == plain_groups(texts)


@pytest.mark.parametrize("percent", [50, 95])
def test_other_limits(spark, percent):
    texts = mixed_texts(random.Random(4))
    assert groups(frame(spark, texts), percent=percent) == plain_groups(texts, percent)


def test_the_limit_is_exact(spark):
    rows = {}
    for n in (10, 20, 100, 400, 1_000):
        for common in (n * 8 // 10, n * 8 // 10 - 1, n * 8 // 10 + 1):
            words = [f"v{len(rows)}x{i}" for i in range(n + 4)]
            rows[len(rows)] = " ".join(words)
            rows[len(rows)] = " ".join(words[: common + 4])
    assert groups(frame(spark, rows)) == plain_groups(rows)


def test_odd_documents(spark, odd_docs, odd_texts, no_docs):
    assert groups(odd_docs) == plain_groups(odd_texts)
    assert jaccard_groups(no_docs).count() == 0


def test_repeated_lines_count_once(spark):
    rng = random.Random(11)
    texts = {}
    for n in range(6):
        words = [f"w{rng.randrange(5_000)}" for _ in range(300)]
        texts[2 * n], texts[2 * n + 1] = " ".join(words), " ".join(words + 25 * [f"line{n}x{i}" for i in range(8)])
    assert {i: c for i, (_, c) in groups(frame(spark, texts)).items()} == {i: i - i % 2 for i in range(12)}


def test_links_that_leave_tasks_grow_with_the_family_only(spark, monkeypatch):
    texts = dict(enumerate(family(random.Random(6), 150, 400, 1, 2)))
    found = []
    links_of = jaccard_join.links_of

    def counted(*args):
        out = links_of(*args)
        found.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "links_of", counted)
    assert {c for _, c in groups(frame(spark, texts)).values()} == {0}
    assert sum(found) < 2 * len(texts)


def test_long_texts_are_cut_at_white_space_only(monkeypatch):
    from openends.llm.word_ids import chunks

    rng = random.Random(8)
    data = b"".join(bytes([rng.choice(b"abc \t\n\x0b")]) for _ in range(3_000)) + b"x" * 500
    for size in (1, 7, 100, 10_000):
        assert [w for c in chunks(data, size) for w in c.split()] == data.split()


def test_prefix_flags_and_set_names():
    tokens = jaccard_join.shingle_set(np.arange(1, 60, dtype=np.uint64), 5)
    assert len(tokens) == 55 and (np.diff(tokens) > 0).all() and not (tokens & np.uint64(7)).any()
    assert jaccard_join.set_id(tokens)[1] & 0xFFFFFFFF == 55
    assert jaccard_join.set_id(tokens[::-1].copy()) == jaccard_join.set_id(tokens)
    assert jaccard_join._prefix(55, 80) == 12 and jaccard_join._prefix(1, 80) == 1
