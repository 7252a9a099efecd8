import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from openends.llm import exact_dedup, simhash, votes, vptree
from openends.operators.components import components


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("keep, pick", [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("max_broadcast", [0, 1000])
def test_exact_duplicates_match_brute_force(odd_docs, odd_texts, keep, pick, max_broadcast):
    groups = {}
    for doc_id, text in odd_texts.items():
        groups.setdefault(lower(text), []).append(doc_id)
    got = {
        r.doc_id: tuple(r)[1:]
        for r in exact_dedup.exact_duplicates(
            odd_docs, keep=keep, max_broadcast=max_broadcast
        ).collect()
    }
    expected = {
        i: (pick(ids), len(ids), i == pick(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    assert got == expected


def test_colliding_digests_are_told_apart_by_bytes(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "doc_id long, text string")
    real = F.md5
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: real(F.lit("same")))
    rows = exact_dedup.exact_duplicates(docs).orderBy("doc_id").collect()
    monkeypatch.undo()
    assert [(r.doc_id, r.keep_id, r.group_size) for r in rows] == [(1, 1, 2), (2, 1, 2), (3, 3, 1), (4, 4, 1)]


def test_a_hot_text_leaves_one_row_per_task(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = exact_dedup.exact_duplicates(docs)
    assert rows.filter("kept").count() == 1 and rows.filter("group_size = 20000").count() == 20_000


def test_empty_tables(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert vptree.simhash_groups(no_docs).count() == 0
    assert simhash.edit_digest(no_docs).count() == 0
    with pytest.raises(ValueError):
        exact_dedup.exact_duplicates(no_docs, keep="any")


def brute_fingerprint(text, size=3):
    words = [w for w in __import__("re").split("[ \t\n\x0b\f\r]+", lower(text)) if w]
    if not words:
        return 0
    terms = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(t.encode(), seed=42) for t in terms]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_groups_match_brute_force(odd_docs, odd_texts):
    prints = {i: brute_fingerprint(t) for i, t in odd_texts.items()}
    groups = brute_components(prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in vptree.simhash_groups(odd_docs).collect()}
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in prints}


def test_the_near_copies_of_the_pipeline_are_fingerprint_groups(spark, odd_docs, odd_texts, sf_dir):
    groups = brute_components({i: brute_fingerprint(t) for i, t in odd_texts.items()}, 2)
    kept = [r.doc_id for r in corpus_pipeline.near_copies(spark, odd_docs, sf_dir).collect()]
    assert sorted(kept) == sorted(set(groups.values()))


def planted(rng, n):
    """Fingerprints with chains and dense balls of near ones."""
    found = [rng.getrandbits(64) for _ in range(n)]
    for start in found[:20]:
        at = start
        for _ in range(rng.randint(1, 30)):
            at ^= 1 << rng.randrange(64)
            at ^= 1 << rng.randrange(64)
            found.append(at)
    for start in found[20:23]:
        found += [start ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a)]
    return sorted(set(found))


@pytest.mark.parametrize("per_shard", [50, 400, 10**6])
def test_vantage_point_shards_lose_no_link(spark, per_shard):
    prints = planted(random.Random(per_shard), 1_500)
    node = {i: p for i, p in enumerate(prints)}
    expected = {i: c for i, c in brute_components(node, 2).items()}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in node.items()]
    df = spark.createDataFrame(signed, "node long, fingerprint long")
    got = {r.node: r.component for r in vptree.near_groups(df, 2, per_shard).collect()}
    linked = {i: c for i, c in expected.items() if list(expected.values()).count(c) > 1}
    assert got == linked


def test_the_tree_deals_every_fingerprint_home_once_and_splits():
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 63, 5_000, dtype=np.int64).view(np.uint64)
    tree = vptree.fit_tree(points[:400], 16, 2)
    shards = list(vptree.place(tree, points, 2))
    home = np.concatenate([rows[at_home] for _, rows, at_home in shards])
    assert sorted(home) == list(range(5_000))
    assert len(shards) >= 12 and max(h.sum() for _, _, h in shards) < 1_500


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("x"), (F.col("id") + 1).alias("y"))
    rows = components(links.unionByName(links), "x", "y")
    assert rows.filter("component = 0").count() == rows.count() == 301


def test_votes_of_weighted_terms(spark):
    terms = spark.createDataFrame(
        [(1, [5, 1], [1, 2]), (2, [], []), (3, [-1], [3])], "doc_id long, h array<long>, w array<long>"
    )
    got = {r.doc_id: r.fingerprint for r in votes.fingerprints(terms, "h", "w").collect()}
    assert got == {1: 1, 2: 0, 3: -1}


def test_edited_texts_match_brute_force(odd_docs, odd_texts):
    ids = list(odd_texts)
    expected = {}
    for n, i in enumerate(ids):
        text, after = odd_texts[i], odd_texts[ids[(n + 1) % len(ids)]]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        expected[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest())
    rows = simhash.edit_digest(odd_docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == expected
    prints = {r.doc_id: r.fingerprint for r in rows}
    by_text = {}
    for i, text in odd_texts.items():
        by_text.setdefault(text, set()).add(prints[i])
    assert all(len(p) == 1 for p in by_text.values())
    for n, r in enumerate(sorted(rows, key=lambda r: r.doc_id)):
        after = prints[ids[(n + 1) % len(ids)]]
        apart = (int(r.fingerprint, 16) ^ int(after, 16)).bit_count()
        assert r.near_next == pytest.approx(1 - apart / 64)
        own = (int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).bit_count()
        assert r.near_edited == pytest.approx(1 - own / 64)
    near = {
        i: sum((int(p, 16) ^ int(prints[i], 16)).bit_count() <= 3 for p in prints.values()) - 1
        for i in prints
    }
    assert {r.doc_id: r.n_near for r in rows} == near


@pytest.mark.parametrize("radius, blocks", [(0, 1), (2, 3), (3, 5), (3, 6)])
def test_block_tables_find_all_pairs_once(spark, radius, blocks):
    prints = planted(random.Random(9), 300)[:1_500]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    asked = df.filter(F.pmod("fingerprint", F.lit(7)) == 0)
    got = [(r.query, r.fingerprint) for r in simhash.near_fingerprints(asked, df, radius, blocks).collect()]
    mask = (1 << 64) - 1
    expected = {
        (a, b) for a in signed if a % 7 == 0 for b in signed
        if ((a ^ b) & mask).bit_count() <= radius
    }
    assert len(got) == len(set(got)) and set(got) == expected
    with pytest.raises(ValueError):
        simhash.near_fingerprints(df, df, 3, 3)
