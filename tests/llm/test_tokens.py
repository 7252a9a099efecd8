import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from openends.llm import bpe, coder, packing, token_files
from openends.llm.common import tokenizer_path

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"
ENCODERS = {name: bpe.Encoder(tokenizer_path(name), bpe.packed_ids) for name in (WORDS, BYTES)}
HARD = [
    "", " ", "a  b", "x \n y", "\n\nfoo\n", "İstanbul ΣΑΣ ΟΔΟΣ. ", "it's we're I'LL 'S", "a\x1cb c\x1dd",
    "<|endoftext|>foo <|startoftext|> x<|endoftext|>", "é ́x", "日本語テキスト。ですね", "x" * 1000,
    "ab" * 500 + ".," * 300, "1234567890" * 50, "ﬁ ½ ² Ⅷ", " a　b c", "😀👍🏽" * 100,
    " lead", "trail ", "tab\tx\t\ty", "x   y   z", "\r\n\r\n z", "<|endoftext|>" * 30, "αβγ" * 100 + "Σ",
]


def library_ids(name, text):
    return ENCODERS[name].library.encode(text, add_special_tokens=False).ids


def ids_of(name, text):
    return np.frombuffer(b"".join(ENCODERS[name].values(text)), dtype=np.uint32).tolist()


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_hard_texts_encode_as_the_library_does(name):
    for text in HARD:
        assert ids_of(name, text) == library_ids(name, text), text[:40]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abceinorsthé'.,! \n\t xX1日ß<|>", max_size=400))
def test_any_text_encodes_as_the_library_does(text):
    for name in (WORDS, BYTES):
        assert ids_of(name, text) == library_ids(name, text)


def test_long_runs_are_joined_exactly():
    rng = random.Random(2)
    for name in (WORDS, BYTES):
        for _ in range(40):
            alphabet = rng.choice(["ab", "inthesaor", "thérêç", "=-*", "aaab"])
            run = "".join(rng.choice(alphabet) for _ in range(rng.randint(130, 4_000)))
            assert ids_of(name, run) == library_ids(name, run)


def test_windows_grow_until_both_sides_agree():
    calls = []
    ids = {"a": 1, "b": 2}

    def again(part, at_end):
        calls.append(len(part))
        return part if len(part) > 5 else [9, *part, 9]

    joined = bpe.join_tree([[1] * 8, [2] * 8, [3] * 4], again)
    assert joined == [1] * 8 + [2] * 8 + [3] * 4 and max(calls) > 5 and ids


def test_digests_of_odd_documents(odd_docs, odd_texts):
    path = tokenizer_path(WORDS)
    got = {r.doc_id: tuple(r)[1:] for r in bpe.encode_digests(odd_docs, path).collect()}
    expected = {}
    for i, text in odd_texts.items():
        ids = library_ids(WORDS, text)
        decoded = ENCODERS[WORDS].library.decode(ids, skip_special_tokens=False)
        expected[i] = (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
    assert got == expected


def test_documents_decode_again(odd_docs, odd_texts):
    path = tokenizer_path(BYTES)
    back = bpe.decode_documents(bpe.encode_documents(odd_docs, path), path)
    assert {r.doc_id: r.text for r in back.collect()} == odd_texts


def test_the_cache_stays_bounded():
    encode = bpe.Encoder(tokenizer_path(WORDS), bpe.packed_ids, cached=50)
    text = " ".join(f"word{i} and" for i in range(500))
    assert b"".join(encode.values(text)) == b"".join(ENCODERS[WORDS].values(text))
    assert len(encode) <= 50 and len(encode.older) <= 50


@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 20_000])
@pytest.mark.parametrize("distinct", [1, 2, 300, 50_000])
def test_coded_ids_come_back(n, distinct):
    ids = np.random.default_rng(n + distinct).integers(0, distinct, n).astype(np.uint32)
    assert np.array_equal(coder.decode(coder.encode(ids)), ids)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 2), max_size=200))
def test_any_ids_come_back(ids):
    assert coder.decode(coder.encode(np.array(ids, dtype=np.uint32))).tolist() == ids


def test_repetition_is_predicted_and_damage_is_found():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 50_000, 700).astype(np.uint32)
    once, often = len(coder.encode(text)), len(coder.encode(np.tile(text, 5)))
    assert often < 1.6 * once
    data = bytearray(coder.encode(np.tile(text, 12)))
    data[-30] ^= 4
    with pytest.raises(coder.CorruptBlock):
        coder.decode(bytes(data))
    with pytest.raises(coder.CorruptBlock):
        coder.decode(b"other" + bytes(data))


def test_token_files_of_odd_documents(spark, odd_docs, odd_texts, monkeypatch):
    expected, start = {}, 0
    for i, text in odd_texts.items():
        packed = np.array([*library_ids(BYTES, text), 0], dtype=np.uint32)
        expected[i] = (start, len(packed), zlib.crc32(packed.tobytes()))
        start += len(packed)
    rows = token_files.round_trip(odd_docs, tokenizer_path(BYTES)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected


def test_no_documents_no_rows(no_docs):
    assert token_files.round_trip(no_docs, tokenizer_path(BYTES)).count() == 0
    assert bpe.encode_digests(no_docs, tokenizer_path(WORDS)).count() == 0
    assert packing.pack(no_docs, tokenizer_path(WORDS)).count() == 0


def sequences(patterns):
    return sum(p.count for p in patterns)


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=25))
def test_plans_hold_every_piece(histogram):
    patterns = packing.plan(histogram, 40)
    held = {}
    for lengths, count in patterns:
        assert sum(lengths) <= 40 and count > 0
        for size in lengths:
            held[size] = held.get(size, 0) + count
    assert held == histogram
    assert sequences(patterns) * 40 >= sum(s * n for s, n in histogram.items())


def optimum(items, capacity):
    """Fewest sequences, by trying all ways."""
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= items[i]}:
            left = list(rooms)
            left[left.index(room)] -= items[i]
            place(i + 1, left)
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_dominance_never_costs_a_sequence(items):
    """What is fixed, and the best packing of the rest, is a best packing of all."""
    histogram = {s: items.count(s) for s in items}
    counts = packing.Counts(histogram)
    fixed = packing.reduce_by_dominance(counts, 20)
    rest = sorted((s for s, n in counts.left.items() for _ in range(n)), reverse=True)
    whole = optimum(sorted(items, reverse=True), 20)
    assert sequences(fixed) + (optimum(rest, 20) if rest else 0) == whole


def test_packed_documents_lie_side_by_side(odd_docs, odd_texts):
    rows = packing.pack(odd_docs, tokenizer_path(WORDS), 100).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(odd_texts)
    for i, text in odd_texts.items():
        ids = np.array([*library_ids(WORDS, text), 0], dtype=np.uint32)
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 100)))
        for r in own:
            part = ids[r.piece * 100 : (r.piece + 1) * 100]
            assert (r.start, r.length, r.ids_crc32) == (r.piece * 100, len(part), zlib.crc32(part.tobytes()))
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= 1.1 * total / 100 + 1


def test_ranks_within_a_hot_group(spark):
    rows = spark.range(5_000).selectExpr("id AS doc_id", "IF(id % 5 = 0, id % 7, 3) AS length")
    got = packing.numbered(rows, "length", ["doc_id"], "doc_id").collect()
    by_length = {}
    for r in got:
        by_length.setdefault(r.length, []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by_length.values())


def column(name, texts, end=7):
    ids, lengths = bpe.column_ids(ENCODERS[name], pa.array(texts, pa.string()), end)
    assert lengths.sum() == len(ids)
    return [part.tolist() for part in np.split(ids, np.cumsum(lengths)[:-1])]


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_columns_encode_as_the_library_does(name):
    spaces = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x2029, 0x202F, 0x3000]]
    rng = random.Random(5)
    glued = ["".join(rng.choice(["a", "Bc", "é", ".", "'s", ")\".", "²", "<|endoftext|>", " ", *spaces]) for _ in range(30)) for _ in range(800)]
    texts = [*HARD, *glued, *(f"{a} {b}" for a in HARD for b in HARD)]
    assert column(name, texts) == [[*library_ids(name, t), 7] for t in texts]
    assert column(name, ["b a", "", "a b"])[1] == [7]


def test_new_words_are_encoded_many_at_a_time():
    """Before, each word that was not in the cache was a call of the library."""
    encode = bpe.Encoder(tokenizer_path(BYTES), bpe.packed_ids, cached=3_000)
    calls, library = [], encode.library

    class Counted:
        def encode(self, text, **kwargs):
            calls.append(text)
            return library.encode(text, **kwargs)

        def encode_batch_fast(self, texts, **kwargs):
            calls.extend(texts)
            return library.encode_batch_fast(texts, **kwargs)

    encode.library = Counted()
    texts = [f"w{i}x, w{i + 1}y" + " and" * 50 for i in range(4_000)]
    ids, _ = bpe.column_ids(encode, pa.array(texts[:100]), 0)
    single = sum(" " not in c.strip() for c in calls)
    assert single <= 105 and len(calls) <= 110
    many, _ = bpe.column_ids(encode, pa.array(texts), 0)
    assert many.tolist() == [i for t in texts for i in [*library_ids(BYTES, t), 0]]
    assert len(encode) <= 3_000 and len(encode.older) <= 3_000


def test_carries_pass_through_words():
    """Likely and unlikely ids by turns; the range coder's words must take carries over block ends too."""
    rng = np.random.default_rng(3)
    ids = np.where(rng.random(300_000) < 0.02, rng.integers(0, 200_000, 300_000), 5).astype(np.uint32)
    data = coder.encode(ids)
    assert np.array_equal(coder.decode(data), ids) and len(data) < 0.25 * len(ids) + 5 * 4_000


def test_a_step_moves_one_word_out_at_most():
    """Before, bytes moved out one by one, up to four rounds over the lanes a step."""
    ids = np.random.default_rng(1).integers(0, 50_000, 8 * coder.BLOCK).astype(np.uint32)
    data = coder.encode(ids)
    total, lanes, _, size = struct.unpack_from("<QIII", data, 4)
    at = 4 + struct.calcsize("<QIII") + size
    for _ in range(lanes):
        count, used, _ = struct.unpack_from("<III", data, at)
        assert used % 4 == 0 and used // 4 <= count + 1  # whole words, one a step at most
        at += 12 + used
    assert at == len(data) and total == len(ids)


def test_a_file_ends_within_a_batch(spark, odd_docs, odd_texts, monkeypatch):
    expected, start = {}, 0
    for i, text in odd_texts.items():
        packed = np.array([*library_ids(BYTES, text), 0], dtype=np.uint32)
        expected[i] = (start, len(packed), zlib.crc32(packed.tobytes()))
        start += len(packed)
    monkeypatch.setattr(token_files, "SLICE", 50)
    sizes = [len(b) for b in token_files.slices(pa.RecordBatch.from_pydict({"text": ["a" * 30] * 10 + ["b" * 500, ""]}))]
    assert sum(sizes) == 12 and len(sizes) > 5
    assert list(token_files.slices(pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())}))) == []
    rows = token_files.round_trip(odd_docs.coalesce(1), tokenizer_path(BYTES)).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == expected
