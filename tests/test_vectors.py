import hashlib
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from openends.errors import EncoderConfigError
from openends.functions import text as tx
from openends.functions import vectors as vx
from openends.operators import encode
from openends.operators.encode import EncoderSettings
from openends.sources import cache

# Python workers cannot import test files, so encoders defined here travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def array(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def reference_vector(text, dim):
    counts = Counter(
        int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim
        for t in re.findall(r"\w+", text.lower())
    )
    vector = np.array([counts[i] for i in range(dim)], float)
    return vector / (np.linalg.norm(vector) or 1)


def test_normalize_and_zero_vector(spark):
    assert one(spark, vx.normalize(array(3, 4))) == [0.6, 0.8]
    assert one(spark, vx.normalize(array(0, 0))) == [0.0, 0.0]
    assert one(spark, vx.normalize_floored(array(0, 0))) == [0.0, 0.0]


def test_truncate(spark):
    assert one(spark, vx.truncate(array(3, 4, 12), 2)) == [0.6, 0.8]
    assert one(spark, vx.truncate(array(3, 4), 2)) == [3.0, 4.0]


def test_dot_and_cosine(spark):
    assert one(spark, vx.dot(array(1, 2), array(3, 4))) == 11.0
    assert one(spark, vx.dot(array(1, 2), array(3))) is None
    assert one(spark, vx.cosine(array(0, 0), array(1, 0))) == 0.0


@pytest.mark.parametrize("text", ["", "!!", "One word", "Größe und größe and don't, a_b 12"])
@pytest.mark.parametrize("dim", [7, 64])
def test_hashed_vector_matches_plain_python(spark, text, dim):
    found = one(spark, vx.hashed_vector(F.lit(text), dim))
    assert found == pytest.approx(reference_vector(text, dim).tolist())


def test_content_key_covers_model_instruction_and_dimension(spark):
    text = F.lit("hello")
    expected = hashlib.sha256(b"m|Find: {text}|8|hello").hexdigest()
    assert one(spark, tx.content_key(text, "m", 8, "Find: {text}")) == expected
    keys = {
        one(spark, tx.content_key(text, m, d, i))
        for m in ("m", "n") for d in (8, 9) for i in (None, "{text}!")
    }
    assert len(keys) == 8


def test_instruction_template(spark):
    assert one(spark, tx.apply_instruction(F.lit("x"), "a {text} b {text}")) == "a x b x"
    assert one(spark, tx.apply_instruction(F.lit("x"), None)) == "x"


def python_encoder(dim, calls=None):
    def encode_list(texts):
        return np.stack([reference_vector(t, dim) for t in texts])

    return encode_list


TEXTS = ["the dog ran", "the dog ran", "a cat slept well", "nothing", "the dog ran"]


def text_rows(spark, texts=TEXTS):
    rows = [(f"s{i}", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "segment_id string, row_seq bigint, text string")


def vectors_of(df):
    return {r.segment_id: list(r.vector) for r in df.collect()}


def test_external_encoder_equals_built_in(spark):
    rows = text_rows(spark)
    own = vectors_of(encode.embed_segments(rows, EncoderSettings("m", 16)))
    other = vectors_of(
        encode.embed_segments(rows, EncoderSettings("m", 16, python_encoder(16), batch_size=2))
    )
    assert own.keys() == other.keys()
    for key in own:
        assert own[key] == pytest.approx(other[key], abs=1e-6)


def test_longer_vectors_are_cut_and_normalised(spark):
    settings = EncoderSettings("m", 8, python_encoder(16))
    for vector in vectors_of(encode.embed_segments(text_rows(spark), settings)).values():
        assert len(vector) == 8
        assert np.linalg.norm(vector) == pytest.approx(1, abs=1e-6)


def test_each_distinct_text_is_encoded_once_and_then_cached(spark, tmp_path):
    log = tmp_path / "log"

    def counting(texts):
        with open(log, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return np.stack([reference_vector(t, 16) for t in texts])

    settings = EncoderSettings("m", 16, counting)
    assert len(vectors_of(encode.embed_segments(text_rows(spark), settings))) == len(TEXTS)
    assert sorted(log.read_text().split()) == sorted(" ".join({*TEXTS}).split())
    log.write_text("")
    path = str(tmp_path / "cache")
    first = vectors_of(encode.embed_segments(text_rows(spark), settings, path))
    assert Counter(log.read_text().split("\n"))["the dog ran"] == 1
    more = text_rows(spark, [*TEXTS, "brand new"])
    second = vectors_of(encode.embed_segments(more, settings, path))
    lines = [line for line in log.read_text().split("\n") if line]
    assert sorted(lines) == sorted({*TEXTS, "brand new"})
    assert second["s0"] == pytest.approx(first["s0"]) and len(second) == 6


def test_built_in_encoder_can_be_cached_too(spark, tmp_path):
    settings = EncoderSettings("m", 16)
    path = str(tmp_path / "cache")
    cached = vectors_of(encode.embed_segments(text_rows(spark), settings, path))
    direct = vectors_of(encode.embed_segments(text_rows(spark), settings))
    assert cached["s2"] == pytest.approx(direct["s2"], abs=1e-6)


def test_cache_keeps_latest_vector_and_counts_hits(spark):
    table = spark.createDataFrame(
        [("a", [1.0], 1), ("a", [2.0], 2), ("b", [3.0], 1)], cache.SCHEMA
    )
    new = spark.createDataFrame([("b", [4.0], 3)], cache.SCHEMA)
    merged = {r.key: r.vector for r in cache.upsert(table, new).collect()}
    assert merged == {"a": [2.0], "b": [4.0]}
    wanted = spark.createDataFrame([("a", "x"), ("c", "y")], "key string, text string")
    assert tuple(cache.hit_counts(wanted, table).first()) == (2, 1, 1)
    assert [r.key for r in cache.misses(wanted, table).collect()] == ["c"]
    assert cache.next_batch(table) == 3


def test_retry_then_success(monkeypatch):
    waits = []
    monkeypatch.setattr(encode.time, "sleep", waits.append)
    tries = []

    def flaky(texts):
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError("busy")
        return np.ones((len(texts), 4))

    assert encode.retrying(EncoderSettings("m", 4, flaky))(["a"]).shape == (1, 4)
    assert waits == [1.5, 3.0]


def test_retry_gives_up_and_setup_errors_are_not_retried(monkeypatch):
    monkeypatch.setattr(encode.time, "sleep", lambda s: None)
    tries = []

    def broken(texts):
        tries.append(1)
        raise ConnectionError("down")

    with pytest.raises(ConnectionError):
        encode.retrying(EncoderSettings("m", 4, broken))(["a"])
    assert len(tries) == 5

    def wrong(texts):
        tries.append(1)
        raise EncoderConfigError("no such model")

    with pytest.raises(EncoderConfigError):
        encode.retrying(EncoderSettings("m", 4, wrong))(["a"])
    assert len(tries) == 6


def test_dimension_above_the_encoders_raises():
    with pytest.raises(EncoderConfigError, match="exceeds"):
        encode.retrying(EncoderSettings("m", 8, python_encoder(4)))(["a"])


def test_dimension_check(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "vector array<double>")
    assert tuple(encode.check_dimension(df, 2).first()) == (1, 2, 2, False)


def test_built_in_encoder_needs_no_shuffle(spark):
    df = encode.embed_segments(text_rows(spark), EncoderSettings("m", 16))
    assert "Exchange" not in df._jdf.queryExecution().toString()
