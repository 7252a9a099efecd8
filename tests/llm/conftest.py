import random

import pytest

CLASHES = (
    "kept fingerprint component_id keep_id n digest length rank score path host h w part shape "
    "node piece start offset ids next_id edited evidence good quality toxic votes query table "
    "key level run line content original reply_to thread depth up url label total sha"
).split()


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta run of the to and in it is was".split()) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with every oddity: nulls, empties, long texts, ties, repeated rows."""
    rng = random.Random(5)
    texts = [None, "", " \n ", "one", "two words", "Ünïcode ẞ 日本 😀", "A B C d", "a b c D"]
    texts += [words(rng, rng.randint(3, 60)) for _ in range(30)]
    texts += [texts[10]] * 5 + [texts[11].upper()] * 3 + [texts[12] + " x"] * 2
    texts.append(words(rng, 4_000))  # a long text
    texts.append("x" * 5_000)  # and one without a break
    texts.append(texts[-2])
    rows = [(i * 3, t, "en", "src0" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (6, None, None, None, None), (None, "no id", "en", "src1", 5)]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(
        odd_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    return docs.withColumns({c: F.lit("clash") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def odd_texts(odd_rows):
    """What the operators see: one text per id, no null ids, null as empty."""
    found = {}
    for doc_id, text, *_ in odd_rows:
        if doc_id is not None:
            found[doc_id] = max(found.get(doc_id, ""), text or "")
    return dict(sorted(found.items()))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame(
        [], "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
