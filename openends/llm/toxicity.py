"""Toxic spans and document scores by a linear-chain conditional random field.

Documents carry labels, words do not, so words of labelled documents are labelled first: a
word of a toxic document is toxic if it, or a beginning of it, is clearly tied to the
toxic label. The field learns from these words and their order; its marginals, by the
forward-backward algorithm, give the spans and, added up, the score of a document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from openends.llm import linear
from openends.llm.common import hashed_sample, texts, unique

# The field is fitted on about this many labelled documents of each label, of at most
# this many characters, chosen by hash. Every document is scored, and its whole text.
MAX_TRAIN = 2_000
MAX_TRAIN_CHARS = 10_000
# Words of a chain; a text is tagged in consecutive chains that pass their messages on.
CHAIN = 128
# Beginnings of a word that are features beside the word itself.
BEGINNINGS = (4, 5, 6, 7)
# Standard errors by which a feature's log-odds must exceed SEED_ODDS to label words.
SEED_ERRORS, SEED_ODDS = 1.96, 1.5
ROUNDS, STEP, RIDGE = 50, 0.3, 1e-4
CACHED = 400_000


def features(word: str) -> list[str]:
    """The word without marks around it, in lower case, and its beginnings."""
    core = word.strip(".,;:!?\"'()[]*$%&#|")
    return ["=" + core, *[core[:n] for n in BEGINNINGS if len(core) >= n]] if core else []


def seeds(docs: list[set[str]], labels: list[int]) -> set[str]:
    """Features whose documents are toxic much more often than others, beyond chance."""
    n1 = sum(labels)
    n0 = len(labels) - n1
    with_one: Counter = Counter()
    with_zero: Counter = Counter()
    for found, label in zip(docs, labels, strict=True):
        (with_one if label else with_zero).update(found)
    chosen = set()
    for feature, d1 in with_one.items():
        d0 = with_zero[feature]
        odds = math.log((d1 + 0.5) / (n1 + 1)) - math.log((d0 + 0.5) / (n0 + 1))
        error = math.sqrt(1 / (d1 + 0.5) + 1 / (d0 + 0.5))
        if odds - SEED_ERRORS * error >= SEED_ODDS:
            chosen.add(feature)
    return chosen


def _normalised(a: np.ndarray) -> np.ndarray:
    return a / a.sum(axis=-1, keepdims=True)


def messages(
    emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, per_doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What the chains before and after tell the first and the last word of each chain [chains, 2].

    `per_doc` is the number of consecutive chains of every document. A chain is the product of
    its steps, so a message crosses it in one multiplication.
    """
    n, width = emission.shape
    move = np.exp(transition)
    before, after = np.ones((n, 2)), np.ones((n, 2))
    last = np.cumsum(per_doc)
    first = last - per_doc
    several = np.repeat(per_doc > 1, per_doc)
    if not several.any():
        return before, after
    potential = np.ones((width, int(several.sum()), 2))
    potential[:, :, 1] = np.exp(np.clip(emission[several].T, -30, 30))
    through = np.eye(2) * potential[0][:, None, :]
    for t in range(1, width):
        step = (through @ move) * potential[t][:, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        through = np.where((t < lengths[several])[:, None, None], step, through)
    whole = np.empty((n, 2, 2))
    whole[several] = through
    for k in range(1, int(per_doc.max())):
        at = first[per_doc > k] + k
        passed = (before[at - 1][:, None, :] @ whole[at - 1])[:, 0]
        before[at] = _normalised(passed @ move)
        at = last[per_doc > k] - 1 - k
        passed = (whole[at + 1] @ after[at + 1][:, :, None])[:, :, 0]
        after[at] = _normalised(passed @ move.T)
    return before, after


def marginals(
    emission: np.ndarray,
    lengths: np.ndarray,
    transition: np.ndarray,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of every word [chains, words], and expected transitions [2, 2] summed.

    `emission` is the score of the toxic state per word (the other state scores 0),
    `transition` the scores [from, to]. Forward and backward messages are scaled at each step;
    `before` and `after` are those of the neighbouring chains, if there are any.
    """
    n, width = emission.shape
    potential = np.ones((width, n, 2))
    potential[:, :, 1] = np.exp(np.clip(emission.T, -30, 30))
    move = np.exp(transition)
    forward = np.empty((width, n, 2))
    forward[0] = _normalised(potential[0] if before is None else before * potential[0])
    for t in range(1, width):
        forward[t] = _normalised((forward[t - 1] @ move) * potential[t])
    end = np.ones((n, 2)) if after is None else after
    backward = end
    toxic = np.zeros((width, n))
    moves = np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        inside = (t < lengths)[:, None]
        if t + 1 < width:
            follows = (t + 1 < lengths)[:, None]
            message = potential[t + 1] * backward
            joint = forward[t][:, :, None] * move[None] * message[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            moves += (joint * follows[:, :, None]).sum(axis=0)
            backward = np.where(follows, _normalised(message @ move.T), end)
        toxic[t] = np.where(inside[:, 0], _normalised(forward[t] * backward)[:, 1], 0.0)
    return toxic.T, moves


class Field:
    """Weights of the features and transitions, and of the document score."""

    def __init__(self, weights: dict[str, float], bias: float, transition: np.ndarray):
        self.weights, self.bias, self.transition = weights, bias, transition
        self.calibration: np.ndarray | None = None

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


class Emissions(dict):
    """Scores by word, kept while they are few enough."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED:
            self.clear()
        self[word] = value = self.field.emission(word)
        return value


def fit_field(docs: list[list[str]], labels: list[int]) -> Field | None:
    """A field fitted to documents as lists of lower-case words; None without both labels."""
    if not 0 < sum(labels) < len(labels):
        return None
    cache: dict[str, list[str]] = {}
    for words in docs:
        for word in words:
            if word not in cache:
                cache[word] = features(word)
    chosen = seeds([{f for w in set(words) for f in cache[w]} for words in docs], labels)
    toxic_word = {w: any(f in chosen for f in fs) for w, fs in cache.items()}
    kept: dict[str, int] = {}
    for word, toxic in toxic_word.items():
        if toxic:
            for f in cache[word]:
                kept.setdefault(f, len(kept))
    chains, marks = [], []
    plain = 0
    for words, label in zip(docs, labels, strict=True):
        for at in range(0, len(words), CHAIN):
            chain = words[at : at + CHAIN]
            mark = [int(bool(label) and toxic_word[w]) for w in chain]
            # As many chains without a toxic word as with one teach what is not toxic.
            if any(mark) or plain <= len(chains) // 2 or any(toxic_word[w] for w in chain):
                plain += not any(mark)
                chains.append(chain)
                marks.append(mark)
    lengths = np.array([len(c) for c in chains])
    y = np.zeros((len(chains), CHAIN))
    row, column, feature = [], [], []
    for i, (chain, mark) in enumerate(zip(chains, marks, strict=True)):
        y[i, : len(mark)] = mark
        for j, word in enumerate(chain):
            for f in cache[word]:
                if f in kept:
                    row.append(i)
                    column.append(j)
                    feature.append(kept[f])
    row, column, feature = (np.array(a, dtype=np.int64) for a in (row, column, feature))
    inside = np.arange(CHAIN)[None, :] < lengths[:, None]
    total = max(1, int(inside.sum()))
    wanted = np.zeros((2, 2))
    both = inside[:, 1:]
    for a in (0, 1):
        for b in (0, 1):
            wanted[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & both).sum()
    # Adam on the log-likelihood's slope: what the labels show minus what the field expects.
    theta = np.zeros(len(kept) + 5)
    theta[len(kept)] = -3.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    seen = np.bincount(feature, weights=y[row, column], minlength=len(kept))
    scale = np.concatenate(
        [np.maximum(1.0, np.bincount(feature, minlength=len(kept))), [total] * 5]
    )
    for step in range(1, ROUNDS + 1):
        emission = np.full((len(chains), CHAIN), theta[len(kept)])
        np.add.at(emission, (row, column), theta[feature])
        p, moves = marginals(emission, lengths, theta[len(kept) + 1 :].reshape(2, 2))
        expected = np.bincount(feature, weights=p[row, column], minlength=len(kept))
        slope = np.concatenate(
            [seen - expected, [(y - p)[inside].sum()], (wanted - moves).ravel()]
        )
        slope = slope / scale - RIDGE * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + STEP * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8
        )
    weights = {f: float(theta[i]) for f, i in kept.items()}
    field = Field(weights, float(theta[len(kept)]), theta[len(kept) + 1 :].reshape(2, 2))
    evidence = document_evidence(Emissions(field), field, docs)[0]
    field.calibration = linear.fit(evidence, np.array(labels, dtype=float), ridge=0.1)
    return field


def document_evidence(
    emissions: Emissions, field: Field, docs: list[list[str]]
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per document what the score is made of, and P(toxic) of every word.

    Evidence is the expected number of toxic words and of clearly toxic ones, their share
    among all words, all as logarithms, the probability that any word is toxic, the largest
    probability of a word, and the number of words.
    """
    counts = np.array([len(words) for words in docs], dtype=np.int64)
    per_doc = -(-counts // CHAIN)
    scores = np.fromiter((emissions[w] for words in docs for w in words), float, counts.sum())
    lengths = np.concatenate(
        [np.minimum(CHAIN, n - CHAIN * np.arange(-(-n // CHAIN))) for n in counts] or [[]]
    ).astype(np.int64)
    probabilities = np.zeros(len(scores))
    ends = np.cumsum(lengths)
    # Chains are tagged in slices of whole documents, to keep the messages of a slice small.
    chains = np.concatenate([[0], np.cumsum(per_doc)])
    doc = 0
    while doc < len(docs):
        upto = max(doc + 1, int(np.searchsorted(chains, chains[doc] + 4096, side="right")) - 1)
        at, to, held = chains[doc], chains[upto], per_doc[doc:upto]
        doc = upto
        if at == to:
            continue
        some = lengths[at:to]
        start = ends[at:to] - some
        width = int(some.max())
        inside = np.arange(width)[None, :] < some[:, None]
        where = (start[:, None] + np.arange(width)[None, :])[inside]
        emission = np.zeros((len(some), width))
        emission[inside] = scores[where]
        sides = messages(emission, some, field.transition, held[held > 0])
        probabilities[where] = marginals(emission, some, field.transition, *sides)[0][inside]
    out = np.zeros((len(docs), 6))
    words: list[np.ndarray] = []
    at = 0
    for i, n in enumerate(counts):
        p = probabilities[at : at + n]
        at += n
        words.append(p)
        if per_doc[i]:
            clear = float((p**4).sum())
            out[i] = (
                math.log1p(p.sum()),
                math.log1p(clear),
                math.log1p(1_000 * clear / n),
                -math.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()),
                p.max(),
                math.log1p(n) / 10,
            )
    return out, words


def _spans(text: str, toxic: np.ndarray) -> list[dict[str, int]]:
    """Offsets of toxic words in the text; neighbours are one span."""
    found: list[dict[str, int]] = []
    at, last = 0, -2
    for i, word in enumerate(text.split()):
        at = text.index(word, at)
        if toxic[i] > 0.5:
            if last == i - 1:
                found[-1]["end"] = at + len(word)
            else:
                found.append({"start": at, "end": at + len(word)})
            last = i
        at += len(word)
    return found


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: its id's crc32 is a multiple of five."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[list[str]], list[int]]:
    """The bounded sample of labelled, not held out documents: words and labels."""
    marked = unique(labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic"))
    marked = marked.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    # Ids and lengths decide; only the chosen texts are read, by some 2 * MAX_TRAIN ids.
    known_ids = docs.filter(F.length("text") <= MAX_TRAIN_CHARS).select("doc_id")
    candidates = marked.join(known_ids, "doc_id")
    chosen: list = []
    for label in (0, 1):
        some = hashed_sample(candidates.filter(F.col("toxic") == label), "doc_id", MAX_TRAIN)
        chosen += some.select("doc_id", "toxic").collect()
    ids = docs.sparkSession.createDataFrame(
        [(r.doc_id, int(r.toxic)) for r in chosen], "doc_id bigint, toxic int"
    )
    found = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic").collect()
    found.sort(key=lambda r: r["doc_id"])
    known: dict[str, str] = {}
    words = [[known.setdefault(w, w) for w in r["text"].lower().split()] for r in found]
    return words, [int(r["toxic"]) for r in found]


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted and the toxic spans.

    Only texts are scored: ids decide which labelled rows may be learned from, and nothing else.
    The field is sent to the tasks; its size is bounded by the training sample. Spans
    are offsets in code points, the end not included.

    Null and empty texts have the score of a text without toxic words. Without labelled rows of
    both kinds nothing can be learned and every score is 0. Rows without an id are left out, rows
    that repeat an id count once, in documents and in labels.
    """
    plain = texts(docs, id_col, text_col)
    field = fit_field(*training_sample(plain, labels))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        emissions = Emissions(field) if field else None
        for frame in frames:
            if emissions is None:
                yield frame[["doc_id"]].assign(score=0.0, spans=[[] for _ in range(len(frame))])
                continue
            for at in range(0, len(frame), 512):
                part = frame.iloc[at : at + 512]
                rows = [t.lower().split() for t in part["text"]]
                evidence, words = document_evidence(emissions, field, rows)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "score": linear.sigmoid(linear.scores(evidence, field.calibration)),
                        "spans": [
                            _spans(t, p) if len(p) and p.max() > 0.5 else []
                            for t, p in zip(part["text"], words, strict=True)
                        ],
                    }
                )

    scored = plain.mapInPandas(
        score, "doc_id bigint, score double, spans array<struct<start:int,end:int>>"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )
