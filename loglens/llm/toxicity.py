"""Toxicity by a subsequence string kernel machine with Nystroem landmarks.

The kernel compares two words by their common subsequences of three characters
within six, each weighted by ``DECAY`` to the power of its gaps, so it tolerates
inserted and swapped characters. Landmarks span the feature space (Nystroem);
a linear support vector machine is trained there. Because a machine on landmark
kernels is linear in subsequences, its decision about a word is one weight per
subsequence: scoring looks weights up instead of comparing with every landmark.

Sentences carry the label of their document, so a sentence of a toxic document
need not be toxic itself. Training therefore picks witnesses: words whose counts
in toxic and clean documents, and whose different neighbours there, differ beyond
chance (log-likelihood ratio) are positive, words of clean documents negative, and clean words that the first
machine takes for toxic are added as hard negatives for the second. A sentence
scores as its worst word, a document as its worst sentence; the boundary is the
one that separates the training documents best.

Words are runs of non-space characters; three or more single characters in a row
make one word ("i d i o t"). Long words are read in overlapping windows.

Training takes at most ``TRAIN_DOCS`` labelled documents and ``TRAIN_WORDS``
words a kind; all words of all documents are scored.

Defined results: a null or empty text, or one without letters, scores as having no toxic word;
without witnesses (no toxic label, or too few) every document has score 0; rows
stay one to one, equal texts have equal scores. An empty table gives an empty
result. Only the text enters a score; other columns do not matter.
"""

from __future__ import annotations

import math
import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import (
    by_position,
    pick,
    ship,
    text_function,
    text_slices,
    texts_of,
    written,
)
from loglens.llm.labelled import held_out, training_texts

TRAIN_DOCS = 20_000
TRAIN_WORDS = 3_000
LANDMARKS = 256
HARD_ROUNDS = 2
FOLDS, FOLD = 5, 0
DECAY, REACH = 0.6, 6
# Log-likelihood ratio beyond which a word is a witness
# (twice the logarithm of the number of words, for as many tests, plus this).
BEYOND_CHANCE = 2.0
CANDIDATES = 20_000
EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))
# Words longer than this are read in windows, half overlapping.
WINDOW = 14
# Words that a task remembers, and text bytes that it splits into words at a time: a
# worker's memory depends on neither the table nor the partition.
TABLE_WORDS = 200_000
SCORE_BYTES = 1024 * 1024
CLASSES = 32
FEATURES = CLASSES**3
NO_WORD = -9.0
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")


def _class_of(c: str) -> int:
    """1-26 letters, 27-29 other letters and digits, 30 start, 31 end, 0 the rest."""
    plain = unicodedata.normalize("NFKD", c)[:1]
    if "a" <= plain <= "z":
        return ord(plain) - 96
    return 27 + ord(plain or c) % 3 if plain.isalnum() else 0


class Alphabet(dict):
    """Translation table from characters to classes; the two word marks stay."""

    def __missing__(self, point):
        found = self[point] = point if point in (30, 31) else _class_of(chr(point))
        return found


def words_of(text: str) -> list[str]:
    """Words in order, in lower case; runs of single characters come joined, at the end."""
    low = text.lower()
    return low.split() + ["".join(m.split()) for m in _SPACED.findall(low)]


def _offsets(n: int):
    """Positions ``(i, j, k)`` of subsequences in ``n`` characters."""
    return [
        (i, j, k)
        for i in range(n)
        for j in range(i + 1, n)
        for k in range(j + 1, min(n, i + REACH))
    ]


def word_windows(words, alphabet):
    """``(word number, codes)`` for each size: windows of the words as rows of classes.

    Words lose other characters at their ends and get a start and an end mark.
    """
    marked = ["\x1e" + w.strip(EDGES) + "\x1f" for w in words]
    codes = np.frombuffer("".join(marked).translate(alphabet).encode("latin-1"), np.uint8)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    starts = np.cumsum(sizes) - sizes
    number, first, size = [np.arange(len(marked))], [starts], [np.minimum(sizes, WINDOW)]
    step = WINDOW // 2
    for i in np.flatnonzero(sizes > WINDOW).tolist():
        more = np.arange(step, sizes[i] - step, step)
        number.append(np.full(len(more), i))
        first.append(starts[i] + more)
        size.append(np.minimum(WINDOW, sizes[i] - more))
    number, first, size = (np.concatenate(x) for x in (number, first, size))
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        for begin in range(0, len(at), 20_000):
            own = at[begin : begin + 20_000]
            yield number[own], codes[first[own] + np.arange(n)[:, None]].astype(np.int32)


def subsequences(codes: np.ndarray):
    """``(feature, weight)`` columns of windows, given as columns of classes.

    Windows are normalised to unit weight, so long ones do not count for more.
    """
    at = _offsets(len(codes))
    index = np.array([(codes[i] * CLASSES + codes[j]) * CLASSES + codes[k] for i, j, k in at])
    plain = np.array([DECAY ** (k - i - 2) for i, _, k in at])
    used = np.array([(codes[[i, j, k]] > 0).all(axis=0) for i, j, k in at]) * plain[:, None]
    return index, used / np.maximum(np.sqrt((used * used).sum(axis=0)), 1e-9)


class Scorer:
    """Decisions about words, remembered in a bounded table."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.bias = bias
        self.by_gap = [(weights * DECAY**g).astype(np.float32) for g in range(REACH)]
        self.alphabet = Alphabet()
        self.known = {}

    def _values(self, codes: np.ndarray) -> np.ndarray:
        """Decision about each window: its weights looked up and summed."""
        total = np.zeros(codes.shape[1], np.float32)
        square = np.zeros(codes.shape[1], np.float32)
        pure = bool((codes > 0).all())
        first, second, last = None, None, None
        for i, j, k in _offsets(len(codes)):
            if (i, j) != (first, second):
                first, second = i, j
                pair = (codes[i] * CLASSES + codes[j]) * CLASSES
                held = None if pure else (codes[i] > 0) & (codes[j] > 0)
            total += self.by_gap[k - i - 2].take(pair + codes[k])
            gap = DECAY ** (2 * (k - i - 2))
            square += gap if pure else gap * (held & (codes[k] > 0))
        value = total / np.sqrt(np.maximum(square, 1e-9)) + self.bias
        value[square == 0] = NO_WORD
        return value

    def decide(self, words) -> np.ndarray:
        """Greatest decision over the windows of each word."""
        best = np.full(len(words), NO_WORD)
        if len(words):
            for number, codes in word_windows(words, self.alphabet):
                pure = (codes > 0).all(axis=0)
                for some in (pure, ~pure):
                    if some.any():
                        np.maximum.at(best, number[some], self._values(codes[:, some]))
        return best

    def documents(self, texts) -> np.ndarray:
        rows = [words_of(t) for t in texts]
        known = self.known
        new = list({w for row in rows for w in row if w not in known})
        known.update(zip(new, self.decide(new).tolist()))
        get = known.__getitem__
        scores = np.array([max(map(get, row), default=NO_WORD) for row in rows])
        for w in [w for w in new if len(w) > 64]:
            known.pop(w)
        if len(known) > TABLE_WORDS:
            # Words met again stay; others are decided anew where they return.
            again = {w for row in rows for w in row if w in known}.difference(new)
            self.known = {w: known[w] for w in islice(again, TABLE_WORDS)}
        return scores


def _count_batches(batches):
    """Documents that hold each word, by label; combined within a slice."""
    for batch in batches:
        for part in text_slices(batch, "text"):
            counts = {}
            labels = part.column(1).to_pylist()
            for text, label in zip(texts_of(part, "text"), labels):
                for w in set(words_of(text)):
                    if len(w) <= 64:
                        pair = counts.setdefault(w, [0, 0])
                        pair[label > 0] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.string()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                ],
                names=["word", "toxic", "clean"],
            )


def _witness_ratio(toxic_docs: int, clean_docs: int):
    """Log-likelihood ratio of the counts; negative where clean documents hold more."""
    total = toxic_docs + clean_docs
    n = F.col("toxic") + F.col("clean")

    def part(seen, share):
        return F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0)

    ratio = 2 * (
        part(F.col("toxic"), toxic_docs / total) + part(F.col("clean"), clean_docs / total)
    )
    rarely_clean = F.col("clean") / clean_docs < 0.02 * F.col("toxic") / toxic_docs
    return F.when(rarely_clean, ratio).otherwise(-ratio)


def _context_counts(sample: DataFrame, candidates) -> DataFrame:
    """``(word, toxic, clean)``: different neighbours of each candidate, by label.

    Copies of one document repeat a word between the same neighbours and so count
    once; a word that insults stands in many places.
    """
    wanted = frozenset(candidates)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = set()
                for text, label in zip(texts_of(part, "text"), part.column(1).to_pylist()):
                    words = ["", *words_of(text), ""]
                    for i, w in enumerate(words):
                        if w in wanted:
                            found.add((w, words[i - 1] + " " + words[i + 1], label > 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.string()),
                        pa.array([f[2] for f in found], pa.bool_()),
                    ],
                    names=["word", "near", "toxic"],
                )

    places = sample.mapInArrow(run, "word string, near string, toxic boolean").distinct()
    return places.groupBy("word").agg(
        F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean")
    )


def landmark_features(words, landmarks) -> tuple[np.ndarray, np.ndarray]:
    """Kernel rows of words against landmarks, and the landmarks' subsequences.

    A training word stands for its first window.
    """
    alphabet = Alphabet()

    def first_windows(some):
        for number, codes in word_windows([w[: WINDOW - 2] for w in some], alphabet):
            yield number, *subsequences(codes)

    marks = np.zeros((len(landmarks), FEATURES), np.float32)
    for number, index, weight in first_windows(landmarks):
        for row in range(len(index)):
            np.add.at(marks, (number, index[row]), weight[row])
    rows = np.zeros((len(words), len(landmarks)), np.float32)
    for number, index, weight in first_windows(words):
        for row in range(len(index)):
            rows[number] += marks[:, index[row]].T * weight[row][:, None]
    return rows, marks


def squared_hinge_machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge=1e-3):
    """Weights and bias of the linear machine with squared hinge loss, by Newton steps.

    ``y`` is -1 or 1. The columns are few (landmarks) and the rows a bounded sample.
    """
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * cost.sum() / len(x))
    penalty[-1] *= 1e-3

    def loss(w):
        return (penalty * w * w).sum() + (cost * np.maximum(0, 1 - y * (z @ w)) ** 2).mean()

    for _ in range(50):
        short = 1 - y * (z @ w)
        inside = np.where(short > 0, cost, 0.0) / len(x)
        gradient = penalty * w - z.T @ (inside * y * np.maximum(short, 0))
        step = np.linalg.solve((z.T * inside) @ z + np.diag(penalty), gradient)
        size, before = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _fit_machine(positive, negative, landmarks):
    """Weight per subsequence and bias, from bounded lists of words."""
    kernel, marks = landmark_features([*positive, *negative], landmarks)
    among = landmark_features(landmarks, landmarks)[0].astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    kept = values > 1e-4
    root = vectors[:, kept] / np.sqrt(values[kept])
    n1, n0 = len(positive), len(negative)
    y = np.r_[np.ones(n1), -np.ones(n0)]
    cost = np.where(y > 0, 1.0, n1 / n0 * 2.0)
    beta, bias = squared_hinge_machine(kernel @ root, y, cost)
    return (marks.T @ (root @ beta)).astype(np.float32), bias


def _spread(words, n):
    """``n`` of the words at even steps."""
    step = max(1, len(words) // max(1, n))
    return words[::step][:n]


def train(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text"):
    """``(weights, bias)`` with the boundary at zero, or None without witnesses."""
    sample = written(
        training_texts(docs, labels, "toxic", FOLDS, FOLD, TRAIN_DOCS, doc_id, text),
        "toxicity-sample",
    )
    kinds = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic_docs, clean_docs = kinds.get(1.0, 0), kinds.get(0.0, 0)
    if not toxic_docs or not clean_docs:
        return None
    words = written(
        sample.mapInArrow(_count_batches, "word string, toxic bigint, clean bigint")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("ratio", _witness_ratio(toxic_docs, clean_docs)),
        "toxicity-words",
    )

    def least(df, *order, bound=TRAIN_WORDS):
        return [r["word"] for r in df.orderBy(*order).limit(bound).select("word").collect()]

    beyond = F.col("ratio") >= 2 * math.log(words.count()) + BEYOND_CHANCE
    likely = least(words.filter(beyond), F.desc("ratio"), "word", bound=CANDIDATES)
    diverse = _context_counts(sample, likely).withColumn(
        "ratio", _witness_ratio(toxic_docs, clean_docs)
    )
    positive = least(diverse.filter(beyond), F.desc("ratio"), "word")
    if not positive:
        return None
    innocent = words.filter("ratio < 4 and clean > 0")
    negative = list(
        dict.fromkeys(
            least(innocent, F.desc("clean"), "word")[: TRAIN_WORDS // 2]
            + least(innocent, F.xxhash64("word"))
        )
    )
    if not negative:
        return None
    landmarks = _spread(positive, LANDMARKS // 2) + _spread(negative, LANDMARKS // 2)
    weights, bias = _fit_machine(positive, negative, landmarks)

    for _ in range(HARD_ROUNDS):
        # Clean words that the machine takes for toxic.
        suspects = _decided(innocent.select("word"), weights, bias)
        hard = least(suspects.filter("decision > -0.5"), F.desc("decision"), "word")
        if not hard:
            break
        negative = list(dict.fromkeys(negative + hard))
        landmarks = landmarks + _spread(hard, LANDMARKS // 4)
        weights, bias = _fit_machine(positive, negative, landmarks)
    return weights, bias - _boundary(sample, weights, bias)


def _decided(words: DataFrame, weights, bias) -> DataFrame:
    def run(batches):
        scorer = Scorer(weights, bias)
        for batch in batches:
            found = scorer.decide(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], names=["word", "decision"]
            )

    return words.mapInArrow(run, "word string, decision double")


def _boundary(sample: DataFrame, weights, bias) -> float:
    """Middle of the best cuts between worst words of clean and toxic documents."""

    def judged(batches):
        scorer = Scorer(weights, bias)
        for batch in batches:
            for part in text_slices(batch, "text", SCORE_BYTES):
                found = scorer.documents(texts_of(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.float64()), part.column(1)], names=["worst", "label"]
                )

    bins = (
        sample.mapInArrow(judged, "worst double, label double")
        .groupBy(F.round(F.greatest(F.lit(-3.0), F.least("worst", F.lit(3.0))), 2).alias("at"))
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
        .orderBy("at")
        .collect()
    )
    at = np.array([b["at"] for b in bins])
    toxic = np.array([b["toxic"] for b in bins])
    clean = np.array([b["clean"] for b in bins])
    cuts = np.arange(-1.5, 1.5, 0.01)
    wrong = np.array([toxic[at < c].sum() + clean[at >= c].sum() for c in cuts])
    best = cuts[wrong == wrong.min()]
    return float((best.min() + best.max()) / 2)


def score_batch(scorer, texts) -> np.ndarray:
    if scorer is None:
        return np.zeros(len(texts))
    z = np.clip(4.0 * scorer.documents(texts), -30, 30)
    return 1.0 / (1.0 + np.exp(-z))


def _with_score(rows: DataFrame, state) -> DataFrame:
    """Replaces the last column, ``text``, by ``score``."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double"

    def run(batches):
        scorer = Scorer(*state) if state else None
        for batch in batches:
            for part in text_slices(batch, "text", SCORE_BYTES):
                scores = score_batch(scorer, texts_of(part, "text"))
                columns = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(scores, pa.float64())],
                    names=[*[f.name for f in kept], "score"],
                )

    return rows.mapInArrow(run, schema)


def score_documents(docs: DataFrame, state, doc_id="doc_id", text="text") -> DataFrame:
    """``(doc_id, score)`` for every row."""
    return _with_score(pick(docs, doc_id=doc_id, text=text), state)


def without_toxic(docs: DataFrame, state, threshold=0.5, text="text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    names = docs.columns

    def scores():
        scorer = Scorer(*state) if state else None
        return lambda texts: pa.array(score_batch(scorer, texts), pa.float64())

    rows = by_position(docs)
    scored = rows.withColumn(
        "score", text_function(scores, "double", SCORE_BYTES)(F.col(f"_c{names.index(text)}"))
    )
    return scored.filter(F.col("score") < threshold).drop("score").toDF(*names)


def op3_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


ship(__name__)
