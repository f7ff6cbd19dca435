"""Toxicity by multiple-instance learning: a noisy-or of sentence scores, trained on document labels.

A sentence's score is a logistic function of its words; a document is toxic unless all its sentences
are clean, so its score is 1 - prod(1 - sentence score). Labels of documents alone train the
words' weights; the sentences that carry a document's score are then located.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.session import written

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)
MOST_CACHED = 1 << 18


@dataclass(frozen=True)
class Training:
    #: The classifier is fitted on at most so many labelled documents of each class, by hash of the id.
    max_per_class: int = 3000
    #: A feature has a weight only where its excess among toxic documents is this sure (the G statistic).
    least_g: float = 15.0
    max_features: int = 1 << 14
    steps: int = 120
    rate: float = 0.08
    decay: float = 2e-4


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


def features(word: str) -> list[str]:
    """The word and its beginnings: languages that join words share those."""
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


def held_out(doc_id: str | Column) -> Column:
    """Rows that training must not see: crc32 of the id as text leaves 1 when divided by 3."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    """(start, end, words) of each sentence that has a word."""
    for m in SENTENCE.finditer(text):
        if words := set(WORD.findall(m[0].lower())):
            yield m.start(), m.end(), words


def training_sample(docs: DataFrame, labels: DataFrame, how: Training) -> tuple[DataFrame, dict[int, float]]:
    """(doc, toxic, sentences) of the sample, and how many labelled rows one of each class stands for."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
    usable = written(usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    total = {r[0]: r[1] for r in usable.groupBy("toxic").count().collect()}  # a row per class
    picked = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.max_per_class)
              for c in (0, 1)]
    ids = F.broadcast(picked[0].union(picked[1]).withColumnRenamed("doc_id", "id"))  # 2 * max_per_class rows at most

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[sorted(w) for _, _, w in sentences(t or "")] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array(lists, pa.list_(pa.list_(pa.string())))],
                names=["id", "toxic", "sentences"])

    joined = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id")).select("id", "toxic", "text")
    sample = written(joined.mapInArrow(split, "id long, toxic int, sentences array<array<string>>"))
    weight = {c: total.get(c, 0) / min(max(total.get(c, 0), 1), how.max_per_class) for c in (0, 1)}
    return sample, weight


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Train on a bounded sample. Without labels of both classes every sentence scores near 0."""
    sample, weight = training_sample(docs, labels, how)
    words = sample.select("id", "toxic", F.explode(F.array_distinct(F.flatten("sentences"))).alias("word"))
    starts = ", ".join(f"IF(length(word) > {k}, concat('^', left(word, {k})), NULL)" for k in PREFIXES)
    found = words.selectExpr("id", "toxic", f"explode(array(word, {starts})) AS feature").where("feature IS NOT NULL").distinct()
    seen = found.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum(F.expr("1 - toxic")).alias("b"))
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model(-12.0, {})
    part = lambda o, of: f"IF({o} > 0, {o} * ln({o} * {n[0] + n[1]}D / (({of[0]}) * {of[1]}D)), 0D)"
    g = " + ".join([part("a", ("a + b", n[1])), part("b", ("a + b", n[0])),
                    part(f"({n[1]} - a)", (f"{n[0] + n[1]} - a - b", n[1])), part(f"({n[0]} - b)", (f"{n[0] + n[1]} - a - b", n[0]))])
    sure = seen.selectExpr("feature", "a", "b", f"2 * ({g}) AS g").where(
        f"g >= {how.least_g} AND a * {n[0]}D > b * {n[1]}D").orderBy(F.desc("g"), "feature").limit(how.max_features)
    number = {r.feature: k for k, r in enumerate(sure.collect())}  # max_features rows at most

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = [], []
            for doc in batch.column("sentences").to_pylist():
                lists = [[number[f] for w in s for f in features(w) if f in number] for s in doc]
                ids.append([i for s in lists for i in s])
                sizes.append([len(s) for s in lists])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("toxic"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(sizes, pa.list_(pa.int32()))], names=["id", "toxic", "words", "sizes"])

    # The sample, as numbers.
    rows = sample.mapInArrow(encode, "id long, toxic int, words array<int>, sizes array<int>").orderBy("id").collect()
    rows = [r for r in rows if r.sizes]
    toxic = np.array([r.toxic for r in rows], np.int64)
    if len(set(toxic.tolist())) < 2 or not number:
        return Model(-12.0, {})
    word = np.concatenate([np.array(r.words, np.int64) for r in rows])
    sizes = np.concatenate([np.array(r.sizes, np.int64) for r in rows])
    of_word = np.repeat(np.arange(len(sizes)), sizes)
    of_sentence = np.repeat(np.arange(len(rows)), [len(r.sizes) for r in rows])
    bias, w = _descend(word, of_word, of_sentence, toxic, np.where(toxic == 1, weight[1], weight[0]), len(number), how)
    return Model(float(bias), {k: float(w[i]) for k, i in number.items() if abs(w[i]) > 0.02})


def _descend(word, of_word, of_sentence, toxic, cost, n_words, how: Training):
    """Adam on the noisy-or likelihood, from each feature's excess among toxic documents."""
    doc = of_sentence[of_word]
    seen = np.unique(doc * n_words + word)
    in_toxic = toxic[seen // n_words] == 1
    hot = np.bincount(seen[in_toxic] % n_words, minlength=n_words) / (toxic == 1).sum()
    cold = np.bincount(seen[~in_toxic] % n_words, minlength=n_words) / (toxic == 0).sum()
    least = 1 / max(len(toxic), 1)
    w = np.maximum(0, np.log((hot + least) / (cold + least)) - 1.0)
    theta = np.concatenate([w, [-7.0]])
    m, v, cost = np.zeros_like(theta), np.zeros_like(theta), cost / cost.sum()
    for t in range(1, how.steps + 1):
        z = np.bincount(of_word, theta[word], minlength=len(of_sentence)) + theta[-1]
        s = 1 / (1 + np.exp(-z))
        a = np.bincount(of_sentence, np.logaddexp(0, z), minlength=len(toxic))
        factor = np.where(toxic == 1, -1 / np.maximum(np.expm1(np.minimum(a, 500)), 1e-9), 1.0) * cost
        gz = s * factor[of_sentence]
        grad = np.concatenate([np.bincount(word, gz[of_word], minlength=n_words) + how.decay * theta[:-1] / 10, [gz.sum()]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - how.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
    return theta[-1], theta[:-1]


SCORES = "doc_id long, score double, n_sentences long, n_offending long, worst_start long, worst_end long"
PLACES = "doc_id long, start long, end long, score double, sentence string"


def _rated(text: str, model: Model) -> Iterator[tuple[int, int, float]]:
    """(start, end, z) of each sentence."""
    of = _word_weights(model)
    if len(of) > MOST_CACHED:
        of.clear()
    for start, end, words in sentences(text):
        yield start, end, model.bias + sum(map(of.__getitem__, words))


class _WordWeights(dict):
    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        self[word] = total = sum(self.weights.get(f, 0.0) for f in features(word))
        return total


def _word_weights(model: Model) -> _WordWeights:
    if "of" not in model.__dict__:
        object.__setattr__(model, "of", _WordWeights(model.weights))
    return model.of


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: its noisy-or score, and where its most offending sentence stands.

    NULL, empty and wordless texts have no sentence: score 0, no place. Repeated rows score alike.
    Labels and other columns are not read.
    """
    given = docs.sparkSession.sparkContext.broadcast(model)  # max_features weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                rated = list(_rated(text or "", given.value))
                z = np.array([r[2] for r in rated])
                worst = rated[int(z.argmax())] if rated else (None, None, None)
                out.append((float(-np.expm1(-np.logaddexp(0, z).sum())), len(rated), int((z >= 0).sum()), *worst[:2]))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "score", "n_sentences", "n_offending", "worst_start", "worst_end"])

    return docs.select("doc_id", "text").mapInArrow(run, SCORES)


def offending_sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, score, sentence): every sentence that scores ``least`` or more by itself."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for start, end, z in _rated(text or "", given.value):
                    score = 1 / (1 + float(np.exp(-z)))
                    if score >= least:
                        rows.append((doc_id, start, end, score, text[start:end]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "start", "end", "score", "sentence"])

    return docs.select("doc_id", "text").mapInArrow(run, PLACES)
