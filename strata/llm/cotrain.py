"""Quality and toxicity by co-training a text view and a metadata view.

Each view has a logistic regression of its own: one sees which words a text holds and how
it is written, the other its source, language, length and lines.  In every round both
score all documents without a label; each view's most confident texts, ``exchange`` per
class at most and each once whatever its copies, join the other view's training rows with the label that it gave them.  Each view is
then calibrated on labelled rows that trained neither, and a regression on the calibrated
views gives the probability that scores all documents.  Quality and toxicity are two such
pairs of classifiers.

Bounds: the classifiers are fitted on at most ``max_labelled`` labelled documents (the
first by a hash of the doc_id), on ``exchange`` pseudo-labels per class, view and round,
and on ``max_words`` words, the most frequent of that sample.  Scores are of all documents
and whole texts.

Defined results: a null text is empty, null metadata is a value of its own; labels that
are null, or whose document is missing, train nothing; a document is labelled by each row
of labels with its doc_id, and of rows that share it the least text stands for it there;
a pseudo-label goes to the row that was scored; where the labels hold one class only, its share is everyone's
probability; a null doc_id is scored; repeated rows are scored alike; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, text_tag, texts, written

TARGETS = ("quality", "toxic")
VIEWS = ("content", "metadata")
#: Characters that part words here, beside white space; other symbols stay in their words.
_PARTING = bytes.maketrans(b".,;:!?\"'()[]", b" " * 12)
SOURCES, LANGUAGES = 64, 16
STYLE, LAYOUT = 6, 5
#: Least calibrated logit, beyond that of the label's share, for a pseudo-label.
SURE = 3.0


def words(text: bytes) -> list[bytes]:
    return text.translate(_PARTING).lower().split()


def style(text: bytes, ws: list[bytes], kinds: int) -> list[float]:
    """How a text is written."""
    n = max(1, len(ws))
    again = sum(map(bytes.__eq__, ws, ws[1:])) if len(ws) > 1 else 0
    letters = sum(map(len, ws)) or 1
    symbols = len(text.translate(None, _PLAIN))
    return [np.log1p(len(ws)), kinds / n, again / n, letters / n / 10, symbols / max(1, len(text)), kinds / n**0.75 / 10]


# Bytes that are no symbols: letters, digits, white space, sentence marks, and all beyond ASCII.
_PLAIN = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b) in " \t\n\r\x0b\x0c.,;:!?\"'()-")


def content_features(text: bytes, index: dict[bytes, int]) -> tuple[list[int], list[float]]:
    ws = words(text)
    kinds = set(ws)
    return [index[w] for w in kinds if w in index], style(text, ws, len(kinds))


def metadata_features(text: bytes, source: str | None, lang: str | None, n_chars: int | None) -> tuple[list[int], list[float]]:
    lines = text.count(b"\n") + 1
    size = float(max(0, n_chars if n_chars is not None else 0))
    there = [
        0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCES - 1),
        SOURCES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANGUAGES - 1)),
    ]
    return there, [np.log1p(size) / 5, np.log1p(lines) / 3, np.log1p(size / lines) / 5, text.count(b"\n\n") / lines, float(n_chars is None)]


class Rows:
    """Training rows of one view: which features are there, dense features, and labels."""

    def __init__(self, there: list, dense: list, labels: list, n_dense: int):
        self.counts = np.array([len(t) for t in there], dtype=np.int64)
        self.features = np.concatenate([np.asarray(t, dtype=np.int64) for t in there]) if there else np.empty(0, np.int64)
        self.dense = np.array(dense, dtype=np.float64).reshape(len(there), n_dense)
        self.labels = np.array(labels, dtype=np.float64)


class Logistic:
    """Regularised logistic regression on present features and standardised dense ones.

    A feature counts by the log-ratio of its shares in both classes, so that the penalty
    falls on the many that tell little.
    """

    def __init__(self, size: int, dense: int):
        self.weights, self.dense, self.bias = np.zeros(size), np.zeros(dense), 0.0
        self.mean, self.scale = np.zeros(dense), np.ones(dense)

    def fit(self, rows: Rows, steps: int = 120, rate: float = 0.05, ridge: float = 1e-3) -> "Logistic":
        n = len(rows.labels)
        share = (rows.labels.sum() + 0.5) / (n + 1.0)
        self.bias = float(np.log(share / (1 - share)))
        if n == 0 or rows.labels.min() == rows.labels.max():
            return self
        self.mean, self.scale = rows.dense.mean(0), rows.dense.std(0) + 1e-6
        dense, row = (rows.dense - self.mean) / self.scale, np.repeat(np.arange(n), rows.counts)
        size = len(self.weights)
        of_class = rows.labels[row] > 0
        present = [np.bincount(rows.features[of_class == c], minlength=size) for c in (True, False)]
        ratio = np.log((present[0] + 1) / (rows.labels.sum() + 2)) - np.log((present[1] + 1) / (n - rows.labels.sum() + 2))
        flat = np.concatenate([self.weights, self.dense, [self.bias]])
        first, second = np.zeros_like(flat), np.zeros_like(flat)
        for step in range(1, steps + 1):
            z = np.bincount(row, (flat[:size] * ratio)[rows.features], n) + dense @ flat[size:-1] + flat[-1]
            wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - rows.labels) / n
            slope = np.concatenate([np.bincount(rows.features, wrong[row], size) * ratio, dense.T @ wrong, [wrong.sum()]])
            slope[:-1] += ridge * flat[:-1]
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            flat = flat - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        self.weights, self.dense, self.bias = flat[:size] * ratio, flat[size:-1], float(flat[-1])
        return self

    def logit(self, there, dense) -> float:
        return float(self.weights[there].sum() + (np.asarray(dense) - self.mean) / self.scale @ self.dense + self.bias)


def plane(x: np.ndarray, labels: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights and bias of a lightly regularised logistic regression on few columns, by Newton steps."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    out = np.r_[np.zeros(x.shape[1]), np.log(share / (1 - share))]
    if len(labels) == 0 or labels.min() == labels.max():
        return out
    one = np.c_[x, np.ones(len(x))]
    prior = np.r_[np.full(x.shape[1], 1.0), 1e-3]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(one @ out, -30, 30)))
        step = np.linalg.solve((one.T * (p * (1 - p))) @ one + np.diag(prior), one.T @ (labels - p) - prior * out)
        out = out + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return out


class Model:
    """Per target: a classifier and a calibration for each view, and what combines them."""

    def __init__(self, index: dict[bytes, int]):
        self.index = index
        self.classifiers: dict[tuple[str, str], Logistic] = {}
        self.calibrations: dict[tuple[str, str], np.ndarray] = {}
        self.combinations: dict[str, np.ndarray] = {}

    def features(self, text: bytes, source, lang, n_chars) -> dict[str, tuple[list[int], list[float]]]:
        return {"content": content_features(text, self.index), "metadata": metadata_features(text, source, lang, n_chars)}

    def calibrated(self, target: str, features: dict) -> list[float]:
        """Calibrated logits by view."""
        out = []
        for view in VIEWS:
            slope, bias = self.calibrations[target, view]
            out.append(slope * float(np.clip(self.classifiers[target, view].logit(*features[view]), -30, 30)) + bias)
        return out

    def combined(self, target: str, calibrated: list[float]) -> float:
        *slopes, bias = self.combinations[target]
        return float(np.dot(slopes, calibrated) + bias)


_COLUMNS = ["doc_id", "text", "source", "lang", "n_chars"]


def _metadata(batch):
    return zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)


def features_of(docs: DataFrame, model) -> list[tuple]:
    """(doc_id, tag, features by view) of a bounded number of documents, brought to the driver."""

    def extract(batch):
        found = [model.value.features(t, *m) for t, m in zip(texts(batch), _metadata(batch), strict=True)]
        arrays = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "tag")]
        for view in VIEWS:
            arrays.append(pa.array([f[view][0] for f in found], pa.list_(pa.int32())))
            arrays.append(pa.array([f[view][1] for f in found], pa.list_(pa.float64())))
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "tag", "c_there", "c_dense", "m_there", "m_dense"])

    schema = "doc_id long, tag long, c_there array<int>, c_dense array<double>, m_there array<int>, m_dense array<double>"
    rows = mapped(docs, extract, schema).collect()
    return [(r[0], r[1], {"content": (r[2], r[3]), "metadata": (r[4], r[5])}) for r in rows]


def one_each(docs: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of ``keys``, the least by the other columns, so that reruns agree."""
    rest = F.min(F.struct(*(c for c in docs.columns if c not in keys))).alias("least")
    return docs.groupBy(*keys).agg(rest).select(*keys, "least.*")


def view_scores(docs: DataFrame, model) -> DataFrame:
    """doc_id, the text's tag and, for each target, both views' calibrated logits and the combined one."""

    def score(batch):
        out: list[list[float]] = []
        for text, meta in zip(texts(batch), _metadata(batch), strict=True):
            features, row = model.value.features(text, *meta), []
            for target in TARGETS:
                views = model.value.calibrated(target, features)
                row += [*views, model.value.combined(target, views)]
            out.append(row)
        columns = list(zip(*out, strict=True)) if out else [()] * (len(names) - 2)
        keys = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "tag")]
        arrays = [*keys, *(pa.array(c, pa.float64()) for c in columns)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", "tag", *(f"{t}_{v}" for t in TARGETS for v in (*VIEWS, "both"))]
    tagged = docs.select(*_COLUMNS, text_tag().alias("tag"))
    return mapped(tagged, score, "doc_id long, tag long, " + ", ".join(f"{n} double" for n in names[2:]))


def surest(scored: DataFrame, by, most: int) -> DataFrame:
    """(doc_id, tag) of the ``most`` texts that come first in ``by``; copies of a text take one place together."""
    rank = F.struct(by.alias("by"), F.xxhash64("doc_id").alias("mixed"), "doc_id").alias("rank")
    texts_ = scored.select("tag", rank).groupBy("tag").agg(F.min("rank").alias("rank"))
    return texts_.orderBy("rank").limit(most).select("rank.doc_id", "tag")


def vocabulary(sample: DataFrame, max_words: int, least: int) -> dict[bytes, int]:
    """The words of most sample documents, numbered."""

    def kinds(batch):
        found: dict[bytes, int] = {}
        for text in texts(batch):
            for word in set(words(text)):
                found[word] = found.get(word, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    counts = mapped(sample.select("text"), kinds, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(max_words).collect()
    return {bytes(r["word"]): i for i, r in enumerate(top)}


def _fit(model: Model, train: dict, held: dict) -> None:
    """Classifiers from ``train`` rows by target and view, calibrations and combinations from ``held`` ones."""
    for target in TARGETS:
        logits = []
        for view in VIEWS:
            size, dense = (len(model.index), STYLE) if view == "content" else (SOURCES + LANGUAGES, LAYOUT)
            rows = train[target, view]
            fitted = Logistic(size, dense).fit(Rows([f[0] for f, _ in rows], [f[1] for f, _ in rows], [y for _, y in rows], dense))
            model.classifiers[target, view] = fitted
            raw = np.array([np.clip(fitted.logit(*f[view]), -30, 30) for f, _ in held[target]]).reshape(-1, 1)
            labels = np.array([y for _, y in held[target]], dtype=np.float64)
            model.calibrations[target, view] = plane(raw, labels)
            logits.append(raw[:, 0] * model.calibrations[target, view][0] + model.calibrations[target, view][1])
        model.combinations[target] = plane(np.stack(logits, axis=1), labels)


def co_train(
    docs: DataFrame, labels: DataFrame, rounds: int = 2, max_labelled: int = 8000, exchange: int = 250, max_words: int = 30_000, least: int = 3
):
    """The broadcast model."""
    spark = docs.sparkSession
    labels = labels.select("doc_id", *(F.col(t).cast("int") for t in TARGETS)).filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    order = F.xxhash64(F.lit("labels"), F.col("doc_id"))
    chosen = written(labels.orderBy(order, "doc_id", *TARGETS).limit(max_labelled), "labels")  # a bounded number of rows
    docs = docs.select(*_COLUMNS, text_tag().alias("tag"))
    sample = written(docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id"), "sample")
    sample = one_each(sample.select("doc_id", "tag", *_COLUMNS[1:]), "doc_id")
    model = Model(vocabulary(sample, max_words, least))
    shared = spark.sparkContext.broadcast(model)
    by_id = {doc_id: features for doc_id, _, features in features_of(sample, shared)}
    train: dict = {(t, v): [] for t in TARGETS for v in VIEWS}
    held: dict = {t: [] for t in TARGETS}
    for row in chosen.collect():
        features = by_id.get(row["doc_id"])
        for target in TARGETS:
            if features is not None and row[target] is not None:
                if zlib.crc32(f"held {row['doc_id']}".encode()) % 4 == 0:
                    held[target].append((features, row[target]))
                else:
                    for view in VIEWS:
                        train[target, view].append((features[view], row[target]))
    _fit(model, train, held)
    for step in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        scored = written(view_scores(docs, shared), f"round{step}")
        free = scored.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").filter("doc_id IS NOT NULL")
        free = written(free, "unlabelled")
        given: dict = {}
        for target in TARGETS:
            for view, other in zip(VIEWS, VIEWS[::-1], strict=True):
                sure = F.col(f"{target}_{view}")
                usual = float(np.clip(plane(np.empty((len(held[target]), 0)), np.array([y for _, y in held[target]], dtype=np.float64))[0], -2, 2))
                for label, by, sure_enough in ((1, -sure, sure > SURE + max(0, usual)), (0, sure, sure < -SURE + min(0, usual))):
                    most = min(exchange, len(held[target]) // 2)
                    for row in surest(free.filter(sure_enough), by, most).collect():
                        given.setdefault((row["doc_id"], row["tag"]), []).append((target, other, label))
        if not given:
            break
        ids = spark.createDataFrame(list(given), "doc_id long, tag long")  # bounded: see above
        for doc_id, tag, features in features_of(one_each(docs.join(F.broadcast(ids), ["doc_id", "tag"]), "doc_id", "tag"), shared):
            for target, view, label in given[doc_id, tag]:
                train[target, view].append((features[view], label))
        model = Model(model.index)
        _fit(model, train, held)
    return spark.sparkContext.broadcast(model)


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, quality and toxic probabilities, score (quality and not toxic) and kept, per row."""
    scored = view_scores(docs.select(*_COLUMNS), co_train(docs, labels, **options))
    quality, toxic = (1 / (1 + F.exp(-F.col(f"{t}_both"))) for t in TARGETS)
    out = scored.select("doc_id", quality.alias("quality"), toxic.alias("toxic"))
    return out.withColumn("score", F.col("quality") * (1 - F.col("toxic"))).withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that the classifiers reject."""
    model = co_train(docs, labels, **options)

    def good(batch):
        stay = []
        for text, meta in zip(texts(batch), _metadata(batch), strict=True):
            features = model.value.features(text, *meta)
            quality, toxic = (model.value.combined(t, model.value.calibrated(t, features)) for t in TARGETS)
            stay.append(quality >= 0 and toxic < 0)
        yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(lambda batches: (out for b in batches for out in good(b)), docs.schema)
