"""Scoring with a class-based bigram model whose classes come from exchange clustering.

A token's probability is that of its class after the class before it, times that of the
token in its class.  Spark counts words and neighbouring units over all training texts.
A unit is one of the ``top_words`` most frequent words, or the ending of all other words
that share it (``endings`` of them), or the end of a text; so the table of neighbouring
units has a bound that does not depend on the corpus, and every word has a class.  Each
round of the exchange lets Spark add up, per unit, the classes of its neighbours, and then
moves unit after unit to the class that raises the likelihood of the classes' bigrams most.

Word counts have no bound: at most ``known_words`` of the most frequent are broadcast, and the words
beyond these are counted per document and joined with the counts, which gives the same
sums.

Words are what stands between white space (U+0020, U+0009 to U+000D), A-Z lower-cased; an
end follows the last one and counts as a token.  Texts train the model unless the CRC-32 of
the doc_id's decimal text is divisible by ``folds``.  Defined results: a null or empty
text is an end alone; a null doc_id is held out; repeated rows are texts of their own;
without training texts all counts are zero; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, text_tag, texts, written

#: Added to each count.
EXTRA = 0.1
#: Weight of the classes' own frequencies in a transition.
BACKOFF = 20.0
PUNCTUATION = b".,;:!?"


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and the six separators, only


def held_out(doc_id: int | None, folds: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def ending(word: bytes, endings: int) -> int:
    """The unit of a word that is not frequent: by its last bytes and whether punctuation follows."""
    core = word.rstrip(PUNCTUATION)
    return zlib.crc32(core[-3:] + (b"." if len(core) < len(word) else b"")) % endings


class Units:
    """Word to unit, and counts of the broadcast words.  The last unit is the end of a text."""

    def __init__(self, words: list[bytes], counts: list[int], top_words: int, endings: int):
        self.endings, self.size = endings, top_words + endings + 1
        self.index = {w: i for i, w in enumerate(words)}
        self.unit = np.array(
            [i if i < top_words else top_words + ending(w, endings) for i, w in enumerate(words)], dtype=np.int32
        )
        self.counts = np.array(counts, dtype=np.int64)
        self.top_words, self.end = top_words, top_words + endings

    def of_text(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Index of each word among the broadcast ones, -1 for others; and the units with the end."""
        at = np.fromiter(map(self.index.get, words, [-1] * len(words)), dtype=np.int64, count=len(words))
        units = np.full(len(words) + 1, self.end, dtype=np.int32)
        known = at >= 0
        units[:-1][known] = self.unit[at[known]]
        for i in np.flatnonzero(~known):
            units[i] = self.top_words + ending(words[i], self.endings)
        return at, units


def _doc_ids(batch) -> list:
    return batch.column(batch.schema.get_field_index("doc_id")).to_pylist()


def word_counts(docs: DataFrame, folds: int) -> DataFrame:
    """(word, n) of the training texts; the row with a null word counts the texts."""

    def count(batch):
        found: dict[bytes | None, int] = {}
        for doc_id, text in zip(_doc_ids(batch), texts(batch), strict=True):
            if not held_out(doc_id, folds):
                for word in tokens(text):
                    found[word] = found.get(word, 0) + 1
                found[None] = found.get(None, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    partial = mapped(docs.select("doc_id", "text"), count, "word binary, n long")
    return written(partial.groupBy("word").agg(F.sum("n").alias("n")), "words")


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The words above a count that at most ``most`` words reach.

    The count comes from a histogram of a few hundred steps, so no task sends more than its
    share of these words to the driver, as a sort with a limit would.
    """
    step = F.floor(F.log2(F.col("n")) * 8)
    held, least = 0, None
    for row in words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # 8 rows a power of two
        held += row["count"]
        if held > most:
            break
        least = row["step"]
    return words.filter(F.lit(False) if least is None else step >= least)


def unit_neighbours(docs: DataFrame, units, folds: int) -> DataFrame:
    """(unit, side, others, times): per unit what stands before (side 0) and after it, and how often."""

    def pairs(batch):
        found = []
        for doc_id, text in zip(_doc_ids(batch), texts(batch), strict=True):
            if not held_out(doc_id, folds):
                u = units.value.of_text(tokens(text))[1].astype(np.int64)
                found.append(np.r_[units.value.end, u[:-1]] * units.value.size + u)
        pair, n = np.unique(np.concatenate(found or [np.empty(0, np.int64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

    partial = mapped(docs.select("doc_id", "text"), pairs, "pair long, n long")
    total = written(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    size = units.value.size
    first, second = F.floor(F.col("pair") / size).cast("int"), (F.col("pair") % size).cast("int")
    sides = [
        total.select(a.alias("unit"), F.lit(side).alias("side"), F.struct(b.alias("unit"), "n").alias("other"))
        for side, a, b in ((0, second, first), (1, first, second))
    ]
    both = sides[0].unionAll(sides[1]).groupBy("unit", "side")
    lists = both.agg(F.collect_list("other").alias("other"))
    return written(lists.select("unit", "side", F.col("other.unit").alias("others"), F.col("other.n").alias("times")), "neighbours")


def class_neighbours(neighbours: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """By side, unit and class: how often the class stands on that side of the unit."""
    of_unit = neighbours.sparkSession.sparkContext.broadcast(classes)

    def add(batch):
        unit, side, others, times = (batch.column(batch.schema.get_field_index(c)) for c in ("unit", "side", "others", "times"))
        row = np.repeat(np.arange(batch.num_rows), others.value_lengths().to_numpy())
        at = row * n_classes + of_unit.value[others.flatten().to_numpy()]
        sums = np.bincount(at, times.flatten().to_numpy(), batch.num_rows * n_classes)
        lists = pa.ListArray.from_arrays(np.arange(0, len(sums) + 1, n_classes, dtype=np.int32), sums)
        yield pa.RecordBatch.from_arrays([unit, side, lists], names=["unit", "side", "sums"])

    out = np.zeros((2, len(classes), n_classes))
    for row in mapped(neighbours, add, "unit int, side int, sums array<double>").collect():  # a row per unit and side
        out[row["side"], row["unit"]] = row["sums"]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(bigrams: np.ndarray) -> float:
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(0)).sum() - _xlogx(bigrams.sum(1)).sum())


def class_bigrams(after: np.ndarray, classes: np.ndarray, n_classes: int) -> np.ndarray:
    out = np.zeros((n_classes, n_classes))
    np.add.at(out, classes, after)
    return out


def sweep(before: np.ndarray, after: np.ndarray, classes: np.ndarray, movable: np.ndarray, n_classes: int) -> np.ndarray:
    """Classes after each movable unit went to the class that raises the likelihood most.

    The last class is the end's alone.
    """
    classes, n = classes.copy(), class_bigrams(after, classes, n_classes)
    diagonal = np.arange(n_classes)
    for unit in movable:
        old, left, right = classes[unit], before[unit], after[unit]
        if not left.any():
            continue
        n[:, old] = np.maximum(n[:, old] - left, 0)
        n[old] = np.maximum(n[old] - right, 0)
        to, out = n + left[:, None], n + right[None, :]  # columns: into a class; rows: out of it
        now = _xlogx(n)
        into = _xlogx(to) - now
        from_ = _xlogx(out) - now
        same = _xlogx(n[diagonal, diagonal] + left + right) - now[diagonal, diagonal]
        gain = into.sum(0) - into[diagonal, diagonal] + from_.sum(1) - from_[diagonal, diagonal] + same
        for totals, more in ((n.sum(0), left.sum()), (n.sum(1), right.sum())):
            gain -= _xlogx(totals + more) - _xlogx(totals)
        new = int(np.argmax(gain[:-1]))
        n[:, new] += left
        n[new] += right
        classes[unit] = new
    return classes


def exchange(neighbours: DataFrame, units: Units, n_classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the units, the bigrams of classes, and the counts of units, of the best round."""
    order = np.r_[np.arange(units.top_words), units.top_words + np.arange(units.endings)]
    classes = np.r_[order % (n_classes - 1), n_classes - 1].astype(np.int64)
    best: tuple[float, tuple] | None = None
    for step in range(rounds + 1):
        before, after = class_neighbours(neighbours, classes, n_classes)
        bigrams = class_bigrams(after, classes, n_classes)
        found = likelihood(bigrams)
        if best is None or found > best[0]:
            best = (found, (classes, bigrams, before.sum(1)))
        elif step > 2:
            break
        classes = sweep(before, after, classes, order if step < 2 else order[step % 2 :: 2], n_classes)
    return best[1]


class Model:
    """Log probabilities, base 10, for scoring."""

    def __init__(self, units: Units, fitted: tuple, texts_: int, words: int, kinds: int, ending_words: np.ndarray):
        classes, bigrams, of_unit = fitted
        self.units, self.classes = units, classes
        frequency = (bigrams.sum(0) + EXTRA) / (bigrams.sum() + EXTRA * len(bigrams))
        self.transition = np.log10((bigrams + BACKOFF * frequency) / (bigrams.sum(1, keepdims=True) + BACKOFF))
        smoothed = of_unit + EXTRA
        self.emission = np.log10(smoothed / np.bincount(classes, smoothed, len(bigrams))[classes])
        rare = slice(units.top_words, units.end)
        # of the words with an ending, and one unseen word
        self.emission[rare] -= np.log10(of_unit[rare] + EXTRA * (ending_words + 1))
        self.train_tokens = words + texts_
        self.texts = texts_
        self.base = np.log10(self.train_tokens + EXTRA * (kinds + bool(texts_) + 1))
        self.log_counts = np.log10(units.counts + EXTRA)

    def of_text(self, words: list[bytes]) -> tuple[int, int, float, float, dict[bytes, int]]:
        """Tokens, known ones, base score and score but for the counts of words beyond the broadcast ones; these words."""
        at, u = self.units.of_text(words)
        known = at[at >= 0]
        c = self.classes[u]
        score = self.transition[np.r_[self.classes[self.units.end], c[:-1]], c].sum() + self.emission[u].sum()
        score += self.log_counts[known[known >= self.units.top_words]].sum()
        base = self.log_counts[known].sum() + np.log10(self.texts + EXTRA) - self.base * (len(words) + 1)
        others: dict[bytes, int] = {}
        for i in np.flatnonzero(at < 0):
            others[words[i]] = others.get(words[i], 0) + 1
        return len(words) + 1, len(known) + bool(self.texts), float(base), float(score), others


def fit(docs: DataFrame, folds: int = 10, top_words: int = 2000, endings: int = 512, n_classes: int = 32, rounds: int = 8, known_words: int = 100_000):
    """The broadcast model and the table of word counts."""
    spark = docs.sparkSession
    counts = word_counts(docs, folds)
    words = counts.filter("word IS NOT NULL")
    total = counts.agg(
        F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("texts"),
        F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("words"),
        F.count("word").alias("kinds"),
    ).first()
    most = sorted(frequent_words(words, known_words).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    units = Units([bytes(r["word"]) for r in most], [r["n"] for r in most], top_words, endings)
    shared = spark.sparkContext.broadcast(units)

    def of_endings(batch):
        found = [ending(w, endings) for w in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32())], names=["ending"])

    top = [bytes(r["word"]) for r in most[:top_words]]
    kinds = np.zeros(endings)
    for row in mapped(words.select("word"), of_endings, "ending int").groupBy("ending").count().collect():
        kinds[row["ending"]] = row["count"]
    for word in top:
        kinds[ending(word, endings)] -= 1
    fitted = exchange(unit_neighbours(docs, shared, folds), units, n_classes, rounds)
    model = Model(units, fitted, total["texts"] or 0, total["words"] or 0, total["kinds"], kinds)
    return spark.sparkContext.broadcast(model), words


def score(docs: DataFrame, folds: int = 10, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and perplexity per row."""
    model, words = fit(docs, folds, **options)

    def score_batch(batch):
        doc_ids = _doc_ids(batch)
        found = [model.value.of_text(tokens(t)) for t in texts(batch)]
        n, known, base, scores, others = zip(*found, strict=True) if found else ((),) * 5
        arrays = [
            pa.array(doc_ids, pa.int64()),
            batch.column(batch.schema.get_field_index("tag")),
            pa.array([held_out(d, folds) for d in doc_ids], pa.bool_()),
            pa.array(n, pa.int64()),
            pa.array(known, pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(scores, pa.float64()),
            pa.array([list(o) for o in others], pa.list_(pa.binary())),
            pa.array([list(o.values()) for o in others], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "tag", "held_out", "n_tokens", "n_known", "base", "part", "words", "times"])

    def in_parts(batch):
        """A few documents at a time: their words and counts are Python objects until they are written."""
        for start in range(0, batch.num_rows, 500):
            yield from score_batch(batch.slice(start, 500))

    rows = written(
        mapped(
            docs.select("doc_id", text_tag().alias("tag"), "text"),
            in_parts,
            "doc_id long, tag long, held_out boolean, n_tokens long, n_known long, base double, part double, words array<binary>, times array<long>",
        ),
        "scores",
    )
    other = rows.select("doc_id", "tag", F.posexplode(F.arrays_zip("words", "times")).alias("place", "other"))
    other = other.select("doc_id", "tag", "place", F.col("other.words").alias("word"), F.col("other.times").alias("times"))
    counted = other.join(words, "word", "left")
    times = F.col("times")
    # rows equal in doc_id and text add up together: each has one word at place 0
    copies = F.sum((F.col("place") == 0).cast("long"))
    sums = counted.groupBy(F.col("doc_id").alias("o_doc"), F.col("tag").alias("o_tag")).agg(
        (F.sum(times * F.log10(F.coalesce("n", F.lit(0)) + EXTRA)) / copies).alias("more"),
        (F.sum(F.when(F.col("n") > 0, times).otherwise(0)) / copies).cast("long").alias("more_known"),
    )
    joined = rows.join(sums, F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("tag") == F.col("o_tag")), "left")
    more = F.coalesce("more", F.lit(0.0))
    total = F.col("part") + more
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.value.train_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
