"""Spelling variants: words one edit apart, over a bit-sliced index of the vocabulary.

Two words one edit apart share their first or their last ``p`` letters, where ``p`` is half
of the shorter one's length less one, rounded down.  So every word goes to four shards: by
its first and by its last letters, with words of its own length and one more, and with
words of its own length and one less.  A shard holds one bitset per (position, letter): the
words with that letter there.  A word runs over the index once; three recurrences keep the
words without an error so far and those with one error, at a position shifted by none, one
more or one less, for all words of the shard at once.  Each pair is counted in one shard.

A shard of more than ``block`` words is split into blocks by a hash of the word: its words
are queries in each block and index entries in one.

Words are maximal runs of Latin letters, A-Z lower-cased.  A run's h is the unsigned
CRC-32 of ``<doc_id>:<run>``; where ``typo_every`` divides it, the run loses its letter
``h % length``.  What is left counts if it has ``min_length`` letters and ``min_count``
occurrences in all texts.  A word's form is its most frequent near word (the smallest of
equals), if that is ``ratio`` times as frequent as the word or more; the root follows forms
to the last.

Defined results: a null text has no words; a null doc_id reads as ``null``; rows count each,
also equal ones; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, texts, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words that a task counts before it hands its counts over.
HELD = 200_000
FOUND = "word string, n_near long, form_n long, form string"


def result_of(doc_id: bytes, run: str, typo_every: int) -> str:
    """The run, without a letter where the hash says so."""
    crc = zlib.crc32(doc_id + run.encode())
    if crc % typo_every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def _counts(min_length: int, typo_every: int):
    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                key = f"{'null' if doc_id is None else doc_id}:".encode()
                # of bytes: A-Z only
                for found, n in Counter(RUN.findall(text.lower().decode())).items():
                    word = result_of(key, found, typo_every)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield batch_of(held)
                    held = Counter()
        if held:
            yield batch_of(held)

    return run


def vocabulary(docs: DataFrame, min_length: int = 5, min_count: int = 3, typo_every: int = 97) -> DataFrame:
    """(word, n) of the words that count."""
    counted = docs.select("doc_id", "text").mapInArrow(_counts(min_length, typo_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Index:
    """Bitsets per (position, letter) of words of ``length`` and ``length + 1`` letters.

    With ``skip``, all words are known to begin with the same so many letters.
    """

    def __init__(self, words: list[str], length: int, skip: int = 0):
        self.words, self.length, self.skip = words, length, skip
        self.sliced: list[dict[str, int]] = [{} for _ in range(length + 1)]
        self.longer = 0
        for k, word in enumerate(words):
            bit = 1 << k
            if len(word) > length:
                self.longer |= bit
            for at in range(skip, len(word)):
                at_letter = self.sliced[at]
                at_letter[word[at]] = at_letter.get(word[at], 0) | bit
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> Iterator[str]:
        """Indexed words one edit from ``word``: of both lengths, but not two that are both longer."""
        found = self._shorter(word) if len(word) > self.length else self._no_shorter(word)
        while found:
            low = found & -found
            yield self.words[low.bit_length() - 1]
            found ^= low

    def _no_shorter(self, word: str) -> int:
        """One letter replaced, or one more letter in the indexed word."""
        same, replaced, shifted = self.all, 0, 0
        for at in range(self.skip, len(word)):
            here, after = self.sliced[at].get(word[at], 0), self.sliced[at + 1].get(word[at], 0)
            replaced = replaced & here | same & ~here
            shifted = (shifted | same) & after
            same &= here
            if not (same | replaced | shifted):
                return 0
        return replaced & ~self.longer | (shifted | same) & self.longer

    def _shorter(self, word: str) -> int:
        """One letter less in the indexed word."""
        same, shifted = self.all, 0
        for at in range(self.skip, len(word)):
            before = self.sliced[at - 1].get(word[at], 0) if at > self.skip else 0
            shifted = shifted & before | same
            same &= self.sliced[at].get(word[at], 0)
        return shifted & ~self.longer


def piece(length: int) -> int:
    """Letters that a word of this length shares, at one end, with any near word that is not shorter."""
    return (length - 1) // 2


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, suffix, shard, block, query_only, word, n), in that order; a block's index entries come first."""
    rows: list[tuple] = []
    key, words, counts, index = None, [], {}, None

    def ask(word: str, n: int) -> None:
        length, suffix = key[:2]
        p = piece(length)
        near, best = 0, (0, "")
        for other in index.near(word[::-1] if suffix else word):
            if suffix:
                other = other[::-1]
                if other[:p] == word[:p]:  # counted by the first letters
                    continue
            near += 1
            size = counts[other]
            if size > best[0] or size == best[0] and other < best[1]:
                best = (size, other)
        if near:
            rows.append((word, near, *best))

    def built() -> Index:
        entries = [w[::-1] for w in words] if key[1] else words
        return Index(entries, key[0], piece(key[0]))

    def own() -> None:
        """Every index entry is a query in its own block."""
        if len(words) > 1:
            for word in words:
                ask(word, counts[word])

    def out() -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "form_n", "form"])

    for batch in batches:
        for *at, query_only, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != key:
                if key is not None and index is None and len(words) > 1:
                    index = built()
                    own()
                key, words, counts, index = at, [], {}, None
            if not query_only:
                words.append(word)
                counts[word] = n
            else:
                if index is None:
                    index = built()
                    own()
                ask(word, n)
        if len(rows) > 5000:
            yield out()
            rows = []
    if key is not None and index is None and len(words) > 1:
        index = built()
        own()
    if rows:
        yield out()


def near_words(words: DataFrame, block: int = 1 << 14) -> DataFrame:
    """(word, n_near, form_n, form) of the words (word, n) that have near ones: their number,
    and the most frequent of them with its count.  A word is in ``words`` once."""
    length = F.length("word")
    ends = [
        F.struct(
            least.cast("int").alias("length"),
            F.lit(suffix).alias("suffix"),
            (F.right if suffix else F.left)(F.col("word"), F.floor((least - 1) / 2).cast("int")).alias("shard"),
        )
        for least in (length, length - 1)
        for suffix in (False, True)
    ]
    keys = ["length", "suffix", "shard"]
    spread = words.select("word", "n", F.explode(F.array(*ends)).alias("end")).select("word", "n", "end.*")
    sizes = written(spread.groupBy(*keys).agg(F.count("*").alias("size")).filter("size > 1"), "shards")
    spread = spread.join(sizes, keys)
    blocks = F.ceil(F.col("size") / block)
    home = F.pmod(F.xxhash64("word"), blocks)
    dealt = spread.withColumn("home", home).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = dealt.select(*keys, "block", (F.col("block") != F.col("home")).alias("query_only"), "word", "n")
    ordered = rows.repartition(partitions(words.sparkSession), *keys, "block").sortWithinPartitions(*keys, "block", "query_only")
    found = ordered.mapInArrow(_search, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", (-F.col("best.order")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms are followed to the last, twice as far in each round."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        joined = now.join(ahead, "root", "left")
        followed = joined.select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        following = written(followed, "roots")
        now = following.select("word", "root")
        if following.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, ratio: float = 2.0, block: int = 1 << 14, **words_options) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that counts."""
    words = written(vocabulary(docs, **words_options), "words")
    near = words.join(near_words(words, block), "word", "left")
    taken = F.col("form_n") >= F.lit(ratio) * F.col("n")
    judged = written(
        near.select(
            "word",
            F.when(taken, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("form_n")).alias("form_n"),
        ),
        "forms",
    )
    followed = roots(judged.filter("form IS NOT NULL"))
    out = judged.join(followed, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
