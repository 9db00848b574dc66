"""Removal of sentences that a repeated span of consecutive sentences covers.

A span starts at every sentence and takes ``min_sentences`` sentences and as many more as
make ``min_words`` words; another ends at every sentence and takes as many before it.  Every
sentence of a repeated run lies in a span of the one or the other kind inside the run, so
that together they cover exactly all repeated runs.  Which kind a span is of depends on its
sentences alone, so all places of a span are of the same kinds.  All spans' hashes meet in one global sort-merge self-join:
spans are range-partitioned by hash and place and sorted, so that a stream over each
partition sees each hash's places in order.  Every place but the first covers its
sentences, and covered sentences are cut.  A hash's run may cross partitions: the first
row of a partition is then decided by the rows with which other partitions end, one each.

Sentences end at . ! ? before white space, or at a line's end; a sentence of more than
``LONG`` words is taken by clauses, which end at , ; or : before white space.  A clause of
more than ``LONG`` words is taken by parts, which end at words that their own hash chooses,
one in ``CHOSEN``, or else after ``LONG`` words: a repeated passage has the same parts from
the first chosen word on, whatever stands before it.  All these count as sentences.  They
are compared with A-Z lower-cased and white space as one space.  The first place is that
of the least doc_id, then the earliest sentence.  Defined results: a null or empty text
has no sentences and stays as it is; rows equal in doc_id and text are one document and
fare alike; a null doc_id comes first; an empty table gives an empty result; other columns
of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_text, mapped, partitions, texts, written

LONG = 30
#: One in so many words ends a part of a long clause.
CHOSEN = 8
_SENTENCE = re.compile(rb"[^\n]+?(?:[.!?]+(?=\s)|(?=\n)|\Z)\s*")
_CLAUSE = re.compile(rb".+?(?:[,;:](?=\s)|\Z)\s*", re.S)
_WORD = re.compile(rb"\s*\S+\s*")
NAMES = ["h1", "h2", "doc", "tag", "first", "last"]
ROW = "h1 long, h2 long, doc long, tag long, first long, last long"
#: A later place of its span; the first row of a partition; the earliest place of a partition's last span.
LATER, START, END = 0, 1, 2


def _parts(text: bytes, start: int, end: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, words) of the clause, or of its parts if it is long."""
    words = text[start:end].lower().split()
    if len(words) <= LONG:
        yield start, end, words
        return
    first = 0
    for i, (word, m) in enumerate(zip(words, _WORD.finditer(text, start, end), strict=True)):
        if i + 1 == len(words) or i + 1 - first == LONG or xxhash.xxh3_64_intdigest(word) % CHOSEN == 0:
            yield start, m.end(), words[first : i + 1]
            start, first = m.end(), i + 1


def sentences(text: bytes) -> list[tuple[int, int, bytes, int]]:
    """(start, end, digest, words) of the sentences that have words; an end takes the white space after it."""
    out = []
    for m in _SENTENCE.finditer(text):
        words = m[0].lower().split()
        if len(words) <= LONG:
            parts = [(m.start(), m.end(), words)]
        else:
            parts = [p for c in _CLAUSE.finditer(text, m.start(), m.end()) for p in _parts(text, c.start(), c.end())]
        out += [(s, e, xxhash.xxh3_64_digest(b" ".join(ws)), len(ws)) for s, e, ws in parts if ws]
    return out


def spans(found: list[tuple[int, int, bytes, int]], min_sentences: int, min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """(hash, first sentence, last sentence) of every span, once."""
    n, before = len(found), [0]
    for s in found:
        before.append(before[-1] + s[3])

    def enough(first: int, last: int) -> bool:
        return last - first + 1 >= min_sentences and before[last + 1] - before[first] >= min_words

    ranges, last = set(), 0
    for first in range(n):
        while last < n and not enough(first, last):
            last += 1
        if last == n:
            break
        ranges.add((first, last))
    first = 0
    for last in range(n):
        if enough(0, last):
            while enough(first + 1, last):
                first += 1
            ranges.add((first, last))
    for first, last in sorted(ranges):
        yield xxhash.xxh3_128_digest(b"".join(s[2] for s in found[first : last + 1])), first, last


def _span_rows(min_sentences: int, min_words: int):
    def rows(batch):
        hashes, owners, ranges = [], [], []
        for i, text in enumerate(texts(batch)):
            for digest, first, last in spans(sentences(text), min_sentences, min_words):
                hashes.append(digest)
                owners.append(i)
                ranges.append((first, last))
        both = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
        places = np.array(ranges, dtype=np.int64).reshape(-1, 2)
        keys = [batch.column(batch.schema.get_field_index(c)).to_numpy()[owners] if owners else [] for c in ("doc", "tag")]
        columns = [both[:, 0], both[:, 1], *keys, places[:, 0], places[:, 1]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

    return rows


def _later(batches) -> Iterator[pa.RecordBatch]:
    """One sorted partition: every row but the first of its span, and the partition's edges."""

    def out(columns: np.ndarray, kind: int) -> pa.RecordBatch:
        arrays = [pa.array(c, pa.int64()) for c in (*columns, np.full(columns.shape[1], kind))]
        return pa.RecordBatch.from_arrays(arrays, names=[*NAMES, "kind"])

    before = earliest = None
    for batch in batches:
        columns = np.stack([c.to_numpy() for c in batch.columns])
        if not columns.shape[1]:
            continue
        if before is None:
            yield out(columns[:, :1], START)
            before = np.full(len(NAMES), -1)
            before[0] = ~columns[0, 0]
        all_ = np.concatenate([before[:, None], columns], axis=1)
        same = (all_[:2, 1:] == all_[:2, :-1]).all(axis=0)
        again = same & (all_[2:5, 1:] == all_[2:5, :-1]).all(axis=0)  # the same place of a repeated row
        later = np.flatnonzero(same & ~again)
        if len(later):
            yield out(columns[:, later], LATER)
        fresh = np.flatnonzero(~same)
        if len(fresh):
            earliest = columns[:, fresh[-1:]]
        before = columns[:, -1]
    if earliest is not None:
        yield out(earliest, END)


def covered(docs: DataFrame, min_sentences: int = 2, min_words: int = 20) -> DataFrame:
    """(doc, tag, first, last) of all spans but the first of each hash."""
    # written, as dealing out by range reads its input twice
    rows = written(mapped(by_text(docs).select("doc", "tag", "text"), _span_rows(min_sentences, min_words), ROW), "span-rows")
    order = NAMES[:5]
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    found = written(ordered.mapInArrow(_later, ROW + ", kind long"), "spans")
    place = F.struct("doc", "tag", "first")
    ends = found.filter(F.col("kind") == END).select("h1", "h2", place.alias("place"))  # one row per partition at most
    starts = found.filter(F.col("kind") == START).withColumn("own", place)
    settled = starts.join(F.broadcast(ends), ["h1", "h2"]).filter("place < own")
    columns = ["doc", "tag", "first", "last"]
    return found.filter(F.col("kind") == LATER).select(*columns).unionAll(settled.select(*columns).distinct())


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, int, bytes]:
    """Sentences, cut sentences, cut words, and the text without these; ranges are of sentences."""
    found = sentences(text)
    gone = np.zeros(len(found) + 1, dtype=np.int64)
    for first, last in ranges:
        gone[first] += 1
        gone[last + 1] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    out, at, words = [], 0, 0
    for (start, end, _, n), out_ in zip(found, gone, strict=True):
        if out_:
            out.append(text[at:start])
            at, words = end, words + n
    return len(found), int(gone.sum()), words, b"".join([*out, text[at:]])


def with_cuts(docs: DataFrame, min_sentences: int, min_words: int) -> DataFrame:
    """``by_text(docs)`` with the ranges to cut, null where nothing is."""
    found = covered(docs, min_sentences, min_words).groupBy("doc", "tag").agg(F.collect_list(F.struct("first", "last")).alias("cuts"))
    return by_text(docs).join(found, ["doc", "tag"], "left")


def _cut_batch(batch):
    rows = []
    ranges = batch.column(batch.schema.get_field_index("cuts")).to_pylist()
    for text, cuts in zip(texts(batch), ranges, strict=True):
        n, gone, words, kept = cut(text, [(r["first"], r["last"]) for r in cuts or ()])
        rows.append((n, gone, words, kept.decode()))
    n, gone, words, kept = zip(*rows, strict=True) if rows else ((),) * 4
    ints = [pa.array(c, pa.int64()) for c in (n, gone, words)]
    doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
    yield pa.RecordBatch.from_arrays(
        [doc_ids, *ints, pa.array(kept, pa.string())], names=["doc_id", "n_sentences", "n_removed", "n_words_removed", "kept_text"]
    )


def drop_spans(docs: DataFrame, min_sentences: int = 2, min_words: int = 20) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_words_removed and kept_text of every row."""
    rows = with_cuts(docs, min_sentences, min_words).select("doc_id", "text", "cuts")
    return mapped(rows, _cut_batch, "doc_id long, n_sentences long, n_removed long, n_words_removed long, kept_text string")
