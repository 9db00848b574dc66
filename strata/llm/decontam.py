"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton accepts every run of consecutive words of every benchmark item.  Documents
are streamed through it word by word: the state and the matched length give, at each
word, the longest run of item words that ends there.  A matched length of ``window`` or
more words hits all its words; an item of fewer words is hit where the whole of it ends.

The automaton grows with the benchmark, not with the documents.  Items are taken in
blocks of at most ``block_words`` words, each with an automaton of its own that is
broadcast (its size is bounded by the block), and what the blocks find is united per
document.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
Defined results: a null text, of a document or an item, has no words; an item without
words is never found; rows that repeat an item_id are one item with several texts, and a
null item_id is left out of the list of items but still hits words; each repeated
document row is reported; an empty benchmark finds nothing, an empty document table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, text_tag, texts, written

# Fixed value: what is not part of a word.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
HITS = "starts array<int>, ends array<int>, items array<string>, n_words long"


def words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: By state, for the run of ``window`` words in it: the items that hold this run.
        self.window_items: dict[int, set[str]] = {}
        #: By state, for whole items of fewer words: (number of words, item), shortest first.
        self.short_items: dict[int, list[tuple[int, str | None]]] = {}
        #: By state, the nearest state from here on, by suffix links, with short items; -1 without one.
        self.short_state: list[int] = []

    def _extend(self, last: int, word: int) -> int:
        """The state after ``word``; an item's states may already be there."""
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._split(last, word, known)
        state = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at != -1:
            other = self.next[at][word]
            self.link[state] = other if self.length[other] == self.length[at] + 1 else self._split(at, word, other)
        return state

    def _split(self, at: int, word: int, other: int) -> int:
        """Parts the runs of ``other`` that end ``at`` + word from its longer ones."""
        short = len(self.next)
        self.next.append(dict(self.next[other]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[other])
        self.link[other] = short
        while at != -1 and self.next[at].get(word) == other:
            self.next[at][word] = short
            at = self.link[at]
        return short

    def build(self, items: list[tuple[str | None, list[bytes]]]) -> "SuffixAutomaton":
        coded = [(item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for item, ws in items if ws]
        for _, codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        for item, codes in coded:
            state = 0
            for i, code in enumerate(codes):
                state = self.next[state][code]
                if i + 1 >= self.window:
                    self.window_items.setdefault(self.window_state(state), set()).add(item)
            if len(codes) < self.window:
                self.short_items.setdefault(state, []).append((len(codes), item))
        for found in self.short_items.values():
            found.sort(key=lambda x: x[0])
        self.short_state = [-1] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            self.short_state[state] = state if state in self.short_items else self.short_state[self.link[state]] if state else -1
        return self

    def window_state(self, state: int) -> int:
        """The state of the last ``window`` words of a run of ``state`` with as many or more."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit runs of words, as merged (start, end), and the items found."""
        get, nxt, link, length, window = self.vocabulary.get, self.next, self.link, self.length, self.window
        short_state, runs, seen_states, items = self.short_state, [], set(), set()
        some_short = bool(self.short_items)
        state = matched = 0
        for i, word in enumerate(text):
            code = get(word)
            if code is None:
                state = matched = 0
                continue
            to = nxt[state].get(code)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = nxt[state].get(code)
            if to is None:
                matched = 0
                continue
            state, matched = to, matched + 1
            hit = 0
            if matched >= window:
                hit = matched
                seen_states.add(self.window_state(state))
            if some_short:
                at = short_state[state]
                while at != -1:
                    for n, item in self.short_items[at]:
                        if n > matched:
                            break
                        items.add(item)
                        hit = max(hit, n)
                    at = short_state[link[at]] if at else -1
            if hit:
                start = i + 1 - hit
                while runs and runs[-1][1] >= start:
                    start = min(start, runs.pop()[0])
                runs.append((start, i + 1))
        for s in seen_states:
            items |= self.window_items[s]
        return runs, items


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items with their words, streamed, in blocks of at most ``block_words`` words or one item."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item"), "text").toLocalIterator():
        found = words((row["text"] or "").encode())
        if block and size + len(found) > block_words:
            yield block
            block, size = [], 0
        block.append((row["item"], found))
        size += len(found)
    if block:
        yield block


def _scanner(automaton, columns: list[str]):
    def scan(batch):
        found = []
        for text in texts(batch):
            ws = words(text)
            runs, items = automaton.value.scan(ws)
            found.append(([s for s, _ in runs], [e for _, e in runs], sorted(x for x in items if x is not None), len(ws)))
        starts, ends, items, n = zip(*found, strict=True) if found else ((), (), (), ())
        ints, strings = pa.list_(pa.int32()), pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in columns]
            + [pa.array(starts, ints), pa.array(ends, ints), pa.array(items, strings), pa.array(n, pa.int64())],
            names=[*columns, "starts", "ends", "items", "n_words"],
        )

    return scan


def _schema(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema if f.name in columns)


def merge_runs(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Overlapping or touching runs, united, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_items(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, columns: list[str], window: int = 10, block_words: int = 1_000_000
) -> DataFrame:
    """``columns`` of ``docs`` with starts, ends (hit runs of words), items and n_words, row by row.

    With more than one block, ``columns`` must tell documents apart, but for repeated rows.
    """
    parts = []
    for block in item_blocks(benchmark, block_words):
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(window).build(block))
        parts.append(mapped(docs, _scanner(automaton, columns), _schema(docs, columns) + HITS))
    if not parts:
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(window).build([]))
        parts.append(mapped(docs, _scanner(automaton, columns), _schema(docs, columns) + HITS))
    if len(parts) == 1:
        return parts[0]
    union = written(parts[0], "block")
    for part in parts[1:]:
        union = union.unionAll(written(part, "block"))
    united = union.groupBy(*columns).agg(
        F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("n_words").alias("n_words"),
        (F.count("*") / len(parts)).cast("long").alias("copies"),
    )
    rows = united.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select(*columns, F.col("runs.starts").alias("starts"), F.col("runs.ends").alias("ends"), "items", "n_words")


def _digests(batch):
    columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "n_words", "starts", "ends", "items")}
    starts, ends, items = (columns[c].to_pylist() for c in ("starts", "ends", "items"))
    n_hit = [sum(e - s for s, e in merge_runs(a, b)) for a, b in zip(starts, ends, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            columns["doc_id"],
            columns["n_words"],
            pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
            pa.array([n > 0 for n in n_hit], pa.bool_()),
        ],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def hit_digests(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    rows = docs.select("doc_id", text_tag().alias("tag"), "text")
    found = find_items(spark, rows, benchmark, ["doc_id", "tag"], window, block_words)
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return mapped(found.drop("tag"), _digests, schema)


def cut_runs(text: str, runs: list[tuple[int, int]]) -> str:
    """``text`` without the runs of words, each with what stands between its words."""
    raw = text.encode()
    spans = [m.span() for m in WORD.finditer(raw.lower())]
    out, at = [], 0
    for start, end in runs:
        out.append(raw[at : spans[start][0]])
        at = spans[end - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def decontaminate(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = 1_000_000
) -> DataFrame:
    """``docs`` without their hit runs of words; documents of which more than ``max_coverage`` is hit go."""
    tagged = docs.withColumn("_tag", text_tag())
    found = find_items(spark, tagged.select("doc_id", "_tag", "text"), benchmark, ["doc_id", "_tag"], window, block_words)
    hit = written(found.filter("size(starts) > 0").dropDuplicates(["doc_id", "_tag"]), "hits")
    h = hit.select(F.col("doc_id").alias("_hit_doc"), F.col("_tag").alias("_hit_tag"), "starts", "ends", "n_words")
    h = h.select("_hit_doc", "_hit_tag", F.struct("starts", "ends", "n_words").alias("_hit"))
    joined = tagged.join(h, F.col("doc_id").eqNullSafe(F.col("_hit_doc")) & (F.col("_tag") == F.col("_hit_tag")), "left")
    rest = [c for c in docs.columns if c != "text"]

    def cut(batch):
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        hits, kept, stay = columns.pop("_hit").to_pylist(), [], []
        for text, hit_ in zip(columns.pop("text").to_pylist(), hits, strict=True):
            runs = merge_runs(hit_["starts"], hit_["ends"]) if hit_ else []
            stay.append(not runs or sum(e - s for s, e in runs) <= max_coverage * hit_["n_words"])
            kept.append(cut_runs(text, runs) if runs and stay[-1] else text)
        columns["_kept_text"] = pa.array(kept, pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).filter(pa.array(stay, pa.bool_()))

    out = mapped(joined.select(*rest, "text", "_hit"), cut, _schema(docs, rest) + "_kept_text string")
    return out.select(*[F.col("_kept_text").alias("text") if c == "text" else c for c in docs.columns])
