"""Removal of repeated byte windows by a depth-limited, most-significant-digit radix sort.

The suffixes that matter start a window of ``length`` bytes.  They are ordered by passes
whose digits cover more of the window each time, and only as deep as the window: equal
groups of the last pass are exactly the repeated windows.  A pass sorts (digit, whole)
pairs over Spark's range partitions and streams them:

1. Neighbouring windows whose least gram hash lies at the same place form a block; the
   digit is that gram, which all of them hold.  A gram that occurs once ends all its
   windows.  Blocks whose whole extent (all bytes of all their windows) is equal are
   repeated as they stand.
2. Where one gram has different extents, one block for each goes on: parts of ``STEP``
   windows, placed by their distance from the gram, with the bytes that all windows of the
   part share as the digit.
3. What differs there goes on window by window.

Equal windows hold the same gram at the same place, so they meet in each pass: nothing is
missed.  Only a block per different extent is expanded, so copies, however many, cost one
row per block.  Digits and wholes are 64-bit hashes each and decide together.  A stream
holds one row; a gram's rows may lie in several partitions, in which case its blocks go on
to the next pass, and the last pass is settled by one row per partition edge.

Defined results: a null text is empty; a text shorter than a window has none; rows equal
in doc_id and text are different places, so they repeat each other; a null doc_id is kept;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_text, mapped, mix64, partitions, texts, written

#: Windows in a part of a block.
STEP = 8
#: Window starts hashed at a time: places in it fit the 16 low bits of a gram's rank.
PIECE = 48_000
_SPAN = 1 << 17  # bytes whose prefix sums are taken at once
_U = np.uint64

# Values of the bytes and bases of the two rolling hashes: odd numbers from a fixed seed.
_RNG = np.random.default_rng(20240630)
_VALUES = _RNG.integers(0, 2**63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
_BASES = (6364136223846793005, 3202034522624059733)


def _power_table(base: int) -> np.ndarray:
    out = np.full(_SPAN + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = [_power_table(b) for b in _BASES]
_INVERSES = [_power_table(pow(b, -1, 2**64)) for b in _BASES]


class Hashes:
    """Hashes of byte ranges of ``data``, at most ``_SPAN`` bytes, that depend on their content alone."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[which][data] * _POWERS[which][: len(data)], out=self.sums[1:], dtype=np.uint64)
        self.inverses = _INVERSES[which]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.inverses[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by minima from both ends of aligned groups."""
    groups = -(-len(values) // width)
    padded = np.full(groups * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(groups, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def blocks(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Blocks of the windows of ``data``: digit, whole, first window, last window, place of the gram."""
    gram = max(1, length * 3 // 10)
    found: list[list[np.ndarray]] = []
    for begin in range(0, len(data) - length + 1, PIECE):
        part = data[begin : begin + PIECE + length - 1]
        hashes, places = Hashes(part), np.arange(len(part) - gram + 1)
        digits = hashes.of(places, places + gram)
        # the place in the low bits: of equal grams the last one in the window counts
        ranks = (digits & ~_U(0xFFFF)) | (_U(0xFFFF) - places.astype(np.uint64))
        least = _U(0xFFFF) - (sliding_min(ranks, length - gram + 1) & _U(0xFFFF))
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], len(least)] - 1
        place = least[first].astype(np.int64)
        found.append([digits[place], hashes.of(first, last + length), first + begin, last + begin, place + begin])
    if not found:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _joined(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring ranges as one."""
    begins = np.flatnonzero(np.r_[True, first[1:] != last[:-1] + 1])
    return first[begins], last[np.r_[begins[1:], len(first)] - 1]


def block_rows(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """digit, whole, lo, shape of what a document sends to the first pass.

    A row for each different block; ``shape`` packs its windows and the gram's place.  The
    blocks that the document itself repeats are settled: their ranges, joined, have a
    negative shape.
    """
    digit, whole, first, last, place = blocks(data, length)
    if not len(digit):
        return digit.view(np.int64), whole.view(np.int64), first, first
    _, at, group, count = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    shape = (last - first) * 65536 + (place - first)
    repeated = np.flatnonzero(count[group] > 1)
    lo, hi = _joined(first[repeated], last[repeated]) if len(repeated) else (first[:0], first[:0])
    spread = mix64(lo.astype(np.uint64)).view(np.int64)
    return (
        np.r_[digit[at].view(np.int64), spread],
        np.r_[whole[at].view(np.int64), spread],
        np.r_[first[at], lo],
        np.r_[shape[at], lo - hi - 1],
    )


KEYS = "doc long, tag long"
ROW = f"digit long, whole long, {KEYS}, lo long, shape long, base long"
NAMES = ["digit", "whole", "doc", "tag", "lo", "shape", "base"]
#: What a pass finds out: all windows of the row are repeated, or the row goes on.
REPEATED, ON = 0, 1


def _ints(batch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _first_rows(length: int):
    def rows(batch):
        docs, tags, parts = _ints(batch, "doc"), _ints(batch, "tag"), []
        for i, text in enumerate(texts(batch)):
            digit, whole, lo, shape = block_rows(np.frombuffer(text, dtype=np.uint8), length)
            n = len(digit)
            parts.append([digit, whole, np.full(n, docs[i]), np.full(n, tags[i]), lo, shape, lo])
        if parts:
            yield _batch([np.concatenate(c) for c in zip(*parts, strict=True)], NAMES)

    return rows


def _stream(batches) -> Iterator[pa.RecordBatch]:
    """One sorted partition of a pass: rows with their outcome.

    A run of equal (digit, whole) is repeated from its second row on; the first row of
    each run goes on if its digit has other runs, or is the first or last of the partition.
    """
    held = None  # the first row of the current run, with its state
    for batch in batches:
        columns = np.stack([_ints(batch, n) for n in NAMES])
        settled = columns[5] < 0
        if settled.any():
            yield _batch([*columns[:, settled], np.full(settled.sum(), REPEATED)], [*NAMES, "kind"])
            columns = columns[:, ~settled]
        if not columns.shape[1]:
            continue
        carried = held is not None
        if carried:
            columns = np.concatenate([held["row"][:, None], columns], axis=1)
        digit, whole = columns[0], columns[1]
        new_digit = np.r_[True, digit[1:] != digit[:-1]]
        new_run = new_digit | np.r_[True, whole[1:] != whole[:-1]]
        of_digit, of_run, starts = np.cumsum(new_digit) - 1, np.cumsum(new_run) - 1, np.flatnonzero(new_run)
        rows_in_run = np.bincount(of_run)
        more_runs = np.bincount(of_digit[starts]) > 1
        on = more_runs[of_digit[starts]]
        if carried:
            rows_in_run[0] += held["rows"] - 1
            on |= (of_digit[starts] == 0) & (held["other_runs"] or held["first_digit"])
            more_runs[0] |= held["other_runs"]
        else:
            on |= of_digit[starts] == 0
        repeated = rows_in_run[of_run] > 1
        last = len(starts) - 1
        state = {
            "row": columns[:, starts[last]].copy(),
            "rows": rows_in_run[last],
            "other_runs": bool(more_runs[-1]),
            "first_digit": of_digit[-1] == 0 and (held["first_digit"] if carried else True),
            "on": bool(on[last]) or bool(carried and last == 0 and held["on"]),
        }
        if carried:  # its outcome was given with an earlier batch
            repeated[0] &= held["rows"] < 2
            on[0] &= not held["on"]
        held = state
        for rows, kind in ((np.flatnonzero(repeated), REPEATED), (starts[on], ON)):
            if len(rows):
                yield _batch([*columns[:, rows], np.full(len(rows), kind)], [*NAMES, "kind"])
    if held is not None and not held["on"]:
        yield _batch([held["row"][[i]] for i in range(len(NAMES))] + [np.array([ON])], [*NAMES, "kind"])


def radix_pass(rows: DataFrame, tag: str) -> DataFrame:
    order = ["digit", "whole", "doc", "tag", "lo"]
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(_stream, ROW + ", kind long"), tag)


def _expanded(batch, length: int, cut) -> Iterator[pa.RecordBatch]:
    """Rows of the next pass from rows with their bytes; ``cut`` gives digits and wholes of many."""
    docs, tags, lo, shape, base, origin = (_ints(batch, n) for n in ("doc", "tag", "lo", "shape", "base", "origin"))
    data = [np.frombuffer(t, dtype=np.uint8) for t in texts(batch, "bytes")]
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and size + len(data[end]) <= _SPAN:
            size += len(data[end])
            end += 1
        offset = np.cumsum([0, *(len(d) for d in data[at : end - 1])]) - origin[at:end]
        which, *columns = cut(np.concatenate(data[at:end]), offset, lo[at:end], shape[at:end], length)
        which = which + at
        digit, whole, first, windows = columns
        yield _batch([digit.view(np.int64), whole.view(np.int64), docs[which], tags[which], first, windows, base[which]], NAMES)
        at = end


def _parts(data, offset, lo, shape, length):
    """Parts of STEP windows; ``offset`` turns places of the document into places of ``data``."""
    hi, place = lo + shape // 65536, lo + shape % 65536
    nearest, farthest = (place - hi) // STEP, (place - lo) // STEP
    n = farthest - nearest + 1
    which = np.repeat(np.arange(len(lo)), n)
    number = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + nearest[which]
    end = place[which] - STEP * number  # the last window of the whole part
    first, last = np.maximum(lo[which], end - STEP + 1), np.minimum(hi[which], end)
    hashes, move = Hashes(data), offset[which]
    digit = hashes.of(end + move, end - STEP + 1 + length + move)
    return which, digit, hashes.of(first + move, last + length + move), first, (last - first) * 65536


def _windows(data, offset, lo, shape, length):
    n = shape // 65536 + 1
    which = np.repeat(np.arange(len(lo)), n)
    first = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]
    at = first + offset[which]
    return which, Hashes(data).of(at, at + length), Hashes(data, 1).of(at, at + length), first, np.zeros(len(first), np.int64)


SNIPPET = f"{KEYS}, lo long, shape long, base long, origin long, bytes binary"


def _snippets(length: int):
    def cut(batch):
        keys = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc", "tag", "found")]
        out: list[tuple] = []
        for doc, tag, found, text in zip(*keys, texts(batch), strict=True):
            for row in found:
                lo, shape = row["lo"], row["shape"]
                out.append((doc, tag, lo, shape, lo, lo, text[lo : lo + shape // 65536 + length]))
        columns = list(zip(*out, strict=True)) if out else [()] * 7
        arrays = [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc", "tag", "lo", "shape", "base", "origin", "bytes"])

    return cut


def repeated_windows(docs: DataFrame, length: int = 200) -> DataFrame:
    """(doc, tag, lo, hi): ranges of places where a repeated window starts."""
    keyed = by_text(docs).select("doc", "tag", "text")
    by_doc = ["doc", "tag"]
    one = radix_pass(mapped(keyed, _first_rows(length), ROW), "blocks")
    on = one.filter(F.col("kind") == ON).groupBy(*by_doc).agg(F.collect_list(F.struct("lo", "shape")).alias("found"))
    snippets = written(mapped(keyed.join(on, by_doc), _snippets(length), SNIPPET), "snippets")

    def expand(cut):
        return lambda batch: _expanded(batch, length, cut)

    two = radix_pass(mapped(snippets, expand(_parts), ROW), "parts")
    bytes_of = snippets.select("doc", "tag", "base", "origin", "bytes").dropDuplicates(["doc", "tag", "base"])
    held = two.filter(F.col("kind") == ON).select("doc", "tag", "lo", "shape", "base").join(bytes_of, ["doc", "tag", "base"])
    three = radix_pass(mapped(held, expand(_windows), ROW), "windows")
    edges = three.filter(F.col("kind") == ON)  # two per partition at most
    meeting = edges.groupBy("digit", "whole").count().filter("count > 1").select("digit", "whole")
    settled = edges.join(F.broadcast(meeting), ["digit", "whole"])

    def ranges(found: DataFrame) -> DataFrame:
        windows = F.when(F.col("shape") < 0, -F.col("shape") - 1).otherwise(F.floor(F.col("shape") / 65536))
        return found.select("doc", "tag", "lo", (F.col("lo") + windows).alias("hi"))

    done = [p.filter(F.col("kind") == REPEATED) for p in (one, two, three)]
    return ranges(done[0]).unionAll(ranges(done[1])).unionAll(ranges(done[2])).unionAll(ranges(settled))


def removed_spans(lo: list[int], hi: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, as (start, end)."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(zip(lo, hi, strict=True)):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last + length))
        else:
            out.append((first, last + length))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]])


def _digests(length: int):
    def digest(batch):
        found = batch.column(batch.schema.get_field_index("found")).to_pylist()
        rows = []
        for ranges, text in zip(found, texts(batch), strict=True):
            spans = removed_spans([r["lo"] for r in ranges or ()], [r["hi"] for r in ranges or ()], length)
            kept = without(text, spans)
            rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        doc_ids = batch.column(batch.schema.get_field_index("doc_id"))
        arrays = [doc_ids, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return digest


def window_digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    found = repeated_windows(docs, length).groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    joined = by_text(docs).join(found, ["doc", "tag"], "left").select("doc_id", "text", "found")
    return mapped(joined, _digests(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
