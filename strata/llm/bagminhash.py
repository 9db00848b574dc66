"""Near-duplicates by weighted MinHash over the multiset of word shingles (BagMinHash).

Every shingle's weight range is cut into (0, 1], (1, 2], (2, 4], (4, 8] ...  On each cut a
Poisson process, seeded by the shingle and the cut, puts points at its length's rate into
random registers; a point is placed at a random unit of its cut, and counts if the
shingle's weight reaches that unit.  A register keeps its earliest point, so two texts
agree in a register with the probability of their weighted Jaccard similarity.  Points are
made in order of time and only up to the time by which all registers are filled.

Texts with equal words are one node, whatever their number.  Nodes that share a band of
their signature are candidates: each is compared with the band's least node first.  The
nodes that share bands with one least node are a group.  Where they are then not all linked,
those outside the least one's component are searched in blocks of the group: a block is held as an inverted index from shingles
to nodes, so that one pass over a node's shingles counts its overlap with every node of the
block, and no pair is made.  First they are searched in one block of each group, then, with
the links found so far, in all of them; only links between components leave a task.  So a
large group costs few rows, and no pair that could link two components is left out.

Similar texts share no band with a probability of 5 in 100,000 at the defaults.  An exact check
follows: of texts as sets of numbered shingles in one order, similar ones share one of their
first ones (``prefix``), so nodes of different classes that share one there, and are of sizes
that allow a link, are groups too.  First shingles alone then show which of them can be similar,
and the texts of those are searched in the same way.  The order puts first what a sample of the
texts has not or seldom; the sample changes the size of these groups, never the links.

Words are what stands between white space (U+0020, U+0009 to U+000D), A-Z lower-cased; a
text of fewer than ``width`` words is one shingle.  Defined results: rows that share a
doc_id are one document, similar to what any of their texts is similar to, for
``class_of_documents``; ``keep_one_per_class`` takes rows that share a doc_id but not their
text as documents of their own.  A null doc_id, and there a shared one, takes a number made
of doc_id and text, above 2**62; a text without words is in no one else's class; an empty
table gives an empty result; other columns of the input are ignored by ``near_classes`` and
kept by ``keep_one_per_class``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, mix64, partitions, text_tag, texts, written

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(5).integers(0, 2**62, 64, dtype=np.uint64) * _U(2) + _U(1)
#: Nodes and words of a block that a task holds, and nodes that it searches there.
BLOCK_NODES, BLOCK_WORDS, QUERIES = 512, 2_000_000, 1024
#: Texts whose shingles are counted for the order of the exact check, and counts that tasks hold.
SAMPLE, COUNTED = 10_000, 200_000
FOUND = "a long, b long"


def word_list(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and the six separators, only


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, in order."""
    hashes = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words)))
    n = max(1, len(words) - width + 1) if len(words) else 0
    out = np.full(n, len(words[:width]), dtype=np.uint64)
    for k in range(min(width, len(words))):
        out += hashes[k : k + n] * _ODD[k]
    return mix64(out)


def bag_minhash(elements: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """Times of the earliest point in each of ``m`` registers, for different elements with whole weights."""
    seeds, rates, below, reach = [mix64(elements + _GOLDEN)], [np.ones(len(elements))], [np.zeros(len(elements))], [weights]
    cut = 1
    while (more := weights > cut).any():
        seeds.append(mix64(elements[more] + _U(int(_GOLDEN) * (2 * cut + 1) % 2**64)))
        rates.append(np.full(more.sum(), float(cut)))
        below.append(np.full(more.sum(), float(cut)))
        reach.append(weights[more])
        cut *= 2
    seed, rate, low, top = (np.concatenate(x) for x in (seeds, rates, below, reach))
    until = m * (np.log(m) + 5.0) / weights.sum()
    while True:
        out = np.full(m, np.inf)
        s, r, lo, w = seed, rate, low, top
        at, step = np.zeros(len(s)), 0
        while len(s):
            ahead = int(min(256, max(3, 1.3 * until * r.mean() + 2)))
            number = (np.arange(step, step + ahead).astype(np.uint64) * _U(2) + _U(1)) * _GOLDEN
            u = ((mix64(s[:, None] + number) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
            gaps = -np.log(u)
            gaps[:, 0] += at  # the sums are the same to the last bit wherever a process was cut
            sums = np.cumsum(gaps, axis=1)
            time = sums / r[:, None]
            where = mix64(s[:, None] ^ (number + _GOLDEN))
            unit = np.floor(((where >> _U(32)).astype(np.float64) * 2.0**-32) * r[:, None]) + lo[:, None]
            counts = (time < until) & (unit < w[:, None])
            np.minimum.at(out, (where[counts] & _U(0xFFFFFFFF)) % _U(m), time[counts])
            on = time[:, -1] < until
            s, r, lo, w, at, step = s[on], r[on], lo[on], w[on], sums[on, -1], step + ahead
        if np.isfinite(out).all():
            return out
        until *= 2.0


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = len(signature) // bands
    values = signature[: bands * rows].view(np.uint64).reshape(bands, rows)
    return mix64((mix64(values) * _ODD[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(bands).astype(np.uint64) * _GOLDEN)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, as (elements in order, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def multiset(text: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(word_list(text), width), return_counts=True)


def numbered_shingles(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """64-bit hashes of a multiset's elements, the copies of each numbered from 0."""
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix64(np.repeat(elements, counts) + number.astype(np.uint64) * _GOLDEN)


def prefix(elements: np.ndarray, counts: np.ndarray, threshold: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first numbered shingles of a multiset in an order that all multisets share: by the binary
    logarithm of their count in ``common`` (hashes in order, counts), then by hash.

    Multisets of a similarity of at least ``threshold`` share at least ``threshold`` times the larger
    one's size, so that one of these is shared.
    """
    hashes = numbered_shingles(elements, counts)
    rank = np.zeros(len(hashes), np.uint64)
    if len(common[0]):
        at = np.minimum(np.searchsorted(common[0], hashes), len(common[0]) - 1)
        there = common[0][at] == hashes
        rank[there] = np.log2(common[1][at[there]]).astype(np.uint64) + _U(1)
    order = (rank << _U(57)) | (hashes >> _U(7))  # the logarithm of a count is below 63
    first = len(order) - max(1, int(np.ceil(threshold * len(order) - 1e-6))) + 1
    return np.sort(np.partition(order, first - 1)[:first])


def _counted(width: int):
    def count(batch):
        hashes = [numbered_shingles(*multiset(text, width)) for text in texts(batch)]
        found, n = np.unique(np.concatenate(hashes), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

    return count


def common_shingles(keyed: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts of the numbered shingles that a sample of the texts repeats most."""
    every = max(1, keyed.count() // SAMPLE)
    sample = keyed.filter(F.pmod(F.xxhash64("doc", "tag"), F.lit(every)) == 0).select("text")
    counts = mapped(sample, _counted(width), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1")
    found = counts.orderBy(F.desc("n"), "hash").limit(COUNTED).toArrow()
    hashes, n = (found.column(c).to_numpy() for c in ("hash", "n"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], n[order]


def _signatures(width: int, threshold: float, bands: int, rows: int, common):
    def sign(batch):
        hashes, keys, firsts, size = [], [], [], []
        for text in texts(batch):
            words = word_list(text)
            hashes.append(xxhash.xxh3_128_digest(b" ".join(words)))
            size.append(len(words))
            if words:
                elements, weights = np.unique(shingles(words, width), return_counts=True)
                keys.append(band_keys(bag_minhash(elements, weights, bands * rows), bands).view(np.int64))
                firsts.append(prefix(elements, weights, threshold, common.value).view(np.int64))
            else:
                keys.append(np.empty(0, np.int64))
                firsts.append(np.empty(0, np.int64))
        both = np.frombuffer(b"".join(hashes), dtype=np.int64).reshape(-1, 2)
        arrays = [batch.column(batch.schema.get_field_index("doc")), pa.array(both[:, 0]), pa.array(both[:, 1])]
        arrays += [pa.array(size, pa.int64()), *(pa.array(k, pa.list_(pa.int64())) for k in (keys, firsts))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc", "h1", "h2", "n_words", "keys", "firsts"])

    return sign


def _compare(width: int):
    def compare(batch):
        ids = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b")]
        found, last = [], (None, None)
        for text_a, text_b in zip(texts(batch, "text_a"), texts(batch, "text_b"), strict=True):
            if last[0] != text_b:  # rows come in order of b
                last = (text_b, multiset(text_b, width))
            found.append(similarity(multiset(text_a, width), last[1]))
        arrays = [*(pa.array(i, pa.int64()) for i in ids), pa.array(found, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "similarity"])

    return compare


class Block:
    """Nodes held as an inverted index of their multisets."""

    def __init__(self, nodes: list[tuple[int, int]], sets: list[tuple[np.ndarray, np.ndarray]]):
        self.nodes = nodes
        self.sizes = np.array([c.sum() for _, c in sets])
        elements = np.concatenate([e for e, _ in sets])
        owners = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
        order = np.argsort(elements, kind="stable")
        self.elements, first = np.unique(elements[order], return_index=True)
        self.bounds = np.append(first, len(elements))
        self.owners, self.counts = owners[order], np.concatenate([c for _, c in sets])[order]

    def shared(self, elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Size of every node's overlap with a multiset."""
        at = np.minimum(np.searchsorted(self.elements, elements), len(self.elements) - 1)
        there = self.elements[at] == elements
        first, last = self.bounds[at[there]], self.bounds[at[there] + 1]
        lengths = last - first
        entries = np.arange(lengths.sum()) + np.repeat(first - np.cumsum(lengths) + lengths, lengths)
        both = np.minimum(self.counts[entries], np.repeat(counts[there], lengths))
        return np.bincount(self.owners[entries], weights=both, minlength=len(self.nodes))

    def similar(self, elements: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
        """Numbers of the nodes that are similar to a multiset."""
        both = self.shared(elements, counts)
        return np.flatnonzero(both / (self.sizes + counts.sum() - both) >= threshold)


def _search(width: int, threshold: float):
    """Rows (lead, block, turn, query, doc, class, text) in that order, a block's nodes before its queries, become links."""

    def run(batches):
        at, nodes, sets, block, found = None, [], [], None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for *key, query, doc, class_, text in zip(*columns, texts(batch), strict=True):
                if key != at:
                    at, nodes, sets, block = key, [], [], None
                if not query:
                    nodes.append((doc, class_))
                    sets.append(multiset(text, width))
                    continue
                if not nodes:
                    continue
                block = block or Block(nodes, sets)
                links = {}  # one for each other class
                for i in block.similar(*multiset(text, width), threshold):
                    if block.nodes[i][1] != class_:
                        links.setdefault(block.nodes[i][1], block.nodes[i][0])
                found += [(doc, other) for other in links.values()]
            if len(found) > 5000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    return run


def _possible(threshold: float):
    """Rows (lead, block, turn, query, doc, class, size, firsts) in that order become (lead, doc) of what may have links.

    Up to the lesser of two texts' last first shingles all that they share is among these; of the
    text that this one belongs to, the rest may be shared."""

    def run(batches):
        at, nodes, firsts, block, found = None, [], [], None, set()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            lists = batch.column(7)
            for n, (*key, query, doc, class_, size) in enumerate(zip(*columns, strict=True)):
                if key != at:
                    if len(found) > 5000:
                        yield _pairs(sorted(found))
                        found = set()
                    at, nodes, firsts, block = key, [], [], None
                own = lists[n].values.to_numpy()
                if not query:
                    nodes.append((doc, class_, size))
                    firsts.append(own)
                    continue
                if not nodes:
                    continue
                if block is None:
                    block = Block(nodes, [np.unique(f, return_counts=True) for f in firsts])
                    classes, sizes = (np.array([x[k] for x in nodes]) for k in (1, 2))
                    last, after = np.array([f[-1] for f in firsts]), sizes - [len(f) for f in firsts]
                both = block.shared(*np.unique(own, return_counts=True))
                most = np.minimum(both + np.where(last <= own[-1], after, size - len(own)), np.minimum(sizes, size))
                may = (both > 0) & (classes != class_) & (most >= threshold * (sizes + size - most) - 1e-6)
                if may.any():
                    found.add((key[0], doc))
                    found.update((key[0], nodes[i][0]) for i in np.flatnonzero(may))
        if found:
            yield _pairs(sorted(found))

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def doc_number(apart: "F.Column | None" = None) -> "F.Column":
    """The doc_id, or a number of doc_id and text for a null one and where ``apart`` holds."""
    made = F.lit(2**62) + F.pmod(F.xxhash64("doc_id", text_tag()), F.lit(2**61))
    own = F.col("doc_id") if apart is None else F.when(~apart, F.col("doc_id"))
    return F.coalesce(own, made)


def numbered(docs: DataFrame) -> DataFrame:
    """(doc, tag, text), where doc is the doc_id or, without one, a number made of the text."""
    return docs.select(doc_number().alias("doc"), text_tag().alias("tag"), "text")


def components(links: DataFrame) -> DataFrame:
    """(doc, class) of every node of the links (a, b): the least node that it is connected with.

    Each round passes labels along the links and then takes the label of the label, so
    long chains shrink by halves.
    """
    both = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("class")).withColumnRenamed("a", "doc"), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("doc", "b"), "b").groupBy("a").agg(F.min("class").alias("heard"))
        told = written(
            labels.join(heard.withColumnRenamed("a", "doc"), "doc").select("doc", "class", F.least("class", "heard").alias("new")), "told"
        )
        jump = told.select(F.col("doc").alias("new"), F.col("new").alias("jumped"))
        following = written(told.join(jump, "new", "left").select("doc", "class", F.coalesce("jumped", "new").alias("now")), "jumped")
        labels = following.select("doc", F.col("now").alias("class"))
        if following.filter("now != class").isEmpty():
            return labels


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def near_classes(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5
) -> DataFrame:
    """(doc, class) of the documents in a class with others."""
    return classes_of(numbered(docs), width, threshold, bands, rows)


def classes_of(keyed: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5) -> DataFrame:
    """``near_classes`` of (doc, tag, text)."""
    common = keyed.sparkSession.sparkContext.broadcast(common_shingles(keyed, width))
    signed = written(
        mapped(
            keyed.select("doc", "text"),
            _signatures(width, threshold, bands, rows, common),
            "doc long, h1 long, h2 long, n_words long, keys array<long>, firsts array<long>",
        ),
        "signatures",
    )
    with_words = signed.filter("n_words > 0")
    nodes = written(
        with_words.groupBy("h1", "h2").agg(F.min("doc").alias("node"), F.first("keys").alias("keys"), F.first("firsts").alias("firsts"), F.first("n_words").alias("n_words"), F.count("*").alias("n")), "nodes"
    )
    same = with_words.select("doc", "h1", "h2").join(nodes.filter("n > 1").select("h1", "h2", "node"), ["h1", "h2"])
    links = [written(same.filter("doc != node").select(F.col("doc").alias("a"), F.col("node").alias("b")).distinct(), "copies")]

    in_band = nodes.select(F.explode("keys").alias("key"), F.col("node").alias("doc"), "n_words")
    shared = written(in_band.groupBy("key").agg(F.min("doc").alias("lead"), F.count("*").alias("size")).filter("size > 1").drop("size"), "bands")
    members = written(in_band.join(shared, "key").groupBy("lead", "doc").agg(F.max("n_words").alias("n_words")), "members")
    pairs = members.filter("doc != lead").select(F.col("doc").alias("a"), F.col("lead").alias("b"))
    held = _texts_of(keyed, members)

    texts_a, texts_b = held.toDF("a", "text_a").hint("merge"), held.toDF("b", "text_b").hint("merge")
    compared = mapped(
        pairs.join(texts_a, "a").join(texts_b, "b").select("a", "b", "text_a", "text_b"),
        _compare(width),
        "a long, b long, similarity double",
    )
    links.append(written(compared.filter(F.col("similarity") >= threshold).select("a", "b").distinct(), "compared"))
    classes = written(components(_union(links)), "classes")
    classes = _linked(members, classes, held, width, threshold, 3)  # two documents that share a band were compared
    alike = written(_alike(nodes, classes, width, threshold), "alike")
    firsts = nodes.select(F.col("node").alias("doc"), _size(width).alias("size"), "firsts")
    dealt = _dealt(alike, classes, firsts, 2, in_blocks="all")
    possible = dealt.mapInArrow(_possible(threshold), FOUND).distinct().toDF("lead", "doc")
    possible = written(possible.join(alike, ["lead", "doc"]), "possible")
    return classes if possible.isEmpty() else _linked(possible, classes, _texts_of(keyed, possible), width, threshold, 2)


def _size(width: int) -> "F.Column":
    """Number of shingles of a text with words."""
    return F.greatest(F.col("n_words") - width + 1, F.lit(1))


def _texts_of(keyed: DataFrame, members: DataFrame) -> DataFrame:
    # texts meet keys by a sort-merge join at every size: neither side has a bound
    involved = members.select("doc").distinct().hint("merge")
    return written(keyed.join(involved, "doc").dropDuplicates(["doc", "tag"]).select("doc", "text"), "involved")


def _linked(members: DataFrame, classes: DataFrame, held: DataFrame, width: int, threshold: float, least: int) -> DataFrame:
    """``classes`` after the links between classes in groups of at least ``least`` documents."""
    for in_blocks in ("first", "others"):
        dealt = _dealt(members, classes, held, least, in_blocks)
        found = written(dealt.mapInArrow(_search(width, threshold), FOUND).distinct(), "found")
        if not found.isEmpty():  # a first block without links says nothing of the others
            classes = _joined(classes, found)
    return classes


def _alike(nodes: DataFrame, classes: DataFrame, width: int, threshold: float) -> DataFrame:
    """(lead, doc, n_words) of nodes of several classes that share one of their first shingles, and whose
    sizes allow a link; the least of them is the lead."""
    each = nodes.select(F.explode("firsts").alias("key"), F.col("node").alias("doc"), _size(width).alias("size"))
    same = Window.partitionBy("key")
    several = each.withColumn("low", F.min("doc").over(same)).withColumn("high", F.max("doc").over(same)).filter("low != high")
    shared = written(several.select("key", "doc", "size"), "shared")
    # linked sizes differ by a factor of 1 / threshold at most, so they are in the same step or in neighbouring ones
    step = F.floor(F.log(F.col("size").cast("double")) / -np.log(min(threshold, 1.0) * (1 - 1e-6)))
    labelled = shared.join(classes, "doc", "left").select("key", "doc", F.coalesce("class", "doc").alias("class"), F.explode(F.array(step, step + 1)).alias("step"))
    same = Window.partitionBy("key", "step")
    found = labelled.select("doc", F.min("doc").over(same).alias("lead"), F.min("class").over(same).alias("low"), F.max("class").over(same).alias("high"))
    words = nodes.groupBy("node").agg(F.max("n_words").alias("n_words")).withColumnRenamed("node", "doc")
    return found.filter("low != high").select("lead", "doc").distinct().join(words, "doc")


def _joined(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` after further links, which are few: they are followed between classes, not documents."""
    of = lambda end: classes.select(F.col("doc").alias(end), F.col("class").alias(f"class_{end}"))
    both = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = both.select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b")).distinct()
    merged = components(between).select(F.col("doc").alias("class"), F.col("class").alias("into"))
    ends = links.select(F.col("a").alias("doc")).unionAll(links.select(F.col("b").alias("doc"))).distinct()
    fresh = ends.join(classes, "doc", "left_anti").select("doc", F.col("doc").alias("class"))
    out = classes.unionByName(fresh).join(merged, "class", "left")
    return written(out.select("doc", F.coalesce("into", "class").alias("class")), "classes")


def _dealt(members: DataFrame, classes: DataFrame, held: DataFrame, least: int, in_blocks: str) -> DataFrame:
    """Rows for ``_search``: in groups of at least ``least`` documents and several classes, those outside
    their least one's class ask all documents of the first block, of all blocks where there are others,
    or of "all" blocks of all groups."""
    whole = in_blocks != "first"
    of_node = classes.withColumnRenamed("class", "own")
    labelled = members.join(of_node, "doc", "left").withColumn("class", F.coalesce("own", "doc")).drop("own")
    by_lead = labelled.groupBy("lead").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.min_by("class", "doc").alias("lead_class"),
        F.count("*").alias("size"), F.sum("n_words").alias("words"),
    )
    # what fits into one block is searched whole at once
    open_leads = by_lead.filter(f"low != high AND size >= {least}").withColumn(
        "blocks", F.greatest(F.ceil(F.col("size") / BLOCK_NODES), F.ceil(F.col("words") / BLOCK_WORDS))
    )
    if in_blocks == "others":
        open_leads = open_leads.filter("blocks > 1")
    open_leads = open_leads.select("lead", "lead_class", "blocks", F.ceil(F.col("size") / QUERIES).alias("turns"))
    open_ = written(labelled.join(open_leads, "lead"), "open")
    home, turn = F.pmod(F.xxhash64("doc"), F.col("blocks")), F.pmod(F.xxhash64("doc", F.lit(1)), F.col("turns"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    held_in = open_.select("lead", home.alias("block"), "turns", "doc", "class").filter(F.lit(whole) | (F.col("block") == 0))
    held_in = held_in.select("lead", "block", each(F.col("turns")).alias("turn"), F.lit(False).alias("query"), "doc", "class")
    every = F.col("blocks") if whole else F.lit(1).cast("long")
    asked = open_.filter("class != lead_class").select("lead", each(every).alias("block"), turn.alias("turn"), F.lit(True).alias("query"), "doc", "class")
    keys = ["lead", "block", "turn"]
    dealt = held_in.unionAll(asked).join(held.hint("merge"), "doc").select(*keys, "query", "doc", "class", *(c for c in held.columns if c != "doc"))
    return dealt.repartition(partitions(members.sparkSession), *keys).sortWithinPartitions(*keys, "query")


def class_of_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id and class_id (the least doc of its class) of every row."""
    classes = near_classes(docs, **options)
    rows = docs.select("doc_id", doc_number().alias("doc"))
    joined = rows.join(classes, "doc", "left")
    return joined.select("doc_id", F.coalesce("class", "doc").alias("class_id"))


def keep_one_per_class(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class, that of its least number; of rows equal in doc_id and text, one stays."""
    several = docs.select("doc_id", text_tag().alias("tag")).distinct().groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL")
    several = written(several.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_several")), "several")
    rows = docs.join(several, F.col("doc_id") == F.col("_id"), "left")
    rows = rows.withColumn("_doc", doc_number(F.coalesce("_several", F.lit(False)))).drop("_id", "_several")
    classes = classes_of(rows.select(F.col("_doc").alias("doc"), text_tag().alias("tag"), "text"), **options)
    others = classes.filter("doc != class").select(F.col("doc").alias("_doc"), F.lit(True).alias("_other"))
    kept = rows.join(others, "_doc", "left").filter("_other IS NULL")
    return kept.dropDuplicates(["_doc"]).drop("_doc", "_other")
