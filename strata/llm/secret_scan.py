"""Secret scans, in DataFrame functions only.

Base kinds are patterns with a least length.  The entropy kinds slide a window over every
candidate, a long run of a kind's characters: the window's Shannon entropy is
``log2(W) - sum(c * log2(c)) / W`` over the counts c of its characters, and a step changes
the sum by the two counts that change, that of the character that leaves and that of the one
that enters.  The sum is kept in whole units of 2**-20, so it does not drift.  Numbers of
digits, upper and lower letters are counted in the same way, for what a kind must hold.  A
span runs from the first window above the kind's threshold to the end of the last.  An
allow list suppresses candidates that look like placeholders, those that what stands before
them tells to be a digest or embedded data, and what lies inside such ones; base spans stay.

Everything is computed inside a row, without a shuffle.  Places are code points, the end is
exclusive; the places of a text's matches are running sums over the pieces between them, in
blocks, so that the cost of very many matches stays small.

Defined results: a null text counts as empty and has no span; rows are scanned each, also
equal ones; an empty table gives an empty result; a column that shares its name with the
span column is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Pattern, group that is judged, and its least length.
BASE = {"assign": (ASSIGN, 2, 8), "access": (r"AKIA[A-Z0-9]{12,}", 0, 16), "hex": (r"[0-9a-f]{32,}", 0, 32)}
#: Matches summed one after another before a block's sum moves the next block.
SUMMED = 256
WINDOW = 20
UNIT = 1 << 20
#: Characters of a long candidate that one pass holds.
PIECE = 4096


@dataclass(frozen=True)
class EntropyKind:
    """Runs of ``chars``, and what a window must hold: bits of entropy, digits, upper, lower and all letters."""

    name: str
    chars: str
    bits: float
    digits: int
    upper: int
    lower: int
    letters: int

    @property
    def pattern(self) -> str:
        return f"{self.chars}{{{WINDOW},}}"

    @property
    def most(self) -> int:
        """The largest sum of c * log2(c) in units that leaves ``bits`` of entropy."""
        return math.floor(WINDOW * (math.log2(WINDOW) - self.bits) * UNIT)


ENTROPY = (
    EntropyKind("entropy_hex", "[0-9A-Fa-f]", 3.0, 3, 0, 0, 3),
    EntropyKind("entropy_alnum", "[A-Za-z0-9]", 3.7, 2, 0, 0, 2),
    EntropyKind("entropy_base64", "[A-Za-z0-9+/_-]", 3.7, 2, 2, 2, 4),
)
#: Every candidate lies in one of this kind.
WIDEST = ENTROPY[-1]
#: Kinds as they are listed; spans that start together are in this order.
KINDS = (*BASE, *(k.name for k in ENTROPY))
#: Candidates that are no secrets, and what stands before candidates that are none, back to the one before.
ALLOWED = r"(?i:example|sample|dummy|placeholder|changeme|xxxx|0123456789|abcdefgh|qwerty)"
ALLOWED_BEFORE = r"(?i:(sha-?(1|256|384|512)|md5|checksum|digest|commit)[\"' ]*[:=-]?[\"' ]*|;base64,)$"
BEFORE = 24

#: Prefix of working columns; columns of the input can't have names that begin with it.
_TMP = "_secret_"
_LONGS = "cast(array() as array<bigint>)"
_SPANS = "cast(array() as array<struct<start:bigint,rank:int,end:bigint>>)"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where ``use`` refers to it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(lengths: Column) -> Column:
    """Sums up to and with each element of an array of bigint, block by block."""
    last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("long"))

    def block(values: Column, k: Column) -> Column:
        one = F.slice(values, k * SUMMED + 1, F.lit(SUMMED))
        return F.aggregate(one, F.expr(_LONGS), lambda sums, x: F.concat(sums, F.array(last(sums) + x)))

    def joined(sums: Column, one: Column) -> Column:
        return bound(last(sums), lambda before: F.concat(sums, F.transform(one, lambda x: x + before)))

    def all_blocks(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SUMMED).cast("int"))
        return F.aggregate(F.transform(numbers, lambda k: block(values, k)), F.expr(_LONGS), joined)

    return bound(lengths, lambda values: F.when(F.size(values) > 0, all_blocks(values)).otherwise(F.expr(_LONGS)))


def with_matches(df: DataFrame, patterns: dict[str, tuple[str, int]], can: dict[str, Column]) -> DataFrame:
    """``df`` (with the working column text) and, per name, the array of (found, piece, before, end)
    of a pattern's leftmost matches that don't overlap: the match, one group of it, the last
    characters before it and where it ends; null where there is none.  ``can`` is false only
    for texts without a match, which are not searched.

    Every step is a projection of its own, so that no array is computed twice.
    """
    text, names = F.col(f"{_TMP}text"), list(patterns)
    all_of = lambda name, group: F.regexp_extract_all(text, F.lit(patterns[name][0]), F.lit(group))
    found = {n: F.col(f"{_TMP}{n}_found") for n in names}
    df = df.withColumns({f"{_TMP}{n}_found": F.when(can[n], all_of(n, 0)) for n in names})
    some = {n: F.size(found[n]) > 0 for n in names}
    gaps = lambda n: F.slice(F.split(text, patterns[n][0], -1), F.lit(1), F.size(found[n]))
    before = {
        n: F.transform(gaps(n), lambda g: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(BEFORE)).alias("before"))) for n in names
    }
    df = df.withColumns({f"{_TMP}{n}_before": F.when(some[n], before[n]) for n in names})
    lengths = {n: F.zip_with(found[n], f"{_TMP}{n}_before", lambda m, g: (g["gap"] + F.length(m)).cast("long")) for n in names}
    df = df.withColumns({f"{_TMP}{n}_ends": F.when(some[n], running_sums(lengths[n])) for n in names})
    pieces = {n: all_of(n, patterns[n][1]) if patterns[n][1] else found[n] for n in names}
    df = df.withColumns({f"{_TMP}{n}_pieces": F.when(some[n], pieces[n]) for n in names})

    def tupled(n: str) -> Column:
        two = F.zip_with(found[n], f"{_TMP}{n}_pieces", lambda m, p: F.struct(m.alias("found"), p.alias("piece")))
        rest = F.zip_with(f"{_TMP}{n}_before", f"{_TMP}{n}_ends", lambda b, e: F.struct(b["before"].alias("before"), e.alias("end")))
        return F.zip_with(
            two, rest, lambda x, y: F.struct(x["found"].alias("found"), x["piece"].alias("piece"), y["before"].alias("before"), y["end"].alias("end"))
        )

    df = df.withColumns({f"{_TMP}{n}": F.when(some[n], tupled(n)) for n in names})
    return df.drop(*(f"{_TMP}{n}_{part}" for n in names for part in ("found", "before", "ends", "pieces")))


def _span(start: Column, kind: str, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("long").alias("end"))


def base_spans(found: Column, kind: str) -> Column:
    kept = F.filter(found, lambda m: F.length(m["piece"]) >= BASE[kind][2])
    return F.transform(kept, lambda m: _span(m["end"] - F.length(m["found"]), kind, m["end"]))


def hot_windows(piece: Column, kind: EntropyKind) -> Column:
    """(first, last): the first and last place, from 0, of a window of ``piece`` that is above the
    kind's threshold and holds what it must; nulls where there is none."""
    weight = F.array(*[F.lit(round(c * math.log2(c) * UNIT) if c else 0).cast("long") for c in range(WINDOW + 1)])
    classes = {"digits": ("0", "9"), "upper": ("A", "Z"), "lower": ("a", "z")}

    def grown(count: Column) -> Column:
        """What the sum gains when a character's count goes up by one from ``count``."""
        return F.element_at(weight, count + 2) - F.element_at(weight, count + 1)

    def moved(s: Column, chars: Column, at: Column) -> Column:
        """The state after the character ``at`` entered and the one a window before it left."""
        enters, leaves = F.element_at(chars, at), F.when(at > WINDOW, F.element_at(chars, F.greatest(at - WINDOW, F.lit(1))))
        between = F.slice(chars, F.greatest(at - WINDOW + 1, F.lit(1)), F.least(at - 1, F.lit(WINDOW - 1)))
        came, went = F.size(F.filter(between, lambda c: c == enters)), F.size(F.filter(between, lambda c: c == leaves))
        total = s["total"] + grown(came) - F.when(at > WINDOW, grown(went)).otherwise(F.lit(0))
        is_in = lambda c, ends: F.coalesce(c.between(*ends), F.lit(False)).cast("int")
        counts = ((s[name] + is_in(enters, ends) - is_in(leaves, ends)).alias(name) for name, ends in classes.items())
        return F.struct(total.alias("total"), *counts, s["first"].alias("first"), s["last"].alias("last"))

    def judged(s: Column, at: Column) -> Column:
        good = (at >= WINDOW) & (s["total"] <= kind.most) & (s["upper"] + s["lower"] >= kind.letters)
        for name in classes:
            good = good & (s[name] >= getattr(kind, name))
        place = F.when(good, at - WINDOW)
        first, last = F.coalesce(s["first"], place), F.coalesce(place, s["last"])
        return F.struct(*(s[c].alias(c) for c in ("total", *classes)), first.alias("first"), last.alias("last"))

    zero = F.struct(
        F.lit(0).cast("long").alias("total"),
        *(F.lit(0).alias(c) for c in classes),
        *(F.lit(None).cast("int").alias(c) for c in ("first", "last")),
    )

    def slid(chars: Column) -> Column:
        step = lambda s, at: bound(moved(s, chars, at), lambda t: judged(t, at))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), zero, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return bound(F.split(piece, ""), slid)


def suppressed(found: Column, allowed: str, allowed_before: str) -> Column:
    """(start, end) of the candidates that the allow list names."""
    named = F.filter(found, lambda m: m["found"].rlike(allowed) | m["before"].rlike(allowed_before))
    return F.transform(named, lambda m: F.struct((m["end"] - F.length(m["found"])).alias("start"), m["end"].alias("end")))


def entropy_spans(found: Column, kind: EntropyKind, allowed: str, allowed_before: str, off: Column) -> Column:
    """``off``: places of suppressed runs of the widest kind; what lies inside them is suppressed as well."""
    stride = PIECE - WINDOW + 1
    candidates = F.filter(
        found,
        lambda m: m["found"].rlike("[0-9]") & m["found"].rlike("[A-Za-z]") & ~m["found"].rlike(allowed) & ~m["before"].rlike(allowed_before),
    )

    def hot(m: Column) -> Column:
        """(start, first, last) of a candidate, whose pieces overlap by a window less one."""
        start = m["end"] - F.length(m["found"])
        last_piece = F.floor((F.length(m["found"]) - WINDOW) / stride).cast("int")

        def piece(k: Column) -> Column:
            windows = hot_windows(F.substring(m["found"], k * stride + 1, F.lit(PIECE)), kind)
            return bound(windows, lambda w: F.struct((w["first"] + k * stride).alias("first"), (w["last"] + k * stride).alias("last")))

        def ends(ws: Column) -> Column:
            first, last = F.array_min(F.transform(ws, lambda w: w["first"])), F.array_max(F.transform(ws, lambda w: w["last"]))
            return F.struct(start.alias("start"), first.alias("first"), last.alias("last"))

        return bound(F.transform(F.sequence(F.lit(0), last_piece), piece), ends)

    inside = lambda c, o: (o["start"] <= c["start"]) & (c["start"] < o["end"])
    spans = F.filter(F.transform(candidates, hot), lambda c: c["first"].isNotNull() & ~F.exists(off, lambda o: inside(c, o)))
    return F.transform(spans, lambda c: _span(c["start"] + c["first"], kind.name, c["start"] + c["last"] + WINDOW))


def find_secrets(
    docs: DataFrame, column: str = "secrets", allowed: str = ALLOWED, allowed_before: str = ALLOWED_BEFORE
) -> DataFrame:
    """``docs`` with an array of (start, rank, end) in order; ``KINDS[rank]`` is the kind."""
    patterns = {k: BASE[k][:2] for k in BASE} | {k.name: (k.pattern, 0) for k in ENTROPY}
    text = F.col(f"{_TMP}text")
    # a candidate of any entropy kind is in, or is, such a run
    long_run = text.rlike(f"(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{{WINDOW},}}")
    can = {"assign": F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), "access": F.contains(text, F.lit("AKIA")), "hex": F.lit(True)}
    opened = docs.withColumn(f"{_TMP}text", F.coalesce("text", F.lit(""))).withColumn(f"{_TMP}long_run", long_run)
    found = with_matches(opened, patterns, can | {k.name: F.col(f"{_TMP}long_run") for k in ENTROPY})
    spans = {k: base_spans(F.col(f"{_TMP}{k}"), k) for k in BASE}
    found = found.withColumn(f"{_TMP}off", suppressed(F.col(f"{_TMP}{WIDEST.name}"), allowed, allowed_before))
    off = F.coalesce(f"{_TMP}off", F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"))
    spans |= {k.name: entropy_spans(F.col(f"{_TMP}{k.name}"), k, allowed, allowed_before, off) for k in ENTROPY}
    parts = [F.when(F.col(f"{_TMP}{k}").isNotNull(), s).otherwise(F.expr(_SPANS)) for k, s in spans.items()]
    out = found.withColumn(column, F.array_sort(F.concat(*parts)))
    return out.drop(f"{_TMP}text", f"{_TMP}long_run", f"{_TMP}off", *(f"{_TMP}{k}" for k in patterns))


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; spans that overlap become one mark."""
    found = find_secrets(docs, "_secrets", **options)
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.greatest(span["start"] - s["at"], F.lit(0)).cast("int"))
        fresh = (span["start"] >= s["at"]) & (span["end"] > s["at"])
        return F.struct(
            F.concat(s["out"], F.when(fresh, F.concat(gap, F.lit(mark))).otherwise(F.lit(""))).alias("out"),
            F.greatest(s["at"], span["end"]).alias("at"),
        )

    rest = F.aggregate("_secrets", state, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return found.withColumn("text", F.when(F.size("_secrets") > 0, rest).otherwise(F.col("text"))).drop("_secrets")


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256 and spans of every row."""
    found = find_secrets(docs.select("doc_id", "text")).drop("text")
    names = F.array(*map(F.lit, KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")

    def number(low: int, high: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["rank"].between(low, high))).cast("long")

    return found.select(
        "doc_id",
        *(number(k, k).alias(f"n_{kind}") for k, kind in enumerate(BASE)),
        number(3, len(KINDS) - 1).alias("n_entropy"),
        F.sha2(listed(F.filter("secrets", lambda s: s["rank"] < 3)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )
