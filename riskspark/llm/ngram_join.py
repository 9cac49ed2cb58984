"""Exact self-join of documents on the Jaccard similarity of their word
shingles, by universe-partition pigeonhole, and the groups it makes.

Sets.  A text is lower-cased (A-Z), cut into words, and its distinct
``width``-word shingles are hashed to 64 bits.  Texts with equal sets are one
class, named by a 64-bit digest of the set; from here on only classes count,
so copies cost one row a batch.

Pigeonhole.  Two sets of sizes r and s that link differ in at most
H = (r + s)(1 - t)/(1 + t) elements.  Sizes are cut into bands; in a band the
universe of shingles is hashed into m segments, so that linked sets agree
exactly in at least m - H of them.  A set emits a signature (a digest of its
elements in the segment) for H + 1 of its segments: the cheapest, in an order
that depends on the signature alone.  Of the segments in which two linked
sets agree, the cheapest cannot be skipped by either: skipping it would mean
skipping all m - H of them, one more than a set may skip.  A set whose
partners can be in the band below emits there too, as a prober.

Allocation by cost.  Frequent shingles are counted over all documents.
Segments without a rare element (above all empty ones) are the dearest and
are the ones skipped.  A band whose sets differ in at most one element can
instead use a single segment with its one-deletion neighbourhood (the whole
set, and the set without each one element); ``allocate`` chooses by the
expected number of signatures and of chance meetings.

Candidates.  Sets with a common signature meet in one of many buckets.
Small meetings give pairs; larger ones give stars around a few members, so
no group of copies becomes all pairs.  A pair must pass a parity sketch (the bits
in which two sketches differ never outnumber the elements in which the sets
do, so nothing that links is lost) and is then verified exactly on its texts.
What a star leaves open is closed afterwards, in rounds: members of a meeting
that are still in different components are compared by their sketches, block
by block, and the nearest pairs that pass and were not verified yet are
verified, until none is left.  Links are counted afterwards, over all pairs of
classes of a component.  Signatures that are common already
within a batch go through the shuffle with the sets that share them told once;
all sets of a signature meet.

Defined results: null, empty and blank texts have no shingles and link with
nothing; texts of fewer than ``width`` words have one, the whole sequence;
repeated rows are copies of each other; a null id never names a component
unless all ids in it are null; other columns are ignored; an empty table
gives no rows.  Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.components import connected_components
from riskspark.llm.shared import (batch_slices, hash_words, join_checked, least_row, lower_bytes, mix64, release_memory,
                                  split_words, stage, text_bytes, tidy)

SLICE_BYTES = 2 << 20
BAND_RATIO = 4
SEGMENT_SLACK = 1.5  # segments of a band, times H + 1: the surplus may be skipped
COMMON_SHARE = 0.0001  # of all documents that hold a shingle, for it to be common
COMMON_LEAST = 8  # documents that hold it, at least
CHANCE_COST = 100.0  # rows that a signature of common shingles only is expected to meet
PAIRS_UPTO = 6  # meetings of up to so many sets give all their pairs
STAR_IN_BATCH = 64  # signatures of so many sets in one batch go on as crowds
ENTRIES_A_BUCKET = 500_000
GROUP_BYTES = 8 << 20  # text whose entries are dealt at once
BATCH_BYTES = 16 << 20  # texts, or entries, that a worker is sent at once
BLOCK = 512  # members of a meeting, or classes of a component, compared at once
PART_BYTES = 4 << 20  # text of the classes of a component compared at once
NEAREST = 128  # pairs that a member offers to each other component in a round
CENTERS = 3  # of a star: more of them leave fewer members to the rounds


@dataclass(frozen=True)
class Threshold:
    """Similarity of at least num / den."""
    num: int = 75
    den: int = 100

    def differ(self, r, s):
        """Most elements in which linked sets of sizes r and s differ."""
        return (r + s) * (self.den - self.num) // (self.den + self.num)

    def least(self, n):
        return -(-n * self.num // self.den)

    def most(self, n):
        return n * self.den // self.num


@dataclass(frozen=True)
class Band:
    low: int
    high: int
    segments: int  # 1: the whole set, with its one-deletion neighbourhood


def band_edges(largest: int, t: Threshold) -> list[tuple[int, int]]:
    """Size bands; the first holds the sizes whose sets differ in at most one element."""
    high = 1
    while t.differ(high + 1, t.most(high + 1)) <= 1:
        high += 1
    edges = [(1, high)]
    while edges[-1][1] < largest:
        low = edges[-1][1] + 1
        edges.append((low, max(low, math.ceil(low * max(BAND_RATIO, t.den / t.num)) - 1)))
    return edges


def allocate(edges: list[tuple[int, int]], common_share: list[float], t: Threshold) -> list[Band]:
    """Segments of each band, by expected cost: signatures, and what a
    signature made of common shingles only meets by chance."""
    bands = []
    for (low, high), share in zip(edges, common_share, strict=True):
        worst = t.differ(high, t.most(high))
        segments = math.ceil(SEGMENT_SLACK * (worst + 1))
        exact = (worst + 1) * (1 + CHANCE_COST * share ** max(1.0, high / segments))
        if worst <= 1:
            deletions = (high + 1) * (1 + CHANCE_COST * share ** high)
            segments = 1 if deletions < exact else max(2, segments)
        bands.append(Band(low, high, max(2, segments) if worst > 1 else segments))
    return bands


# ------------------------------------------------------------- sets

_WEIGHTS = mix64(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(raw: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it; bounds."""
    first, last, rows = split_words(raw, starts)
    words = hash_words(lower_bytes(raw), first, last)
    count = np.diff(rows)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], made) + np.repeat(rows[:-1], made)
    length = np.repeat(np.minimum(count, width), made)
    value = length.astype(np.uint64)
    for k in range(width if len(words) else 0):
        inside = k < length
        value = value + np.where(inside, words[np.where(inside, at + k, 0)], np.uint64(0)) * _WEIGHTS[k]
    value = mix64(value)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        value[lo:hi].sort()
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[bounds[:-1][made > 0]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return value[new], upto[bounds]


def _sum_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_digests(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit digest a set; never 0."""
    n = np.diff(bounds).astype(np.uint64)
    return np.maximum(mix64(_sum_rows(mix64(values ^ np.uint64(0x5E7)), bounds) + n), np.uint64(1))


def parity_sketches(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Of each set, the parity of its elements in each of b places; b is the
    power of two (64 at least) that holds four times the set's size.  Half a sketch
    xor the other half is the sketch in b / 2 places."""
    n = np.diff(bounds)
    size = np.maximum(64, 4 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(len(n)), n)
    place = (mix64(values + np.uint64(0x51AE)) & (size[owner] - 1).astype(np.uint64)).astype(np.int64)
    bits = (np.bincount(base[owner] + place, minlength=base[-1]) & 1).astype(bool)
    packed, at = np.packbits(bits, bitorder="little").tobytes(), (base // 8).tolist()
    return [packed[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]


def _words_of(sketches) -> np.ndarray:
    """Sketches of one size as a matrix of 64-bit words."""
    return np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sketches), -1)


def _halved(words: np.ndarray) -> np.ndarray:
    half = words.shape[1] // 2
    return words[:, :half] ^ words[:, half:]


def least_difference(one: bytes, two: bytes) -> int:
    """A lower bound of the number of elements in which two sets differ."""
    x, y = _words_of([one]), _words_of([two])
    while x.shape[1] > y.shape[1]:
        x = _halved(x)
    while y.shape[1] > x.shape[1]:
        y = _halved(y)
    return int(np.bitwise_count(x ^ y).sum())


def _sets_of(column, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, starts = text_bytes(column)
    for lo, hi in batch_slices(starts, SLICE_BYTES):
        yield lo, hi, *shingle_sets(raw[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo], width)


def describe_sets(docs: DataFrame, width: int) -> DataFrame:
    """A stage of two kinds of rows: of each document (k, doc_id, n, class,
    sketch), and of each shingle that is frequent in a batch (shingle, texts)."""
    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes, digests, all_values, sketches = [], [], [], []
            for _, _, values, bounds in _sets_of(batch.column("text"), width):
                sizes.append(np.diff(bounds))
                digests.append(set_digests(values, bounds))
                all_values.append(values)
                sketches += parity_sketches(values, bounds)
            if not sizes:
                continue
            n, cls = np.concatenate(sizes), np.concatenate(digests)
            # frequent shingles: a class counts once in a batch
            _, one = np.unique(cls, return_index=True)
            chosen = np.zeros(len(cls), bool)
            chosen[one] = True
            values = np.concatenate(all_values)
            all_values.clear()
            values = values[np.repeat(chosen, n)]
            values.sort()
            new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
            held = np.diff(np.concatenate([new, [len(values)]]))
            often = held >= max(3, 2 * COMMON_SHARE * len(one))
            kinds, texts = values[new][often], held[often]
            rows, none = len(n), pa.nulls(len(kinds), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.ones(rows, bool), np.zeros(len(kinds), bool)])),
                 pa.concat_arrays([batch.column("k"), none]), pa.concat_arrays([batch.column("doc_id"), none]),
                 pa.array(np.concatenate([n, texts]).astype(np.int64)),
                 pa.array(np.concatenate([cls, kinds]).view(np.int64)),
                 pa.array(sketches + [None] * len(kinds), pa.binary())],
                ["is_doc", "k", "doc_id", "n", "code", "sketch"])

    return stage(docs.select("k", "doc_id", "text").mapInArrow(
        tidy(describe), "is_doc boolean, k long, doc_id long, n long, code long, sketch binary"), "ngram-sets")


# ------------------------------------------------------- signatures

_SALT = np.uint64(0xA5A5_1234_9E37_79B9)


def _elements(bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the elements of the chosen sets, and each one's set (0..)."""
    n = np.diff(bounds)[chosen]
    begin = np.concatenate([[0], np.cumsum(n)])
    owner = np.repeat(np.arange(len(chosen)), n)
    return np.arange(begin[-1]) - begin[owner] + bounds[:-1][chosen][owner], owner


def band_signatures(values: np.ndarray, bounds: np.ndarray, common: np.ndarray, chosen: np.ndarray,
                    differ: np.ndarray, band: Band, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``chosen``, signature) of the sets ``chosen`` in one band;
    ``differ``: in how many elements a partner of each may differ;
    ``common``: whether each element is a common shingle."""
    place, owner = _elements(bounds, chosen)
    e = values[place]
    mixed = mix64(e ^ _SALT)
    if band.segments == 1:
        total = _sum_rows(mixed, np.concatenate([[0], np.cumsum(np.diff(bounds)[chosen])]))
        salt = mix64(np.array([number << 32], np.uint64))
        whole = mix64(total + salt)
        less = differ[owner] > 0
        without = mix64(total[owner[less]] - mixed[less] + salt)
        return np.concatenate([np.arange(len(chosen)), owner[less]]), np.concatenate([whole, without])
    m = band.segments
    segment = ((mix64(e + np.uint64(number)) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    slot = owner * m + segment
    total = np.zeros(len(chosen) * m, np.uint64)
    np.add.at(total, slot, mixed)
    rare = np.bincount(slot[~common[place]], minlength=len(total))
    held = np.bincount(slot, minlength=len(total))
    salt = mix64((np.uint64(number) << np.uint64(32)) + np.arange(m, dtype=np.uint64))
    signature = mix64(total + np.tile(salt, len(chosen)))
    cost = np.where(held == 0, 3, np.where(rare == 0, 2, np.where(rare == 1, 1, 0))).astype(np.uint64)
    order = np.argsort(((cost << np.uint64(62)) | (signature >> np.uint64(2))).reshape(-1, m), axis=1)
    emit = np.arange(m)[None, :] <= differ[:, None]  # H + 1 of them
    row, column = np.nonzero(emit)
    return row, signature[row * m + order[row, column]]


def signatures(values: np.ndarray, bounds: np.ndarray, common: np.ndarray, bands: list[Band], t: Threshold):
    """(set, signature) of all sets, in their own band and as probers of the
    band below."""
    n = np.diff(bounds)
    sets, found = [], []
    for number, band in enumerate(bands):
        home = (n >= band.low) & (n <= band.high)
        probe = (n > band.high) & (t.least(n) <= band.high)
        chosen = np.flatnonzero(home | probe)
        if not len(chosen):
            continue
        size = n[chosen]
        partner = np.where(home[chosen], t.most(size), band.high)
        row, signature = band_signatures(values, bounds, common, chosen, t.differ(size, partner), band, number)
        sets.append(chosen[row])
        found.append(signature)
    if not sets:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(sets), np.concatenate(found)


# ------------------------------------------------------- candidates

ENTRY = np.dtype([("sig", "<u8"), ("cls", "<u8"), ("n", "<i4")])
PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])
MEMBER = np.dtype([("sig", "<u8"), ("cls", "<u8"), ("n", "<i4")])
_ENTRIES, _CROWDS = 0, 1


def _sorted_entries(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sig, cls), in order, and the bounds of the signatures."""
    entries = entries[np.lexsort((entries["cls"], entries["sig"]))]
    if len(entries):
        new = np.ones(len(entries), bool)
        new[1:] = (entries["sig"][1:] != entries["sig"][:-1]) | (entries["cls"][1:] != entries["cls"][:-1])
        entries = entries[new]
    first = np.flatnonzero(np.concatenate([[True], entries["sig"][1:] != entries["sig"][:-1]])) if len(entries) else []
    return entries, np.concatenate([first, [len(entries)]]).astype(np.int64)


def pairs_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distinct unordered pairs."""
    other = a != b
    pairs = np.empty(int(other.sum()), PAIR)
    pairs["a"], pairs["b"] = np.minimum(a[other], b[other]), np.maximum(a[other], b[other])
    return np.unique(pairs)


def stars(entries: np.ndarray, bounds: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and members of the meetings ``runs`` of sorted entries.  A star's
    centres are the members that are in most of them: of near copies, mostly
    the original.  Meetings of the same sets are told once, so ``entries`` must
    hold all sets of a signature."""
    place, owner = _elements(bounds, runs)
    own = entries[place]
    begin = np.concatenate([[0], np.cumsum(np.diff(bounds)[runs])]).astype(np.int64)
    _, at, often = np.unique(own["cls"], return_inverse=True, return_counts=True)
    ranked = own["cls"][np.lexsort((own["cls"], -often[at], owner))]
    pairs = np.unique(np.concatenate([
        pairs_of(ranked[np.minimum(begin[:-1] + k, begin[1:] - 1)][owner], own["cls"]) for k in range(CENTERS)]))
    _, once = np.unique(_sum_rows(mix64(own["cls"]), begin), return_index=True)
    place, _ = _elements(begin, once)
    members = np.empty(len(place), MEMBER)
    for name in MEMBER.names:
        members[name] = own[name][place]
    return pairs, members


def meet(entries: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs to verify and members of larger meetings, from a bucket's entries."""
    entries, bounds = _sorted_entries(entries)
    lengths = np.diff(bounds)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in range(2, PAIRS_UPTO + 1):
        at, (i, j) = bounds[:-1][lengths == size][:, None], np.triu_indices(size, 1)
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    a, b = np.concatenate(left), np.concatenate(right)
    small = np.minimum(entries["n"][a], entries["n"][b]).astype(np.int64)
    large = np.maximum(entries["n"][a], entries["n"][b]).astype(np.int64)
    fits = small * t.den >= large * t.num
    pairs = pairs_of(entries["cls"][a[fits]], entries["cls"][b[fits]])
    more, members = stars(entries, bounds, np.flatnonzero(lengths > PAIRS_UPTO))
    return np.unique(np.concatenate([pairs, more])), members


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers as their first bytes, then their second ones and so on:
    the bytes that are mostly 0 lie together and compress away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _packed(entries: np.ndarray, buckets: int) -> list[bytes]:
    """Entries of one bucket as columns, a class and its size once for its run
    of signatures, and a signature by what its bucket does not tell of it."""
    new = np.flatnonzero(np.concatenate([[True], entries["cls"][1:] != entries["cls"][:-1]]))
    run = np.diff(np.concatenate([new, [len(entries)]]))
    return [(entries["sig"] // np.uint64(buckets)).astype("<u4").tobytes(), entries["cls"][new].tobytes(),
            _planes(entries["n"][new]), _planes(run)]


def _unpacked(bucket: int, buckets: int, sig: bytes, cls: bytes, n: bytes, run: bytes) -> np.ndarray:
    entries, run = np.empty(len(sig) // 4, ENTRY), _from_planes(run)
    entries["sig"] = np.frombuffer(sig, "<u4").astype(np.uint64) * np.uint64(buckets) + np.uint64(bucket)
    entries["cls"], entries["n"] = np.repeat(np.frombuffer(cls, "<u8"), run), np.repeat(_from_planes(n), run)
    return entries


def _dealt(entries: np.ndarray, buckets: int) -> list[tuple]:
    bucket = (entries["sig"] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    entries, edge = entries[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(i, _ENTRIES, *_packed(entries[edge[i]:edge[i + 1]], buckets))
            for i in range(buckets) if edge[i] < edge[i + 1]]


def _dealt_crowds(entries: np.ndarray, bounds: np.ndarray, buckets: int) -> list[tuple]:
    """Sorted entries as crowds, a row for each bucket: signatures of it that
    are held by the same sets, and these sets once."""
    sig, same = entries["sig"][bounds[:-1]], _sum_rows(mix64(entries["cls"]), bounds)
    bucket = (sig % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((same, bucket))
    new = np.ones(len(order), bool)
    new[1:] = (bucket[order][1:] != bucket[order][:-1]) | (same[order][1:] != same[order][:-1])
    first = np.flatnonzero(new)
    one = order[first]
    run = np.stack([np.diff(np.concatenate([first, [len(order)]])), np.diff(bounds)[one]], 1).astype("<i4")
    to, upto = bucket[one], np.concatenate([first, [len(order)]])
    out = []
    for i in np.unique(to).tolist():
        lo, hi = np.searchsorted(to, [i, i + 1])
        place, _ = _elements(bounds, one[lo:hi])
        out.append((i, _CROWDS, sig[order[upto[lo]:upto[hi]]].tobytes(), entries["cls"][place].tobytes(),
                    entries["n"][place].tobytes(), run[lo:hi].tobytes()))
    return out


def _uncrowded(sig: bytes, cls: bytes, n: bytes, run: bytes) -> np.ndarray:
    """The entries of a row of crowds."""
    run = np.frombuffer(run, "<i4").reshape(-1, 2).astype(np.int64)
    signatures, held = run.T
    each = np.repeat(np.arange(len(run)), signatures)  # the crowd of each signature
    bounds = np.concatenate([[0], np.cumsum(held)])
    place, owner = _elements(bounds, each)
    entries = np.empty(len(place), ENTRY)
    entries["sig"] = np.frombuffer(sig, "<u8")[owner]
    entries["cls"], entries["n"] = np.frombuffer(cls, "<u8")[place], np.frombuffer(n, "<i4")[place]
    return entries


def candidates(docs: DataFrame, common: np.ndarray, bands: list[Band], buckets: int, width: int,
               t: Threshold) -> DataFrame:
    """A stage of pairs (a, b) and of members of larger meetings (sig, b, n)."""
    wire = docs.sparkSession.sparkContext.broadcast(common)  # at most mean set size / COMMON_SHARE

    def entries_of(column, seen: set) -> np.ndarray:
        parts = [np.zeros(0, ENTRY)]
        for _, _, values, bounds in _sets_of(column, width):
            cls, n = set_digests(values, bounds), np.diff(bounds)
            fresh = np.zeros(len(cls), bool)
            for i, c in enumerate(cls.tolist()):  # copies within a batch emit once
                if c not in seen and n[i]:
                    seen.add(c)
                    fresh[i] = True
            values, n, cls = values[np.repeat(fresh, n)], n[fresh], cls[fresh]
            bounds = np.concatenate([[0], np.cumsum(n)])
            known = wire.value
            at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            usual = known[at] == values if len(known) else np.zeros(len(values), bool)
            which, signature = signatures(values, bounds, usual, bands, t)
            part = np.empty(len(which), ENTRY)
            # 32 bits besides the bucket's: signatures that then agree by chance
            # (one in thousands of entries has such a fellow) make a meeting more
            part["sig"], part["cls"], part["n"] = signature % np.uint64(buckets << 32), cls[which], n[which]
            parts.append(part[np.argsort(which, kind="stable")])
        return np.concatenate(parts)

    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            column, seen = batch.column("text"), set()
            for lo, hi in batch_slices(text_bytes(column)[1], GROUP_BYTES):
                entries = entries_of(column.slice(lo, hi - lo), seen)
                out: list[tuple] = []
                # signatures of many sets here go on as crowds
                ordered = np.sort(entries["sig"])
                often = np.unique(ordered[STAR_IN_BATCH - 1:][ordered[STAR_IN_BATCH - 1:] == ordered[:1 - STAR_IN_BATCH]])
                if len(often):
                    at = np.minimum(np.searchsorted(often, entries["sig"]), len(often) - 1)
                    hot = often[at] == entries["sig"]
                    out += _dealt_crowds(*_sorted_entries(entries[hot]), buckets)
                    entries = entries[~hot]
                out += _dealt(entries, buckets)
                if out:
                    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)],
                        ["bucket", "kind", "sig", "cls", "n", "run"])

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        entries = [_unpacked(bucket, buckets, *x) if kind == _ENTRIES else _uncrowded(*x)
                   for bucket, kind, *x in pdf[["bucket", "kind", "sig", "cls", "n", "run"]].itertuples(index=False)]
        pairs, members = meet(np.concatenate([np.zeros(0, ENTRY), *entries]), t)
        k, size = len(pairs), len(pairs) + len(members)
        sig, a, b, n = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, int)
        a[:k], b[:k] = pairs["a"], pairs["b"]
        sig[k:], b[k:], n[k:] = members["sig"], members["cls"], members["n"]
        return pd.DataFrame({"is_pair": np.arange(size) < k, "sig": sig.view(np.int64), "a": a.view(np.int64),
                             "b": b.view(np.int64), "n": n})

    dealt = docs.select("text").mapInArrow(tidy(emit), "bucket int, kind int, sig binary, cls binary, n binary, run binary")
    return stage(dealt.groupBy("bucket").applyInPandas(
        reduce, "is_pair boolean, sig long, a long, b long, n long"), "ngram-candidates", BATCH_BYTES)


# ----------------------------------------------------- verification

def passing(pairs: DataFrame, classes: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches let them link; a stage."""
    def test(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b")], strict=True)
            fits = [min(r, s) * t.den >= max(r, s) * t.num and least_difference(x, y) <= t.differ(r, s)
                    for r, s, x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(fits, pa.bool_()))

    side = lambda x: classes.select(
        F.col("code").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return stage(both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(
        tidy(test), "a long, b long"), "ngram-passing")


def verify(pairs: DataFrame, texts: DataFrame, width: int, t: Threshold) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets; a stage.
    ``texts``: (code, text), one row a class."""
    def test(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                one, two = ([v[b[i]:b[i + 1]] for _, _, v, b in _sets_of(part.column(c), width) for i in range(len(b) - 1)]
                            for c in ("text_a", "text_b"))
                fits = []
                for x, y in zip(one, two, strict=True):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    fits.append(shared * t.den >= (len(x) + len(y) - shared) * t.num)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(
                    pa.array(fits, pa.bool_()))

    both = pairs.join(texts.select(F.col("code").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("code").alias("b"), F.col("text").alias("text_b")), "b")
    return stage(both.select("a", "b", "text_a", "text_b").mapInArrow(
        tidy(test), "a long, b long"), "ngram-links", BATCH_BYTES)


def _texts_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """A text of each class in ``pairs``."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("code")).distinct()
    rows = stage(classes.join(wanted, "code").select("code", "k"), "ngram-wanted")
    return stage(join_checked(docs.select("k", "text"), rows, "k").select("code", "text").groupBy("code").agg(
        F.min("text").alias("text")), "ngram-texts")


def _block_pairs(code, component, n, side, sketch, failed, t: Threshold) -> list[tuple]:
    """(a, b, cut) of a block of one meeting: members of different components
    whose sizes and sketches let them link and that did not fail before
    (``failed``: codes, or None).  A member offers its NEAREST in each other
    component; ``cut`` tells that it has more.  ``side`` 0 and 1 are two parts
    of the meeting; in a block of one part (side 0 only) all are compared."""
    size = np.fromiter(map(len, sketch), np.int64, len(sketch))
    alone, found = not side.any(), []
    # of two components one is not the largest: its members are the rows
    kinds, of, members = np.unique(component, return_inverse=True, return_counts=True)
    minor = of != members.argmax()
    for width in np.unique(size):
        same, twice = np.flatnonzero(size == width), np.flatnonzero(size == 2 * width)
        at = np.concatenate([same, twice])
        rows = np.flatnonzero(minor[at])
        if not len(rows):
            continue
        words = _words_of(sketch[same])
        if len(twice):
            words = np.concatenate([words, _halved(_words_of(sketch[twice]))])
        step = max(1, (4 << 20) // words.nbytes)
        for lo in range(0, len(rows), step):
            own = rows[lo:lo + step]
            x = at[own]
            big, little = np.maximum(n[x][:, None], n[at]), np.minimum(n[x][:, None], n[at])
            open_ = (component[x][:, None] != component[at]) & (little * t.den >= big * t.num)
            open_ &= ~minor[at] | (np.arange(len(at)) > own[:, None])  # each pair once
            open_ &= (own < len(same))[:, None] | (np.arange(len(at)) < len(same))  # two of twice: at their width
            if not alone:
                open_ &= side[x][:, None] != side[at]
            if not open_.any():
                continue
            apart = np.bitwise_count(words[own][:, None] ^ words[None]).sum(2, dtype=np.int32)
            open_ &= apart <= t.differ(n[x][:, None], n[at])
            for i in np.flatnonzero(open_.any(1)):
                if failed[x[i]] is not None:
                    open_[i] &= ~np.isin(code[at], failed[x[i]])
            row, column = np.nonzero(open_)
            if not len(row):
                continue
            order = np.lexsort((apart[row, column], component[at[column]], row))
            row, column = row[order], column[order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (component[at[column]][1:] != component[at[column]][:-1])
            run = np.cumsum(first) - 1
            begin = np.flatnonzero(first)
            nearest = np.arange(len(row)) - begin[run] < NEAREST
            cut = np.diff(np.concatenate([begin, [len(row)]]))[run] > NEAREST
            one, two = code[x[row[nearest]]], code[at[column[nearest]]]
            found.append((np.minimum(one, two), np.maximum(one, two), cut[nearest]))
    return found


def open_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, failed: DataFrame, t: Threshold) -> DataFrame:
    """(a, b, cut): pairs that are open still: of one meeting, in different components,
    not failed before, passing by their sketches; a stage.  A meeting is cut
    into parts of about BLOCK members, and each two parts are a block."""
    m = members.join(labels, members.b == labels.node, "left").select(
        "sig", F.col("b").alias("code"), F.coalesce("component", "b").alias("component"))
    mixed = m.groupBy(F.bitwise_not("sig").alias("x")).agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")).filter("low <> high")
    # meetings of one component (mostly of one group of copies) go to one
    # bucket, where their pairs are told once, or to several if they are many
    mixed = stage(mixed.select(F.bitwise_not("x").alias("sig"), "low", "size"), "ngram-mixed")
    spread = mixed.groupBy("low").agg(F.ceil(F.sum("size") / 20_000).cast("int").alias("spread"))
    mixed = mixed.join(spread, "low").select(
        "sig", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"), "low",
        F.pmod(F.xxhash64("sig"), F.col("spread")).cast("int").alias("salt"))
    m = stage(m.join(mixed, "sig"), "ngram-open")
    buckets = max(1, math.ceil(m.count() / 20_000))
    partners = failed.select(F.explode(F.array(F.struct(F.col("a").alias("code"), F.col("b").alias("other")),
                                               F.struct(F.col("b").alias("code"), F.col("a").alias("other")))).alias("p"))
    partners = partners.groupBy("p.code").agg(F.collect_list("p.other").alias("failed"))
    about = stage(classes.select("code", "n", "sketch").join(m.select("code").distinct(), "code", "left_semi")
                  .join(partners, "code", "left"), "ngram-about")
    part = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    m = m.withColumn("part", part).select("*", others)
    m = m.select("sig", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                 (F.col("part") > F.col("other")).cast("int").alias("side"), "code", "component",
                 F.pmod(F.xxhash64("low", "salt", F.least("part", "other"), F.greatest("part", "other")),
                        F.lit(buckets)).alias("bucket"))
    # what is known of a class goes to a bucket once, not with each meeting
    told = m.select(F.col("bucket").alias("to"), F.col("code").alias("of")).distinct().join(
        about.withColumnRenamed("code", "of"), "of")

    def compare(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        pdf = pdf.sort_values(["sig", "i", "j", "side", "code"])
        known = known.set_index("of")
        at = known.index.get_indexer(pdf["code"])
        key = pdf[["sig", "i", "j"]].to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1), [True]]))
        n, sketch, failed = (known[c].to_numpy()[at] for c in ("n", "sketch", "failed"))
        columns = [pdf["code"].to_numpy(), pdf["component"].to_numpy(), n, pdf["side"].to_numpy(), sketch, failed]
        found = [x for lo, hi in zip(edge[:-1], edge[1:], strict=True)
                 for x in _block_pairs(*[c[lo:hi] for c in columns], t)]
        a, b, cut = (np.concatenate([np.zeros(0, kind), *z]) for kind, z in zip(
            (np.int64, np.int64, bool), zip(*found, strict=True) if found else ((), (), ()), strict=True))
        return pd.DataFrame({"a": a, "b": b, "cut": cut}).groupby(["a", "b"], as_index=False).max()

    found = m.groupBy("bucket").cogroup(told.groupBy("to")).applyInPandas(
        compare, "a long, b long, cut boolean")
    return stage(found.groupBy("a", "b").agg(F.max("cut").alias("cut")), "ngram-more-pairs")


def _block_links(values: np.ndarray, bounds: np.ndarray, side: np.ndarray, t: Threshold) -> np.ndarray:
    """To how many others each set of a block links; if the block is of two
    parts (``side`` 0 and 1), of the other part."""
    n, kinds = np.diff(bounds), np.unique(values, return_inverse=True, return_counts=True)
    held = kinds[2] > 1
    own, column = np.repeat(np.arange(len(n)), n), (np.cumsum(held) - 1)[kinds[1]]
    own, column = own[held[kinds[1]]], column[held[kinds[1]]]
    order = np.argsort(column, kind="stable")
    own, column = own[order], column[order]
    one, two = (np.flatnonzero(side == i) for i in (0, 1)) if side.any() else [np.arange(len(n))] * 2
    shared = np.zeros((len(one), len(two)), np.float32)
    step = max(256, (2 << 20) // len(n))
    for lo in range(0, int(held.sum()), step):
        i, j = np.searchsorted(column, [lo, lo + step])
        holds = np.zeros((len(n), min(step, int(held.sum()) - lo)), np.float32)
        holds[own[i:j], column[i:j] - lo] = 1
        shared += holds[one] @ holds[two].T
    link = shared.astype(np.int64) * (t.den + t.num) >= (n[one][:, None] + n[two]) * t.num
    count = np.zeros(len(n), np.int64)
    if side.any():
        count[one], count[two] = link.sum(1), link.sum(0)
    else:
        count = link.sum(1) - 1  # not to itself
    return count


def count_links(docs: DataFrame, classes: DataFrame, labels: DataFrame, width: int, t: Threshold) -> DataFrame:
    """(code, class_links): to how many other classes each class in ``labels``
    links; a stage.  Linked classes are of one component.  A component is cut
    into parts of about BLOCK classes, and each two parts are a block, in which
    all pairs are compared by their whole sets; so each pair counts once."""
    node = labels.select(F.col("node").alias("code"), "component")
    texts = stage(_texts_of(docs, classes, labels.select(F.col("node").alias("a"), F.col("node").alias("b")))
                  .join(node, "code"), "ngram-component-texts")
    length = F.octet_length("text")
    size = texts.groupBy(F.bitwise_not("component").alias("x")).agg(
        F.count(F.lit(1)).alias("size"), F.sum(length).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / PART_BYTES)).cast("int")
    size = stage(size.select(F.bitwise_not("x").alias("component"), parts.alias("parts"), "bytes"), "ngram-component-sizes")
    buckets = max(1, math.ceil((size.agg(F.sum(F.col("bytes") * F.col("parts"))).first()[0] or 0) / (2 * PART_BYTES)))
    m = join_checked(texts, size.drop("bytes"), "component").withColumn(
        "part", F.pmod(F.xxhash64("code"), F.col("parts")).cast("int"))
    m = m.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    i, j = F.least("part", "other"), F.greatest("part", "other")
    m = m.select("component", i.alias("i"), j.alias("j"), (F.col("part") > F.col("other")).cast("int").alias("side"),
                 "code", "text", F.pmod(F.xxhash64("component", i, j), F.lit(buckets)).alias("bucket"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        import pyarrow as pa

        pdf = pdf.sort_values(["component", "i", "j", "side", "code"])
        key = pdf[["component", "i", "j"]].to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1), [True]]))
        side, text, found = pdf["side"].to_numpy(), pa.array(pdf["text"], pa.large_string()), []
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            parts = [(v, np.diff(b)) for _, _, v, b in _sets_of(text.slice(lo, hi - lo), width)]
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([x for _, x in parts]))])
            # a block of two parts of which one is empty has no pairs
            found.append(_block_links(np.concatenate([v for v, _ in parts]), bounds, side[lo:hi], t)
                         if key[lo, 1] == key[lo, 2] or np.ptp(side[lo:hi]) else np.zeros(hi - lo, np.int64))
        out = pd.DataFrame({"code": pdf["code"].to_numpy(), "class_links": np.concatenate(found)})
        return out.groupby("code", as_index=False).sum()

    found = m.groupBy("bucket").applyInPandas(count, "code long, class_links long")
    return stage(found.groupBy("code").agg(F.sum("class_links").alias("class_links")), "ngram-class-links")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, t: Threshold) -> tuple[DataFrame, ...]:
    """Documents (k, doc_id, text), a row of each (k, doc_id, n, code, ...),
    classes, and the components of those that link."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("k", F.xxhash64("doc_id", "text"))
    found = describe_sets(docs, width)
    rows = found.filter("is_doc").select("k", "doc_id", "n", "code", "sketch")
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"), F.max("n").alias("largest")).first()

    # frequent shingles, over all documents; at most mean set size / COMMON_SHARE of them
    least = max(COMMON_LEAST, COMMON_SHARE * total.rows)
    common = found.filter("not is_doc").groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    common = stage(common, "ngram-common")
    hashes = np.sort(common.select("code").toPandas()["code"].to_numpy(np.int64).view(np.uint64))
    share = float(common.agg(F.sum("n")).first()[0] or 0) / max(1, total.shingles or 0)
    edges = band_edges(total.largest or 1, t)
    bands = allocate(edges, [min(1.0, share)] * len(edges), t)
    buckets = max(1, math.ceil(0.4 * (total.shingles or 0) / ENTRIES_A_BUCKET))
    met = candidates(docs, hashes, bands, buckets, width, t)

    classes = stage(rows.filter("n > 0").groupBy("code").agg(
        F.min("k").alias("k"), F.max("n").alias("n"), F.max("sketch").alias("sketch")), "ngram-classes")
    pairs = stage(met.filter("is_pair").select("a", "b").distinct(), "ngram-pairs")
    near = passing(pairs, classes, t)
    # one pair a class first; then what is not in one component by those
    first = stage(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "ngram-first")
    links = verify(first, _texts_of(docs, classes, first), width, t)
    labels = connected_components(links)
    rest = near.join(first, ["a", "b"], "left_anti")
    for x in ("a", "b"):
        rest = rest.join(labels.select(F.col("node").alias(x), F.col("component").alias(f"in_{x}")), x, "left")
    rest = stage(rest.filter(~F.col("in_a").eqNullSafe(F.col("in_b")) | F.col("in_a").isNull()).select("a", "b"),
                 "ngram-rest")
    if not rest.isEmpty():
        links = stage(links.unionByName(verify(rest, _texts_of(docs, classes, rest), width, t)), "ngram-links")
        labels = connected_components(links)
    members = stage(met.filter("not is_pair").select("sig", "b").distinct(), "ngram-members")
    failed = first.unionByName(rest).join(links, ["a", "b"], "left_anti")
    while True:
        more = open_pairs(members, labels, classes, failed, t)
        if more.isEmpty():
            break
        new = verify(more, _texts_of(docs, classes, more), width, t)
        wrong = stage(more.join(new, ["a", "b"], "left_anti"), "ngram-wrong")
        if not new.isEmpty():
            links = stage(links.unionByName(new), "ngram-links")
            labels = connected_components(links)
        # a member that offered all it had, or whose offers held, is settled
        again = wrong.filter("cut").select(F.explode(F.array("a", "b")).alias("b")).distinct()
        open_meetings = members.join(again, "b", "left_semi").select("sig").distinct()
        members = stage(members.join(open_meetings, "sig", "left_semi"), "ngram-members")
        if members.isEmpty():
            break
        failed = stage(failed.unionByName(wrong.drop("cut")), "ngram-failed")
    return docs, rows, classes, labels


def _with_smallest(rows: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    """``rows`` (doc_id, n, code, and ``columns``) with the smallest id of their component."""
    linked = rows.filter("n > 0").join(labels.withColumnRenamed("node", "code"), "code", "left")
    linked = stage(linked.select("doc_id", "n", *columns, F.coalesce("component", "code").alias("component")), "ngram-linked")
    # ~ hides the joins' partitioning: the aggregate combines before its own shuffle
    smallest = linked.groupBy(F.bitwise_not("component").alias("c")).agg(F.min("doc_id").alias("component_id"))
    smallest = smallest.select(F.bitwise_not("c").alias("component"), "component_id")
    out = linked.join(smallest, "component").select("doc_id", "n", *columns, "component_id")
    alone = rows.filter("n = 0").select("doc_id", "n", *columns, F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumnRenamed("n", "n_shingles")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                      threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_links`` (to how many other
    classes the row's class links), one row per input row."""
    t = Threshold(*threshold)
    docs, rows, classes, labels = _grouped(docs, id_col, text_col, width, t)
    rows = rows.join(count_links(docs, classes, labels, width, t), "code", "left").withColumn(
        "class_links", F.coalesce("class_links", F.lit(0).cast("long")))
    return _with_smallest(rows, labels, "class_links")


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """One row of ``docs`` of each group stays: the one with the smallest id
    (a null id is the largest), of equal ids the one whose digest ``k`` of id
    and text is the smallest, of equal rows one.  Rows without shingles stay.

    Ids name the rows to drop; rows whose id is null or repeated are decided by
    ``k``."""
    _, rows, _, labels = _grouped(docs, id_col, text_col, width, Threshold(*threshold))
    columns, id_ = docs.columns, F.col(id_col)
    linked = rows.filter("n > 0").join(labels.withColumnRenamed("node", "code"), "code", "left")
    linked = stage(linked.select("k", "doc_id", F.coalesce("component", "code").alias("component")), "ngram-linked")
    # ~ hides the joins' partitioning: the aggregate combines before its own shuffle
    best = linked.groupBy(F.bitwise_not("component").alias("c")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("best"))
    best = best.select(F.bitwise_not("c").alias("component"), F.col("best.k").alias("best"))
    vague = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter(
        "rows > 1").select("doc_id")
    vague = stage(vague, "ngram-vague-ids")
    gone = linked.filter("doc_id is not null").join(best, "component").filter("k <> best").select("doc_id")
    gone = stage(gone.unionByName(vague).distinct().withColumnRenamed("doc_id", id_col), "ngram-gone")
    clear = join_checked(docs.filter(id_.isNotNull()), gone, id_col, "left_anti").select(columns)
    unclear = rows.filter("doc_id is null").unionByName(join_checked(rows, vague, "doc_id", "left_semi").select(rows.columns))
    if unclear.isEmpty():
        return clear
    unclear = stage(unclear.groupBy("k").agg(F.max("n").alias("__n")), "ngram-unclear")
    stays = unclear.join(best.select(F.col("best").alias("k")), "k", "left_semi").unionByName(unclear.filter("__n = 0"))
    stays = stage(stays.withColumnRenamed("k", "__k"), "ngram-stays")
    chosen = docs.filter(id_.isNull()).unionByName(
        join_checked(docs, vague.withColumnRenamed("doc_id", id_col), id_col, "left_semi").select(columns))
    chosen = chosen.withColumn("__k", F.xxhash64(id_.cast("long"), F.coalesce(F.col(text_col), F.lit(""))))
    chosen = join_checked(chosen, stays, "__k")
    one = chosen.filter("__n > 0").groupBy("__k").agg(least_row(columns).alias("__row")).select("__row.*")
    return clear.unionByName(one).unionByName(chosen.filter("__n = 0").select(columns))
