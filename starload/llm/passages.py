"""Substring dedup: passages that nearly repeat across documents, by compact windows.

A text is a sequence of shingles of five words. Under one hash function the Cartesian tree over the
shingles' hashes groups the subsequences of a text by their smallest hash: the node at ``c`` that
rules ``[l, r]`` stands for all subsequences that begin in ``[l, c]`` and end in ``[c, r]``. Only
nodes that rule a passage of ``words`` words are kept, about ``2 n / words`` per function; these are
the places that are smallest in some window of that width.

Equal texts are one: their copies are passages of the one with the smallest id, and only that one is
compared with others.

1. Every document emits the hashes of its windows under ``FUNCTIONS`` functions.
2. A hash met in several documents links each of them to the first (smallest id): the smallest and
   largest id per hash are aggregated (map-side combined), and the hashes are joined with them. No
   pairs within a group are made: a passage shared by m documents gives m - 1 links. A pair counts
   if hashes under ``ENOUGH`` functions agree on the first, and so does each pair of repeated
   hashes near each other in one text, which is linked like a single hash; two documents with a
   common passage have it in common whatever the first documents of its single hashes are.
3. Such pairs get both texts. Interval join: collisions are swept along the first text and kept
   together while their windows overlap in both texts; an area with ``ENOUGH`` functions is a
   candidate.
4. Verification on whole texts: inside an area, runs of equal shingles are chained in text order,
   and a part of a chain of at least ``words`` words on both sides whose sets of shingles have a
   Jaccard similarity of ``similarity`` is a passage; of overlapping parts the one with most equal
   shingles is taken. Only similarity ends a chain, no fixed gap. Pairs without a window of which
   ``similarity / (2 - similarity)`` is shared are not looked at further, nor is what lies far from
   such windows.
5. Where a document meets its first but no passage covers the window, it stays open: it emits pairs
   of hashes of that window again, of the shingles that the first does not have, and is linked anew
   among the documents that failed with the same first (steps 2 to 4). What two of them have in
   common besides the first's part links them there. Each round takes the first documents out of
   their groups, and the rounds end when no group of open documents is left.

The result has one row per passage of a document and its partner: exact copies are the case of
similarity 1 and the whole text. Documents without a repeated passage have no row.

Defined cases: a null, empty or short text (under ``words`` words) has no passage; a row without id
takes no part, since nothing could name it; rows that share an id are one document and are not
compared with each other; rows that repeat give the same passages once. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from starload.llm.text import documents
from starload.tables import discard, materialize

SHINGLE = 5
WORDS = 50
SIMILARITY = 0.8
FUNCTIONS = 5
ENOUGH = 2
#: A hash with more pairs of windows than this in two texts counts as one collision.
MANY = 16
#: In texts full of repeats (see ``REPEATS``), equal shingles further apart than this begin a new
#: chain; one changed word parts them by five.
GAP = 16
#: Up to so many pairs of equal shingles for each shingle of the texts, all their runs are chained.
REPEATS = 16
#: What a chain loses for each shingle of a gap: less than any gap that a similar passage can have
#: would cost it, enough to prefer the near run.
GAP_COST = 0.25
#: Chains of so many runs are looked at by all pairs of runs at once.
TOGETHER = 256


class WordHashes(dict):
    """The hash of each word, as eight bytes."""

    def __missing__(self, word: bytes) -> bytes:
        value = xxhash.xxh64_digest(word)
        if len(word) <= 40:
            if len(self) >= 300_000:
                self.clear()
            self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(text: str, known: WordHashes) -> np.ndarray:
    """One hash per shingle; none for a text of fewer words."""
    words = text.encode().lower().split()
    count = len(words) - SHINGLE + 1
    if count < 1:
        return np.empty(0, np.uint64)
    single = np.frombuffer(b"".join(map(known.__getitem__, words)), ">u8").astype(np.uint64)
    joined = np.zeros(count, np.uint64)
    for i in range(SHINGLE):
        joined = joined * np.uint64(0x9E3779B97F4A7C15) + single[i : i + count]
    return _mixed(joined)


def hashed(marks: np.ndarray, function: int) -> np.ndarray:
    seed = (function + 1) * 0xD1342543DE82EF95 % 2**64
    return _mixed(marks ^ np.uint64(seed))


_SEEDS = np.array(
    [(j + 1) * 0xD1342543DE82EF95 % 2**64 for j in range(FUNCTIONS)], np.uint64
)[:, None]


def all_hashed(marks: np.ndarray) -> np.ndarray:
    """``hashed`` under every function, a row each."""
    return _mixed(marks ^ _SEEDS)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Along the last axis."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[..., :-size], values[..., size:])
        size *= 2
    rest = width - size
    if not rest:
        return values
    return np.minimum(values[..., : values.shape[-1] - rest], values[..., rest:])


def _places_in(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values the sorted array ``ordered`` has, and where each would stand first."""
    places = np.searchsorted(ordered, values)
    if not len(ordered):
        return np.zeros(len(values), bool), places
    return ordered[np.minimum(places, len(ordered) - 1)] == values, places


def window_keys(marks: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all compact windows, the number of the function in the lowest three bits."""
    if len(marks) < width:
        return np.empty(0, np.int64)
    keys = []
    for j in range(FUNCTIONS):
        lowest = np.unique(sliding_minimum(hashed(marks, j), width))
        keys.append((lowest & ~np.uint64(7)) | np.uint64(j))
    return np.unique(np.concatenate(keys)).view(np.int64)


def _joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return _mixed(one * np.uint64(0x9E3779B97F4A7C15) + other)


def placed_keys(marks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the ``window_keys`` and where they stand."""
    values = all_hashed(marks)
    function, places, _ = _all_ruling(values, width)
    keys = (values[function, places] & ~np.uint64(7)) | function.astype(np.uint64)
    return keys.view(np.int64), places


def near_keys(ids: np.ndarray, places: np.ndarray, keys: np.ndarray, width: int):
    """(ids, keys) of all pairs of keys of two functions that one window may have; the rows are
    sorted by id and place."""
    owners, pairs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    unsigned = keys.view(np.uint64)
    for step in range(1, len(ids)):
        near = (ids[step:] == ids[:-step]) & (places[step:] - places[:-step] < width)
        if not near.any():
            break
        two = np.flatnonzero(near & ((keys[step:] ^ keys[:-step]) & 7 != 0))
        one, other = unsigned[two], unsigned[two + step]
        first = (one & np.uint64(7)) < (other & np.uint64(7))
        owners.append(ids[two])
        pairs.append(_joined(np.where(first, one, other), np.where(first, other, one)).view(np.int64))
    return np.concatenate(owners), np.concatenate(pairs)


_PAIRS = np.array([(i, j) for i in range(FUNCTIONS) for j in range(i + 1, FUNCTIONS)])


def open_keys(
    marks: np.ndarray, shared: np.ndarray, had: np.ndarray, found: list[tuple], width: int, path: int
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, which shingles are had): pairs of hashes of the windows that ``ENOUGH`` hashes
    link to the other text outside the passages ``found``, by preference of shingles that no first
    document had. ``shared`` says which shingles the other text has."""
    now, whole = had | shared, had | shared
    if len(marks) < width or not shared.any():
        return np.empty(0, np.int64), whole
    places = np.flatnonzero(shared)
    near = slice(max(0, int(places[0]) - width), int(places[-1]) + width + 1)
    if near.start or near.stop < len(marks):
        marks, shared, had, now = marks[near], shared[near], had[near], now[near]
        found = [(max(0, f[0] - near.start), f[1] - near.start) for f in found if f[1] > near.start]
    if len(marks) < width:
        return np.empty(0, np.int64), whole

    low, top = np.uint64(2**63 - 1), np.uint64(2**64 - 1)
    halves = all_hashed(marks) >> np.uint64(1)
    ranked = halves | (had.astype(np.uint64) << np.uint64(63))
    heads = sliding_minimum(ranked, width)
    # A window's smallest shingle is a shared one if the smallest shared one is as small.
    again = (heads == sliding_minimum(np.where(shared, ranked, top), width)).sum(0) >= ENOUGH
    for start, end, *_ in found:
        again[start : max(start, end - (SHINGLE - 1) - width + 1)] = False
    if not again.any():
        return np.empty(0, np.int64), whole
    ranked = halves | (now.astype(np.uint64) << np.uint64(63))
    heads = sliding_minimum(ranked, width)[:, again] & low
    heads = heads[:, np.r_[True, (heads[:, 1:] != heads[:, :-1]).any(0)]]
    which = (FUNCTIONS * _PAIRS[:, :1] + _PAIRS[:, 1:]).astype(np.uint64)
    pairs = _joined(heads[_PAIRS[:, 0]], heads[_PAIRS[:, 1]])
    return np.unique(_joined(pairs, which ^ np.uint64(path % 2**64))).view(np.int64), whole


def dense_part(shared: np.ndarray, width: int, similarity: float) -> slice | None:
    """Where passages of ``width`` shingles can be, or None: around the windows of that width of
    which at least ``similarity / (2 - similarity)`` are shared.

    A similar part of s shingles has at least ``similarity * s`` shared ones, so its first window lacks
    at most ``(1 - similarity) * s``, and one of the windows that cover it has its share of them: some
    window is that dense. What a part has beyond its dense windows is less dense, and so is at
    most ``(1 - similarity) / (similarity - least share)`` times as long as what lies between them.
    """
    share = similarity / (2 - similarity)
    if len(shared) < width or not shared.any():
        return None
    sums = np.r_[0, np.cumsum(shared)]
    dense = np.flatnonzero(sums[width:] - sums[:-width] >= width * share - 1e-9)
    if not len(dense):
        return None
    low, high = int(dense[0]), int(dense[-1]) + width
    beyond = similarity - share
    more = width + (int((1 - similarity) / beyond * (high - low)) + 1 if beyond else len(shared))
    return slice(max(0, low - more), high + more)


def verified(
    mine: np.ndarray, other: np.ndarray, shared: np.ndarray, words: int, similarity: float
) -> list[tuple[int, int, int, int, float]]:
    """``shared_passages`` of two whole texts; ``shared`` says which of ``mine`` the other has."""
    width = words - SHINGLE + 1
    if len(mine) == len(other) and np.array_equal(mine, other):
        return shared_passages(mine, other, words, similarity)
    part = dense_part(shared, width, similarity)
    if part is None:
        return []
    own = mine[part]
    there = np.flatnonzero(_places_in(np.sort(own[shared[part]]), other)[0])
    low = max(0, int(there[0]) - width)
    found = shared_passages(own, other[low : int(there[-1]) + width + 1], words, similarity)
    return [
        (s + part.start, e + part.start, s_b + low, e_b + low, share)
        for s, e, s_b, e_b, share in found
    ]


def ruling_places(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the nodes of the Cartesian tree that rule at least ``width`` places.

    These are the places that are smallest in some window of that width. ``values`` are 64-bit
    hashes, of which the lowest bits (as many as number the places) give way to a scrambled place:
    that settles equal values, and keeps the places few where one value fills the text.
    """
    _, places, keys = _all_ruling(values[None, :], width)
    return places, keys


def _all_ruling(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, key) of the ``ruling_places`` of every row of ``values``, by row and place.

    No two keys of a row are equal, so the smallest place only moves on as the window does: where
    the minimum changes, a new place begins to rule.
    """
    size = values.shape[1]
    if size < width:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    bits = np.uint64(size.bit_length())
    low, factor = (np.uint64(1) << bits) - np.uint64(1), 0x9E3779B97F4A7C15
    back = np.uint64(pow(factor, -1, 1 << int(bits)))
    scrambled = np.arange(size, dtype=np.uint64) * np.uint64(factor) & low
    lowest = sliding_minimum((values >> bits << bits) | scrambled, width)
    new = np.ones(lowest.shape, bool)
    new[:, 1:] = lowest[:, 1:] != lowest[:, :-1]
    keys = lowest[new]
    return np.nonzero(new)[0], (keys * back & low).astype(np.int64), keys


def compact_windows(values: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(l, c, r) of every node of the Cartesian tree that rules at least ``width`` places."""
    places, keys = ruling_places(values, width)
    return _extents(places.tolist(), keys.tolist(), len(values))


def _extents(places: list[int], keys: list[int], size: int) -> list[tuple[int, int, int]]:
    """What each place rules. The ancestors of a node that rules enough do so too, so the nearest
    smaller places on either side are among ``places``."""
    lefts, stack = [], []
    rights = [size - 1] * len(places)
    for i, key in enumerate(keys):
        while stack and keys[stack[-1]] > key:
            rights[stack.pop()] = places[i] - 1
        lefts.append(places[stack[-1]] + 1 if stack else 0)
        stack.append(i)
    return list(zip(lefts, places, rights))


Area = tuple[int, int, int, int]
Windows = list[dict[int, list[tuple[int, int]]]]


#: Per function: the ruling places, their keys and the hashes there.
Heads = list[tuple[list[int], list[int], list[int]]]


def _heads(marks: np.ndarray, width: int) -> Heads:
    values = all_hashed(marks)
    function, places, keys = _all_ruling(values, width)
    heads = values[function, places]
    ends = np.searchsorted(function, np.arange(FUNCTIONS + 1)).tolist()
    parts = [slice(*x) for x in zip(ends, ends[1:])]
    return [(places[x].tolist(), keys[x].tolist(), heads[x].tolist()) for x in parts]


def _windows_at(heads: Heads, size: int, wanted: list) -> Windows:
    """Where the windows of the ``wanted`` hashes lie (None: of all)."""
    found: Windows = []
    for (places, keys, values), these in zip(heads, wanted):
        own: dict[int, list[tuple[int, int]]] = {}
        if these is None or not these.isdisjoint(values):
            for head, (low, _, high) in zip(values, _extents(places, keys, size)):
                if these is None or head in these:
                    own.setdefault(head, []).append((low, high))
        found.append(own)
    return found


def windows_of(marks: np.ndarray, width: int, among: Windows | None = None) -> Windows:
    """Per function, where the windows of each smallest hash lie; ``among``: of the hashes that
    another text has too."""
    wanted = [None] * FUNCTIONS if among is None else [x.keys() for x in among]
    return _windows_at(_heads(marks, width), len(marks), wanted)


def _common_windows(a: np.ndarray, b: np.ndarray, width: int) -> tuple[Windows, Windows]:
    """The windows of both texts of the hashes that both have."""
    left, right = _heads(a, width), _heads(b, width)
    both = [set(x[2]).intersection(y[2]) for x, y in zip(left, right)]
    return _windows_at(left, len(a), both), _windows_at(right, len(b), both)


def areas(left: Windows, right: Windows, enough: int = ENOUGH) -> list[Area]:
    """Where collisions of compact windows overlap in both texts: (from, to) in each.

    A hash that has many windows on both sides (a line repeated inside the texts) collides once,
    with the span of all its windows: a wider area, but no pairs of its windows.
    """
    meets = []
    for j, (own, other) in enumerate(zip(left, right)):
        for value in own.keys() & other.keys():
            here, there = own[value], other[value]
            if len(here) * len(there) > MANY:
                here = [(min(x[0] for x in here), max(x[1] for x in here))]
                there = [(min(x[0] for x in there), max(x[1] for x in there))]
            meets += [(*x, *y, j) for x in here for y in there]
    meets.sort()
    open_areas: list[list] = []
    for low, high, low_b, high_b, j in meets:
        merged = [low, high, low_b, high_b, {j}]
        apart = []
        for area in open_areas:
            if area[1] >= low and area[2] <= high_b and low_b <= area[3]:
                merged = [
                    min(area[0], merged[0]), max(area[1], merged[1]),
                    min(area[2], merged[2]), max(area[3], merged[3]), area[4] | merged[4],
                ]
            else:
                apart.append(area)
        open_areas = [*apart, merged]
    return [tuple(x[:4]) for x in open_areas if len(x[4]) >= enough]


Chain = tuple[np.ndarray, np.ndarray]


def _chains(a: np.ndarray, b: np.ndarray) -> list[Chain]:
    """Equal shingles of a and b in text order, parted at gaps."""
    order, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    sorted_a, sorted_b = a[order], b[order_b]
    equal = _places_in(sorted_b, sorted_a)[0]
    if not equal.any():
        return []
    common = sorted_a[equal]
    common = common[np.concatenate([[True], common[1:] != common[:-1]])]
    here = np.sort(order[equal])
    equal = _places_in(sorted_a, sorted_b)[0]
    there, values = order_b[equal], sorted_b[equal]
    first = np.searchsorted(values, a[here], "left")
    if len(here) == len(common) == len(there):
        partners = there[first]
        if (partners[1:] > partners[:-1]).all():
            return [(here, partners)]
        return _chains_of_runs(here, partners)
    counts = np.searchsorted(values, a[here], "right") - first
    if counts.sum() > REPEATS * (len(a) + len(b)):
        return list(_chains_of_repeats(a, b, common))
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return _chains_of_runs(np.repeat(here, counts), there[np.repeat(first, counts) + inside])


def _chains_of_runs(rows: np.ndarray, partners: np.ndarray) -> list[Chain]:
    """Chains of the runs on all diagonals: each run goes on from the run that gives it most equal
    shingles after the cost of the gap. A run may go on from one that another chain has too."""
    order = np.lexsort((rows, partners - rows))
    rows, partners = rows[order], partners[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(rows) != 1) | (np.diff(partners) != 1)])
    lengths = np.diff(np.r_[starts, len(rows)])
    order = np.lexsort((partners[starts], rows[starts] + lengths))
    begin, begin_b, size = rows[starts][order], partners[starts][order], lengths[order]
    end, end_b = begin + size, begin_b + size
    score, before = size.astype(float), np.full(len(size), -1)
    # What goes on from a run gains its ``lead`` less what the place of the next one costs. All are
    # multiples of a quarter, so that no order of the sums rounds.
    lead, top = score + GAP_COST * (end + end_b), 0.0
    for t, (at, at_b, most) in enumerate(zip(begin.tolist(), begin_b.tolist(), size.tolist())):
        cost = GAP_COST * (at + at_b)
        if top <= cost:
            top = max(top, lead[t])
            continue
        skip = np.maximum(end[:t] - at, end_b[:t] - at_b)
        np.maximum(skip, 0, out=skip)
        gain = lead[:t] - (1 + 2 * GAP_COST) * skip
        gain[skip >= most] = -np.inf
        best = int(gain.argmax())
        if gain[best] > cost:
            score[t], before[t] = most + gain[best] - cost, best
            lead[t] += gain[best] - cost
        top = max(top, lead[t])
    skip = np.maximum(np.maximum(end[before] - begin, end_b[before] - begin_b), 0)
    skip[before < 0] = 0
    begin, begin_b, counts = begin + skip, begin_b + skip, size - skip
    chains, used, sizes, before = [], [False] * len(size), size.tolist(), before.tolist()
    for t in np.argsort(-score, kind="stable").tolist():
        path, new = [], 0
        while t >= 0 and not used[t]:
            path.append(t)
            new += sizes[t]
            t = before[t]
        if new < SHINGLE:
            continue
        for run in path:
            used[run] = True
        while t >= 0:  # what a used run goes on from is used
            path.append(t)
            t = before[t]
        path = np.array(path[::-1])
        count = counts[path]
        ahead = np.cumsum(count) - count
        run = np.arange(ahead[-1] + count[-1])
        rows = run + np.repeat(begin[path] - ahead, count)
        chains.append((rows, run + np.repeat(begin_b[path] - ahead, count)))
    return chains


def _chains_of_repeats(a: np.ndarray, b: np.ndarray, common: np.ndarray) -> Iterator[Chain]:
    """The same where shingles stand at very many places: a chain begins with the partner whose run
    is longest and goes on with the partner nearest to its diagonal, and a stray match inside a
    chain does not end it."""
    following: dict[int, list[int]] = {}
    for place in np.flatnonzero(np.isin(b, common)).tolist():
        following.setdefault(int(b[place]), []).append(place)
    rows, partners = [], []
    for i in np.flatnonzero(np.isin(a, common)).tolist():
        options = following[int(a[i])]
        if rows and i - rows[-1] <= GAP:
            if len(options) < 50:
                near = [p for p in options if 0 < p - partners[-1] <= GAP]
            else:
                near = range(partners[-1] + 1, min(partners[-1] + GAP + 1, len(b)))
                near = [p for p in near if b[p] == a[i]]
            if near:
                expected = partners[-1] + i - rows[-1]
                rows.append(i)
                partners.append(min(near, key=lambda p: abs(p - expected)))
                continue
            if len(rows) > 1 and i - rows[-1] < SHINGLE:
                continue
        if rows:
            yield np.array(rows), np.array(partners)
        rows, partners = [i], [_longest(a, b, i, options)]
    if rows:
        yield np.array(rows), np.array(partners)


def _longest(a: np.ndarray, b: np.ndarray, i: int, options: list[int]) -> int:
    """The first of the ``options`` whose run is longest; a run of ``WORDS`` is long enough."""
    left = np.array(options)
    for step in range(1, min(WORDS, len(a) - i)):
        on = left[left + step < len(b)]
        on = on[b[on + step] == a[i + step]]
        if not len(on):
            break
        left = on
    return int(left[0])


def _best_part(rows, partners, width, similarity) -> tuple[int, int] | None:
    """The part of a chain, from run to run, that has most equal shingles of those that are long and
    similar enough (as far as no shingle repeats)."""
    cuts = np.flatnonzero((rows[1:] - rows[:-1] > 1) | (partners[1:] - partners[:-1] > 1)) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(rows)]])
    # Spans of ``width`` with the similarity asked for have at least so many equal shingles.
    best, part = int(np.ceil(similarity * width - 1e-6)) - 1, None
    if len(begins) <= TOGETHER:
        begins = begins[len(rows) - begins > best]
        matched = ends - begins[:, None]
        span = rows[ends - 1] + 1 - rows[begins][:, None]
        span_b = partners[ends - 1] + 1 - partners[begins][:, None]
        good = (np.minimum(span, span_b) >= width) & (
            matched >= similarity * (span + span_b - matched) - 1e-9
        )
        matched = np.where(good, matched, 0)
        if not matched.any():
            return None
        most = int(matched.argmax())
        return int(begins[most // len(ends)]), int(ends[most % len(ends)])
    for at, begin in enumerate(begins.tolist()):
        if ends[-1] - begin <= best:
            break
        to = ends[at:]
        matched = to - begin
        span, span_b = rows[to - 1] + 1 - rows[begin], partners[to - 1] + 1 - partners[begin]
        good = (np.minimum(span, span_b) >= width) & (
            matched >= similarity * (span + span_b - matched) - 1e-9
        )
        last = np.flatnonzero(good)
        if len(last) and matched[last[-1]] > best:
            best, part = int(matched[last[-1]]), (begin, int(to[last[-1]]))
    return part


def _accepted(
    a: list, b: list, rows, partners, width, similarity
) -> Iterator[tuple[int, int, int, int, float]]:
    """The chain if it is similar enough, else its best part and what is left on either side. Where
    repeats hide that, the parts between the widest gaps (all of that width at once, so there are
    as many rounds as widths)."""
    todo = [(rows, partners)]
    while todo:
        rows, partners = todo.pop()
        begin, end, begin_b, end_b = int(rows[0]), int(rows[-1]) + 1, int(partners[0]), int(partners[-1]) + 1
        if min(end - begin, end_b - begin_b) < width:
            continue
        one, other = set(a[begin:end]), set(b[begin_b:end_b])
        both = len(one & other)
        share = both / (len(one) + len(other) - both)
        if share >= similarity:
            yield begin, end, begin_b, end_b, share
            continue
        best = _best_part(rows, partners, width, similarity)
        if best and best != (0, len(rows)):
            low, high = best
            parts = [slice(0, low), slice(low, high), slice(high, len(rows))]
            todo += [(rows[x], partners[x]) for x in parts if x.start < x.stop]
        elif len(rows) > 2:
            steps = np.diff(rows) + np.diff(partners)
            if steps.max() > 2:
                cuts = np.flatnonzero(steps == steps.max()) + 1
                todo += zip(np.split(rows, cuts), np.split(partners, cuts))


def shared_passages(
    a: np.ndarray,
    b: np.ndarray,
    words: int = WORDS,
    similarity: float = SIMILARITY,
    b_windows: Windows | None = None,
) -> list[tuple[int, int, int, int, float]]:
    """(start, end) in words of a, then of b, and the similarity, of every common passage."""
    width = words - SHINGLE + 1
    if len(a) >= width and np.array_equal(a, b):
        return [(0, len(a) + SHINGLE - 1, 0, len(b) + SHINGLE - 1, 1.0)]
    found = set()
    if b_windows is None:
        a_windows, b_windows = _common_windows(a, b, width)
    else:
        a_windows = windows_of(a, width, b_windows)
    for low, high, low_b, high_b in areas(a_windows, b_windows):
        part, part_b = a[low : high + 1], b[low_b : high_b + 1]
        listed = part.tolist(), part_b.tolist()
        for rows, partners in _chains(part, part_b):
            for s, e, s_b, e_b, share in _accepted(*listed, rows, partners, width, similarity):
                more = SHINGLE - 1
                found.add((low + s, low + e + more, low_b + s_b, low_b + e_b + more, share))
    return sorted(found)


def repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """doc_id, start, end, other_id, other_start, other_end (in words), similarity."""
    width = words - SHINGLE + 1
    texts = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    windows = _windows(texts, words)
    copies, gone = _copied(windows)
    pairs = _first_pairs(windows, gone, width)
    discard(windows)
    # Whoever is linked later is open in an earlier round, so no text but these is needed.
    paired = pairs.select("id").unionByName(pairs.select(F.col("first").alias("id"))).distinct()
    texts = _written(texts.join(paired, "id", "left_semi"), "texts")
    passages, rows, done = [copies], None, []
    while rows is None or not pairs.isEmpty():
        rows = _written(_verified(pairs, texts, words, similarity), "passages")
        passages.append(rows.where("start is not null").select(*_RESULT.names))
        done.append(pairs.select("id", "row", "first"))
        pairs = _open_pairs(rows.where("start is null"), reduce(DataFrame.unionByName, done))
    return reduce(DataFrame.unionByName, passages).distinct()


_RESULT = StructType(
    [
        StructField(n, LongType())
        for n in ("doc_id", "start", "end", "other_id", "other_start", "other_end")
    ]
    + [StructField("similarity", DoubleType())]
)
#: A passage, or what is open: which of its texts, the firsts it has met, their shingles, its keys.
_VERIFIED = StructType(
    _RESULT.fields
    + [
        StructField("row", LongType()),
        StructField("path", LongType()),
        StructField("had", BinaryType()),
        StructField("keys", ArrayType(LongType())),
    ]
)


#: Whether Spark removes the shuffles of a query when it ends, not when the driver happens to collect.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, label: str) -> DataFrame:
    """``materialize``; nothing reads the shuffles of that write again, so they go with it."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return materialize(df, label)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def _windows(texts: DataFrame, words: int) -> DataFrame:
    """(id, sha, n, keys, places) of every text of enough words: their number, its windows."""
    width = words - SHINGLE + 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, shas, counts, keys, places = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                marks = shingles(text, known)
                if len(marks) < width:
                    continue
                ids.append(doc)
                shas.append(hashlib.sha256(text.encode()).digest())
                counts.append(len(marks) + SHINGLE - 1)
                for into, values in zip((keys, places), placed_keys(marks, width)):
                    into.append(values)
            if not ids:
                continue
            ends = np.cumsum([0, *map(len, keys)])
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x), t))
                for x, t in ((keys, pa.int64()), (places, pa.int32()))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(shas), pa.array(counts), *lists],
                names=["id", "sha", "n", "keys", "places"],
            )

    schema = "id long, sha binary, n long, keys array<long>, places array<int>"
    return _written(texts.mapInArrow(emit, schema), "windows")


def _copied(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the passages that copies of whole texts are, the ids that stand for such copies only)."""
    sizes = windows.select("id", "sha", "n")
    firsts = sizes.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    repeated = _written(firsts.where("first < last").select("sha", "first"), "copied")
    zero, is_copy = F.lit(0).cast("long"), F.coalesce(F.col("id") != F.col("first"), F.lit(False))
    marked = sizes.join(repeated, "sha", "left").withColumn("is_copy", is_copy)
    marked = _written(marked.select("id", "n", "first", "is_copy"), "marked")
    copies = marked.where("is_copy").select(
        F.col("id").alias("doc_id"), zero.alias("start"), F.col("n").alias("end"),
        F.col("first").alias("other_id"), zero.alias("other_start"), F.col("n").alias("other_end"),
        F.lit(1.0).alias("similarity"),
    )
    only = marked.groupBy("id").agg(F.min("is_copy").alias("only")).where("only").select("id")
    return copies.distinct(), _written(only, "gone")


def _repeated(keys: DataFrame) -> DataFrame:
    """(key, first) of the keys of several documents."""
    first = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    return _written(first.where("first < last").select("key", "first"), "repeated")


def _first_pairs(windows: DataFrame, gone: DataFrame, width: int) -> DataFrame:
    """(id, row, path, had, first): all texts of an id, no first met before. Ids that are ``gone``
    stand for copies of smaller ids, so none of them is a first."""

    def join_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.empty((3, 0), np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            rows = np.concatenate([before, rows], axis=1)
            if not rows.shape[1]:
                continue
            new = np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(0)]
            rows = np.ascontiguousarray(rows[:, new])
            ids, keys = near_keys(*rows, width)
            before = rows[:, (rows[0] == rows[0, -1]) & (rows[1] > rows[1, -1] - width)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "id"])

    single = windows.select(F.explode("keys").alias("key"), "id")
    placed = windows.select("id", "places", F.posexplode("keys").alias("pos", "key"))
    placed = placed.select("key", "id", F.get("places", "pos").alias("at"))
    repeated = _repeated(single)
    met = placed.join(repeated, "key").join(gone, "id", "left_anti")
    met = _written(met, "met")
    several = (
        met.where("id <> first")
        .groupBy("id", "first")
        .agg(*[F.max((F.col("key").bitwiseAND(F.lit(7)) == j).cast("int")).alias(f"f{j}") for j in range(FUNCTIONS)])
        .where(sum(F.col(f"f{j}") for j in range(FUNCTIONS)) >= ENOUGH)
        .select("id", "first")
    )
    near = met.select("id", "at", "key").repartition("id").sortWithinPartitions("id", "at", "key")
    near = _written(near.mapInArrow(join_near, "key long, id long"), "near")
    near_repeated = _repeated(near)
    linked = near.join(near_repeated, "key").where("id <> first").select("id", "first")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("row", "long"), ("had", "binary"))]
    pairs = several.unionByName(linked).distinct().select("id", "first", F.lit(0).cast("long").alias("path"), *none)
    pairs = _written(pairs, "pairs")
    discard(repeated, met, near, near_repeated)
    return pairs


def _open_pairs(rows: DataFrame, done: DataFrame) -> DataFrame:
    """The next links of what is open, among those that have met the same firsts. Each pair is
    verified once: a document that meets a first again goes on from where it met it before."""
    rows = rows.withColumnRenamed("doc_id", "id").select("id", "row", "path", "had", "keys")
    keys = rows.select("id", "row", "path", F.explode("keys").alias("key"))
    repeated = _repeated(keys)
    links = keys.join(repeated, "key").where("id <> first")
    links = links.select("id", "row", "path", "first").distinct()
    links = links.groupBy("id", "row", "first").agg(F.min("path").alias("path"))
    met = done.toDF("_id", "_row", "_first")
    same = (F.col("id") == F.col("_id")) & (F.col("first") == F.col("_first"))
    new = links.join(met, same & (F.col("_row").isNull() | (F.col("row") == F.col("_row"))), "left_anti")
    had = rows.select("id", "row", "path", "had").dropDuplicates(["id", "row", "path"])
    pairs = _written(new.join(had, ["id", "row", "path"]), "pairs")
    discard(repeated)
    return pairs


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The passages of the pairs, and what stays open."""
    width = words - SHINGLE + 1
    both = (
        pairs.join(texts, "id")
        .where(F.col("row").isNull() | (F.col("row") == F.xxhash64("text")))
        .withColumnsRenamed({"id": "doc_id", "first": "id", "text": "own"})
        .join(texts, "id")
        .select("doc_id", F.col("id").alias("other_id"), "own", F.col("text").alias("other"),
                F.xxhash64("own").alias("row"), F.col("path").bitwiseXOR(F.xxhash64("id", "text")).alias("path"), "had")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, other, ordered = WordHashes(), None, None, None
        for batch in batches:
            rows = []
            for doc, partner, own, text, row, path, had in zip(*batch.columns):
                text, doc, path = text.as_py(), doc.as_py(), path.as_py()
                if text != last:
                    last, other = text, shingles(text, known)
                    ordered = np.sort(other)
                mine = shingles(own.as_py(), known)
                shared = _places_in(ordered, mine)[0]
                found = verified(mine, other, shared, words, similarity)
                for s, e, s_b, e_b, share in found:
                    rows.append((doc, s, e, partner.as_py(), s_b, e_b, share, *[None] * 4))
                before = np.frombuffer(had.as_py() or bytes(len(mine) // 8 + 1), np.uint8)
                before = np.unpackbits(before, count=len(mine)).astype(bool)
                keys, now = open_keys(mine, shared, before, found, width, path)
                if len(keys):
                    now = np.packbits(now).tobytes()
                    rows.append((doc, *[None] * 6, row.as_py(), path, now, keys))
            columns = list(zip(*rows)) or [()] * 11
            types = [*[pa.int64()] * 6, pa.float64(), pa.int64(), pa.int64(), pa.binary()]
            types.append(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=_VERIFIED.names
            )

    return both.mapInArrow(verify, _VERIFIED)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir))


QUERIES = {"op5_substring_dedup": op5_substring_dedup}
TWINS: dict[str, str] = {}
