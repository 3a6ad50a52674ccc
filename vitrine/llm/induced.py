"""Suffix sorting of a shard by external induced sorting with common-prefix values.

Suffixes move as tuples (position, common prefix with the tuple before) through priority queues
that are keyed by first character and popped in key order.  A queue holds its newest tuples in
memory and appends the rest to a file, so a shard may be far larger than memory; text and types
can be memory-mapped.  As in the internal algorithm, the sorted left-most S suffixes induce the L
suffixes in one ascending scan, and these the S suffixes in one descending scan.  The left-most S
suffixes are ordered by naming their substrings, which the same two scans sort, and recursing on
the string of names, until a string fits in memory, where its ranks are doubled directly.

Everything is ordered and compared up to ``depth`` characters: that is all a repeat of that
length needs, and suffixes alike that far stay in any order.  Character 0 ends a string; each end
counts as different from all others, so no common prefix reaches across it.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Callable

import numpy as np

#: Tuples taken from a queue at once.
BLOCK = 1 << 21


class DiskQueue:
    """Tuples by key, first in first out within a key, spilled to one file beyond ``limit`` bytes."""

    def __init__(self, limit: int):
        self.limit, self.size = limit, 0
        self.memory: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.disk: dict[int, list[tuple[int, int]]] = {}
        self.file = None

    def push(self, key: int, places: np.ndarray, common: np.ndarray) -> None:
        self.memory.setdefault(key, []).append((places, common))
        self.size += places.nbytes + common.nbytes
        if self.size > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for key, parts in self.memory.items():
            places = np.concatenate([p for p, _ in parts])
            common = np.concatenate([c for _, c in parts])
            self.disk.setdefault(key, []).append((self.file.tell(), len(places)))
            self.file.write(places.tobytes())
            self.file.write(common.tobytes())
        self.memory, self.size = {}, 0

    def _load(self, at: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(at)
        places = np.frombuffer(self.file.read(8 * count), dtype=np.int64)
        return places, np.frombuffer(self.file.read(2 * count), dtype=np.uint16)

    def keys(self) -> set[int]:
        return set(self.memory) | set(self.disk)

    def pop(self, key: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The next block of a key, oldest first; None when the key is empty."""
        runs = self.disk.get(key)
        if runs:
            at, count = runs[0]
            part = self._load(at, min(count, BLOCK)) if count <= BLOCK else self._head(runs)
            if count <= BLOCK:
                runs.pop(0)
            if not runs:
                del self.disk[key]
            return part
        parts = self.memory.pop(key, None)
        if not parts:
            return None
        self.size -= sum(p.nbytes + c.nbytes for p, c in parts)
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])

    def _head(self, runs: list) -> tuple[np.ndarray, np.ndarray]:
        """The first ``BLOCK`` tuples of a spilled run, which is split in two runs for that."""
        at, count = runs[0]
        places, common = self._load(at, count)
        self.file.seek(0, 2)
        start, rest = self.file.tell(), count - BLOCK
        self.file.write(places[BLOCK:].tobytes())
        self.file.write(common[BLOCK:].tobytes())
        runs[0] = (start, rest)
        return places[:BLOCK], common[:BLOCK]

    def drain(self, key: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return list(iter(lambda: self.pop(key), None))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; ends are, and the last place is."""
    n = len(text)
    up = np.empty(n, dtype=np.int8)
    up[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1])
    up[-1] = 1
    up[text == 0] = 1
    decided = np.where(up != 0, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return up[decided] > 0


def leftmost(small: np.ndarray) -> np.ndarray:
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


class _Scan:
    """Pushes the predecessors of scanned suffixes and carries common prefixes to them."""

    def __init__(self, text, small, want: bool, depth: int, limit: int):
        self.text, self.small, self.want, self.depth = text, small, want, depth
        self.queue = DiskQueue(limit)
        self.fresh: list[int] = []
        #: Least common prefix since the last push to a key, over all that was scanned since.
        self.least: dict[int, int] = {}

    def feed(self, places: np.ndarray, common: np.ndarray) -> None:
        """Scan a block: ``common[i]`` is what suffix ``i`` shares with the one scanned before."""
        before = np.maximum(places - 1, 0)
        chars = self.text[before]
        moves = np.flatnonzero((places > 0) & (self.small[before] == self.want) & (chars > 0))
        floor = int(common.min())
        kinds = chars[moves]
        order = np.argsort(kinds, kind="stable")
        kinds, moves = kinds[order], moves[order]
        edges = np.flatnonzero(np.diff(kinds)) + 1
        hit = set()
        if len(kinds):
            for part in np.split(moves, edges):
                key = int(chars[part[0]])
                hit.add(key)
                shared = np.empty(len(part), dtype=np.int64)
                first = int(common[: part[0] + 1].min())
                if key in self.least:
                    shared[0] = min(first, self.least[key]) + 1
                else:
                    shared[0] = 0
                    self.fresh.append(key)
                if len(part) > 1:
                    # the ranges (part[i - 1], part[i]], each as one span of a reduction
                    shared[1:] = np.minimum.reduceat(common[: part[-1] + 1], part[:-1] + 1) + 1
                tail = common[part[-1] + 1 :]
                self.least[key] = int(tail.min()) if len(tail) else self.depth
                self.queue.push(key, before[part], np.minimum(shared, self.depth).astype(np.uint16))
        for key in self.least.keys() - hit:
            if self.least[key] > floor:
                self.least[key] = floor


def _run_length(text: np.ndarray, place: int, depth: int) -> int:
    part = text[place : place + depth]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _seams(text, a: int | None, b: int, depth: int) -> int:
    """Common prefix of an L and an S suffix with one first character: the shorter run of it."""
    return 0 if a is None else min(_run_length(text, a, depth), _run_length(text, b, depth))


def induce(
    text: np.ndarray,
    small: np.ndarray,
    seeds: np.ndarray,
    common: np.ndarray,
    depth: int,
    limit: int,
    sink: Callable[[np.ndarray, np.ndarray], None],
) -> None:
    """Give ``sink`` all suffixes from the largest to the least, block by block, each with what it
    shares with the one given before; ``seeds`` are left-most S suffixes in order."""
    first = text[seeds]
    chars, begins = np.unique(first, return_index=True)
    ends = np.append(begins[1:], len(seeds))
    seeded = {int(c): (int(b), int(e)) for c, b, e in zip(chars, begins, ends)}
    laid = DiskQueue(limit)
    up = _Scan(text, small, False, depth, limit)
    heap = sorted(seeded)
    pending = set(heap)
    while heap:
        key = heapq.heappop(heap)
        last = None
        while (block := up.queue.pop(key)) is not None:
            places, shared = block
            laid.push(key, places, shared)
            last = int(places[-1])
            up.feed(places, shared)
        if key in seeded:
            begin, end = seeded[key]
            shared = common[begin:end].copy()
            # ends differ from each other; a bucket's first suffix shares nothing with the last one
            shared[0] = _seams(text, last, int(seeds[begin]), depth) if key else 0
            up.feed(seeds[begin:end], shared)
        for fresh in up.fresh:
            if fresh not in pending:
                pending.add(fresh)
                heapq.heappush(heap, fresh)
        up.fresh.clear()
    up.queue.close()
    down = _Scan(text, small, True, depth, limit)
    heap = [-key for key in laid.keys() | set(seeded)]
    heapq.heapify(heap)
    pending = set(heap)
    while heap:
        key = -heapq.heappop(heap)
        last = None
        while (block := down.queue.pop(key)) is not None:
            places, shared = block
            last = int(places[-1])
            sink(places, shared)
            down.feed(places, shared)
        carry = None
        for places, shared in reversed(laid.drain(key)):
            # downwards, a suffix shares with its larger neighbour what that one had recorded
            turned = places[::-1]
            moved = np.empty_like(shared)
            moved[1:] = shared[:0:-1]
            moved[0] = _seams(text, last, int(turned[0]), depth) if carry is None else carry
            carry = int(shared[0])
            last = int(turned[-1])
            sink(turned, moved)
            down.feed(turned, moved)
        for fresh in down.fresh:
            if -fresh not in pending:
                pending.add(-fresh)
                heapq.heappush(heap, -fresh)
        down.fresh.clear()
    down.queue.close()
    laid.close()


def doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of ``names`` up to ``depth`` names, by doubling ranks in memory.

    A rank is the place of a group's first member, so only groups still tied are sorted again."""
    n = len(names)
    bits = int(names.max() + 1).bit_length()
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for step in range(width):
        key <<= bits
        if step < n:
            key[: n - step] += names[step:] + 1
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied) and width < depth:
        part = order[tied]
        after = part + width
        key = rank[part] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        turn = np.argsort(key)
        part, key = part[turn], key[turn]
        order[tied] = part
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[part] = np.maximum.accumulate(np.where(new, tied, 0))
        tied = tied[~(new & np.append(new[1:], True))]
        width *= 2
    return order


def _shared(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes of bytes, up to ``depth``; an end matches nothing."""
    n = len(text)
    place = np.where(text == 0, np.arange(n), n)
    until = np.minimum.accumulate(place[::-1])[::-1] - np.arange(n)
    most = np.minimum(np.minimum(until[a], until[b]), depth)
    padded = np.zeros(n + depth + 16, dtype=np.uint8)
    padded[:n] = text
    words = np.ndarray(shape=(n + depth,), dtype="<u8", buffer=padded, strides=(1,))
    found = most.copy()
    live = np.flatnonzero(most > 0)
    for offset in range(0, depth, 8):
        other = words[a[live] + offset] ^ words[b[live] + offset]
        ended = other != 0
        bits = other[ended]
        same = np.bitwise_count((bits & (~bits + np.uint64(1))) - np.uint64(1)) >> 3
        found[live[ended]] = np.minimum(offset + same, most[live[ended]])
        live = live[~ended]
        live = live[most[live] > offset + 8]
        if not len(live):
            break
    return found


def _names(text, small, left, ordered, depth) -> np.ndarray:
    """Names, in text order, of the substrings from one left-most S place to the next."""
    length = np.diff(np.append(left, len(text) - 1)) + 1
    of = np.zeros(len(text), dtype=np.int64)
    of[left] = length
    size = of[ordered]
    a, b = ordered[:-1], ordered[1:]
    differ = size[:-1] != size[1:]
    live, offset = np.flatnonzero(~differ), 0
    while len(live):
        live = live[size[live] > offset]
        x, y = text[a[live] + offset], text[b[live] + offset]
        wrong = (x != y) | (x == 0)
        differ[live[wrong]] = True
        live = live[~wrong]
        offset += 1
    name = np.concatenate([[0], np.cumsum(differ)])
    of[ordered] = name
    return of[left]


def ordered_leftmost(text, small, left, depth: int, limit: int, base: int) -> np.ndarray:
    """The left-most S suffixes in order, up to ``depth`` characters."""
    start = left[np.argsort(text[left], kind="stable")]
    found: list[np.ndarray] = []
    is_left = np.zeros(len(text), dtype=bool)
    is_left[left] = True

    def keep(places: np.ndarray, _: np.ndarray) -> None:
        kept = places[is_left[places]]
        if len(kept):
            found.append(kept)

    induce(text, small, start, np.zeros(len(start), dtype=np.uint16), depth, limit, keep)
    ends = left[text[left] == 0]
    rest = np.concatenate(found)[::-1] if found else np.empty(0, dtype=np.int64)
    ordered = np.concatenate([ends, rest[text[rest] > 0]])
    names = _names(text, small, left, ordered, depth)
    if names.max() == len(left) - 1:
        return ordered
    if len(left) <= base:
        return left[doubled(names, depth)]
    # a name for each place, and one end that is smaller than all of them
    reduced = np.append(names + 1, 0)
    inner = types(reduced)
    tops = leftmost(inner)
    sorted_tops = ordered_leftmost(reduced, inner, tops, depth, limit, base)
    out: list[np.ndarray] = []
    induce(
        reduced, inner, sorted_tops, np.zeros(len(tops), dtype=np.uint16), depth, limit,
        lambda places, _: out.append(places),
    )
    whole = np.concatenate(out)[::-1]
    return left[whole[whole < len(left)]]


def _runs_of_one(text: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of one character (not the end mark) of at least ``least``."""
    edges = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1, [len(text)]])
    long = (np.diff(edges) >= least) & (text[edges[:-1]] > 0)
    return edges[:-1][long], edges[1:][long]


def repeated(text: np.ndarray, depth: int, limit: int = 256 << 20, base: int = 1 << 24) -> np.ndarray:
    """True at each place whose next ``depth`` characters also start at another place.

    ``text`` holds bytes and ends with 0; 0 ends a string.  ``limit`` bounds the bytes that a queue
    keeps in memory, ``base`` the number of names that are ordered in memory.

    All places inside a long run of one character are alike, and inducing would walk it suffix by
    suffix: only ``depth`` characters at both its ends are sorted, with an end mark between."""
    begins, ends = _runs_of_one(text, 2 * depth + 2)
    if not len(begins):
        return _repeated(text, depth, limit, base)
    inside = np.zeros(len(text) + 1, np.int64)
    inside[begins + depth] += 1
    inside[ends - depth - 1] -= 1
    kept = np.flatnonzero(np.cumsum(inside)[:-1] == 0)
    shorter = text.copy()
    shorter[ends - depth - 1] = 0
    mark = np.zeros(len(text), dtype=bool)
    mark[kept] = _repeated(shorter[kept], depth, limit, base)
    alike = np.zeros(len(text) + 1, np.int64)
    alike[begins] += 1
    alike[ends - depth + 1] -= 1
    return mark | (np.cumsum(alike)[:-1] > 0)


def _repeated(text: np.ndarray, depth: int, limit: int, base: int) -> np.ndarray:
    mark = np.zeros(len(text), dtype=bool)
    small = types(text)
    left = leftmost(small)
    if not len(left):
        return mark
    last = np.empty(0, dtype=np.int64)

    def see(places: np.ndarray, shared: np.ndarray) -> None:
        nonlocal last
        full = np.flatnonzero(shared >= depth)
        mark[places[full]] = True
        before = np.concatenate([last, places])
        mark[before[full + len(last) - 1]] = True
        last = places[-1:]

    ordered = ordered_leftmost(text, small, left, depth, limit, base)
    common = np.zeros(len(ordered), dtype=np.uint16)
    common[1:] = _shared(text, ordered[:-1], ordered[1:], depth)
    induce(text, small, ordered, common, depth, limit, see)
    return mark
