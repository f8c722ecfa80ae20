"""Packing into as few sequences as possible: bin completion, a branch and bound over the histogram of lengths.

Documents are tokenised as in packing.py; only those of more than `capacity` ids are cut, into pieces of `capacity`
and a rest. The histogram of the rests' lengths, fewer than `capacity` rows at any size of the corpus, goes to the
driver, and the search is over it: pieces of one length are the same to it, and packs of the same lengths are one
pattern with a count.

The search fills one sequence at a time around the longest piece left, by the fillings of the rest of the sequence
that are undominated: no piece left could take the place of some pieces of the filling, or of empty places, and waste
no more. Fillings that waste least come first, each as often as pieces last, and then once. Two bounds prune: what is
wasted so far must leave room for a solution better than the best known one, and what is left needs at least the
sequences that its volume and its long pieces ask for. At every node, best fit decreasing completes what is chosen so
far, which gives the best known solutions. The search ends at a solution that meets the lower bound, when nothing is
left to try (then the solution is optimal), or after `nodes` nodes.

`nodes`, and `width`, the fillings tried at a node, bound the work at the driver and don't leave out any piece.

A null text is empty and has one piece with the end id alone. Rows with the same doc_id are packed like others.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm import packing

CAPACITY = 4096
NODES = 500
WIDTH = 16
#: Steps of the search for one node's fillings.
STEPS = 3000

Packs = list[tuple[int, tuple[int, ...]]]


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> Packs:
    """(count, lengths) of packs: longest pieces first, each into the fullest pack that has room."""
    open_packs: dict[int, list[tuple[int, tuple]]] = {}  # by space left
    spaces: list[int] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                count, held = open_packs[space].pop()
                if not open_packs[space]:
                    del open_packs[space]
                    del spaces[at]
            else:
                count, held, space = -(-left // (capacity // length)), (), capacity
            # A pack that took one piece is the fullest with room for the next, as long as it has room.
            most = space // length
            full = min(count, left // most)
            part = left - full * most if full < count else 0
            for n, k in ((full, most), (1 if part else 0, part), (count - full - (1 if part else 0), 0)):
                if n:
                    s = space - k * length
                    if s not in open_packs:
                        open_packs[s] = []
                        insort(spaces, s)
                    open_packs[s].append((n, (length, k, held) if k else held))
            left -= full * most + part
    found: dict[tuple[int, ...], int] = {}
    for packs in open_packs.values():
        for n, pack in packs:
            lengths: list[int] = []
            while pack:
                lengths += [pack[0]] * pack[1]
                pack = pack[2]
            if lengths:
                key = tuple(reversed(lengths))
                found[key] = found.get(key, 0) + n
    return [(n, key) for key, n in found.items()]


def fitted(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """How many packs best_fit() takes; packs with as much space left are one to it."""
    packs: dict[int, int] = {}  # by space left
    spaces: list[int] = []
    taken = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                count = packs[space]
            else:
                at, space = -1, capacity
                count = -(-left // (capacity // length))
                taken += count
            most = space // length
            full = min(count, left // most)
            part = left - full * most if full < count else 0
            rest = count - full - (part > 0)
            if at >= 0:
                if rest:
                    packs[space] = rest
                else:
                    del packs[space]
                    del spaces[at]
            for n, k in ((full, most), (part > 0, part)):
                if n and (s := space - k * length):
                    if s in packs:
                        packs[s] += n
                    else:
                        packs[s] = int(n)
                        insort(spaces, s)
            left -= full * most + part
    return taken


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that are needed at least: the most, over thresholds k, of pieces too long to share with one of k or more, of those over half, and of the volume that those leave no room for."""
    items = sorted((k, n) for k, n in histogram.items() if n)
    longer = [(k, n) for k, n in items if 2 * k > capacity]
    half = sum(n for _, n in longer)
    best = max(half, -(-sum(k * n for k, n in items) // capacity))
    # need: the volume of pieces up to half, from k on; room: what longer ones leave to them, where k fits at all.
    need = room = 0
    at = 0
    for k, n in reversed([(k, n) for k, n in items if 2 * k <= capacity]):
        need += k * n
        while at < len(longer) and capacity - longer[at][0] >= k:
            room += (capacity - longer[at][0]) * longer[at][1]
            at += 1
        best = max(best, half + -(-max(0, need - room) // capacity))
    return best


def _smeared(bits: int, least: int, most: int) -> int:
    """The bits moved up by each of least to most places."""
    out, span, want = bits << least, 1, most - least + 1
    while span < want:
        step = min(span, want - span)
        out |= out << step
        span += step
    return out


def dominated(filling: tuple[int, ...], waste: int, available: int) -> bool:
    """Whether a length in `available`, a set of bits, could take the place of pieces of the filling or of waste, and waste less, or the same with fewer pieces."""
    some, several = 1, 0  # sums of any pieces, of two and more
    single = 0
    for length in filling:
        several |= several << length | single << length
        some |= some << length
        single |= 1 << length
    return bool(available & several) or waste > 0 and bool(available & _smeared(some, 1, waste))


def fillings(lengths: list[int], counts: dict[int, int], room: int, waste: int, width: int = WIDTH, steps: int = STEPS) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, lengths) of undominated fillings of `room` that leave at most `waste` of it, least waste first.

    lengths ascend and have counts of one and more. At most `width` fillings, found in at most `steps` steps.
    """
    available = sum(1 << k for k in lengths)
    volumes = [0]  # of the first pieces by length
    for k in lengths:
        volumes.append(volumes[-1] + k * counts[k])

    def search() -> Iterator[tuple[int, tuple[int, ...]]]:
        stack: list[tuple[int, int, tuple[int, ...]]] = [(room, len(lengths), ())]
        for _ in range(steps):
            if not stack:
                return
            left, below, chosen = stack.pop()
            if left <= waste:
                yield left, chosen
            # Lengths not longer than the last one that still fit, shortest at the bottom of the stack.
            top = bisect_left(lengths, left + 1, 0, below)
            if not top:
                continue
            length = lengths[top - 1]
            if volumes[top - 1] >= left - waste:  # shorter ones alone can come near enough
                stack.append((left, top - 1, chosen))
            most = min(counts[length], left // length)
            for k in range(1, most + 1):
                stack.append((left - k * length, top - 1, chosen + (length,) * k))

    found: list[tuple[int, tuple[int, ...]]] = []
    seen: set[tuple[int, ...]] = set()
    for left, chosen in search():
        if lengths and left >= lengths[0] and chosen.count(lengths[0]) < counts[lengths[0]]:
            continue  # dominated: the shortest piece could take the place of waste
        if chosen in seen:
            continue
        seen.add(chosen)
        rest = available
        for k in set(chosen):
            if chosen.count(k) == counts[k]:
                rest &= ~(1 << k)
        if not dominated(chosen, left, rest):
            found.append((left, chosen))
            if len(found) == width:
                break
    return sorted(found, key=lambda f: (f[0], [-k for k in f[1]]))


def complete(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, width: int = WIDTH) -> Packs:
    """(count, lengths) of as few packs as the search finds for the given numbers of pieces by length."""
    start = {k: n for k, n in histogram.items() if n}
    best = best_fit(start, capacity)
    size, floor = sum(n for n, _ in best), lower_bound(start, capacity)
    total = sum(k * n for k, n in start.items())
    seen: dict[int, int] = {}
    # (pieces before its last packs, those packs as a number and their lengths, packs used, waste, packs chosen as a chain)
    stack: list[tuple[dict[int, int], int, dict[int, int], int, int, tuple | None]] = [(start, 0, {}, 0, 0, None)]
    while stack and nodes and size > floor:
        before, t, uses, used, wasted, chosen = stack.pop()
        counts = {k: n - t * uses.get(k, 0) for k, n in before.items() if n > t * uses.get(k, 0)} if t else before
        nodes -= 1
        if not counts or used + lower_bound(counts, capacity) >= size or (size - 1) * capacity - total < wasted:
            continue
        own = hash(tuple(sorted(counts.items())))
        if seen.get(own, size) <= used:
            continue
        seen[own] = used
        if chosen:
            rest = fitted(counts, capacity)
            if used + rest < size:
                best, size = best_fit(counts, capacity), used + rest
                at = chosen
                while at:
                    best.append(at[0])
                    at = at[1]
                if size <= floor:
                    break
        longest = max(counts)
        left = dict(counts)
        left[longest] -= 1
        if not left[longest]:
            del left[longest]
        allowed = (size - 1) * capacity - total - wasted
        if allowed < 0:
            continue
        branches, pieces = [], sum(counts.values())
        for waste, filling in fillings(sorted(left), left, capacity - longest, min(allowed, capacity - longest), width):
            pack = (longest, *filling)
            uses = {k: pack.count(k) for k in set(pack)}
            times = min(counts[k] // n for k, n in uses.items())
            if waste:
                times = min(times, allowed // waste)
            for t in sorted({1, times}, reverse=True):
                if t * len(pack) == pieces and used + t < size:
                    best, size = [(t, pack)], used + t
                    at = chosen
                    while at:
                        best.append(at[0])
                        at = at[1]
                branches.append((counts, t, uses, used + t, wasted + t * waste, ((t, pack), chosen)))
        stack += reversed(branches)
    merged: dict[tuple[int, ...], int] = {}
    for n, lengths in best:
        merged[lengths] = merged.get(lengths, 0) + n
    return [(n, lengths) for lengths, n in sorted(merged.items(), reverse=True)]


def sequences(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The padded sequences of all documents, written: (sequence_id, filled, ids, pieces), see packing.filled()."""
    return packing.sequences(documents, path, capacity, plan=complete)


def packed(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece, read from the written sequences."""
    return packing.placed(sequences(documents, path, capacity)).withColumn("piece", F.floor(F.col("start") / capacity).cast("int"))
