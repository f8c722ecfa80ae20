"""Bin completion against exhaustive search, and the packed pieces against the tokenizer."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from chunkloom.llm import bestfit, packing


def fewest(items, capacity):
    """The optimum, by trying every place of every item."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {room: j for j, room in enumerate(bins) if room >= items[i]}.values():
            bins[j] -= items[i]
            place(i + 1, bins)
            bins[j] += items[i]
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best[0]


def one_by_one(items, capacity):
    rooms = []
    for k in sorted(items, reverse=True):
        fits = [j for j in range(len(rooms)) if rooms[j] >= k]
        if fits:
            rooms[min(fits, key=lambda j: rooms[j])] -= k
        else:
            rooms.append(capacity - k)
    return len(rooms)


def size(packs):
    return sum(n for n, _ in packs)


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_the_optimum(seed):
    rnd = random.Random(seed)
    for _ in range(150):
        capacity = rnd.choice([10, 20, 50, 100])
        items = [rnd.randint(1, capacity) if rnd.random() < 0.5 else rnd.randint(capacity // 5, capacity // 2) for _ in range(rnd.randint(0, 12))]
        histogram, want = dict(Counter(items)), fewest(items, capacity)
        packs = bestfit.complete(histogram, capacity, 10**6, 10**6)
        assert all(sum(lengths) <= capacity for _, lengths in packs)
        assert Counter({k: sum(n * lengths.count(k) for n, lengths in packs) for k in histogram}) == Counter(items)
        assert bestfit.lower_bound(histogram, capacity) <= want == size(packs)
        assert size(bestfit.best_fit(histogram, capacity)) == one_by_one(items, capacity)


def test_search_beats_best_fit():
    rnd = random.Random(3)
    items = []
    for _ in range(100):
        a, b = rnd.randint(1100, 1800), rnd.randint(1000, 1500)
        items += [a, b, 4096 - a - b]
    histogram = dict(Counter(items))
    assert size(bestfit.complete(histogram)) <= 103 < size(bestfit.best_fit(histogram))


def test_dominated_fillings():
    bits = lambda *lengths: sum(1 << k for k in lengths)
    assert bestfit.dominated((3, 4), 0, bits(7)) and not bestfit.dominated((3, 4), 0, bits(3, 4, 6, 8))
    assert bestfit.dominated((5,), 2, bits(6)) and bestfit.dominated((5,), 2, bits(2)) and not bestfit.dominated((5,), 2, bits(3, 4, 5, 8))
    assert bestfit.fillings([2, 3, 4], {2: 1, 3: 1, 4: 1}, 6, 6) == [(0, (4, 2))]


def test_nodes_count_packs_and_build_only_better_ones(monkeypatch):
    rnd = random.Random(8)
    for _ in range(300):
        capacity = rnd.choice([10, 37, 100])
        histogram = {rnd.randint(1, capacity): rnd.randint(1, 9) for _ in range(rnd.randint(0, 20))}
        assert bestfit.fitted(histogram, capacity) == size(bestfit.best_fit(histogram, capacity))
    built, kept = [], bestfit.best_fit
    monkeypatch.setattr(bestfit, "best_fit", lambda *a: built.append(1) or kept(*a))
    packs = bestfit.complete({k: 3 for k in range(26, 50)}, 100, 60)
    assert sum(n * len(lengths) for n, lengths in packs) == 72 and len(built) <= 4


def test_each_id_lies_once_in_a_sequence(spark):
    texts = ["some words here " * 40, None, "", "x", "long text " * 3000, "été " * 2048, "a b c"] * 3
    rows = [(i % 15, t, "s", 1) for i, t in enumerate(texts)]  # ids repeat
    got = bestfit.packed(spark.createDataFrame(rows, "doc_id long, text string, piece string, offset int")).collect()
    encoder, want = packing.encoder(packing.tokenizer_path()), []
    for doc, text, *_ in rows:
        ids = [*np.frombuffer(encoder.encode(text), "<u4").tolist(), 1]
        for at in range(0, len(ids), 4096):
            part = ids[at : at + 4096]
            want.append((doc, at // 4096, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in held.values():
        ends = [0, *[o + n for o, n in sorted(own)]]
        assert [o for o, _ in sorted(own)] == ends[:-1] and ends[-1] <= 4096
    assert len(held) == size(bestfit.complete(dict(Counter(w[3] for w in want))))
    assert bestfit.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
