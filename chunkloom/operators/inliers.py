"""Agreement of repeated shift measurements of a pair, in three axes.

Measurements agree where no axis differs by more than its bound. Sets whose members agree pairwise are those that fit
into a box with the bounds as sides, as intervals that meet pairwise have a common point. So the largest set starts
at a corner made of its members' coordinates, and no search over subsets is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Measurements of one pair; more are an error, as corners grow with the third power.
MOST = 120
#: Up to so many measurements a set is the bits of one number, and pairs of one size are searched at once.
BITS = 60
#: Corners searched at once.
CORNERS = 1 << 20


def largest_agreeing(shifts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The positions of the largest set that agrees; of equally large ones, the first in the order of their positions."""
    inside = [(shifts[None, :, a] >= np.unique(shifts[:, a])[:, None]) & (shifts[None, :, a] <= np.unique(shifts[:, a])[:, None] + bounds[a]) for a in range(3)]
    best = np.zeros(0, np.int64)
    for z in inside[0]:
        held = (z & inside[1])[:, None, :] & inside[2][None, :, :]
        size = held.sum(2)
        if size.max() < len(best):
            continue
        for row in np.unique(held[size == size.max()], axis=0):
            found = np.flatnonzero(row)
            if len(found) > len(best) or (len(found) == len(best) and tuple(found) < tuple(best)):
                best = found
    return best


def agreeing_sets(shifts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """largest_agreeing() of many pairs (pair, measurement, axis) with as many measurements each, as booleans (pair, measurement)."""
    n, m, _ = shifts.shape
    if m > BITS:
        out = np.zeros((n, m), bool)
        for own, rows in zip(out, shifts):
            own[largest_agreeing(rows, bounds)] = True
        return out
    # The first measurement is the highest bit: of sets as large, the first in the order of positions is the greatest number.
    bit = np.uint64(1) << np.arange(m - 1, -1, -1, dtype=np.uint64)
    best = np.zeros(n, np.uint64)
    step = max(1, CORNERS // m**3)
    for k in range(0, n, step):
        own = shifts[k : k + step]
        z, y, x = ((((own[:, None, :, a] >= own[:, :, None, a]) & (own[:, None, :, a] <= own[:, :, None, a] + bounds[a])) * bit).sum(2, dtype=np.uint64) for a in range(3))
        held = (z[:, :, None, None] & y[:, None, :, None] & x[:, None, None, :]).reshape(len(own), -1)
        size = np.bitwise_count(held)
        best[k : k + step] = np.where(size == size.max(1, keepdims=True), held, np.uint64(0)).max(1)
    return (best[:, None] & bit) > 0


def marked(measured: DataFrame, bounds: tuple[float, float, float], least: int, weak: float) -> DataFrame:
    """measured (fixed, moving, id, z, y, x, weight) with `status` and the weight that follows from it.

    Pairs with fewer than `least` agreeing measurements keep all of them at `weak` times their weight
    (`downweighted`); else the agreeing ones are `inlier`, and the others `outlier` without weight. Positions are in
    the order of id. Pairs lie in order within their task, which searches those of one size at once.
    """
    kinds = "fixed long, moving long, id long, z double, y double, x double, weight double"
    names = [k.split()[0] for k in kinds.split(", ")]
    room = np.array(bounds)

    def mark(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        """Whole pairs, which begin at starts."""
        shifts = np.stack([rows[c].to_numpy() for c in "zyx"], 1).astype(float)
        weight = rows["weight"].to_numpy().astype(float)
        sizes = np.diff(np.append(starts, len(shifts)))
        if sizes.max(initial=0) > MOST:
            raise ValueError(f"a pair has more than {MOST} measurements")
        chosen = np.zeros(len(shifts), bool)
        enough = np.zeros(len(shifts), bool)
        for m in np.unique(sizes):
            at = starts[sizes == m][:, None] + np.arange(m)
            found = agreeing_sets(shifts[at], room)
            chosen[at] = found
            enough[at] = (found.sum(1) >= least)[:, None]
        after = np.where(enough, np.where(chosen, weight, 0.0), np.clip(weight, 0, None) * weak)
        status = np.where(enough, np.where(chosen, "inlier", "outlier"), "downweighted")
        columns = [rows[c].combine_chunks() for c in names[:-1]] + [pa.array(after, from_pandas=True), pa.array(status.astype(object), pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*names, "status"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]).combine_chunks() if rest is not None else rows
            if not len(rows):
                continue
            ends = [rows[c].fill_null(0).to_numpy() for c in names[:2]] + [rows[c].is_null().to_numpy() for c in names[:2]]
            starts = np.flatnonzero(np.append(True, np.any([e[1:] != e[:-1] for e in ends], axis=0)))
            # The last pair may go on in the next batch.
            last = int(starts[-1])
            if len(rows) - last > MOST:
                raise ValueError(f"a pair has more than {MOST} measurements")
            if last:
                yield mark(rows.slice(0, last), starts[:-1])
            rest = rows.slice(last)
        if rest is not None and len(rest):
            yield mark(rest, np.zeros(1, np.int64))

    dealt = measured.select(*[F.col(k.split()[0]).cast(k.split()[1]).alias(k.split()[0]) for k in kinds.split(", ")]).repartition("fixed", "moving")
    return dealt.sortWithinPartitions("fixed", "moving", F.col("id").asc_nulls_last()).mapInArrow(apply, kinds + ", status string")


def medians(marks: DataFrame) -> DataFrame:
    """(fixed, moving, n, z, y, x): the median shift of each pair's inliers."""
    inside = marks.where(F.col("status") == "inlier")
    return inside.groupBy("fixed", "moving").agg(F.count("*").alias("n"), *[F.median(c).alias(c) for c in "zyx"])
