"""Generalised pigeonhole search: all pairs of distinct 64-bit fingerprints within a Hamming distance.

The 64 bits are dealt into m partitions of correlated bits. With integer thresholds T_1..T_m whose sum
is tau - m + 1, any two fingerprints at distance <= tau differ in at most T_i bits in some partition i
(a threshold of -1 takes a partition out). The thresholds come from dynamic programming over the
estimated number of candidates of each partition at each threshold. Every fingerprint is indexed under
its value in each partition and probes all values within T_i of its own; candidates are verified.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

BITS = 64
#: Buckets with more fingerprints than this are searched by neighbourhood enumeration instead of by pairs.
CROWDED = 128


def bit_statistics(nodes: DataFrame, fp: str) -> tuple[int, np.ndarray]:
    """The number of fingerprints and the 64 x 64 counts of bits set together, over all rows."""

    def count(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).view(np.uint8)
            bits = np.unpackbits(values.reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                part = bits[at : at + (1 << 16)]
                total += part.T @ part
            n += len(bits)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, -1).astype(np.int32)), pa.array(np.append(j, -1).astype(np.int32)), pa.array(np.append(total.ravel(), n).astype(np.int64))],
            ["i", "j", "n"],
        )

    rows = nodes.select(fp).mapInArrow(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    n, together = 0, np.zeros((BITS, BITS))
    for r in rows:
        if r.i < 0:
            n = r.n
        else:
            together[r.i, r.j] = r.n
    return n, together


def group_bits(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits into m partitions: each starts from the bit with least entropy that is left and takes those most correlated with it."""
    mean = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tied = np.abs(together / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    left, out = list(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        part = [min(left, key=lambda b: (round(spread[b], 9), b))]
        left.remove(part[0])
        while len(part) < width:
            nxt = max(left, key=lambda b: (round(float(tied[b, part].sum()), 9), -b))
            part.append(nxt)
            left.remove(nxt)
        out.append(sorted(part))
    return out


def within(disagree: np.ndarray, most: int) -> np.ndarray:
    """P(at most t of the bits disagree), t = 0..most, for independent bits."""
    p = np.zeros(most + 1)
    p[0] = 1.0
    for q in disagree:
        p[1:] = p[1:] * (1 - q) + p[:-1] * q
        p[0] *= 1 - q
    return np.cumsum(p)


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds T_i >= -1 with sum total and least summed cost; costs[i][t + 1] is that of T_i = t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for have, (cost, chosen) in best.items():
            for t, c in enumerate(own, -1):
                new = (cost + c, [*chosen, t])
                if have + t not in step or new < step[have + t]:
                    step[have + t] = new
        best = step
    return best[total][1]


def _costs(n: float, pairs0: list[float], parts: list[list[int]], mean: np.ndarray, tau: int) -> list[list[float]]:
    out = []
    for part, start in zip(parts, pairs0, strict=True):
        q = 2 * mean[part] * (1 - mean[part])
        p = within(q, tau)
        probes = np.cumsum([math.comb(len(part), t) for t in range(tau + 1)])
        out.append([0.0, *(float(n * probes[t] + start * p[t] / max(p[0], 1e-300)) for t in range(tau + 1))])
    return out


def choose_parts(n: int, together: np.ndarray, tau: int) -> list[list[int]]:
    """The partitions of the least estimated cost: of 64 even bits at distance 2, three up to some ten million fingerprints, two of 32 bits beyond, so buckets stay small."""
    mean, plans = np.diag(together) / max(n, 1), []
    for m in range(1, tau + 3):
        parts = group_bits(n, together, m)
        start = [n * n * float(within(2 * mean[p] * (1 - mean[p]), 0)[0]) for p in parts]
        costs = _costs(n, start, parts, mean, tau)
        plans.append((sum(c[t + 1] for c, t in zip(costs, allocate(costs, tau - m + 1), strict=True)), m, parts))
    return min(plans, key=lambda x: x[:2])[2]


def _value(fp: Column, part: list[int]) -> Column:
    """The bits of a partition, in place: two fingerprints agree in it iff their masked values do."""
    return fp.bitwiseAND(F.lit(_signed(sum(1 << b for b in part))))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_pairs(nodes: DataFrame, fp: str = "fp", tau: int = 2, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose connected components are those of all pairs within tau bits.

    nodes holds each fingerprint once. Pairs that meet in a bucket of at most `crowded` fingerprints are
    found by probing and verified one by one; this returns each of them. Fingerprints that index or
    probe a larger bucket are compared by neighbourhood: each emits the values within ceil(tau / 2)
    bits of it, two fingerprints within tau bits share one, and those that share one are linked to the
    least of them if they are within tau bits of it, or else to each other. So no bucket is paired with
    itself beyond the limit, and none is dropped. For odd tau the shared value can tie fingerprints
    tau + 1 bits apart, which the verification takes out again. No nodes: no edges.
    """
    n, together = bit_statistics(nodes, fp)
    mean = np.diag(together) / max(n, 1)
    parts = choose_parts(n, together, tau)
    m = len(parts)

    x = F.col(fp)
    every = nodes.select(x.alias("fp"), F.explode(F.array(*[F.struct(F.lit(i).alias("part"), _value(x, p).alias("value")) for i, p in enumerate(parts)])).alias("k")).select("fp", "k.*")
    sizes = materialise(every.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    exact = {r.part: float(r.s) for r in sizes.groupBy("part").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("s")).collect()}
    chosen = allocate(_costs(n, [n + exact.get(i, 0.0) for i in range(m)], parts, mean, tau), tau - m + 1)

    used = [i for i, t in enumerate(chosen) if t >= 0]
    index = every.where(F.col("part").isin(used))
    flips = {i: [_signed(sum(1 << b for b in c)) for k in range(1, chosen[i] + 1) for c in combinations(parts[i], k)] for i in used}
    probes = index
    for i in used:
        if flips[i]:
            near = F.explode(F.array(*[F.lit(f) for f in flips[i]]))
            probes = probes.unionAll(index.where(F.col("part") == i).withColumn("f", near).select("fp", "part", F.col("value").bitwiseXOR(F.col("f")).alias("value")))
    full = sizes.where((F.col("n") > crowded) & F.col("part").isin(used)).select("part", "value")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    has_full = bool(full.take(1))
    left, right = probes.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    if not any(flips.values()):  # equal values only: a bucket of one fingerprint pairs with nothing
        some = sizes.where(F.col("n").between(2, crowded)).select("part", "value")
        left = left.join(some, ["part", "value"], "left_semi")
    elif has_full:
        right = right.join(full, ["part", "value"], "left_anti")
    found = left.join(right, ["part", "value"]).where((F.col("a") < F.col("b")) if not any(flips.values()) else (F.col("a") != F.col("b"))).where(apart <= tau).select("a", "b")
    if not has_full:
        return found
    dense = probes.join(full, ["part", "value"], "left_semi").select("fp").unionAll(index.join(full, ["part", "value"], "left_semi").select("fp")).distinct()
    radius = (tau + 1) // 2
    ball = [_signed(sum(1 << b for b in c)) for k in range(radius + 1) for c in combinations(range(BITS), k)]
    met = (
        dense.select("fp", F.explode(F.array(*[F.lit(f) for f in ball])).alias("f"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("f")).alias("at"))
        .agg(F.sort_array(F.collect_set("fp")).alias("all"))  # at most as many as a ball has values
        .where(F.size("all") > 1)
    )
    tied = met.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, F.size("all"))).alias("b"))
    if tau % 2:
        tied = met.select(F.explode("all").alias("a"), "all").select("a", F.explode("all").alias("b")).where("a < b")
    return found.unionAll(tied.where(apart <= tau).select("a", "b"))
