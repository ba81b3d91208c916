"""Groups of cities by k-means whose answer does not follow the table's layout.

Candidates for centres are drawn as in k-means||: over a few rounds every city
is taken with a chance that grows with its squared distance to the candidates
so far. The draw is a hash of the city's name, not a random number per
partition, and every sum is one of decimals, so partitions and the order of
tasks decide nothing. The candidates, weighted by the cities nearest to them,
are grouped on the driver; from there all starts advance together, one pass
over the cities each: to the means of the groups, and where those stand still,
by the one move of a city that lowers the cost most (Hartigan's step).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from incidara.models.clusters import FEATURES, K, MEAN_DIGITS, SEED
from incidara.operators.panel import CITY

STARTS = 4
ROUNDS = 3
#: Candidates drawn in a round, as a multiple of k.
OVERSAMPLING = 2
#: Passes over the cities before a start is left as it stands.
PASSES = 200
#: A move counts if it lowers the cost by this share of it.
GAIN = 1e-9

EXACT = f"decimal(38,{MEAN_DIGITS})"


@dataclass(frozen=True)
class Groups:
    """``centres`` are listed by group number, in the scale the distances were taken in;
    ``cost`` is the sum of squared distances."""

    table: DataFrame
    centres: list[list[float]]
    cost: float


def _constant(centres: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in centre]) for centre in centres])


def _squared(centre: Column) -> Column:
    apart = F.zip_with(F.col("x"), centre, lambda a, b: (a - b) * (a - b))
    return F.aggregate(apart, F.lit(0.0), lambda total, value: total + value)


def _nearest(centres: Sequence[Sequence[float]]) -> Column:
    """(squared distance, number) of the nearest centre, ties to the first."""
    return F.array_min(
        F.transform(_constant(centres), lambda c, n: F.struct(_squared(c).alias("d"), n.alias("n")))
    )


def _points(profile: DataFrame, keys: Sequence[str], features: Sequence[str], scale: bool) -> DataFrame:
    """Keys and measures, and the measures as an array x of rounded doubles."""
    rounded = [F.round(F.col(name).cast("double"), MEAN_DIGITS) for name in features]
    facts = profile.agg(
        F.count("*").alias("n"),
        *[F.sum(value.try_cast(EXACT)).alias(f"sum_{p}") for p, value in enumerate(rounded)],
        *[F.count_if(value.isNotNull() & ~F.isnan(value)).alias(f"n_{p}") for p, value in enumerate(rounded)],
    ).first()
    short = [name for p, name in enumerate(features) if facts[f"n_{p}"] < facts["n"]]
    if short:
        raise ValueError(f"cities without a value in {', '.join(short)}")
    if scale and facts["n"]:
        means = [float(facts[f"sum_{p}"] / facts["n"]) for p in range(len(features))]
        squares = profile.agg(
            *[F.sum(((value - mean) * (value - mean)).cast(EXACT)) for value, mean in zip(rounded, means)]
        ).first()
        widths = [float(s / max(facts["n"] - 1, 1)) ** 0.5 or 1.0 for s in squares]
        rounded = [F.round((v - m) / w, MEAN_DIGITS) for v, m, w in zip(rounded, means, widths)]
    return profile.select(*keys, *features, F.array(*rounded).alias("x"))


def _draw(keys: Sequence[str], *salt: int) -> Column:
    """A number in [0, 1) fixed by the keys and the salt."""
    return F.pmod(F.xxhash64(*keys, *[F.lit(s) for s in salt]), F.lit(1 << 52)) / float(1 << 52)


def _candidates(points: DataFrame, keys, k: int, starts: int, rounds: int, seed: int) -> list[list[tuple]]:
    """Per start the candidates for centres, sorted."""
    firsts = points.agg(
        *[F.min(F.struct(_draw(keys, seed, s, 0).alias("u"), F.col("x"))).alias(f"s{s}") for s in range(starts)]
    ).first()
    found = [{tuple(first.x)} for first in firsts]
    for number in range(1, rounds + 1):
        near = [_nearest(sorted(each))["d"] for each in found]
        costs = points.agg(*[F.sum(d.cast(EXACT)) for d in near]).first()
        drawn = [
            _draw(keys, seed, s, number) * float(cost) < d * float(OVERSAMPLING * k) if cost else F.lit(False)
            for s, (d, cost) in enumerate(zip(near, costs))
        ]
        # Some OVERSAMPLING * k cities a start, however many there are.
        rows = points.select("x", F.array(*drawn).alias("drawn")).filter(F.exists("drawn", lambda b: b)).collect()
        for row in rows:
            for each, taken in zip(found, row.drawn):
                if taken:
                    each.add(tuple(row.x))
    return [sorted(each) for each in found]


def _first_centres(candidates: Sequence[tuple], weights: Sequence[int], k: int, seed: int) -> list[list[float]]:
    """Weighted k-means over the candidates: the best of some k-means++ draws, each improved."""
    x, w = np.array(candidates, float), np.array(weights, float)
    rng = np.random.default_rng(seed)
    best, best_cost = None, np.inf
    for _ in range(8):
        chosen = [int(rng.choice(len(x), p=w / w.sum()))]
        apart = ((x - x[chosen[0]]) ** 2).sum(1)
        while len(chosen) < k and (w * apart).sum() > 0:
            chosen.append(int(rng.choice(len(x), p=w * apart / (w * apart).sum())))
            apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(1))
        centres = x[chosen]
        for _ in range(50):
            group = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
            moved = np.array(
                [np.average(x[group == g], axis=0, weights=w[group == g]) if w[group == g].any() else c for g, c in enumerate(centres)]
            )
            if (moved == centres).all():
                break
            centres = moved
        cost = (w * ((x[:, None] - centres) ** 2).sum(2).min(1)).sum()
        if cost < best_cost:
            best, best_cost = centres, cost
    return [list(map(float, centre)) for centre in best]


@dataclass
class _Start:
    centres: list[list[float]]
    sizes: list[int]
    sums: list[list[Decimal]]
    cost: Decimal = Decimal(0)
    done: bool = False

    def means(self) -> list[list[float]]:
        return [
            [float(value / size) for value in total] if size else centre
            for centre, size, total in zip(self.centres, self.sizes, self.sums)
        ]


def _assign(points: DataFrame, starts: Sequence[_Start], width: int) -> None:
    """One pass: sizes, sums and cost of every start's groups by its centres."""
    near = F.array(*[_nearest(start.centres) for start in starts])
    facts = (
        points.select("x", F.posexplode(near).alias("start", "near"))
        .groupBy("start", "near.n")
        .agg(
            F.count("*").alias("size"),
            F.sum(F.col("near.d").cast(EXACT)).alias("cost"),
            *[F.sum(F.get("x", F.lit(p)).cast(EXACT)).alias(f"x{p}") for p in range(width)],
        )
        .collect()
    )
    for number, start in enumerate(starts):
        k = len(start.centres)
        start.sizes, start.sums, start.cost = [0] * k, [[Decimal(0)] * width for _ in range(k)], Decimal(0)
        for row in facts:
            if row.start == number:
                start.sizes[row.n] = row.size
                start.sums[row.n] = [row[f"x{p}"] for p in range(width)]
                start.cost += row.cost


def _best_moves(points: DataFrame, keys: Sequence[str], starts: Sequence[_Start]) -> list:
    """Per start the move of one city to another group that lowers the cost most, or None."""

    def gain(start: _Start) -> Column:
        join = F.array(*[F.lit(size / (size + 1)) for size in start.sizes])
        leave = F.array(*[F.lit(size / (size - 1) if size > 1 else 0.0) for size in start.sizes])
        near = _nearest(start.centres)
        to = F.array_min(
            F.filter(
                F.transform(
                    _constant(start.centres),
                    lambda c, n: F.struct((_squared(c) * F.get(join, n)).alias("d"), n.alias("n")),
                ),
                lambda other: other["n"] != near["n"],
            )
        )
        return F.struct((to["d"] - near["d"] * F.get(leave, near["n"])).alias("gain"), *keys, "x", near["n"].alias("a"), to["n"].alias("b"))

    row = points.agg(*[F.min(gain(start)).alias(f"m{n}") for n, start in enumerate(starts)]).first()
    return [m if m.gain is not None and m.gain < -GAIN * float(start.cost) else None for m, start in zip(row, starts)]


def group_cities(
    profile: DataFrame,
    keys: Sequence[str] = CITY,
    k: int = K,
    features: Sequence[str] = FEATURES,
    starts: int = STARTS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: bool = False,
) -> Groups:
    """Assign every city to one of ``k`` groups: the cheapest of several starts.

    In the answer every centre is the mean of its cities, every city is at its
    nearest centre, and no move of a single city lowers the cost. Groups are
    numbered by centre, temperature first (then humidity, then the order of
    ``features``). Fewer different cities than ``k`` give fewer groups, no city
    none. A city without a value in some measure raises. Give ``profile``
    staged: it is read once a pass. What comes to the driver is some
    k x ``OVERSAMPLING`` x ``rounds`` candidates a start, and sums per group.
    """
    width = len(features)
    points = _points(profile, keys, features, scale)
    if points.isEmpty():
        return Groups(points.select(*keys, *features, F.lit(0).alias("cluster")), [], 0.0)
    candidates = _candidates(points, keys, k, starts, rounds, seed)
    weighed = [_Start([list(c) for c in each], [], []) for each in candidates]
    _assign(points, weighed, width)
    running = [
        _Start(_first_centres(each, start.sizes, k, seed + number), [], [])
        for number, (each, start) in enumerate(zip(candidates, weighed))
    ]
    for _ in range(PASSES):
        active = [start for start in running if not start.done]
        if not active:
            break
        _assign(points, active, width)
        still = [start for start in active if start.means() == start.centres]
        for start in active:
            if start not in still:
                start.centres = start.means()
        if still:
            for start, move in zip(still, _best_moves(points, keys, still)):
                if move is None or len(start.centres) == 1:
                    start.done = True
                    continue
                for p, value in enumerate(move.x):
                    exact = Decimal(repr(value)).quantize(Decimal(1).scaleb(-MEAN_DIGITS))
                    start.sums[move.a][p] -= exact
                    start.sums[move.b][p] += exact
                start.sizes[move.a] -= 1
                start.sizes[move.b] += 1
                start.centres = start.means()
    best = min(running, key=lambda start: start.cost)
    first = [features.index(name) for name in ("avg_temp", "avg_humidity") if name in features]
    ranked = sorted(range(len(best.centres)), key=lambda n: [best.centres[n][p] for p in [*first, *range(width)]])
    number = F.array(*[F.lit(ranked.index(n)) for n in range(len(ranked))])
    table = points.select(*keys, *features, F.get(number, _nearest(best.centres)["n"]).alias("cluster"))
    return Groups(table, [best.centres[n] for n in ranked], float(best.cost))
