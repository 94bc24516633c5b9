"""Packing of documents into sequences by a configuration linear program.

A configuration says how many pieces of each length share a sequence. The program asks for the fewest
sequences, in fractions, that cover the histogram of lengths. Its prices are multiplicative weights: in each
round dynamic programming over the capacity finds the dearest configurations, these get the sequences of a
whole plan, and a length that is covered too little becomes dearer, one that is covered too much cheaper. The
plans' average is the fractional solution; every round's prices bound the program from below (duality).
Rounded down, the average leaves a rest, which goes to whole configurations chosen greedily and then into the
best-fitting gaps. The greedy plan of all pieces is kept instead if it needs no more sequences.

Only the histogram, at most one row per length, is on the driver. The pieces are numbered within their
length by distributed counts and find their place by number, so no task holds a length's pieces.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import cut, pieces, shuffle_partitions
from millrace.llm.word_ids import encoder

CAPACITY = 2048
ROUNDS = 150  # of the fractional solution
STEP = 0.4  # how fast its prices move at first
RATE = 0.02  # how fast the weight of a length that lags behind grows
LENGTHENED = 0.05  # how much dearer than its share of the capacity a long piece starts, being harder to place
PARTS = (1.0, 0.97, 0.9, 0.75)  # of the fractional solution that are rounded down, the best plan is kept
NEARLY = 0.01  # by how much a configuration may cost less than the dearest
REST = 16  # sequences' worth of pieces that are left to the best-fit step

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

Configuration = tuple[tuple[int, int], ...]  # (length, times), longest first


def price_table(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``capacity`` the highest total price of lengths (ascending, with repetition)
    that fit, and the length to take first for it (0: none)."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(int(lengths[0]), capacity + 1):
        n = fitting[room]
        worth = best[room - lengths[:n]]
        worth += prices[:n]
        pick = int(worth.argmax())
        if worth[pick] > best[room - 1]:
            best[room], choice[room] = worth[pick], lengths[pick]
        else:
            best[room], choice[room] = best[room - 1], choice[room - 1]
    return best, choice


def best_fit(left: dict[int, int], gaps: dict[Configuration, int], capacity: int) -> dict[Configuration, int]:
    """Puts the pieces ``left`` (count per length), longest first, into the fullest sequences of ``gaps``
    (sequences per configuration) that have room, or into new ones. Equal sequences move together."""
    by_room: dict[int, Counter[Configuration]] = {}
    for configuration, times in gaps.items():
        room = capacity - sum(n * k for n, k in configuration)
        by_room.setdefault(room, Counter())[configuration] += times
    for length in sorted(left, reverse=True):
        waiting = left[length]
        while waiting:
            room = length
            while room <= capacity and room not in by_room:
                room += 1
            if room > capacity:
                times = capacity // length
                whole, over = divmod(waiting, times)
                for n, k in ((whole, times), (1, over)):
                    if n and k:
                        by_room.setdefault(capacity - k * length, Counter())[((length, k),)] += n
                break
            configuration, there = by_room[room].popitem()
            if not by_room[room]:
                del by_room[room]
            moved = min(there, waiting)
            if there > moved:
                by_room.setdefault(room, Counter())[configuration] = there - moved
            fuller = Counter(dict(configuration))
            fuller[length] += 1
            key = tuple(sorted(fuller.items(), reverse=True))
            by_room.setdefault(room - length, Counter())[key] += moved
            waiting -= moved
    return {c: n for held in by_room.values() for c, n in held.items()}


def fractional(
    histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS
) -> tuple[dict[Configuration, float], float]:
    """Fractions of sequences per configuration that about cover ``histogram``, and a lower bound: no plan, whole or
    in fractions, has fewer sequences."""
    lengths = np.array(sorted(n for n, k in histogram.items() if k), np.int64)
    if not len(lengths):
        return {}, 0.0
    wanted = np.array([histogram[int(n)] for n in lengths], float)
    place = {int(n): i for i, n in enumerate(lengths)}
    prices = lengths / capacity
    bound = float(lengths @ wanted) / capacity
    total: Counter[Configuration] = Counter()
    counted = 0
    for number in range(rounds):
        best, choice = price_table(lengths, prices, capacity)
        dearest = float(best[capacity])
        bound = max(bound, float(prices @ wanted) / dearest)
        plan = _priced_plan(lengths, prices, choice, wanted, dearest, bound, capacity)
        covered = np.zeros(len(lengths))
        for configuration, times in plan.items():
            for n, k in configuration:
                covered[place[n]] += k * times
        if number >= rounds // 3:  # the first prices are far off
            counted += 1
            for configuration, times in plan.items():
                total[configuration] += times
        step = STEP / math.sqrt(1 + number)
        prices = prices * np.exp(-step * np.clip(covered / wanted - 1, -1, 3))
        prices /= prices.max()
    return {c: x / counted for c, x in total.items()}, bound


def _priced_plan(
    lengths: np.ndarray, prices: np.ndarray, choice: np.ndarray, wanted: np.ndarray, dearest: float, sequences: float, capacity: int
) -> dict[Configuration, float]:
    """``sequences`` in fractions, of configurations that cost nearly as much as the dearest; one of each longest
    piece, used until a length of it is covered, then the dearest of all."""
    place = {int(n): i for i, n in enumerate(lengths)}
    left, free = wanted.copy(), sequences
    plan: Counter[Configuration] = Counter()
    for longest in [0, *lengths[::-1].tolist()]:  # 0: the dearest of all
        taken, room, cost = Counter(), capacity - longest, 0.0
        if longest:
            taken[longest], cost = 1, float(prices[place[longest]])
        while room > 0 and choice[room]:
            n = int(choice[room])
            taken[n] += 1
            cost += float(prices[place[n]])
            room -= n
        if cost < (1 - NEARLY) * dearest:
            continue
        configuration = tuple(sorted(taken.items(), reverse=True))
        if not longest:
            first = configuration
        times = min(free, *(left[place[n]] / k for n, k in configuration))
        if times > 0:
            plan[configuration] += times
            free -= times
            for n, k in configuration:
                left[place[n]] -= k * times
    if free > 0:
        plan[first] += free
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[Configuration, int]:
    """Sequences of each configuration that together hold exactly the pieces of ``histogram``: the fractional
    solution rounded down with its rest packed greedily, or all packed greedily if that needs no more. The lower
    bound ends the search."""
    shares, bound = fractional(histogram, capacity)
    best = greedy(histogram, capacity)
    for part in PARTS:
        if sum(best.values()) <= math.ceil(bound - 1e-6):
            break
        plan = _rounded(shares, part, histogram, capacity)
        if sum(plan.values()) < sum(best.values()):
            best = plan
    return best


def _rounded(
    shares: dict[Configuration, float], part: float, histogram: dict[int, int], capacity: int
) -> dict[Configuration, int]:
    """``part`` of the fractional solution rounded down, and the rest."""
    left = dict(histogram)
    used: Counter[Configuration] = Counter()
    for configuration, share in sorted(shares.items(), key=lambda x: (-x[1], x[0])):
        times = min(math.floor(part * share + 1e-9), *(left[n] // k for n, k in configuration))
        if times > 0:
            used[configuration] += times
            for n, k in configuration:
                left[n] -= k * times
    # sequences with room take part in the best-fit step of the rest
    full = Counter({c: n for c, n in used.items() if sum(a * b for a, b in c) == capacity})
    rest = {n: k for n, k in left.items() if k}
    ends = (greedy(rest, capacity, used - full), best_fit(rest, used - full, capacity))
    full.update(min(ends, key=lambda plan: sum(plan.values())))
    return dict(full)


def greedy(
    histogram: dict[int, int], capacity: int = CAPACITY, gaps: dict[Configuration, int] | None = None
) -> dict[Configuration, int]:
    """Sequences of each configuration, those of ``gaps`` and their room included, that together hold
    ``gaps`` and the pieces of ``histogram``; whole configurations by prices that follow what is left."""
    used: Counter[Configuration] = Counter()
    if histogram.get(capacity):
        used[((capacity, 1),)] = histogram[capacity]
    lengths = np.array(sorted(n for n in histogram if n < capacity), np.int64)
    wanted = {int(n): histogram[int(n)] for n in lengths}
    left = dict(wanted)
    volume = total = sum(n * k for n, k in wanted.items())
    weights = lengths * (1 + LENGTHENED * lengths / capacity) / capacity
    gap = 0  # the room that a sequence may leave
    while volume > REST * capacity and gap < capacity // 8:
        share = np.array([left[n] / wanted[n] for n in lengths.tolist()])
        weights = weights * np.exp(RATE * (share - volume / total))
        here = share > 0
        _, choice = price_table(lengths[here], weights[here], capacity)
        before = volume
        for longest in lengths[here][::-1].tolist():
            taken, room = Counter({longest: 1}), capacity - longest
            while room > 0 and choice[room]:
                taken[int(choice[room])] += 1
                room -= int(choice[room])
            taken = Counter({n: min(k, left[n]) for n, k in taken.items() if left[n]})
            size = sum(n * k for n, k in taken.items())
            if not taken[longest] or size < capacity - gap:
                continue
            steps = max(1, min(left[n] // k for n, k in taken.items()) // 2)
            used[tuple(sorted(taken.items(), reverse=True))] += steps
            for n, k in taken.items():
                left[n] -= steps * k
            volume -= steps * size
        if before - volume < 0.02 * before:
            gap = 2 * gap + 1
    rest = {n: k for n, k in left.items() if k}
    used.update(gaps or {})
    open_ones = {c: n for c, n in used.items() if sum(a * b for a, b in c) < capacity}
    filled = Counter({c: n for c, n in used.items() if c not in open_ones})
    filled.update(best_fit(rest, open_ones, capacity))
    return dict(filled)


@dataclass
class Places:
    """Where the pieces of one length go: from ``first`` on, ``times`` to a sequence."""

    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    times: np.ndarray


def places(plan: dict[Configuration, int]) -> dict[int, Places]:
    """Per length, ranges of piece numbers and the sequences they fill. Its size depends on the capacity
    and the number of configurations, not on the number of pieces."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    given: Counter[int] = Counter()
    sequence = 0
    for configuration in sorted(plan, reverse=True):
        offset = 0
        for length, times in configuration:
            rows.setdefault(length, []).append((given[length], sequence, offset, times))
            given[length] += times * plan[configuration]
            offset += length * times
        sequence += plan[configuration]
    return {n: Places(*np.array(r, np.int64).T) for n, r in rows.items()}


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        ending = np.array([end_id], own.dtype)
        for batch in pieces(batches, 256):
            rows: list[tuple[int | None, int, int, int, int]] = []
            found = own.encode([t or "" for t in batch.column("text").to_pylist()])
            for key, ids in zip(batch.column("doc_id").to_pylist(), found):
                ids = np.concatenate((ids, ending)).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                stops = range(first, len(ids) + 1, capacity)
                for number, stop in enumerate(stops):
                    start = max(0, stop - capacity) if number else 0
                    rows.append((key, number, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids with its end id, in pieces of ``capacity``; the first may be shorter."""
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(_pieces(tokenizer, end_id, capacity), PIECES)


def _placed(plan: dict[int, Places], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                table = plan[int(length)]
                at = np.searchsorted(table.first, numbers[own], side="right") - 1
                within = numbers[own] - table.first[at]
                sequence[own] = table.sequence[at] + within // table.times[at]
                offset[own] = table.offset[at] + within % table.times[at] * length
            kept = [batch.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=schema.names)

    return run


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (PIECES) with sequence_id and offset."""
    order = ["doc_id", "piece", "tie"]
    spread = F.pmod(F.xxhash64(*order), F.lit(shuffle_partitions(parts))).cast("int")
    held = cut(
        parts.withColumn("tie", F.monotonically_increasing_id()).withColumn("bucket", spread), "packing-pieces"
    )
    counts = held.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = places(solve(histogram, capacity))
    within = Window.partitionBy("length", "bucket").orderBy(*order)
    numbered = (
        held.withColumn("local", F.row_number().over(within) - 1)
        .join(bases, ["length", "bucket"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("number"))
    )
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    schema = pa.schema(list(zip(names, kinds)))
    return numbered.mapInArrow(_placed(plan, schema), f"{PIECES}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document with its sequence and its place there, gapless from 0.

    A null or empty text is a piece of its end id alone; repeated rows are packed each; other columns
    are ignored; no rows, no sequences.
    """
    return assign(token_pieces(docs, tokenizer, end_id, capacity), capacity)
