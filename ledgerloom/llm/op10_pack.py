"""Best-fit packing of documents into sequences by bin completion.

Documents become token ids with an end id; longer ones than a sequence are cut, their first piece being the shorter one.
Sequences are planned from the number of pieces of each length (at most `capacity` rows whatever the input): the longest
piece left opens a sequence, the undominated fillings of the room beside it are enumerated and taken as often as the counts allow.
Best-fit solutions are the incumbents. Where they miss the bound, branches over the fillings are searched and cut where their waste exceeds what a better solution
could have; then the room of the best one is gathered in few sequences by exchanges, and most patterns are fixed while the pieces of a few are searched anew. The budgets
count branches and steps of the enumerations, so the search ends whatever the counts are; a plan above the bound need not be the shortest. Then the pieces of
each length are numbered in parts, and the number gives the sequence and the place.

Defined results: null text is empty and has the end id alone; a null doc_id and repeated rows are packed as rows of
their own; an empty table gives no rows; columns beside doc_id and text are not read.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import body, number_within, read, small_batches, travels_by_value
from ledgerloom.llm.token_ids import token_ids
from ledgerloom.session import materialise

CAPACITY = 1024
END = 2
NODES = 8  # branches for each length that occurs
BRANCHES = 30  # of them for one try to save a sequence among a few
FILLINGS = 24
STEPS = 1_500
PLAN_STEPS = 1_000_000  # for what follows the first incumbents
TRIES = ((3, FILLINGS, STEPS), (2, 8, 600))  # piece cost, fillings and steps of the incumbents made of first fillings
PIECE_COST = 8  # waste that a filling may have more for each piece it has less: short pieces are kept for later

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


def fillings(counts: list[int], longest: int, capacity: int, most: int = FILLINGS, steps: int = STEPS, piece_cost: int = PIECE_COST) -> list[tuple[int, Pattern]]:
    """(waste, pattern) of undominated fillings around one piece of length `longest`, those with little waste and few pieces first.

    Lengths are tried from long to short. A filling with room for another piece, or in which a piece could be exchanged for a longer one that
    is left, is dominated. The search ends with `most` fillings or after `steps` places, the ones with longer pieces come first.
    """
    return _enumerated(counts, longest, capacity, most, steps, piece_cost)[0]


def _enumerated(counts: list[int], longest: int, capacity: int, most: int, steps: int, piece_cost: int) -> tuple[list[tuple[int, Pattern]], bool, int]:
    """The fillings, whether they are all there are, and the steps taken."""
    room = capacity - longest
    left = counts[: capacity + 1]
    left[longest] -= 1
    lengths = [n for n in range(min(room, longest), 0, -1) if left[n] > 0]
    if not lengths:
        return [(room, ((longest, 1),))], True, 1
    found: dict[Pattern, int] = {}
    shortest, tried, perfect = lengths[-1], 0, 0
    stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(0, room, ())]
    while stack and tried < steps and perfect < most:
        at, open_, chosen = stack.pop()
        tried += 1
        while at < len(lengths) and lengths[at] > open_:
            at += 1
        if open_ and at < len(lengths):
            n = lengths[at]
            stack.append((at + 1, open_, chosen))
            for take in range(1, min(left[n], open_ // n) + 1):
                stack.append((at + 1, open_ - take * n, (*chosen, (n, take))))
            continue
        used = dict(chosen)
        if any(left[y] > used.get(y, 0) for x in used for y in range(x + 1, x + open_ + 1) if y < len(left)):
            continue
        if open_ >= shortest and any(left[n] > used.get(n, 0) for n in lengths if n <= open_):
            continue
        whole = defaultdict(int, {longest: 1})
        for n, take in chosen:
            whole[n] += take
        found[tuple(sorted(whole.items(), reverse=True))] = open_
        perfect += open_ == 0
    if not found:
        chosen, open_ = [], room
        for n in lengths:
            take = min(left[n], open_ // n)
            open_ -= take * n
            chosen += [(n, take)] if take else []
        whole = defaultdict(int, {longest: 1})
        for n, take in chosen:
            whole[n] += take
        found[tuple(sorted(whole.items(), reverse=True))] = open_
    return sorted(((waste, p) for p, waste in found.items()), key=lambda x: (x[0] + piece_cost * sum(t for _, t in x[1]), x[1])), not stack, tried


def best_fit(counts: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on the counts: the pieces of a length go to the sequences with the least room that holds them."""
    groups: dict[int, list[list]] = defaultdict(list)  # room -> [pattern as dict, sequences]
    for n in range(capacity, 0, -1):
        left = counts[n]
        while left:
            room = min((r for r in groups if r >= n), default=None)
            if room is None:
                per = capacity // n
                for take in (per, left % per):
                    many = left // take if take else 0
                    if many:
                        groups[capacity - take * n].append([{n: take}, many])
                        left -= take * many
                continue
            pattern, many = groups[room].pop()
            take = min(many, left)
            if many > take:
                groups[room].append([pattern, many - take])
            if not groups[room]:
                del groups[room]
            groups[room - n].append([pattern | {n: pattern.get(n, 0) + 1}, take])
            left -= take
    return [(tuple(sorted(p.items(), reverse=True)), many) for g in groups.values() for p, many in g]


class _Level:
    """The untried fillings around one longest piece, the best last; enumerated further when all of them have failed."""

    def __init__(self, longest: int):
        self.longest, self.whole, self.entered = longest, not longest, False
        self.options: list[tuple[int, Pattern, int]] = []
        self.seen: set[Pattern] = set()
        self.most, self.steps = FILLINGS, STEPS

    def enumerate(self, counts: list[int], capacity: int) -> int:
        """Steps taken; each further call looks at four times as many."""
        found, self.whole, taken = _enumerated(counts, self.longest, capacity, self.most, self.steps, PIECE_COST)
        self.options = [(waste, p, 0) for waste, p in reversed(found) if p not in self.seen]
        self.seen.update(p for _, p in found)
        self.most, self.steps = 4 * self.most, 4 * self.steps
        return taken


@dataclass
class _Search:
    capacity: int
    total: int
    least: int
    best: list[tuple[Pattern, int]]
    nodes: int = NODES
    steps: int = PLAN_STEPS
    path: list[tuple[Pattern, int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.best)

    def run(self, counts: list[int]) -> None:
        """Depth first without recursion: each level holds the fillings still to be tried around its longest piece.

        Steps of the enumerations are paid for, and so are branches: every filling of a level but its first, and every wider enumeration.
        A filling is taken as often as the counts and the waste allow, then half as often, down to once.
        """
        longest, waste, used = self._longest(counts, self.capacity), 0, 0
        levels, wastes = [_Level(longest)], []
        while levels and self.nodes > 0 and self.steps > 0 and self.sequences > self.least:
            level = levels[-1]
            if len(self.path) == len(levels):  # back from below: take the filling out
                pattern, many = self.path.pop()
                for n, take in pattern:
                    counts[n] += take * many
                used -= many
                waste -= wastes.pop()
            spare = (self.sequences - 1) * self.capacity - self.total
            if not level.options:
                if level.whole:
                    levels.pop()
                    continue
                if level.seen:
                    self.nodes -= level.steps // STEPS // 4
                self.steps -= level.enumerate(counts, self.capacity)
                continue
            lost, pattern, limit = level.options.pop()
            if waste + lost > spare:
                continue
            self.nodes -= level.entered
            level.entered = True
            many = min(counts[n] // take for n, take in pattern)
            if lost:
                many = max(1, min(many, (spare - waste) // lost))
            many = min(many, limit or many)
            if many > 1:
                level.options.append((lost, pattern, many // 2))
            for n, take in pattern:
                counts[n] -= take * many
            self.path.append((pattern, many))
            wastes.append(lost * many)
            waste, used = waste + lost * many, used + many
            longest = self._longest(counts, level.longest)
            if not longest and used < self.sequences:
                self.best = list(self.path)
            levels.append(_Level(longest))
        for pattern, many in self.path:
            for n, take in pattern:
                counts[n] += take * many
        self.path.clear()

    @staticmethod
    def _longest(counts: list[int], start: int) -> int:
        return next((n for n in range(start, 0, -1) if counts[n]), 0)


def completed(counts: list[int], capacity: int, piece_cost: int = PIECE_COST, most: int = FILLINGS, steps: int = STEPS) -> list[tuple[Pattern, int]]:
    """Always the first filling around the longest piece, taken as often as the counts allow."""
    counts, out, longest = counts[:], [], capacity
    while longest:
        if not counts[longest]:
            longest -= 1
            continue
        _, pattern = fillings(counts, longest, capacity, most, steps, piece_cost)[0]
        many = min(counts[n] // take for n, take in pattern)
        for n, take in pattern:
            counts[n] -= take * many
        out.append((pattern, many))
    return out


def least_sequences(counts: list[int], capacity: int) -> int:
    """No solution has fewer: pieces above half a sequence never meet, and the room beside them takes only so much of the others."""
    best, half = 0, capacity // 2
    for short in range(half + 1):
        alone = sum(counts[capacity - short + 1 :]) if short else 0
        halves = range(half + 1, capacity - short + 1)
        many, long_sum = sum(counts[n] for n in halves), sum(n * counts[n] for n in halves)
        rest = sum(n * counts[n] for n in range(max(short, 1), half + 1))
        best = max(best, alone + many + max(0, -(-(rest - many * capacity + long_sum) // capacity)))
    return best


def plan(counts_by_length: dict[int, int], capacity: int = CAPACITY, nodes: int | None = None, steps: int = PLAN_STEPS) -> list[tuple[Pattern, int]]:
    """(pattern, how many sequences) that use up all pieces.

    Incumbents come from best fit and from first fillings. Where they miss the bound, the fillings are searched; then the room is gathered in few
    sequences, and the pieces of a few sequences are searched anew. nodes is the budget of branches, by default NODES for each length there is; steps
    bounds the work, whatever the number of pieces.
    """
    counts = [0] * (capacity + 1)
    for n, many in counts_by_length.items():
        counts[n] = many
    total = sum(n * many for n, many in counts_by_length.items())
    left = NODES * max(1, len(counts_by_length)) if nodes is None else nodes
    least, best = least_sequences(counts, capacity), best_fit(counts, capacity)
    for tried in TRIES:
        if _sequences(best) > least:
            best = min(best, completed(counts, capacity, *tried), key=_sequences)
    search = _Search(capacity, total, least, best, left, steps // 2)
    search.run(counts)
    best = search.best
    if _sequences(best) > least:
        best = gathered(best, least, capacity, steps // 4)
    if _sequences(best) > least:
        best = repaired(best, least, capacity, left, steps // 4)
    return best


def _sequences(solution: list[tuple[Pattern, int]]) -> int:
    return sum(many for _, many in solution)


def _room(pattern: Pattern, capacity: int) -> int:
    return capacity - sum(n * take for n, take in pattern)


def _sums(pattern: Pattern) -> dict[int, tuple[int, ...]]:
    """Up to two pieces of a sequence by their length together; none is 0."""
    singles = [n for n, take in pattern for _ in range(min(take, 2))]
    out: dict[int, tuple[int, ...]] = {}
    for i, n in enumerate(singles):
        for m in singles[i + 1 :]:
            out[n + m] = (n, m)
    return out | {n: (n,) for n in singles} | {0: ()}


def _exchanged(pattern: Pattern, out: tuple[int, ...], in_: tuple[int, ...]) -> Pattern:
    now = Counter(dict(pattern))
    now.subtract(out)
    now.update(in_)
    return tuple(sorted((+now).items(), reverse=True))


def _most_moved(giver: Pattern, taker: Pattern, room: int) -> tuple[int, tuple[int, ...], tuple[int, ...]] | None:
    """The exchange of up to two pieces each that takes the most length, at most the taker's room, from giver to taker: (length, giver's, taker's pieces)."""
    gives, takes = _sums(giver), _sums(taker)
    ordered = sorted(takes)
    best = None
    for y, pieces in gives.items():
        at = bisect_left(ordered, y - room)
        if at < len(ordered) and (moved := y - ordered[at]) > (best[0] if best else 0):
            best = (moved, pieces, takes[ordered[at]])
            if moved == room:
                break
    return best


def gathered(solution: list[tuple[Pattern, int]], least: int, capacity: int, steps: int) -> list[tuple[Pattern, int]]:
    """Moves the room of a solution together until sequences are empty.

    The sequence with the most room gives: longer pieces against shorter ones of other sequences with room, which become fuller. When none of them can
    take, a sequence with room takes from a full one, so that the room stands beside other pieces, and it goes on. A step is a pair of sequences looked at.
    """
    rng, full, loose = random.Random(1), Counter[Pattern](), []
    for p, many in _summed(solution):
        if _room(p, capacity):
            loose += [p] * many
        else:
            full[p] += many
    whole = list(full)
    best, fewest = solution, _sequences(solution)
    while steps > 0 and len(loose) + full.total() > least and loose:
        loose.sort(key=lambda p: _room(p, capacity))
        giver, others, moved = loose.pop(), [], False
        for i, taker in enumerate(loose):
            steps -= len(giver) + len(taker)
            found = _most_moved(giver, taker, _room(taker, capacity)) if giver else None
            if found is None:
                others.append(taker)
                continue
            moved = True
            giver, taker = _exchanged(giver, found[1], found[2]), _exchanged(taker, found[2], found[1])
            if _room(taker, capacity):
                others.append(taker)
            else:
                full[taker] += 1
                whole.append(taker)
        loose = others + ([giver] if giver else [])
        if len(loose) + full.total() < fewest:
            best, fewest = [*full.items(), *_summed([(p, 1) for p in loose])], len(loose) + full.total()
            best = [(p, many) for p, many in best if many]
        if moved or not whole:
            if not moved:
                break
            continue
        # the room of the others goes beside other pieces
        for i in range(len(loose) - 1):
            for _ in range(20):
                giver = rng.choice(whole)
                steps -= len(giver) + len(loose[i])
                if full[giver] <= 0:
                    continue
                room = _room(loose[i], capacity)
                found = _most_moved(giver, loose[i], room)
                if found is not None and found[0] == room:
                    taker = _exchanged(loose[i], found[2], found[1])
                    full[giver] -= 1
                    full[taker] += 1
                    whole.append(taker)
                    loose[i] = _exchanged(giver, found[1], found[2])
                    break
    return best


def repaired(solution: list[tuple[Pattern, int]], least: int, capacity: int, nodes: int, steps: int) -> list[tuple[Pattern, int]]:
    """All but a few patterns of a solution are fixed, and the pieces of those few are searched anew, as long as there are branches and steps.

    One of the few has room. A try is taken over if it needs fewer sequences, or as many and the room is in fewer of them: it gathers until a sequence is saved.
    """
    rng, now = random.Random(0), Counter(dict(_summed(solution)))
    room = {p: _room(p, capacity) for p in now}
    worth = lambda some: sum(many * (capacity - room[p]) ** 2 for p, many in some)
    while nodes > 0 and steps > 0 and now.total() > least:
        patterns = list(now)
        loose = [p for p in patterns if room[p]]
        chosen = {rng.choice(loose or patterns), *rng.sample(patterns, min(len(patterns), rng.randint(1, 8)))}
        many = min(now[p] for p in chosen) if rng.random() < 0.5 else 1
        old, counts = [(p, many) for p in sorted(chosen)], [0] * (capacity + 1)
        for p, _ in old:
            for n, take in p:
                counts[n] += take * many
        total = sum(n * c for n, c in enumerate(counts))
        new = completed(counts, capacity, rng.choice((0, PIECE_COST)))
        nodes -= 1
        steps -= STEPS
        fewest = -(-total // capacity)
        if fewest < len(old) * many <= _sequences(new):
            search = _Search(capacity, total, max(fewest, least_sequences(counts, capacity)), old, min(nodes, BRANCHES), steps)
            before = search.nodes
            search.run(counts)
            nodes, steps = nodes - (before - max(search.nodes, 0)), search.steps
            new = search.best if search.sequences < len(old) * many else new
        for p, _ in new:
            room[p] = _room(p, capacity)
        if (-_sequences(new), worth(new)) >= (-len(old) * many, worth(old)):
            now.subtract(dict(old))
            now.update(dict(_summed(new)))
            now = +now
    return list(now.items())


def _summed(solution: list[tuple[Pattern, int]]) -> list[tuple[Pattern, int]]:
    out: Counter[Pattern] = Counter()
    for p, many in solution:
        out[p] += many
    return list(out.items())


def plan_rows(solution: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, pieces in a sequence, first sequence, first place)."""
    out, taken, sequence = [], defaultdict(int), 0
    for pattern, many in solution:
        place = 0
        for n, take in pattern:
            out.append((n, taken[n], taken[n] + take * many, take, sequence, place))
            taken[n] += take * many
            place += take * n
        sequence += many
    return out


def pieces_of(text: Column, file: str, capacity: int = CAPACITY, end: int = END, spaces_count: bool = True) -> Column:
    """array of (start, length, ids_crc32) of the text's pieces."""
    tail = end.to_bytes(4, "little")

    @F.arrow_udf("array<struct<start: bigint, length: bigint, ids_crc32: bigint>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = token_ids(file, spaces_count)
        for batch in batches:
            texts = batch.to_pylist()
            offsets, starts, sizes, sums = [0], [], [], []
            for i in range(0, len(texts), 256):
                for ids in encoder.encode(t or "" for t in texts[i : i + 256]):
                    ids += tail
                    n = len(ids) // 4
                    start = 0
                    while start < n:
                        stop = start + ((n - start - 1) % capacity + 1 if not start else capacity)
                        starts.append(start)
                        sizes.append(stop - start)
                        sums.append(zlib.crc32(ids[4 * start : 4 * stop]))
                        start = stop
                    offsets.append(len(starts))
            rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, sizes, sums)], ["start", "length", "ids_crc32"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return cut(text)


def pack(docs: DataFrame, file: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    small_batches(spark)
    cut = docs.select("doc_id", pieces_of(body(), file, capacity, end).alias("__pieces")).withColumn("row_id", F.monotonically_increasing_id())
    pieces = materialise(cut.select("row_id", "doc_id", F.posexplode("__pieces").alias("piece", "p")).select("row_id", "doc_id", "piece", "p.*"), "pack-pieces")
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    columns = "n long, first long, end long, take long, sequence long, place long"
    planned = F.broadcast(spark.createDataFrame(plan_rows(plan(lengths, capacity)), columns))  # some rows per length
    numbered = number_within(pieces, ["length"], ["row_id", "piece"], "number")
    rank = F.col("number") - F.col("first")
    return numbered.join(planned, (F.col("length") == F.col("n")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("end"))).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence") + F.floor(rank / F.col("take"))).cast("long").alias("sequence_id"),
        (F.col("place") + rank % F.col("take") * F.col("length")).cast("long").alias("offset"),
    )


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


travels_by_value(__name__)
