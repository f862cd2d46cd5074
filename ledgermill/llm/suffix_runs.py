"""Distributed merge sort of byte strings that never compares a known common prefix again.

Each map task sorts its distinct strings and front-codes them: a string is the length of the prefix that it shares
with the one before, and the rest. Splitters, drawn from samples of all runs, cut each run into parts; the parts of
all runs that fall between two splitters go to one task, front-coded, and a loser tree merges them. The tree keeps,
for each loser, the length of the prefix that it shares with the winner: of two strings the one that shares more with
the last output is smaller, and only where both share equally much are bytes compared, from there on.

The strings here only need to be found equal. A part's strings are distinct within a run, so a string that a third of
all documents hold is one entry of each run, and parts are bounded by their splitters whatever the strings are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import arrow_rows, dropped, stored

#: Distinct strings that a map task sorts at once, and those of one front-coded block of a run.
RUN, BLOCK = 1 << 16, 1 << 11
#: Strings that one part holds on average, and strings for each that is sampled.
PART, SAMPLED = 60_000, 1 << 9
#: Blocks that go to a Python worker at once.
BATCH_BLOCKS = 16

#: A block of a run: where it stands, its front-coded strings, how often each occurs, and its occurrences. `element` is
#: the string of an occurrence; the other columns of occurrences are up to the caller.
BLOCKS = "run bigint, block int, n int, shared binary, lengths binary, rests binary, counts binary, element binary, samples array<binary>"
MARKS = "run bigint, block int, first int, marks binary"
#: What a merge tells of a string: it occurs once, again and again, or that and this is its first run.
ALONE, REPEATED, FIRST = 0, 1, 2


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    differing = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return n - (differing.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """(shared lengths, lengths of the rests, rests) of sorted strings; the first shares nothing."""
    shared = [0, *(common(a, b) for a, b in zip(strings, strings[1:], strict=False))]
    rests = [s[k:] for s, k in zip(strings, shared, strict=True)]
    return np.array(shared, "<u4").tobytes(), np.array([len(x) for x in rests], "<u4").tobytes(), b"".join(rests)


def decoded(shared: bytes, lengths: bytes, rests: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for k, n in zip(np.frombuffer(shared, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist(), strict=True):
        last = last[:k] + rests[at : at + n]
        at += n
        out.append(last)
    return out


@dataclass
class Run:
    """A reader over consecutive front-coded pieces of a sorted run."""

    pieces: list[tuple[bytes, bytes, bytes]]
    string: bytes = b""
    _shared: list[int] = field(default_factory=list)
    _lengths: list[int] = field(default_factory=list)
    _piece: int = -1
    _at: int = 0
    _byte: int = 0

    def advance(self) -> int:
        """Read the next string; what it shares with the one before, or -1 at the end."""
        while self._at == len(self._shared):
            self._piece += 1
            if self._piece == len(self.pieces):
                return -1
            shared, lengths, _ = self.pieces[self._piece]
            self._shared, self._lengths = np.frombuffer(shared, "<u4").tolist(), np.frombuffer(lengths, "<u4").tolist()
            self._at = self._byte = 0
        k, n = self._shared[self._at], self._lengths[self._at]
        rest = self.pieces[self._piece][2][self._byte : self._byte + n]
        if self._at:
            self.string = self.string[:k] + rest
        else:  # a piece begins with a whole string
            k = common(self.string, rest)
            self.string = rest
        self._at += 1
        self._byte += n
        return k


def merged(runs: list[Run]) -> Iterator[tuple[int, bool]]:
    """(run, whether its string equals the one before) of all strings of the runs in order."""
    size = 1 << max(len(runs) - 1, 0).bit_length()
    loser, known = [-1] * size, [0] * size  # of each inner node: the run that lost, what it shares with the winner
    winners = [-1] * size + [i if i < len(runs) and runs[i].advance() >= 0 else -1 for i in range(size)]
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        if a >= 0 and b >= 0:
            known[node] = common(runs[a].string, runs[b].string)
            if runs[b].string < runs[a].string:
                a, b = b, a
        elif a < 0:
            a, b = b, a
        winners[node], loser[node] = a, b
    best, shares, before = winners[1], 0, -1
    while best >= 0:
        own = runs[best]
        n = len(own.string)
        yield best, shares == n == before
        before = n
        challenger, shares = best, own.advance()
        if shares < 0:
            challenger = -1
        node = (size + best) >> 1
        while node:
            other = loser[node]
            if other >= 0:
                also = known[node]
                if challenger < 0 or also > shares:
                    loser[node], known[node] = challenger, shares
                    challenger, shares = other, also
                elif also == shares:
                    a, b = runs[challenger].string, runs[other].string
                    both = shares + common(a[shares:], b[shares:])
                    known[node] = both
                    if b[both:] < a[both:]:
                        loser[node], challenger = challenger, other
            node >>= 1
        best = challenger


class Sorter:
    """Collects strings with their occurrences and gives sorted runs as blocks."""

    def __init__(self, columns: dict[str, str]) -> None:
        self.columns = columns
        self.number = TaskContext.get().partitionId() << 32
        self._empty()

    def _empty(self) -> None:
        self.place: dict[bytes, int] = {}
        self.counts: list[int] = []
        self.element: list[int] = []
        self.rows: list[tuple] = []

    def add(self, string: bytes, count: int, row: tuple | None) -> None:
        """One more string that occurs so often; what is known of an occurrence comes back with its verdict."""
        at = self.place.setdefault(string, len(self.counts))
        if at == len(self.counts):
            self.counts.append(count)
        else:
            self.counts[at] += count
        if row is not None:
            self.element.append(at)
            self.rows.append(row)

    def full(self) -> bool:
        return len(self.counts) >= RUN or len(self.rows) >= 4 * RUN

    def blocks(self) -> Iterator[pa.RecordBatch]:
        strings = sorted(self.place)
        order = np.array([self.place[s] for s in strings], np.int64)
        rank = np.zeros(len(order), np.int64)
        rank[order] = np.arange(len(order))
        counts = np.array(self.counts, np.int64)[order]
        at = rank[np.array(self.element, np.int64)] if self.rows else np.zeros(0, np.int64)
        by_rank = np.argsort(at, kind="stable")
        at = at[by_rank]
        columns = [np.array(x, kind)[by_rank] for x, kind in zip(zip(*self.rows, strict=True), self.columns.values(), strict=True)] if self.rows else [np.zeros(0, kind) for kind in self.columns.values()]
        for block, first in enumerate(range(0, len(strings), BLOCK)):
            own = strings[first : first + BLOCK]
            low, high = np.searchsorted(at, (first, first + len(own)))
            shared, lengths, rests = front_coded(own)
            yield _one(
                run=(self.number, pa.int64()), block=(block, pa.int32()), n=(len(own), pa.int32()), shared=(shared, pa.binary()),
                lengths=(lengths, pa.binary()), rests=(rests, pa.binary()), counts=(counts[first : first + len(own)].tobytes(), pa.binary()),
                element=((at[low:high] - first).astype(np.int32).tobytes(), pa.binary()), samples=(own[::SAMPLED], pa.list_(pa.binary())),
                **{c: (x[low:high].tobytes(), pa.binary()) for c, x in zip(self.columns, columns, strict=True)},
            )
        self.number += 1
        self._empty()


def _one(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in columns.values()], list(columns))


def block_schema(columns: dict[str, str]) -> str:
    return BLOCKS + "".join(f", {c} binary" for c in columns)


def runs_of(rows: DataFrame, strings: Callable[[pa.RecordBatch], Iterator[tuple[bytes, int, tuple | None]]], columns: dict[str, str]) -> DataFrame:
    """The stored blocks of all runs over what `strings` gives for the rows; `columns` are the occurrences' numpy types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorter = Sorter(columns)
        for batch in batches:
            for string, count, row in strings(batch):
                sorter.add(string, count, row)
                if sorter.full():
                    yield from sorter.blocks()
        yield from sorter.blocks()

    return stored(rows.mapInArrow(run, block_schema(columns)))


def _splitters(blocks: DataFrame) -> list[bytes]:
    """Strings that cut all runs into parts of about PART strings: one for each part and one more a range at most."""
    spark = blocks.sparkSession
    total = int(blocks.agg(F.sum("n")).first()[0] or 0)
    step = max(1, min(PART, -(-total // (4 * spark.sparkContext.defaultParallelism))) // SAMPLED)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            places = np.arange(at, at + len(batch))
            at += len(batch)
            yield batch.take(pa.array(np.flatnonzero(places % step == step - 1)))

    samples = blocks.select(F.explode("samples").alias("string"))
    ranges = max(1, total // (PART * 64))
    chosen = samples.repartitionByRange(ranges, "string").sortWithinPartitions("string").mapInArrow(pick, "string binary")
    return sorted({bytes(r["string"]) for r in chosen.collect()})


PIECES = "part int, run bigint, block int, first int, shared binary, lengths binary, rests binary, counts binary"


def _cut(splitters) -> Callable:
    """The pieces of each block, a part at a time: strings below the first splitter, then those from each on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = splitters.value
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                strings = decoded(row["shared"], row["lengths"], row["rests"])
                counts = np.frombuffer(row["counts"], np.int64)
                if not strings:
                    continue
                low, high, first = bisect_right(cuts, strings[0]), bisect_right(cuts, strings[-1]), 0
                for part in range(low, high + 1):
                    last = bisect_left(strings, cuts[part], first) if part < high else len(strings)
                    if last > first:
                        coded = front_coded(strings[first:last])
                        rows.append((part, row["run"], row["block"], first, *coded, counts[first:last].tobytes()))
                    first = last
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 4
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return run


def _judged(pieces: pa.Table) -> pa.Table:
    """Merge the pieces of a part; the marks of the strings of each."""
    pieces = pieces.sort_by([("run", "ascending"), ("block", "ascending"), ("first", "ascending")])
    run, counts = pieces.column("run").to_pylist(), [np.frombuffer(x, np.int64) for x in pieces.column("counts").to_pylist()]
    coded = list(zip(*(pieces.column(c).to_pylist() for c in ("shared", "lengths", "rests")), strict=True))
    firsts = [i for i in range(len(run)) if not i or run[i] != run[i - 1]]
    runs = [Run(coded[a:b]) for a, b in zip(firsts, [*firsts[1:], len(run)], strict=True)]
    sizes = [len(x) for x in counts]
    before = np.r_[0, np.cumsum(sizes)]
    at = before[firsts].tolist()  # of each run, the number of its next string
    weight = np.concatenate(counts)
    groups, starts = np.zeros(len(weight), np.int64), []
    order = np.zeros(len(weight), np.int64)
    for n, (i, same) in enumerate(merged(runs)):
        if not same:
            starts.append(n)
        order[n] = at[i]
        groups[at[i]] = len(starts) - 1
        at[i] += 1
    totals = np.bincount(groups, weight)  # exact below 2^53
    marks = np.where(totals[groups] >= 2, REPEATED, ALONE).astype(np.uint8)
    heads = order[np.array(starts, np.int64)]
    marks[heads[totals >= 2]] = FIRST
    own = [marks[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True)]
    return pieces.select(["run", "block", "first"]).append_column("marks", pa.array(own, pa.binary()))


def marked(blocks: DataFrame) -> DataFrame:
    """Stored (run, block, all) for blocks of runs: the marks of a block's strings, in pieces (first, marks)."""
    spark = blocks.sparkSession
    splitters = spark.sparkContext.broadcast(_splitters(blocks))
    with arrow_rows(spark, BATCH_BLOCKS):
        pieces = blocks.select("run", "block", "shared", "lengths", "rests", "counts").mapInArrow(_cut(splitters), PIECES)
        marks = pieces.groupBy("part").applyInArrow(_judged, MARKS)
        out = stored(marks.groupBy("run", "block").agg(F.collect_list(F.struct("first", "marks")).alias("all")))
    splitters.unpersist()
    return out


def occurrences(blocks: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Stored rows (the occurrences' columns, mark); FIRST stands at one occurrence of a repeated string only."""
    marks = marked(blocks)
    kinds = {"<i8": ("bigint", pa.int64()), "<i4": ("int", pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                all_marks = np.concatenate([np.frombuffer(x["marks"], np.uint8) for x in sorted(row["all"], key=lambda x: x["first"])])
                element = np.frombuffer(row["element"], np.int32)
                mark = all_marks[element]
                later = np.r_[False, element[1:] == element[:-1]]  # occurrences of a string stand together
                mark[later & (mark == FIRST)] = REPEATED
                own = [pa.array(np.frombuffer(row[c], kind), kinds[kind][1]) for c, kind in columns.items()]
                yield pa.RecordBatch.from_arrays([*own, pa.array(mark.astype(np.int32))], [*columns, "mark"])

    schema = ", ".join(f"{c} {kinds[kind][0]}" for c, kind in columns.items()) + ", mark int"
    with arrow_rows(blocks.sparkSession, BATCH_BLOCKS):
        own = blocks.select("run", "block", "element", *columns).join(marks, ["run", "block"])
        out = stored(own.mapInArrow(run, schema))
    dropped(marks)
    return out
