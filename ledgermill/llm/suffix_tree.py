"""Language-model scores by a probabilistic suffix tree over words, beside a word-unigram base.

Tokens are the lower-cased words of a text and one end token; words that training did not see are one unknown
token. A context is a run of up to `DEPTH` tokens before a token, within the text; before the first token
stands one start token.

Contexts and their next-symbol distributions are built from the runs (context, next token) that training has at
least `LEAST` times. This floor is a number of occurrences, so contexts and listed symbols grow with the corpus;
nothing caps them. Runs, contexts and distributions are tables, made one length after the other: a run gets the
probability after its suffix from the run one shorter, and the size of its context from the run that ends with the
context. The driver sees counts and what is broadcast.

A context is retained if its distribution diverges from that of its longest retained suffix: Kullback-Leibler
divergence of at least `DIVERGENCE` nats, and at least log(training tokens) nats over all its occurrences. The
rest of the symbols is one class in this test. Distributions are smoothed towards the suffix: a listed symbol has
(n + k p) / (all + k), with p its probability after the suffix and k the number of listed symbols; the other
symbols share what is left in proportion to the suffix's distribution. At the root stands the base. A token is
scored in the state of the longest retained context before it.

A token's score is its base plus a term for each retained context before it (the factor of unlisted symbols) plus a
term for each listed run that it ends (what the symbol has beyond that). So scores are sums over keys. The most
frequent words and entries, `MOST` of each, are broadcast; the keys of all others meet their terms in a join, in which
no key is hot. Keys that no entry has are turned away by a bitmap of `BITS` bits first; where the model outgrows it, it
turns away fewer and the result stays the same.

`Tree` is the same model in memory, over runs that `_grown` counts; the tables are tested against it.

Defined results: null and empty texts are the end token alone; a null doc_id counts as empty text for the split;
repeated rows are scored one by one; with no training text c, N and V are 0. Words and runs are compared by 64
bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import arrow_rows, dropped, often_enough, shuffles_given_back, small_batches, stored
from ledgermill.llm.words import Words, mix, one_hash, slices, words

DEPTH, DIVERGENCE, LEAST = 3, 0.02, 4
#: Words, and entries of the model, that are broadcast at most; about 32 bytes each in a worker.
MOST = 2_000_000
#: Bits of a bitmap of keys, a power of two; where more keys are set it turns away fewer, and the results stay.
BITS = 1 << 27
#: The start and the end token; no word has a line feed.
EDGE = np.uint64(one_hash(b"\n"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column, modulus: int = 7, remainder: int = 2) -> Column:
    """Whether the crc32 of the doc_id as text has the given remainder."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def sequence(found: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, row, place in the row) of a slice; each row has a start token at place 0 and an end token."""
    n = np.diff(found.first_of)
    sizes = n + 2
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(n)), sizes)
    place = np.arange(len(row)) - first[row]
    tokens = np.full(len(row), EDGE)
    tokens[(place > 0) & (place <= n[row])] = hashes
    return tokens, row, place


def contexts(tokens: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places that have k tokens before them, fingerprints of these contexts) for k = 1 .. depth."""
    before = np.zeros(len(tokens), np.uint64)
    for k in range(1, depth + 1):
        at = np.flatnonzero(place >= k)
        wider = np.zeros(len(tokens), np.uint64)
        wider[at] = mix(before[at] * _STEP + tokens[at - k] + np.uint64(k))
        before = wider
        yield k, at, before[at]


def run_of(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Fingerprints of contexts with a next token."""
    return mix(context ^ mix(token + _STEP))


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, how often, where each is found)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)]), order[first]


class Lossy:
    """Counts of frequent keys of a stream, too small by at most `error` times what was read; with a note for each."""

    def __init__(self, error: float) -> None:
        self.error, self.read = error, 0
        self.keys, self.notes = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.counts, self.missed = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, notes: np.ndarray) -> None:
        self.waiting.append((keys, notes))
        self.held += len(keys)
        if self.held * self.error >= 1:
            self.settle()

    def settle(self) -> None:
        """Count what waits and forget what cannot be frequent."""
        if not self.held:
            return
        keys, notes = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        new, n, where = _tally(keys)
        missed = np.full(len(new), int(self.read * self.error), np.int64)
        self.read, self.waiting, self.held = self.read + self.held, [], 0
        keys, counts = np.concatenate([self.keys, new]), np.concatenate([self.counts, n])
        notes, missed = np.concatenate([self.notes, notes[where]]), np.concatenate([self.missed, missed])
        order = np.argsort(keys, kind="stable")  # of equal keys the older one first, which has missed less
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        counts, missed, notes = np.add.reduceat(counts[order], first), missed[order][first], notes[order][first]
        keep = counts + missed > self.read * self.error
        self.keys, self.counts, self.missed, self.notes = keys[first][keep], counts[keep], missed[keep], notes[keep]


class Lookup:
    """Places of keys in a sorted set; most keys that are not in it are turned away by one bit.

    Keys are mixed, so their first bits tell the place nearly; a search by halves would miss the cache at every step.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self._of(np.unique(keys))

    def _of(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(16, int(np.ceil(np.log2(len(self.keys) + 1))) + 4)
        self.mask = np.uint64((1 << bits) - 1)
        self.some = np.zeros(1 << bits, bool)
        self.some[self.keys & self.mask] = True
        bits = max(1, len(self.keys).bit_length() - 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __getstate__(self) -> np.ndarray:
        """The keys alone: a broadcast is a file on every executor, and the rest is made anew from them."""
        return self.keys

    __setstate__ = _of

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes of keys that are in the set, their places there)."""
        hits = np.flatnonzero(self.some[keys & self.mask])
        if not len(hits):
            return hits, hits
        wanted, last = keys[hits], len(self.keys) - 1
        place = np.minimum(self.first[wanted >> self.shift], last).astype(np.int64)
        behind = np.flatnonzero(self.keys[place] < wanted)
        while len(behind):
            place[behind] += 1
            behind = behind[place[behind] <= last]
            behind = behind[self.keys[place[behind]] < wanted[behind]]
        place = np.minimum(place, last)
        real = self.keys[place] == wanted
        return hits[real], place[real]


_COUNTED = "kind tinyint, key bigint, note bigint, train bigint, n bigint"
#: Distinct words that a task sums up before it sends them on.
_HELD = 1 << 20


def _rows(kind: int, keys: np.ndarray, notes: np.ndarray, train: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(keys), kind, np.int8)), pa.array(keys.view(np.int64)), pa.array(notes.view(np.int64)), pa.array(train), pa.array(n)]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "note", "train", "n"])


def _counted(depth: int, error: float):
    """Rows of kind 0: words; 1: the end token; 2: runs that may be frequent, with their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ends, lossy = [], np.zeros(2, np.int64), [Lossy(error) for _ in range(depth)]

        def summed() -> pa.RecordBatch:
            nonlocal held
            hashes, learns = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes)
            hashes, learns = hashes[order], learns[order]
            first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
            n = np.diff(np.r_[first, len(hashes)])
            train = np.add.reduceat(learns.astype(np.int64), first) if len(first) else n
            held = []
            return _rows(0, hashes[first], np.zeros(len(first), np.uint64), train, n)

        for batch in batches:
            train = ~np.array(batch.column("held_out").to_pylist(), bool)
            ends += (int(train.sum()), len(train))
            for part in slices(batch.column("text")):
                found, own = words(part), train[part.first : part.first + len(part)]
                hashes = found.hashes()
                held.append((hashes, own[found.row]))
                if sum(len(h[0]) for h in held) > 4 * _HELD:
                    yield summed()
                if not depth:
                    continue
                tokens, row, place = sequence(found, hashes)
                learns = own[row]
                for k, at, context in contexts(tokens, place, depth):
                    use = learns[at]
                    lossy[k - 1].add(run_of(context[use], tokens[at][use]), context[use])
        if held:
            yield summed()
        yield _rows(1, np.zeros(1, np.uint64), np.zeros(1, np.uint64), ends[:1], ends[1:])
        for counts in lossy:
            counts.settle()
            yield _rows(2, counts.keys, counts.notes, counts.counts, counts.counts)

    return run


def _exact(model, depth: int):
    """(key, k, suffix, token, n): occurrences of the surviving runs, and with token null of their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, known = model.value
        n_run, n_context = np.zeros(len(runs.keys), np.int64), np.zeros(len(known.keys), np.int64)
        what = np.zeros((4, len(runs.keys)), np.uint64)  # context, suffix, token and length of a run
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                tokens, _, place = sequence(found, found.hashes())
                suffix = np.zeros(len(tokens), np.uint64)
                for k, at, context in contexts(tokens, place, depth):
                    hit, where = known(context)
                    n_context += np.bincount(where, minlength=len(n_context))
                    at_hit = at[hit]
                    of, which = runs(run_of(context[hit], tokens[at_hit]))
                    n_run += np.bincount(which, minlength=len(n_run))
                    for i, value in enumerate((context[hit][of], suffix[at_hit[of]], tokens[at_hit[of]], k)):
                        what[i, which] = value
                    suffix[at] = context
        of = np.flatnonzero(n_run)
        names = ["key", "context", "suffix", "token", "k", "n"]
        columns = [runs.keys[of], *what[:3, of]]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns), pa.array(what[3, of].astype(np.int32)), pa.array(n_run[of])], names=names)
        of = np.flatnonzero(n_context)
        key, none = pa.array(known.keys[of].view(np.int64)), pa.nulls(len(of), pa.int64())
        yield pa.RecordBatch.from_arrays([key, key, none, none, pa.array(np.zeros(len(of), np.int32)), pa.array(n_context[of])], names=names)

    return run


_EXACT = "key bigint, context bigint, suffix bigint, token bigint, k int, n bigint"


class Tree:
    """Retained contexts with the log10 factor of their unlisted symbols, and log10 probabilities of listed runs."""

    def __init__(self, runs: list[tuple], sizes: dict[int, int], root: dict[int, float], tokens: int, divergence: float) -> None:
        listed: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for context, suffix, token, k, n in runs:
            listed.setdefault((k, context, suffix), []).append((token, n))
        back: dict[int, float] = {}  # of a retained context: the factor of unlisted symbols
        after: dict[tuple[int, int], float] = {}
        longest: dict[int, int | None] = {}  # of a context: its longest retained suffix, itself included
        above: dict[int, int | None] = {}

        def probability(context: int | None, token: int) -> float:
            factor = 1.0
            while context is not None:
                if (context, token) in after:
                    return factor * after[context, token]
                factor *= back[context]
                context = above[context]
            return factor * root[token]

        for (_, context, suffix), nexts in sorted(listed.items()):
            up = longest.get(suffix)
            total = sizes[context]
            wide = [probability(up, t) for t, _ in nexts]
            own = [n / total for _, n in nexts]
            rest, wide_rest = max(1 - sum(own), 0.0), max(1 - sum(wide), 1e-12)
            apart = sum(p * np.log(p / q) for p, q in zip(own, wide, strict=True)) + (rest * np.log(rest / wide_rest) if rest > 1e-12 else 0.0)
            if apart < divergence or total * apart < np.log(tokens):
                longest[context] = up
                continue
            k = len(nexts)
            smooth = [(n + k * q) / (total + k) for (_, n), q in zip(nexts, wide, strict=True)]
            above[context], longest[context] = up, context
            back[context] = max(1 - sum(smooth), 1e-12) / wide_rest
            after |= {(context, t): p for (t, _), p in zip(nexts, smooth, strict=True)}
        self.retained = len(back)
        unsigned = lambda x: np.array(list(x), np.int64).view(np.uint64)
        self.contexts, self.runs = Lookup(unsigned(back)), Lookup(run_of(unsigned(c for c, _ in after), unsigned(t for _, t in after)))
        self.back, self.after = np.zeros(len(back)), np.zeros(len(after))
        self.back[self.contexts(unsigned(back))[1]] = np.log10(list(back.values())) if back else 0
        self.after[self.runs(run_of(unsigned(c for c, _ in after), unsigned(t for _, t in after)))[1]] = np.log10(list(after.values())) if after else 0

    def log10(self, tokens: np.ndarray, place: np.ndarray, base: np.ndarray, depth: int) -> np.ndarray:
        """The log10 probability of each token from that of the root; places 0 have no meaning."""
        out = base.copy()
        for _, at, context in contexts(tokens, place, depth):
            hit, where = self.contexts(context)
            at = at[hit]
            out[at] += self.back[where]
            of, which = self.runs(run_of(context[hit], tokens[at]))
            out[at[of]] = self.after[which]
        return out


_RUNS = "key bigint, context bigint, up bigint, size bigint, n bigint"


def _tokens(depth: int) -> list[str]:
    """Columns of the tokens of a run: the last one, then those before it, nearest first; 0 where a run has no more."""
    return [f"t{j}" for j in range(depth + 1)]


#: Runs of one length that a task sums up before it sends them on, and rows that it sends at once.
_RUNS_HELD, _SENT = 1 << 21, 1 << 16
#: Bits of a run that candidates are counted by; runs that share them are told apart by the exact count.
_CANDIDATE = np.uint64((1 << 40) - 1)
#: Bits that such a key leaves free.
_SPARE = np.uint64(24)


def _maybe(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bits of keys are set."""
    at = keys & np.uint64(BITS - 1)
    return (bitmap[at >> np.uint64(6)] >> (keys & np.uint64(63)) & np.uint64(1)).astype(bool)


def _runs_of(tokens: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple]:
    """(k, runs, contexts, the run of the suffix, the run that ends with the context) for k = 1 .. depth.

    For a context of one token the last two are words: the next token and the context itself.
    """
    shorter = tokens
    for k, at, context in contexts(tokens, place, depth):
        runs = np.zeros(len(tokens), np.uint64)
        runs[at] = run_of(context, tokens[at])
        yield k, runs[at], context, shorter[at], shorter[at - 1]
        shorter = runs


def _candidates(k: int, below):
    """(key, n): runs of length k by some of their bits, where both runs one shorter may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, held = below.value, []

        def summed() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for i in range(0, len(keys), _SENT):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + _SENT].view(np.int64)), pa.array(n[i : i + _SENT])], names=["key", "n"])

        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                tokens, _, place = sequence(found, found.hashes())
                for j, key, _, up, size in _runs_of(tokens, place, k):
                    if j == k:
                        held.append(key[_maybe(bitmap, up) & _maybe(bitmap, size)] & _CANDIDATE)
                if sum(map(len, held)) > _RUNS_HELD:
                    yield from summed()
        if held:
            yield from summed()

    return run


def _learned(depth: int, frequent):
    """How often the runs occur that the bitmaps have, by their tokens, which repeat and so take less room than fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in range(depth)]

        def summed(k: int) -> Iterator[pa.RecordBatch]:
            key, *own = (np.concatenate(x) for x in zip(*held[k - 1], strict=True))
            held[k - 1] = []
            key, n, where = _tally(key)
            own = [c[where].view(np.int64) for c in own] + [np.zeros(len(key), np.int64)] * (depth - k)
            columns = [np.full(len(key), k, np.int8), *own, n]
            for i in range(0, len(key), _SENT):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + _SENT]) for c in columns], names=["k", *_tokens(depth), "n"])

        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                tokens, _, place = sequence(found, found.hashes())
                for k, at, context in contexts(tokens, place, depth):
                    key = run_of(context, tokens[at])
                    use = _maybe(frequent.value[k - 1], key)
                    at = at[use]
                    held[k - 1].append((key[use], *(tokens[at - j] for j in range(k + 1))))
                    if sum(len(h[0]) for h in held[k - 1]) > _RUNS_HELD // 4:
                        yield from summed(k)
        for k in range(1, depth + 1):
            if held[k - 1]:
                yield from summed(k)

    return run


def _named(k: int):
    """Runs of length k with fingerprint, context, suffix's run (`up`) and the run that ends with the context (`size`).

    For a context of one token the last two are words: the next token and the context itself.
    """

    def context(before: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(before[0]), np.uint64)
        for j, token in enumerate(before, 1):
            out = mix(out * _STEP + token + np.uint64(j))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, *before = (batch.column(c).to_numpy().view(np.uint64) for c in _tokens(k))
            whole = context(before)
            up, size = (last, before[0]) if k == 1 else (run_of(context(before[:-1]), last), run_of(context(before[1:]), before[0]))
            columns = [pa.array(c.view(np.int64)) for c in (run_of(whole, last), whole, up, size)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("n")], names=["key", "context", "up", "size", "n"])

    return run


#: Tokens for each bucket of counts, and keys that a task holds before it packs them.
_BUCKET = 1 << 20
_PACKED = "bucket int, packed binary"


def _pack(columns: list[np.ndarray]) -> bytes:
    """Columns of 64-bit numbers by their bytes of equal weight, of which the high ones take little room."""
    head = np.array([len(columns), *map(len, columns)], np.int64).tobytes()
    return head + pa.compress(b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns), "zstd", asbytes=True)


def _unpack(packed: bytes) -> list[np.ndarray]:
    """The columns of `_pack`."""
    head = 8 * (int(np.frombuffer(packed[:8], np.int64)[0]) + 1)
    ends = np.cumsum(np.frombuffer(packed[8:head], np.int64)) * 8
    raw = np.frombuffer(pa.decompress(packed[head:], int(ends[-1]), "zstd"), np.uint8)
    return [np.ascontiguousarray(c.reshape(8, -1).T).view(np.uint64).ravel() for c in np.split(raw, ends[:-1])]


def _short(tokens: list[np.ndarray], known: Lookup) -> list[np.ndarray]:
    """Each token's place among the known ones, from 3 on; 0 is none, 1 others, which follow as they are, 2 start or end."""
    every = np.concatenate(tokens)
    place = (every != 0).astype(np.uint64)
    hit, where = known(every)
    place[hit] = where + 3
    place[every == EDGE] = 2
    return [*np.split(place, len(tokens)), every[place == 1]]


def _long(places: list[np.ndarray], known: Lookup) -> list[np.ndarray]:
    """The tokens of `_short`."""
    *places, others = places
    place = np.concatenate(places)
    every, listed = np.where(place == 2, EDGE, np.uint64(0)), place > 2
    every[listed] = known.keys[place[listed].astype(np.int64) - 3]
    every[place == 1] = others
    return np.split(every, len(places))


def _by_range(keys: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of what the keys are mixed to, bucket in this order); a single key stands for itself."""
    mixed = keys[0] << _SPARE if len(keys) == 1 else np.zeros(len(keys[0]), np.uint64)
    for key in keys if len(keys) > 1 else []:
        mixed = mix(mixed * _STEP + key)
    order = np.argsort(mixed)
    return order, ((mixed[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _dealt(counted, keys: list[str], buckets: int, known=None):
    """Rows (keys, n) of the function `counted`, packed for each bucket. Buckets are ranges of the mixed keys.

    Single keys are sent as differences of sorted values, tokens by their places among the known ones.
    """

    def packed(n: np.ndarray, *own: np.ndarray) -> bytes:
        if not known:
            return _pack([n, np.diff(own[0], prepend=np.uint64(0))])
        *places, others = _short(own, known.value)
        if not len(others):  # their order is that of the places
            order = np.argsort(places[0] << np.uint64(32) | places[1])
            n, places = n[order], [c[order] for c in places]
            places[0] = np.diff(places[0], prepend=np.uint64(0))
        return _pack([n, *places, others])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def sent() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            held.clear()
            order, bucket = _by_range(columns[1:], buckets)
            for i, c in enumerate(columns):
                columns[i] = c[order]
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            parts = [packed(*(c[a:b] for c in columns)) for a, b in zip(first, [*first[1:], len(bucket)], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(parts, pa.binary())], names=["bucket", "packed"])

        for batch in counted(batches):
            if batch.num_rows:
                held.append([batch.column(c).to_numpy().view(np.uint64) for c in ["n", *keys]])
            if sum(len(h[0]) for h in held) * len(keys) >= _BUCKET:
                yield sent()
        if held:
            yield sent()

    return run


def _summed(keys: list[str], least: int, known=None):
    """(keys, n) of the rows of a bucket that are there at least `least` times in all."""

    def unpacked(packed: bytes) -> list[np.ndarray]:
        n, *own = _unpack(packed)
        if not known:
            return [n, np.cumsum(own[0], dtype=np.uint64)]
        if not len(own[-1]):
            own[0] = np.cumsum(own[0], dtype=np.uint64)
        return [n, *_long(own, known.value)]

    def run(table: pa.Table) -> pa.Table:
        n, *own = (np.concatenate(x) for x in zip(*(unpacked(x.as_py()) for x in table.column("packed")), strict=True))
        order, _ = _by_range(own, 1)
        n, own = n[order].view(np.int64), [c[order] for c in own]
        first = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in own], axis=0)])
        n = np.add.reduceat(n, first)
        first, n = first[n >= least], n[n >= least]
        return pa.table([*(pa.array(c[first].view(np.int64)) for c in own), pa.array(n)], names=[*keys, "n"])

    return run


def _counts(rows: DataFrame, counted, keys: list[str], buckets: int, least: int, known=None) -> DataFrame:
    """(keys, n) of what the function `counted` counts in `rows` at least `least` times; moved in packed form."""
    spec = f"{', '.join(f'{c} bigint' for c in keys)}, n bigint"
    return rows.mapInArrow(_dealt(counted, keys, buckets, known), _PACKED).groupBy("bucket").applyInArrow(_summed(keys, least, known), spec)


def _frequent(rows: DataFrame, base: DataFrame, known, tokens: int, depth: int, least: int) -> DataFrame:
    """(k, tokens, n) of the runs that `rows` have at least `least` times; `known` is a broadcast lookup of frequent words.

    A run is no more frequent than the two that are one shorter. So each length is first counted by few bits among
    runs whose shorter ones may be frequent, and what remains is counted exactly. A bucket has a bounded share of the
    tokens, so their number grows with the input.
    """
    spark, bitmaps, own = rows.sparkSession, [], _tokens(depth)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // _BUCKET)
    below = _bitmap(base.where(F.col("n") >= least).select("key"))
    for k in range(1, depth + 1):
        sent = spark.sparkContext.broadcast(below)
        below = _bitmap(_counts(rows, _candidates(k, sent), ["key"], buckets, least).select("key"))
        bitmaps.append(below)
        sent.destroy()
    sent = spark.sparkContext.broadcast(bitmaps)
    runs = _counts(rows, _learned(depth, sent), own, buckets, least, known)
    # Words have other fingerprints than 0, the mark of a run's end.
    k = sum((F.col(c) != 0).cast("int") for c in own[1:])
    with arrow_rows(spark, _SENT):
        runs = stored(runs.select(k.cast("tinyint").alias("k"), *own, "n"))
    sent.destroy()
    return runs


def _modelled(rows: DataFrame, base: DataFrame, known, tokens: int, depth: int, least: int, divergence: float) -> list[DataFrame]:
    """Stored tables (key, n, term, is_context): retained contexts and their listed runs, from `rows` (text).

    `base` (key, n, p) has the count and the base probability of each training token, the end token included;
    `known` is a broadcast lookup of frequent words.
    """
    runs, shorter, entries, used = _frequent(rows, base, known, tokens, depth, least), base, [], []
    for k in range(1, depth + 1):
        own = runs.where(F.col("k") == k).mapInArrow(_named(k), _RUNS)
        own = own.join(shorter.select(F.col("key").alias("up"), F.col("p").alias("q")), "up")
        own = own.join(shorter.select(F.col("key").alias("size"), F.col("n").alias("total")), "size")
        with arrow_rows(rows.sparkSession, _SENT):
            own = raw = stored(own.select("key", "context", "n", "q", "total"))
        share = F.col("n") / F.col("total")
        sums = own.groupBy("context").agg(
            F.first("total").alias("total"), F.count("*").alias("listed"), F.sum("n").alias("seen"),
            F.sum("q").alias("wide"), F.sum(share * F.log(share / F.col("q"))).alias("apart"),
        )
        rest, wide_rest = 1 - F.col("seen") / F.col("total"), F.greatest(1 - F.col("wide"), F.lit(1e-12))
        apart = F.col("apart") + F.when(rest > 1e-12, rest * F.log(rest / wide_rest)).otherwise(0.0)
        sums = sums.withColumn("apart", apart).where((F.col("apart") >= divergence) & (F.col("total") * F.col("apart") >= float(np.log(tokens))))
        smooth = (F.col("seen") + F.col("listed") * F.col("wide")) / (F.col("total") + F.col("listed"))
        retained = stored(sums.select("context", "total", "listed", F.log10(F.greatest(1 - smooth, F.lit(1e-12)) / wide_rest).alias("back")))
        own = own.join(retained.select("context", "listed", "back"), "context", "left")
        p = F.when(F.col("listed").isNotNull(), (F.col("n") + F.col("listed") * F.col("q")) / (F.col("total") + F.col("listed"))).otherwise(F.col("q"))
        before, shorter = used[-1:], stored(own.select("key", "n", p.alias("p"), (F.log10(p / F.col("q")) - F.col("back")).alias("term")))
        contexts_ = retained.select(F.col("context").alias("key"), F.col("total").alias("n"), F.col("back").alias("term"), F.lit(True).alias("is_context"))
        entries.append(stored(contexts_.unionByName(shorter.where("term is not null").select("key", "n", "term", F.lit(False).alias("is_context")))))
        dropped(raw, retained, *before)
        used.append(shorter)
    dropped(runs, *used[-1:])
    return entries


def _bitmap(keys: DataFrame) -> np.ndarray:
    """BITS bits, of which those of the keys are set."""
    at = F.col("key").bitwiseAND(F.lit(BITS - 1))
    with shuffles_given_back(keys.sparkSession):
        slots = keys.select(F.shiftright(at, 6).alias("slot"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit"))
        slots = slots.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[slots["slot"].to_numpy()] = slots["bits"].to_numpy()
    return bitmap.view(np.uint64)


def _scorer(model, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, counts, known_entries, terms, bitmap, end, total = model.value
        for batch in batches:
            for part in slices(batch.column("text")):
                found, n_rows = words(part), len(part)
                tokens, row, place = sequence(found, found.hashes())
                c = np.zeros(len(tokens))
                hit, where = heavy(tokens)
                c[hit] = counts[where]
                known = np.zeros(len(tokens), bool)
                known[hit] = True
                edge = tokens == EDGE
                c[edge], known[edge] = end, True
                base = np.where(known, np.log10((c + 1) / total), 0.0)  # of light words it is added later
                score = base.copy()
                light, light_row = [tokens[~known]], [row[~known]]
                for _, at, keys in contexts(tokens, place, depth):
                    for is_context in (True, False):
                        hit, where = known_entries(keys)
                        score[at[hit]] += terms[where]
                        other = _maybe(bitmap, keys)
                        other[hit] = False
                        light.append(keys[other])
                        light_row.append(row[at[other]])
                        if is_context:
                            # Runs are listed after retained contexts alone.
                            other[hit] = True
                            at, keys = at[other], run_of(keys[other], tokens[at[other]])
                real = place > 0
                add = lambda x: np.bincount(row[real], x[real], n_rows)  # noqa: E731, B023
                light, light_row = np.concatenate(light), np.concatenate(light_row)
                light = light[np.argsort(light_row, kind="stable")]
                ends = np.cumsum(np.bincount(light_row, minlength=n_rows))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(light.view(np.int64)))
                cut = lambda name: batch.column(name).slice(part.first, n_rows)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [cut("row"), cut("doc_id"), cut("held_out"), pa.array(np.diff(found.first_of) + 1), pa.array(add(known & (c > 0)).astype(np.int64)), pa.array(add(base)), pa.array(add(score)), lists],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "light"],
                )

    return run


def _grown(spark, rows: DataFrame, survivors: DataFrame, root, tokens: int, depth: int, share: float, divergence: float) -> Tree:
    """The tree from the surviving runs (key, note): counts them exactly, then tests their contexts."""
    table = survivors.toArrow()
    unsigned = lambda name: table[name].to_numpy().astype(np.int64).view(np.uint64)
    wanted = spark.sparkContext.broadcast((Lookup(unsigned("key")), Lookup(unsigned("note"))))
    exact = rows.where("not held_out").select("text").mapInArrow(_exact(wanted, depth), _EXACT)
    exact = exact.groupBy("key", "context", "suffix", "token", "k").agg(F.sum("n").alias("n"))
    exact = exact.where(F.col("token").isNull() | (F.col("n") >= max(2, share * tokens))).drop("key").toArrow()
    rows_ = list(zip(*(exact[c].to_pylist() for c in ("context", "suffix", "token", "k", "n")), strict=True))
    sizes = {r[0]: r[4] for r in rows_ if r[2] is None}
    runs = [r for r in rows_ if r[2] is not None]
    return Tree(runs, sizes, {t: root(t) for _, _, t, _, _ in runs}, tokens, divergence)


def scores(docs: DataFrame, depth: int = DEPTH, limit: int = MOST, divergence: float = DIVERGENCE, least: int = LEAST) -> DataFrame:
    """Scores of each row of docs (doc_id, text), trained on the rows that are not held out.

    The `limit` most frequent words and entries of the model are broadcast; the results do not depend on it.
    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_contexts)
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"), held_out(docs["doc_id"]).alias("held_out"))
    counted = rows.select("text", "held_out").mapInArrow(_counted(0, 0.0), _COUNTED)
    counted = stored(counted.groupBy("kind", "key").agg(F.sum("train").alias("train"), F.sum("n").alias("n")))
    sums = counted.groupBy("kind").agg(F.sum("train").alias("train"), F.sum("n").alias("n"), F.count_if(F.col("train") > 0).alias("v"))
    sums = {r["kind"]: r for r in sums.collect()}
    of = lambda kind, what: int(sums[kind][what]) if kind in sums else 0
    train, end = of(0, "train") + of(1, "train"), of(1, "train")
    total = float(train + of(0, "v") + of(1, "v") + 1)
    p = (F.col("train") + 1) / F.lit(total)
    edge = F.lit(int(np.array([EDGE]).view(np.int64)[0]))
    base = counted.where("train > 0").select(F.when(F.col("kind") == 1, edge).otherwise(F.col("key")).alias("key"), F.col("train").alias("n"), p.alias("p"))

    def ordered(frame: DataFrame, value: str) -> tuple[Lookup, np.ndarray]:
        table = frame.select("key", value).toArrow()
        keys = table["key"].to_numpy().astype(np.int64).view(np.uint64)
        return Lookup(keys), table[value].to_numpy()[np.argsort(keys)]

    own_words = counted.where(F.col("kind") == 0)
    is_heavy = often_enough(own_words, "n", limit)
    lookup, n = ordered(own_words.where(is_heavy), "train")
    frequent = spark.sparkContext.broadcast(lookup)
    parts = _modelled(rows.where("not held_out").select("text"), base, frequent, max(train, 1), depth, least, divergence)
    frequent.destroy()
    entries = parts[0]
    for more in parts[1:]:
        entries = entries.unionByName(more)
    retained = entries.where("is_context").count()
    often = often_enough(entries, "n", limit)
    known, terms = ordered(entries.where(often), "term")
    others = entries.where(~often)
    model = spark.sparkContext.broadcast((lookup, n, known, terms, _bitmap(others), end, total))
    spec = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, light array<bigint>"
    scored = stored(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text").mapInArrow(_scorer(model, depth), spec))
    # Terms of words are of base and score, those of contexts and runs of the score alone.
    rare = own_words.where(~is_heavy).select("key", F.log10(p).alias("word"), F.lit(0.0).alias("term"), (F.col("train") > 0).alias("seen"))
    rare = rare.unionByName(others.select("key", F.lit(0.0).alias("word"), "term", F.lit(False).alias("seen")))
    light = scored.select("row", F.explode("light").alias("key")).join(rare, "key")
    light = light.groupBy("row").agg(F.sum("word").alias("word"), F.sum("term").alias("term"), F.count_if("seen").alias("more_known"))
    out, more = scored.drop("light").join(light, "row", "left"), F.coalesce("word", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more + F.coalesce("term", F.lit(0.0))).alias("score"),
        F.lit(retained).cast("bigint").alias("n_contexts"),
    )
