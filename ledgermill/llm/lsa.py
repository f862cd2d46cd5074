"""Benchmark decontamination by latent semantic retrieval, confirmed on common subsequences and answers.

1. Benchmark items (longer ones in pieces of 256 words, each an item for what follows) are cut into passages
   of at most 32 words, 16 apart, and dealt by hash into blocks of about 256 passages. How many documents hold
   each benchmark word is counted over all documents.
2. Each block's TF-IDF matrix gets a randomised singular value decomposition; blocks are factored by
   Spark tasks side by side. A block keeps `RANK` directions, and a direction more for each passage that they
   show less than `SEEN` of.
3. Every document is read in windows of 32 words, 16 apart. A window's vector (weights of its distinct words) is
   projected on the directions of each block and compared with the block's passages. What is bounded is the
   cosine of the passage with the window as far as it consists of the passage's words: its square is the
   weighted share of the passage that the window has. So the words of the host around a copy and the size of the
   corpus change nothing. A window with less weight than the lightest passage needs is passed over.
4. For each candidate the longest common subsequence of the item's words with the words around the window
   decides: a leak has it over at least 80 % of the item (or of the passage, for parts of long items), or
   over 60 % with the answer, the item's last sentence, present by the same measure. So substituted,
   inserted and dropped words do not hide a copy, and common words alone do not make one.

The share that makes a candidate follows from the 60 % that a leak has at least: words that are not in the
text may be heavier than those that are, which halves it; a copy of more than 17 words may lie across windows, of
which one then has at least half. Items under `LEAST` words must be there in full, which asks for 60 %.

The benchmark goes through in groups of `GROUP` blocks, each group a pass over the documents, so what is
broadcast (directions, passages) is bounded by parameters whatever the size of the benchmark.

Defined results: null and empty texts and items match nothing; items under `LEAST` words must be found as a
run of words; a document is reported once for each item, with its best match; rows that share a doc_id are
reported together; a null doc_id is reported as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import small_batches, stored
from ledgermill.llm.words import one_hash, slices, words

WINDOW, STRIDE, PIECE = 32, 16, 256
RANK, OVERSAMPLE, POWER = 192, 32, 2
BLOCK, GROUP = 256, 16
SURE, LIKELY, LEAST = 0.8, 0.6, 8
SEEN = 0.5
CLOSING = (b".", b"!", b"?")


def _cut(n: int) -> list[tuple[int, int]]:
    """Bounds of the passages of n words; the last one ends with the text."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    starts = list(range(0, n - WINDOW, STRIDE)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


def needed(n: int) -> float:
    """The weighted share of a passage of n words that makes a window a candidate."""
    if n < LEAST:
        return LIKELY
    return LIKELY / 2 if n <= WINDOW - STRIDE + 1 else LIKELY / 4


class Pattern:
    """Words whose longest common subsequence with other words is asked for again and again."""

    def __init__(self, own: list) -> None:
        self.own = own
        self.where: dict = {}
        for i, x in enumerate(own):
            self.where[x] = self.where.get(x, 0) | 1 << i

    def reaches(self, others: list, among: set, share: float) -> float:
        """The length of the subsequence over that of the pattern, 0 if it is below `share`.

        `among` are the other words as a set: words that are not there cannot be common, so most texts
        are turned away by counting. The rest is done by bit-parallel rows.
        """
        n = len(self.own)
        if sum(map(among.__contains__, self.own)) < share * n:
            return 0.0
        get, full = self.where.get, (1 << n) - 1
        row = full
        for y in others:
            if here := get(y):
                hit = row & here
                row = ((row + hit) | (row - hit)) & full
        found = (n - row.bit_count()) / n
        return found if found >= share else 0.0


def _answer(item: list[bytes]) -> list[bytes]:
    """The last sentence, if there is more than one."""
    ends = [i for i, w in enumerate(item[:-1]) if w.endswith(CLOSING)]
    return item[ends[-1] + 1 :] if ends else []


class _Item:
    """What the check needs of an item and one of its passages."""

    def __init__(self, text: bytes, low: int, high: int) -> None:
        ws = text.lower().split()
        self.whole, self.passage = Pattern(ws), Pattern(ws[low:high])
        answer = _answer(ws)
        self.answer = Pattern(answer) if answer else None
        self.low, self.high = low, high

    def share(self, document: list[bytes], at: int) -> float:
        """How much of the item the words around document[at:] hold in order; 0 if that is no leak."""
        own = self.whole.own
        n = len(own)
        if n < LEAST:
            near = document[max(0, at - n) : at + WINDOW + n]
            return float(any(near[i : i + n] == own for i in range(len(near) - n + 1)))
        slack = 4 + n // 4
        near = document[max(0, at - self.low - slack - STRIDE) : at + WINDOW + (n - self.high) + slack + STRIDE]
        among = set(near)
        whole = self.whole.reaches(near, among, LIKELY)
        if whole >= SURE or whole and self.answer and self.answer.reaches(near, among, LIKELY):
            return whole
        if len(self.passage.own) < n:
            slack = 4 + len(self.passage.own) // 4
            near = document[max(0, at - slack) : at + WINDOW + slack]
            return self.passage.reaches(near, set(near), SURE)
        return 0.0


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word fingerprints of each text."""
    for batch in batches:
        for part in slices(batch.column("text")):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(words(part).hashes()).view(np.int64))], names=["term"])


def _counts(vocabulary: np.ndarray):
    """How many texts of a task hold each word of the sorted vocabulary, and how many texts there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            total += batch.num_rows
            for part in slices(batch.column("text")):
                found = words(part)
                place, known = _lookup(vocabulary, found.hashes())
                pair = np.unique(found.row[known] * len(vocabulary) + place[known])
                n += np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1]), pa.array(np.r_[n[at], total])], names=["place", "n"])

    return run


def _lookup(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return place, vocabulary[place] == hashes


def factor(matrix: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Orthonormal columns that span the leading right singular directions of a matrix, by random projection."""
    width = min(rank + OVERSAMPLE, *matrix.shape)
    basis = matrix @ np.random.default_rng(seed).standard_normal((matrix.shape[1], width))
    for _ in range(POWER):
        basis = matrix @ (matrix.T @ np.linalg.qr(basis)[0])
    q = np.linalg.qr(basis)[0]
    _, sizes, right = np.linalg.svd(q.T @ matrix, full_matrices=False)
    return right[: min(rank, int((sizes > 1e-9).sum()))].T


def complete(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The directions and, where they show less than SEEN of a (unit) vector, those of what is left of it."""
    rest = vectors - (vectors @ directions) @ directions.T
    rest = rest[(rest**2).sum(axis=1) > 1 - SEEN]
    if not len(rest):
        return directions
    return np.hstack([directions, np.linalg.qr(rest.T)[0]])


def _factored(vocabulary: np.ndarray, weights: np.ndarray, rank: int):
    """Of one block: a row with its words, their directions, and its passages' places in latent space."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("item_id", "ascending"), ("low", "ascending"), ("text", "ascending")])
        rows = []
        for text, low, high in zip(*(table[c].to_pylist() for c in ("text", "low", "high")), strict=True):
            ws = text.encode().lower().split()[low:high]
            rows.append(np.searchsorted(vocabulary, np.array([one_hash(w) for w in ws], np.uint64)))
        own = np.unique(np.concatenate(rows))
        vectors = np.zeros((len(rows), len(own)))
        for i, places in enumerate(rows):
            vectors[i, np.searchsorted(own, places)] = weights[places]
        mass = (vectors**2).sum(axis=1)
        vectors /= np.maximum(np.sqrt(mass), 1e-12)[:, None]
        directions = complete(vectors, factor(vectors, rank, len(rows)))
        latent = vectors @ directions
        # Scaled so that the inner product with a window is the share of the passage that the window has.
        latent /= np.maximum((latent**2).sum(axis=1) * np.sqrt(mass), 1e-12)[:, None]
        latent = latent.astype(np.float32)
        return pa.table(
            {
                "block": table["block"][:1],
                "words": pa.array([vocabulary[own].tobytes()]),
                "directions": pa.array([directions.astype(np.float32).tobytes()]),
                "latent": pa.array([latent.tobytes()]),
                "mass": pa.array([mass.tolist()], pa.list_(pa.float64())),
                "passages": pa.array([[{"item_id": i, "text": t, "low": a, "high": b} for i, t, a, b in zip(*(table[c].to_pylist() for c in ("item_id", "text", "low", "high")), strict=True)]], pa.list_(pa.struct([("item_id", pa.int64()), ("text", pa.string()), ("low", pa.int32()), ("high", pa.int32())]))),
            }
        )

    return run


_FACTORED = "block bigint, words binary, directions binary, latent binary, mass array<double>, passages array<struct<item_id: bigint, text: string, low: int, high: int>>"


class _Model:
    """A group of blocks as a task uses them."""

    def __init__(self, blocks: list[tuple], vocabulary: np.ndarray, weights: np.ndarray) -> None:
        self.vocabulary, self.weights = vocabulary, weights
        self.blocks, self.least = [], np.inf
        for own, directions, latent, mass, passages in blocks:
            places = np.searchsorted(vocabulary, np.frombuffer(own, np.uint64))
            at = np.full(len(vocabulary), -1, np.int32)
            at[places] = np.arange(len(places), dtype=np.int32)
            rank = len(directions) // 4 // len(places)
            table = np.frombuffer(directions, np.float32).reshape(len(places), rank) * weights[places, None].astype(np.float32)
            items = [(i, _Item(t.encode(), a, b)) for i, t, a, b in passages]
            need = np.array([needed(b - a) for _, _, a, b in passages], np.float32)
            self.least = min(self.least, float((need * np.array(mass)).min()))
            self.blocks.append((at, table, np.frombuffer(latent, np.float32).reshape(len(items), rank), need, items))

    def candidates(self, found) -> Iterator[tuple[int, int, int, float, _Item]]:
        """(row, first word, item, cosine, passage) of each window and passage that are close enough."""
        place, known = _lookup(self.vocabulary, found.hashes())
        n_of = np.diff(found.first_of)
        n_segments = -(-n_of // STRIDE)
        base = np.cumsum(n_segments) - n_segments
        within = np.arange(len(found.row)) - found.first_of[found.row]
        segment = base[found.row] + within // STRIDE
        count = int(n_segments.sum())
        if not count:
            return
        owner = np.repeat(np.arange(len(n_of)), n_segments)
        # The distinct words of each segment, in the order of segments.
        taken = np.unique(segment[known] * len(self.vocabulary) + place[known])
        segment, place = np.divmod(taken, len(self.vocabulary))
        light = np.bincount(segment, self.weights[place] ** 2, count)
        last = np.r_[owner[1:] != owner[:-1], True]
        light += np.where(last, 0, np.r_[light[1:], 0])  # a window is a segment and the next
        only = last & np.r_[False, owner[1:] == owner[:-1]]  # the tail of a text is in the window before
        use = np.flatnonzero((light >= 0.999 * self.least) & (light > 0) & ~only)
        if not len(use):
            return
        wanted = np.zeros(count, bool)
        wanted[use] = True
        wanted[np.minimum(use + 1, count - 1)] |= ~last[use]
        slot = np.cumsum(wanted) - 1
        chosen = wanted[segment]
        slots, place = slot[segment[chosen]], place[chosen]
        more = ~last[use]
        for at, table, latent, need, items in self.blocks:
            own = at[place]
            here = own >= 0
            own, filled = own[here], slots[here]
            starts = np.flatnonzero(np.r_[True, np.diff(filled) != 0]) if len(filled) else []
            sums = np.zeros((int(wanted.sum()), table.shape[1]), np.float32)
            for i in range(0, len(starts), 512):  # few words at a time, for the cache and for memory
                a, b = starts[i], starts[i + 512] if i + 512 < len(starts) else len(own)
                sums[filled[starts[i : i + 512]]] = np.add.reduceat(table[own[a:b]], starts[i : i + 512] - a, axis=0)
            window = sums[slot[use]]
            window[more] += sums[slot[use[more] + 1]]
            share = window @ latent.T
            for w, p in zip(*np.nonzero(share >= need), strict=True):
                s = use[w]
                row = int(owner[s])
                yield row, int(s - base[row]) * STRIDE, items[p][0], min(1.0, float(share[w, p])) ** 0.5, items[p][1]


def _search(model, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = _Model(*model.value)
        for batch in batches:
            keys, out = batch.column("key").to_pylist(), {}
            for part in slices(batch.column("text")):
                found, text = words(part), (-1, [])
                for row, at, item_id, cos, item in group.candidates(found):
                    if text[0] != row:
                        text = row, found.data[part.offsets[row] : part.offsets[row + 1]].tobytes().split()
                    if share := item.share(text[1], at):
                        key = keys[part.first + row], item_id
                        if share > out.get(key, (0,))[0]:
                            out[key] = share, cos, at
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in out], kind), pa.array([k[1] for k in out], pa.int64()), *(pa.array([v[i] for v in out.values()], t) for i, t in ((0, pa.float64()), (1, pa.float64()), (2, pa.int64())))],
                    names=["key", "item_id", "lcs_share", "cosine", "first_word"],
                )

    return run


def _pieces(text: str) -> list[str]:
    """The text in pieces of PIECE words, so that no passage carries more than one; a last short piece
    stays with the one before."""
    ws = text.encode().split()
    ends = [*range(PIECE, len(ws) - WINDOW, PIECE), len(ws)]
    return [b" ".join(ws[a:b]).decode() for a, b in zip([0, *ends], ends, strict=False) if b > a]


def passages(benchmark: DataFrame) -> DataFrame:
    """(block, item_id, text, low, high): passages of the items that have words, with their piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            rows = [(i, t, a, b) for i, whole in items for t in _pieces(whole or "") for a, b in _cut(len(t.split(" ")))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32()))], names=["item_id", "text", "low", "high"])

    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    rows = stored(rows.mapInArrow(cut, "item_id bigint, text string, low int, high int"))
    blocks = max(1, -(-rows.count() // BLOCK))
    return rows.select(F.pmod(F.xxhash64("item_id", "text", "low"), F.lit(blocks)).alias("block"), "item_id", "text", "low", "high")


def _found(docs: DataFrame, benchmark: DataFrame, rank: int) -> DataFrame:
    """(key, item_id, lcs_share, cosine, first_word) of docs (key, text), the key a bigint or a string."""
    spark = docs.sparkSession
    small_batches(spark)
    key = docs.schema["key"].dataType
    kind, columns = pa.int64() if key.simpleString() == "bigint" else pa.string(), f"key {key.simpleString()}, item_id bigint, lcs_share double, cosine double, first_word bigint"
    cut = stored(passages(benchmark))
    n_blocks = (cut.agg(F.max("block")).first()[0] or 0) + 1
    found = []
    for first in range(0, n_blocks, GROUP):
        group = cut.where((F.col("block") >= first) & (F.col("block") < first + GROUP))
        vocabulary = np.array([r[0] for r in group.select("text").distinct().mapInArrow(_terms, "term bigint").distinct().collect()], np.int64).view(np.uint64)
        if not len(vocabulary):
            continue
        vocabulary.sort()
        counted = docs.select("text").mapInArrow(_counts(vocabulary), "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
        n = {r["place"]: r["n"] for r in counted.collect()}
        total = n.pop(-1, 0)
        held = np.zeros(len(vocabulary))
        held[list(n)] = list(n.values())
        weights = np.log((total + 1) / (held + 1)) + 1e-3
        factored = group.groupBy("block").applyInArrow(_factored(vocabulary, weights, rank), _FACTORED).collect()
        blocks = [(bytes(r["words"]), bytes(r["directions"]), bytes(r["latent"]), r["mass"], [tuple(p) for p in r["passages"]]) for r in factored]
        model = spark.sparkContext.broadcast((blocks, vocabulary, weights))
        found.append(docs.select("key", "text").mapInArrow(_search(model, kind), columns))
    if not found:
        return spark.createDataFrame([], columns)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    best = pairs.groupBy("key", "item_id").agg(F.max(F.struct("lcs_share", "cosine", F.expr("-first_word").alias("back"))).alias("m"))
    return best.select("key", "item_id", F.col("m.lcs_share").alias("lcs_share"), F.col("m.cosine").alias("cosine"), (-F.col("m.back")).alias("first_word"))


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """(doc_id, item_id, lcs_share, cosine, first_word): which documents hold which items."""
    found = _found(docs.select(docs["doc_id"].cast("bigint").alias("key"), docs["text"].alias("text")), benchmark, rank)
    return found.withColumnRenamed("key", "doc_id")


def without_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """The rows of `docs` that hold no item, all columns as they are. Rows without a doc_id are told apart by a
    digest of their text."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("text:"), F.sha2(docs["text"].cast("binary"), 256)))
    rows = docs.select(key.alias("key"), docs["text"].alias("text"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("d"))
    leaked = stored(_found(rows.select("key", "text"), benchmark, rank).select(F.col("key").alias("leaked")).distinct())
    return rows.join(leaked, F.col("key") == F.col("leaked"), "left_anti").select("d.*")
