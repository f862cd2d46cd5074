"""Near duplicates by min-max hashing, confirmed on whole shingle sets.

Of each permutation a document keeps the smallest and the largest value, so 100 permutations give 200
signature values: half the hash evaluations of plain MinHash. Both ends estimate the Jaccard similarity
without bias, and being nearly independent they have the lower variance of 200 samples. Forty bands of
five values make candidates: a pair at similarity 0.8 shares no band with probability 1.2e-7.

Documents with the same sequence of words form one class, named by its smallest doc_id; only classes are
compared. In a bucket of a
band, classes are first compared with one of them, the pivot. Where that does not join the whole
bucket, further pivots are taken, in growing numbers, each compared with the members that are still in
another component, until nothing is left that could join. So a bucket of near copies costs its size,
not its square, and no link between components is missed. Pairs whose set sizes rule a link out are no
candidates, nor are those whose sketches, a mixed bit of each signature value, differ in more bits than
links do but for one in 5e7: the sketch of the signature itself, and in later rounds one of 1,024 permutations, made for the texts of open buckets alone. Every candidate is confirmed on the
full sets.

Defined results: a null or wordless text has no shingles and is linked with nothing; a row with a null
doc_id is linked with nothing, its component_id is null and it is kept; rows that share a doc_id are one
document, whatever their texts. Sets and classes are compared by 64- and 128-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.components import connected, extended, merged
from ledgermill.llm.shared import small_batches, stored
from ledgermill.llm.words import mix, shingles, slices, words

PERMUTATIONS, BANDS, ROWS = 100, 40, 5
#: Bits of the sketch that all documents have, and of the finer one of those in buckets that stay open; how many
#: bits may differ: 5.5 standard deviations more than are expected at similarity 0.8, exceeded by one link in 5e7 if
#: bits differ independently. A bit is of the mixed value, so that one shingle has another under each permutation.
#: Sets of up to 4 shingles are only linked if they are equal, and then no bit differs.
SKETCH_BITS, SKETCH_DIFFERENT = 2 * PERMUTATIONS, 43
FINE_BITS, FINE_DIFFERENT = 2048, 280
#: A character of a word.
WORD = r"[^\x20\x09-\x0D]"
#: All pivots are taken at once if that compares so many sketches for each member of a bucket at most.
_AT_ONCE = 128
_STEP = 4096  # set members that are hashed at a time
#: A pair of classes, with the components that they were in.
_PAIR = ["a", "b", "label_a", "label_b"]


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n, None], seeds[n:, None] | np.uint64(1)


def signature(members: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """The least and the greatest value of a non-empty set under each permutation, least ones first."""
    flip, factor = _seeds(permutations)
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for i in range(0, len(members), _STEP):
        values = (members[None, i : i + _STEP] ^ flip) * factor
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band. Band j has values j, j + bands, ...: all of different permutations."""
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = mix(key + values[i * bands : (i + 1) * bands])
    return key


def sketch(values: np.ndarray) -> np.ndarray:
    """A bit of each value of a signature, packed into 64-bit words."""
    bits = np.packbits((mix(values) & np.uint64(1)).astype(np.uint8))
    return np.frombuffer(bits.tobytes() + bytes(-len(bits) % 8), np.uint64)


def _class_of(data: np.ndarray) -> bytes:
    """128 bits of a text's sequence of words."""
    return hashlib.blake2b(b" ".join(data.tobytes().split()), digest_size=16).digest()


def _profile(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = words(part)
                sets = shingles(found, shingle)
                keys, bounds = [], part.offsets
                for members in sets:
                    values = signature(members) if len(members) else None
                    keys.append(np.r_[band_keys(values), sketch(values)].view(np.int64) if len(members) else None)
                ids = batch.column("doc_id").slice(part.first, len(part))
                data = found.data
                classes = [_class_of(data[a:b]) if len(s) else None for a, b, s in zip(bounds[:-1], bounds[1:], sets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(classes, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "class", "n_shingles", "signature"],
                )

    return run


def _confirm(shingle: int, percent: int):
    """Keeps the pairs whose texts `x` and `p` have 100 * intersection >= percent * union."""

    def sets_of(column: pa.Array) -> Iterator[np.ndarray]:
        for part in slices(column):
            yield from shingles(words(part), shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(sets_of(batch.column("text_a")), sets_of(batch.column("text_b")), strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(_PAIR).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text).

    `percent` may be 80 or more: bands and sketches are laid out for that.
    """
    if percent < 80:
        raise ValueError("the bands are laid out for a similarity of 80 percent or more")
    small_batches(docs.sparkSession)
    docs = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    spec = "doc_id bigint, class binary, n_shingles bigint, signature array<bigint>"
    profile = stored(docs.mapInArrow(_profile(shingle), spec))
    known = profile.where("doc_id is not null and class is not null")
    classes = stored(known.groupBy("class").agg(F.min("doc_id").alias("node")))
    labels = _linked(docs, profile, classes, shingle, percent)
    # An id with several texts joins their classes.
    several = known.groupBy("doc_id").agg(F.countDistinct("class").alias("n")).where("n > 1")
    if several.limit(1).count():
        mixed = known.join(several, "doc_id").join(classes, "class").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
        labels = extended(labels, mixed.where("a <> b"))
    component = classes.join(labels, "node", "left").select("class", F.coalesce("label", "node").alias("component_id"))
    out = profile.select("doc_id", "class", "n_shingles").join(stored(component), "class", "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component_id).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _with_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(key, text, d): rows with a key of their own, `d` being all their columns; and `d` of rows that have none.

    The key is the doc_id. Rows without one get numbers that no doc_id has, above all others where there is room;
    of those with equal texts one is taken. Rows with neither doc_id nor words have no key.
    """
    rows = docs.select(docs["doc_id"].cast("bigint").alias("key"), docs["text"].alias("text"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("d"))
    nameless = rows.where("key is null")
    if not nameless.limit(1).count():
        return rows, None
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # Numbers differ when a task is done again, so the rows are written with them.
    once = stored(nameless.where(worded).dropDuplicates(["text"]).withColumn("number", F.monotonically_increasing_id()))
    least, most = rows.agg(F.min("key"), F.max("key")).first()
    last = once.agg(F.max("number")).first()[0] or 0
    if (most or 0) + 1 + last < 2**63:
        key = F.lit(max(most or 0, 0) + 1) + F.col("number")
    else:
        key = F.lit(min(least or 0, 0) - 1) - F.col("number")
    return rows.where("key is not null").unionByName(once.select(key.alias("key"), "text", "d")), nameless.where(~worded).select("d")


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay: of each group the document with the smallest doc_id, once.

    All columns stay as they are. A row with a null doc_id goes if its text is near that of a row with a doc_id,
    and of a group without any doc_id one row stays; it stays if it has no words. Of equal rows one stays.
    """
    rows, rest = _with_keys(docs)
    found = near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"), **options)
    gone = stored(found.where("not kept").select(F.col("doc_id").alias("gone_id")).distinct())
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("key")))
    rows = rows.join(gone, rows["key"] == gone["gone_id"], "left_anti")
    if repeated.limit(1).count():
        again = rows.join(repeated, "key", "left_semi")
        first = Window.partitionBy("key", F.xxhash64("text")).orderBy("text")
        again = again.withColumn("rank", F.row_number().over(first)).where("rank = 1")
        rows = rows.join(repeated, "key", "left_anti").select("d").unionByName(again.select("d"))
    rows = rows.select("d")
    return (rows.unionByName(rest) if rest is not None else rows).select("d.*")


def _linked(docs: DataFrame, profile: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, label) of the classes with links: the smallest class that they reach by confirmed links.

    `members` are the classes of each bucket that have not been a pivot. Once a pivot has been compared
    with every member of another component it can be left out, so a bucket is through when its members
    are all in one component. Pivots come from outside the largest component of their bucket; each round
    takes 64 times as many, and the first that can take all that are left, for few comparisons, is the last.
    """
    first = classes.select("class", F.col("node").alias("doc_id"))
    of_first = profile.join(first, ["class", "doc_id"]).select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "signature")
    banded = of_first.select("node", "n", F.slice("signature", BANDS + 1, 64).alias("sketch"), F.explode(F.slice("signature", 1, BANDS)).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("p"), F.max("node").alias("last")).where("p <> last").drop("last")
    members = stored(banded.join(shared, "bucket").distinct())
    texts = docs.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id").distinct()
    texts = stored(texts.select(F.col("doc_id").alias("node"), "text"))
    heads = members.where("node = p").select(F.col("bucket").alias("p_bucket"), "p", F.col("n").alias("p_n"), F.col("sketch").alias("p_sketch"))
    members = members.where("node <> p").drop("p")
    pairs = members.join(heads, (members["bucket"] == heads["p_bucket"]) & _likely(percent, SKETCH_BITS, SKETCH_DIFFERENT))
    members = members.drop("sketch")
    pairs = pairs.select(F.least("p", "node").alias("a"), F.greatest("p", "node").alias("b")).distinct()
    first = pairs = stored(pairs.select("a", "b", F.col("a").alias("label_a"), F.col("b").alias("label_b")))
    labels, take, known, through = None, 64, members.count(), False
    while True:
        both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        found = both.select(*_PAIR, "text_a", "text_b").mapInArrow(_confirm(shingle, percent), ", ".join(f"{c} bigint" for c in _PAIR))
        found = stored(found)
        labels = merged(labels, found) if labels else connected(found)
        if through:
            return labels
        placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        sizes = placed.groupBy("bucket", "label").count().groupBy("bucket")
        sizes = sizes.agg(F.max(F.struct("count", "label")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
        open_ = stored(placed.join(sizes.select("bucket", F.col("top.label").alias("top")), "bucket"))
        outside = open_.groupBy("bucket").agg(F.sum((F.col("label") != F.col("top")).cast("bigint")).alias("outside"), F.count("*").alias("members"))
        compared = outside.agg(F.sum(F.col("outside").cast("double") * F.col("members"))).first()[0]
        if not compared:
            return labels
        if "sketch" not in open_.columns:
            # Texts are hashed once; what later rounds need of them goes with the members from then on.
            fine = texts.join(open_.select("node").distinct(), "node")
            fine = stored(fine.mapInArrow(_fine(shingle), "node bigint, bands array<bigint>, sketch array<bigint>"))
            open_ = stored(open_.join(fine, "node"))
        pivots, through = open_.where("label <> top"), compared <= _AT_ONCE * known
        if not through:
            by_bucket = Window.partitionBy("bucket").orderBy("node")
            pivots = pivots.withColumn("rank", F.row_number().over(by_bucket)).where(F.col("rank") <= take)
        pivots = pivots.select(*[F.col(c).alias(f"p_{c}") for c in ("bucket", "n", "label", "bands", "sketch")], F.col("node").alias("p"))
        if not through:
            pivots = stored(pivots)
            gone = pivots.select(F.col("p_bucket").alias("bucket"), F.col("p").alias("node"))
            members = open_.join(gone, ["bucket", "node"], "left_anti").drop("label", "top")
            take *= 64
        likely = (F.col("label") != F.col("p_label")) & _likely(percent, FINE_BITS, FINE_DIFFERENT)
        # A pair that shares several bands is taken in the first of them, and in one round, as its pivot leaves the bucket then.
        shared = F.array_position(F.zip_with("bands", "p_bands", lambda x, y: x == y), F.lit(True))
        pairs = open_.join(pivots, (open_["bucket"] == pivots["p_bucket"]) & likely & (shared == F.array_position("bands", open_["bucket"])))
        up = F.col("p") < F.col("node")
        ends = {"a": ("p", "node"), "b": ("node", "p"), "label_a": ("p_label", "label"), "label_b": ("label", "p_label")}
        pairs = pairs.select(*[F.when(up, F.col(x)).otherwise(F.col(y)).alias(c) for c, (x, y) in ends.items()]).distinct()
        pairs = stored(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"))


def _fine(shingle: int):
    """(node, bands, sketch) of texts, the sketch of FINE_BITS bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                sets = shingles(words(part), shingle)
                bands = [band_keys(signature(s)).view(np.int64) for s in sets]
                bits = [sketch(signature(s, FINE_BITS // 2)).view(np.int64) for s in sets]
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(part.first, len(part)), pa.array(bands, kind), pa.array(bits, kind)], names=["node", "bands", "sketch"])

    return run


def _likely(percent: int, bits: int, different: int) -> Column:
    """Whether the sizes and the sketches of a member and a pivot allow the similarity."""
    apart = [F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("p_sketch", F.lit(i)))) for i in range((bits + 63) // 64)]
    return (100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n")) & (sum(apart[1:], apart[0]) <= different)
