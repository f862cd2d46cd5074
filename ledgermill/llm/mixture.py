"""Mixing sources to target weights by Poisson replication.

Each source gets the mean repetition rate at which it fills its share of the target size. A document's
count is the inverse of that Poisson distribution at a number in [0, 1) that a hash of seed and doc_id
gives; the document is exploded by its count, and all copies are put in the order of another hash, which
is a global shuffle. Only built-in functions; the rates are literals, so no source is joined or gathered
and a hot source costs what its rows cost.

`weights` names sources and their parts of the target; `rest` is the part of all other sources together
(null among them), which share one rate. Parts are relative to their sum. Sizes are code points of text.
The driver holds one rate for each named source: as many as the caller has passed.

Defined results: null or empty texts have no size but are drawn like others of their source; a source
whose texts are all empty, or with weight 0, gets rate 0; rows that share a doc_id share their count; an
empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of an md5 that make a number in [0, 1): 52 bits, which a double holds exactly.
DIGITS = 13


def _unit(*parts: Column) -> Column:
    key = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """(least, steps): the count for a number u is `least` plus how many of the rising steps are <= u.

    `steps` are the cumulative probabilities of least, least + 1, ... until 2^-53 is all that is left;
    what lies below `least` is smaller than that too.
    """
    if rate <= 0:
        return 0, []
    least = max(0, math.floor(rate - 12 * math.sqrt(rate) - 20))
    steps, total, k = [], 0.0, least
    while True:
        p = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total += p
        steps.append(min(total, 1.0))
        k += 1
        if k > rate and (p < 1e-18 or total >= 1 - 2**-53):
            return least, steps


def rates(docs: DataFrame, weights: dict[str, float], rest: float, target: int | None = None) -> dict[str | None, float]:
    """The mean repetition rate of each named source, and under None of all others."""
    group = F.when(docs["source"].isin(list(weights)), docs["source"])
    sizes = docs.select(group.alias("source"), F.length("text").alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    size = {row["source"]: row["size"] or 0 for row in sizes.collect()}
    total = sum(weights.values()) + rest
    target = sum(size.values()) if target is None else target
    share = weights | {None: rest}
    return {s: share[s] / total * target / size[s] if size.get(s) else 0.0 for s in share}


def mix(docs: DataFrame, weights: dict[str, float], rest: float = 0.0, target: int | None = None, seed: int = 0) -> DataFrame:
    """Copies of documents in shuffled order: struct `d` of the columns of docs, rate, n_copies, copy, u, place.

    `target` is the size of the result on average, the size of `docs` by default. `copy` counts from 1;
    `place` in [0, 1) is what the result is sorted by.
    """
    found = rates(docs, weights, rest, target)
    rate, count = F.lit(found[None]), None
    u = F.col("u")
    counts = {}
    for source, value in found.items():
        least, steps = poisson_steps(value)
        counts[source] = F.lit(least) + (F.size(F.filter(F.lit(steps), lambda c: c <= u)) if steps else F.lit(0))
    count = counts.pop(None)
    for source, own in counts.items():
        count = F.when(F.col("source") == source, own).otherwise(count)
        rate = F.when(F.col("source") == source, F.lit(found[source])).otherwise(rate)
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("d"),
        docs["source"].alias("source"),
        docs["doc_id"].alias("doc_id"),
        _unit(F.lit(seed), docs["doc_id"]).alias("u"),
    )
    rows = rows.select("d", "doc_id", "u", rate.alias("rate"), count.cast("int").alias("n_copies")).where("n_copies > 0")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    place = _unit(F.lit(seed), F.col("doc_id"), F.col("copy"))
    return rows.select("d", "rate", "n_copies", "copy", "u", place.alias("place")).orderBy("place")


def placed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, text, place): copies of documents with the places that `mix` has put them in.

    A table has no order once it is read again. Equal rows are counted, in each map task first, and numbered
    from 1, so their places are those of the copies 1, 2, ... of their doc_id. Rows without a doc_id are told
    apart by a digest of their text.
    """
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).groupBy("doc_id", "text").agg(F.count("*").cast("int").alias("n"))
    rows = rows.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.col("text").cast("binary"), 256))
    return rows.select("doc_id", "text", _unit(F.lit(seed), name, F.col("copy")).alias("place"))
