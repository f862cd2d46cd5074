"""Toxicity: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features are rates and shares: hits of a fixed lexicon, hits of words and word beginnings learned from labelled
texts, hits near second-person words, capitals, punctuation, spelling that hides words. The whole text is read.

Training takes at most `LABELLED` labelled rows (documented bound, the first by a hash of doc_id), split in
three by a hash of the text's least words, so that near copies mostly fall in one part: one part finds the
learned lexicon, one fits the trees (Spark ML), one fits the calibration. Labels, lang, source and doc_id are
never inputs of a score.

Defined results: null and empty texts have all features 0 and get the score of such a text; without labels of
both classes the score is the share of label 1, or 0 without any; null labels are left out; a doc_id with several
labels takes the largest; rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import small_batches, stored
from ledgermill.llm.words import one_hash, slices, words

LABELLED, TREES, TREE_DEPTH, STEP, SEED = 20_000, 20, 3, 0.3, 7
#: A learned entry is in so many texts of label 1 at least, and its odds are so many times those of label 0.
LEAST_TEXTS, LEAST_ODDS = 5, 8.0
BEGINNINGS = (4, 5, 6)
NEAR = 5
#: Insults of several languages, and second-person words.
INSULTS = (
    "idiot idiots moron morons stupid dumb dumbass loser losers pathetic worthless disgusting trash scum clown clowns "
    "imbecile cretin fool foolish garbage filth filthy vermin pig swine bastard bitch whore slut asshole jerk freak "
    "retard retarded retards ugly useless hate kill die shut crap damn shit fuck fucking fucker bullshit dickhead "
    "dummkopf blöd blöde blödmann arschloch scheiße hurensohn wichser dreck abschaum schwein "
    "imbécile connard salope merde pute crétin débile ordure salaud stupide "
    "idiota imbécil estúpido estúpida basura mierda puta cabrón gilipollas asqueroso escoria"
)
SECOND = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre usted tú ti tus vosotros"
FEATURES = [
    "insults", "insult_count", "learned", "learned_count", "learned_weight", "beginnings", "beginnings_count",
    "near_second", "second", "capitals", "shouted", "exclaimed", "punctuation", "hidden", "length",
]


def _set(text: str) -> np.ndarray:
    return np.unique(np.array([one_hash(w.encode()) for w in text.split()], np.uint64))


def _among(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(hashes), bool)
    return keys[np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)] == hashes


def _bare(found) -> np.ndarray:
    """Fingerprints of the words without ASCII punctuation at their ends."""
    letter = np.ones(256, bool)
    letter[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = False
    start, end = found.start.copy(), found.end.copy()
    for _ in range(4):  # up to four signs at each end
        start += (start < end - 1) & ~letter[found.data[start]]
        end -= (start < end - 1) & ~letter[found.data[end - 1]]
    cut = type(found)(found.data, start, end, found.row, found.first_of, found.prefix)
    return cut.hashes(), [np.where(end - start >= n, cut.hashes(n) + np.uint64(n), np.uint64(0)) for n in BEGINNINGS]


def _hidden(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether letters stand on both sides of a digit or sign within a word (st*pid, 1d10t, s.t.u.p.i.d)."""
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    sign = np.zeros(256, bool)
    sign[[ord(c) for c in "*@$!#%013457._-"]] = True
    inside = np.zeros(len(data) + 1, np.int64)
    if len(data) > 2:
        inside[2:-1] = np.cumsum(letter[data[:-2]] & sign[data[1:-1]] & letter[data[2:]])
        inside[-1] = inside[-2]
    return inside[np.maximum(end - 1, start + 1)] > inside[start + 1]


def _measured(lexicon):
    """Rows of (row columns, FEATURES) of texts."""
    insults, second = _set(INSULTS), _set(SECOND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, weights, beginnings = lexicon.value
        for batch in batches:
            for part in slices(batch.column("text")):
                found, n = words(part), len(part)
                row, data = found.row, part.data
                hashes, begins = _bare(found)
                is_insult, is_second = _among(insults, hashes), _among(second, hashes)
                is_learned = _among(learned, hashes)
                weight = np.zeros(len(hashes))
                weight[is_learned] = weights[np.searchsorted(learned, hashes[is_learned])]
                begun = np.zeros(len(hashes), bool)
                for b in begins:
                    begun |= _among(beginnings, b)
                hit = is_insult | is_learned | begun
                near = np.zeros(len(hashes), bool)
                for step in range(1, NEAR + 1):
                    near[step:] |= is_second[:-step] & (row[step:] == row[:-step])
                    near[:-step] |= is_second[step:] & (row[step:] == row[:-step])
                byte_row = np.repeat(np.arange(n), np.diff(part.offsets))
                by_byte = lambda mask: np.bincount(byte_row[mask], minlength=n)  # noqa: E731, B023
                by_word = lambda mask: np.bincount(row[mask], minlength=n)  # noqa: E731, B023
                upper = (data >= 65) & (data <= 90)
                uppers = np.r_[0, np.cumsum(upper)]
                letters = found.end - found.start
                shouted = (uppers[found.end] - uppers[found.start] >= np.maximum(3, 0.6 * letters))
                marks = (data > 32) & (data < 127) & ~upper & ~((data >= 97) & (data <= 122)) & ~((data >= 48) & (data <= 57))
                n_words, n_bytes = np.maximum(np.diff(found.first_of), 1), np.maximum(np.diff(part.offsets), 1)
                columns = [
                    by_word(is_insult) / n_words, by_word(is_insult), by_word(is_learned) / n_words, by_word(is_learned),
                    np.bincount(row, weight, n) / np.sqrt(n_words), by_word(begun) / n_words, by_word(begun),
                    by_word(hit & near) / n_words, by_word(is_second) / n_words, by_byte(upper) / n_bytes,
                    by_word(shouted) / n_words, by_byte((data == 33) | (data == 63)) / n_words, by_byte(marks) / n_bytes,
                    by_word(_hidden(data, found.start, found.end)) / n_words, np.log1p(np.diff(found.first_of)),
                ]
                rest = [c for c in batch.schema.names if c != "text"]
                kept = [batch.column(c).slice(part.first, n) for c in rest]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(np.asarray(c, np.float64)) for c in columns)], names=[*rest, *FEATURES])

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, begins, ones, zeros): texts of each label that hold a word, or one that begins so."""
    for batch in batches:
        label = np.array(batch.column("label").to_pylist(), np.int64)
        for part in slices(batch.column("text")):
            found = words(part)
            hashes, begins = _bare(found)
            for is_begin, keys in ((False, hashes), *((True, b) for b in begins)):
                some = keys != 0
                order = np.lexsort((found.row[some], keys[some]))
                key, row = keys[some][order], found.row[some][order]
                new = np.r_[True, (key[1:] != key[:-1]) | (row[1:] != row[:-1])] if len(key) else np.zeros(0, bool)
                key, one = key[new], label[part.first + row[new]]
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
                ones = np.add.reduceat(one, first) if len(first) else first
                n = np.diff(np.r_[first, len(key)])
                yield pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(np.full(len(first), is_begin)), pa.array(ones), pa.array(n - ones)], names=["entry", "begins", "ones", "zeros"])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `part`: a number that near copies mostly share, from the two least word fingerprints."""
    for batch in batches:
        parts = []
        for some in slices(batch.column("text")):
            found = words(some)
            h = found.hashes()
            for a, b in zip(found.first_of[:-1].tolist(), found.first_of[1:].tolist(), strict=True):
                parts.append(int(h[a:b].min() % np.uint64(10)) if b > a else 0)
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("label"), pa.array(parts, pa.int32())], names=["text", "label", "part"])


class Model:
    """A fitted scorer: lexicon, trees, calibration; or a constant where there is nothing to learn."""

    def __init__(self, lexicon, trees=None, calibration=None, constant: float = 0.0) -> None:
        self.lexicon, self.trees, self.calibration, self.constant = lexicon, trees, calibration, constant

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) for each row of docs (doc_id, text)."""
        rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
        if self.trees is None:
            return rows.select("doc_id", F.lit(self.constant).alias("score"))
        rows = features(rows, self.lexicon, "doc_id bigint")
        return self.calibration.transform(_margin(self.trees, rows)).select("doc_id", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)).alias("score"))


def features(rows: DataFrame, lexicon, spec: str) -> DataFrame:
    """The columns of `rows` but text, as `spec` declares them, and a vector of the features."""
    measured = rows.mapInArrow(_measured(lexicon), ", ".join([spec, *(f"{f} double" for f in FEATURES)]))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(measured).drop(*FEATURES)


def _margin(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("margin", vector_to_array("probability")[1])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Learn from labels (doc_id, label) and the texts of their documents."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = labels.where("doc_id is not null and label is not null").groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.max(F.col("label").cast("int")).alias("label"))
    chosen = labels.orderBy(F.xxhash64("label_id"), "label_id").limit(labelled)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("label_id"), docs["text"].alias("text"))
    # At most `labelled` rows, so that no text is shuffled for them.
    rows = rows.join(F.broadcast(chosen), "label_id").dropDuplicates(["label_id", "text"]).select("text", F.col("label").cast("bigint").alias("label"))
    rows = stored(rows.mapInArrow(_dealt, "text string, label bigint, part int"))
    sums = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, zeros = sums.get(1, 0), sum(sums.values()) - sums.get(1, 0)
    if not ones or not zeros:
        return Model(None, constant=1.0 if ones else 0.0)
    first, second, third = rows.where("part < 4"), rows.where("part between 4 and 7"), rows.where("part > 7")
    if any(part.select("label").distinct().count() < 2 for part in (first, second, third)):
        first = second = third = rows  # too few rows to split
    n = {r["label"]: r["count"] for r in first.groupBy("label").count().collect()}
    found = first.mapInArrow(_entries, "entry bigint, begins boolean, ones bigint, zeros bigint").groupBy("entry", "begins").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    odds = (F.col("ones") + 0.5) / (n[1] + 1) / ((F.col("zeros") + 0.5) / (n[0] + 1))
    table = found.where((F.col("ones") >= LEAST_TEXTS) & (odds >= LEAST_ODDS)).select("entry", "begins", F.log(odds).alias("weight")).toArrow()
    entry, begins, weight = (table[c].to_numpy() for c in ("entry", "begins", "weight"))
    entry, begins = entry.astype(np.int64).view(np.uint64), begins.astype(bool)
    order = np.argsort(entry[~begins])
    lexicon = spark.sparkContext.broadcast((entry[~begins][order], weight[~begins].astype(float)[order], np.sort(entry[begins])))
    trees = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=STEP, seed=SEED, cacheNodeIds=False)
    trees = trees.fit(stored(features(second.select("text", "label"), lexicon, "label bigint")))
    calibration = IsotonicRegression(labelCol="label", featuresCol="margin", predictionCol="calibrated")
    margins = _margin(trees, features(third.select("text", "label"), lexicon, "label bigint"))
    return Model(lexicon, trees, calibration.fit(margins.select("label", "margin")))
