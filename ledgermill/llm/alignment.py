"""Alignment of two tokenizers over the distinct texts of a corpus.

A pair of ids (a, b) is the number a * (ids of B) + b.

Texts are shuffled by their full text, so each distinct one is tokenised and aligned once and counts as many
times as documents hold it. Byte offsets where tokens of both end cut a text into groups, and tokens whose byte
ranges overlap are linked. The cut points of both, merged, bound segments that lie in one token of each, and two
tokens overlap in one segment at most: links are the segments.

Neither tokenizer joins bytes across a place where a space follows something other than white space, so a text
falls into chunks there that are tokenised and aligned on their own; a worker does that once for each distinct
chunk that it keeps. The piece model is checked for this when it is loaded.

How many documents hold a pair of ids is a table. The most frequent pairs, MAX_FREQUENT at most, go to all
workers as arrays; what is left of each text is joined to the table.

Defined results: texts null, empty, or changed by a tokenizer's own normalisation have no tokens, hence zeros and
an empty text of groups; rows with null or repeated doc_id are rows like others; an empty table gives an empty
one; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import distinct_texts, dropped, often_enough, small_batches, stored, to_documents

#: Pairs that are sent to every worker: 16 bytes each.
MAX_FREQUENT = 1_000_000
#: Distinct chunks that a worker keeps before it begins anew, about 200 bytes each; changes only the speed.
CACHED_CHUNKS = 500_000
#: Chunks that are tokenised as one text, and bytes of texts that are aligned at once, if there is more than one.
LINE, SLICE_BYTES = 200, 1 << 18
SPACE_MARK = "▁"
_CUT = re.compile(r"(?<=\S) ")

ALIGNED = (
    "key binary, n bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "pairs array<bigint>, times array<int>"
)


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs stand for themselves,
    the other bytes, in order, for the signs from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_pieces(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file; entries with other signs are plain text."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    signs = byte_of_sign()
    entries = dict(spec["model"]["vocab"])
    for added in spec.get("added_tokens") or ():
        entries.setdefault(added["content"], added["id"])
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        known = all(sign in signs for sign in entry)
        out[i] = bytes(signs[sign] for sign in entry) if known else entry.encode()
    return out


def marked_pieces(model) -> list[bytes]:
    """The bytes of each id of a piece model."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE_MARK, " ").encode())
    return out


def chunks(text: str) -> list[str]:
    """The parts of a space and the text, which is not empty: cut before a space after something that is no white
    space. Each begins with a space, which is left out here, and holds more."""
    parts = _CUT.split(text)
    if not parts[-1] and len(parts) > 1:  # a last space alone is nothing to a piece model, which adds a space itself
        parts[-2:] = [parts[-2] + " "]
    return parts


class Tokens:
    """Ids of the distinct chunks that a worker met lately, end to end, with the place of each chunk."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = [np.zeros(1 << 16, np.int32) for _ in range(2)]
        self.used = [0, 0]
        self.first = [np.zeros(1 << 16, np.int32) for _ in range(2)]
        self.count = [np.zeros(1 << 16, np.int32) for _ in range(2)]
        self.whole = np.zeros(1 << 16, bool)

    def add(self, new: list[str], counts: list[np.ndarray], ids: list[np.ndarray], whole: np.ndarray) -> None:
        n, m = len(self.place), len(new)
        for side in range(2):
            have = self.used[side]
            self.used[side] += len(ids[side])
            self.ids[side] = _room(self.ids[side], self.used[side])
            self.ids[side][have : self.used[side]] = ids[side]
            self.first[side], self.count[side] = _room(self.first[side], n + m), _room(self.count[side], n + m)
            self.first[side][n : n + m] = have + np.cumsum(counts[side]) - counts[side]
            self.count[side][n : n + m] = counts[side]
        self.whole = _room(self.whole, n + m)
        self.whole[n : n + m] = whole
        self.place.update(zip(new, range(n, n + m), strict=True))

    def of(self, side: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks at the places, number of ids of each)."""
        n = self.count[side][places]
        skip = self.first[side][places] - (np.cumsum(n) - n)
        return self.ids[side][np.repeat(skip, n) + np.arange(n.sum())], n


def _room(array: np.ndarray, n: int) -> np.ndarray:
    if len(array) >= n:
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


@dataclass
class Alignment:
    """Some texts aligned: for each its numbers and groups, and its distinct pairs with how often it links them."""

    numbers: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    times: np.ndarray
    first: np.ndarray


class Aligner:
    """Both tokenizers, and the chunks that were tokenised lately."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        for i in range(self.b.get_piece_size()):
            if SPACE_MARK in self.b.id_to_piece(i).lstrip(SPACE_MARK):
                raise ValueError(f"{path_b} has pieces over the end of a word: texts can't be cut there")
        self.pieces = byte_pieces(path_a), marked_pieces(self.b)
        self.lengths = [np.array([len(x) for x in side], np.int64) for side in self.pieces]
        sizes = [len(x) for x in self.pieces]
        # Each id as text with what follows it: "," within a side of a group, "|" after A, ";" after B.
        self.texts = [f"{i}{sign}" for side, ends in enumerate((",|", ",;")) for sign in ends for i in range(sizes[side])]
        self.codes = (0, sizes[0], 2 * sizes[0], 2 * sizes[0] + sizes[1])
        self.kept = Tokens()

    def _encoded(self, lines: list[list[str]]) -> tuple[list[list[int]], list[list[int]]]:
        texts = [" ".join(x) for x in lines]
        a = [x.ids for x in self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def _learn(self, new: list[str]) -> None:
        """Tokenise chunks, many as one text; where a line's bytes change, its chunks are taken one by one.

        A chunk that ends in white space is the end of a text, and nothing may follow it in a line.
        """
        ends = [x for x in new if x[-1].isspace()]
        new = [x for x in new if not x[-1].isspace()]
        lines = [new[i : i + LINE] for i in range(0, len(new), LINE)] + [[x] for x in ends]
        new += ends
        todo = [(line, a, b) for line, a, b in zip(lines, *self._encoded(lines), strict=True)]
        counts, ids, whole = ([], []), ([], []), []
        for line, *sides in todo:
            raw = b" " + " ".join(line).encode()
            good = [b"".join([pieces[i] for i in side]) == raw for pieces, side in zip(self.pieces, sides, strict=True)]
            if not all(good) and len(line) > 1:
                for text, *own in zip(line, *self._encoded([[x] for x in line]), strict=True):
                    raw = b" " + text.encode()
                    whole.append(all(b"".join([pieces[i] for i in side]) == raw for pieces, side in zip(self.pieces, own, strict=True)))
                    for side in range(2):
                        counts[side].append(np.array([len(own[side])]))
                        ids[side].append(own[side])
                continue
            whole += [all(good)] * len(line)
            ends = np.cumsum([len(x.encode()) + 1 for x in line])
            for side in range(2):
                cuts = np.searchsorted(np.cumsum(self.lengths[side][sides[side]]), ends) + 1 if all(good) else np.array([len(sides[side])])
                counts[side].append(np.diff(np.r_[0, cuts]))
                ids[side].append(sides[side])
        self.kept.add(new, [np.concatenate(x) for x in counts], [np.concatenate([np.array(y, np.int32) for y in x]) for x in ids], np.array(whole))

    def align(self, texts: list[str], digest: bool = False) -> Alignment:
        """All texts of a list; `digest` gives the SHA-256 of the groups instead of their text."""
        parts = [chunks(x) if x else [] for x in texts]
        met = set().union(*parts)
        if len(self.kept.place) + len(met) > CACHED_CHUNKS:
            self.kept = Tokens()
        place = self.kept.place
        new = [x for x in met if x not in place]
        if new:
            self._learn(new)
        places = np.fromiter(map(place.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))
        row = np.repeat(np.arange(len(texts)), [len(x) for x in parts])
        changed = np.bincount(row[~self.kept.whole[places]], minlength=len(texts)) > 0
        live = ~changed[row]
        places, row = places[live], row[live]
        ids, rows, ends = [], [], []
        for side in range(2):
            own, n = self.kept.of(side, places)
            ids.append(own.astype(np.int64))
            rows.append(np.repeat(row, n))
            ends.append(np.cumsum(self.lengths[side][own]))
        total = int(ends[0][-1]) + 1 if len(ends[0]) else 1
        is_end = np.zeros((2, total), bool)
        for side in range(2):
            is_end[side, ends[side]] = True
        cuts = np.flatnonzero(is_end[0] | is_end[1])  # a segment ends at each, and is a link
        ended = is_end[:, cuts]
        token = np.cumsum(ended, axis=1) - ended  # of each segment, the token that it lies in
        both = ended[0] & ended[1]
        group = np.cumsum(both) - both
        link_row = rows[0][token[0]]
        numbers = [np.bincount(x, minlength=len(texts)) for x in (rows[0], rows[1], link_row[both], link_row)]
        size_b = len(self.pieces[1])
        links = link_row * (len(self.pieces[0]) * size_b) + ids[0][token[0]] * size_b + ids[1][token[1]]
        links.sort()
        starts = np.flatnonzero(np.r_[True, links[1:] != links[:-1]]) if len(links) else np.zeros(0, np.int64)
        pairs = links[starts]
        first = np.searchsorted(pairs, np.arange(len(texts) + 1) * (len(self.pieces[0]) * size_b))
        pairs = pairs % (len(self.pieces[0]) * size_b)
        times = np.diff(np.r_[starts, len(links)])
        groups = self._groups(ids, ended, both, group, rows, len(texts), digest)
        return Alignment(np.stack(numbers), groups, pairs, times, first)

    def _groups(self, ids, ended, both, group, rows, n: int, digest: bool) -> list[str]:
        """Groups as text: the tokens of A of a group, then those of B, each as its number and a sign."""
        of = [group[ended[side]] for side in range(2)]  # the group of each token
        last = [both[ended[side]] for side in range(2)]
        firsts = [np.searchsorted(x, np.arange(int(both.sum()) + 1)) for x in of]
        codes = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        codes[np.arange(len(ids[0])) + firsts[1][of[0]]] = np.where(last[0], self.codes[1], self.codes[0]) + ids[0]
        codes[np.arange(len(ids[1])) + firsts[0][of[1] + 1]] = np.where(last[1], self.codes[3], self.codes[2]) + ids[1]
        ends = np.cumsum(np.bincount(rows[0], minlength=n) + np.bincount(rows[1], minlength=n))
        codes, texts, out, at = codes.tolist(), self.texts, [], 0
        for end in ends.tolist():
            own = "".join([texts[i] for i in codes[at:end]])[:-1]
            out.append(hashlib.sha256(own.encode()).hexdigest() if digest and own else own)
            at = end
        return out


#: The aligners of this worker, by their files.
_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _aligned(path_a: str, path_b: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            texts, at = batch.column("text"), 0
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            while at < len(texts):  # a bounded number of bytes at once, or one text
                below = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, below + SLICE_BYTES, side="right")))
                found = own.align(texts.slice(at, to - at).to_pylist(), digest)
                part = batch.slice(at, to - at)
                first = pa.array(found.first.astype(np.int32))
                lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (found.pairs, found.times.astype(np.int32))]
                columns = [part.column("key"), part.column("n"), *map(pa.array, found.numbers), pa.array(found.groups, pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in ALIGNED.split(", ")])
                at = to

    return run


def aligned_texts(texts: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Texts (key, text, n) with their tokens, groups and distinct pairs; `groups` as text or as its SHA-256."""
    small_batches(texts.sparkSession)
    return texts.select("key", "text", "n").mapInArrow(_aligned(path_a, path_b, digest), ALIGNED)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, held, best): documents that hold each linked pair, and whether no pair of its A id is held by more."""
    pairs = aligned.select("n", F.explode("pairs").alias("pair"))
    held = pairs.groupBy("pair").agg(F.sum("n").alias("held"))
    held = stored(held.withColumn("a", F.expr(f"pair div {size_b}")))
    most = held.groupBy("a").agg(F.max("held").alias("most"))  # one row for each id of the vocabulary at most
    counts = stored(held.join(most, "a").select("pair", "held", (F.col("held") == F.col("most")).alias("best")))
    dropped(held)
    return counts


SUMS = "key binary, best bigint, held bigint, pairs array<bigint>, times array<int>"


def _summed(table):
    """Sums over the pairs of each text that the table has, and the text's other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held, best = table.value
        for batch in batches:
            lists = [batch.column(c) for c in ("pairs", "times")]
            sizes = np.diff(lists[0].offsets.to_numpy())
            wanted, times = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.searchsorted(pairs, wanted)
            place[place == len(pairs)] = 0
            known = pairs[place] == wanted if len(pairs) else np.zeros(len(wanted), bool)
            sums = []
            for values in (best, held):
                total = np.zeros(len(sizes), np.int64)
                np.add.at(total, row[known], times[known] * values[place[known]])
                sums.append(pa.array(total))
            ends = np.r_[0, np.cumsum(np.bincount(row[~known], minlength=len(sizes)))].astype(np.int32)
            rest = [(wanted[~known], pa.int64()), (times[~known], pa.int32())]
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x).cast(kind)) for x, kind in rest]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *sums, *rest], [x.split()[0] for x in SUMS.split(", ")])

    return run


def link_sums(aligned: DataFrame, counts: DataFrame, limit: int = MAX_FREQUENT) -> DataFrame:
    """(key, n_best, count_sum) of each text: links whose pair is a best one of its A id, and the sum of counts."""
    spark = aligned.sparkSession
    top = counts.where(often_enough(counts, "held", limit)).toArrow()  # `limit` rows at most
    order = np.argsort(top.column("pair").to_numpy())
    arrays = [top.column("pair").to_numpy(), top.column("held").to_numpy(), top.column("best").to_numpy(zero_copy_only=False).astype(np.int64)]
    table = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(x[order]) for x in arrays))
    sums = stored(aligned.select("key", "pairs", "times").mapInArrow(_summed(table), SUMS))
    rest = sums.select("key", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    times = F.col("times").cast("bigint")
    rest = rest.join(counts.withColumnRenamed("held", "n"), "pair").select(
        "key", F.when(F.col("best"), times).otherwise(F.lit(0)).alias("best"), (times * F.col("n")).alias("held")
    )
    both = sums.select("key", "best", "held").unionByName(rest)
    return both.groupBy("key").agg(F.sum("best").alias("n_best"), F.sum("held").alias("count_sum"))


def alignment(docs: DataFrame, path_a: str, path_b: str, limit: int = MAX_FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of docs (doc_id, text)."""
    aligned = stored(aligned_texts(distinct_texts(docs), path_a, path_b, digest=True))
    counts = pair_counts(aligned, len(aligner(path_a, path_b).pieces[1]))
    sums = link_sums(aligned, counts, limit)
    measures = aligned.drop("n", "pairs", "times").withColumnRenamed("groups", "groups_sha256").join(sums, "key")
    measures = stored(measures)
    dropped(aligned, counts)
    return to_documents(docs, measures)
