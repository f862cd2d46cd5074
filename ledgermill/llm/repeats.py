"""Removal of long byte strings that repeat anywhere in the corpus, by a distributed sort of suffixes.

A byte goes if a string of WINDOW bytes covers it that also starts anywhere else. Which windows repeat is found by
sorting suffixes, each as far as its window reaches (`suffix_runs`). Suffixes that need no sorting, or not each on its
own, are told apart before:

1. Each window has an anchor: its GRAM bytes with the least hash, the leftmost of several. Equal windows have equal
   anchors at the same place, and neighbouring windows mostly share theirs, so one suffix stands for all windows of an
   anchor: from the first such window to the end of the last one. If an anchor's bytes occur once in the corpus, no
   window of it repeats.
2. The others are sorted. A suffix that is found again in full settles all its windows.
3. What differs from all others of its anchor may still share some windows with them. It is cut into bands of BAND
   neighbouring windows, next to one representative of each full repeat of the same anchor. A band whose common bytes
   occur in one such suffix alone can't repeat; the suffixes of the others are sorted, and one that is found again
   settles its windows.
4. The windows of the bands that are still open are sorted one by one, with one representative as before.

Every step counts with partial sums or compares strings that are distinct within a run, so a passage that a third of
all documents hold is an entry for each map task. One side of each join is a stored table of distinct keys, so the adaptive
skew join can split the other side. Texts are distinct (`distinct_texts`) and count as often as
documents hold them; a task holds a slice of texts, a run, or a part between two splitters.

Defined results: null text is empty; texts under WINDOW bytes lose nothing; copies of a text of WINDOW bytes or more lose
everything; rows with null or repeated doc_id are rows like others; an empty table gives an empty one; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import distinct_texts, dropped, small_batches, stored, to_documents
from ledgermill.llm.suffix_runs import ALONE, FIRST, occurrences, runs_of
from ledgermill.llm.words import _INVERSE, BASE, Texts, mix, powers, slices

WINDOW, GRAM, BAND = 200, 64, 8
_HALF = np.uint64(32)


def anchors(texts: Texts, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, anchor, first window, last window, hash) of each run of windows with one anchor; places from the text's start."""
    data, n = texts.data, len(texts.data)
    if n < window:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n)[:n], out=prefix[1:])
    h = mix((prefix[gram:] - prefix[:-gram]) * powers(_INVERSE, n)[: n - gram + 1])
    # Half of the hash above the place: the least value is the least hash, and among equal ones the leftmost.
    least = ((h >> _HALF) << _HALF) | np.arange(len(h), dtype=np.uint64)
    wide, span = 1, window - gram + 1
    while 2 * wide <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < span:
        least = np.minimum(least[: len(least) - (span - wide)], least[span - wide :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    valid = np.zeros(n - window + 1, bool)  # windows within one text
    row = np.zeros(n - window + 1, np.int32)
    for i, (a, b) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)):
        if b - a >= window:
            valid[a : b - window + 1] = True
            row[a : b - window + 1] = i
    same = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1])
    first = np.flatnonzero(valid & ~np.r_[False, same])
    last = np.flatnonzero(valid & ~np.r_[same, False])
    row = row[first].astype(np.int64)
    at = texts.offsets[row]
    return row, anchor[first] - at, first - at, last - at, h[anchor[first]].view(np.int64)


TEXTS = "tid bigint, key binary, n bigint, text string, anchor array<int>, low array<int>, high array<int>, hash array<bigint>"


def _with_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in TEXTS.split(", ")]
    for batch in batches:
        for part in slices(batch.column("text")):
            row, anchor, low, high, h = anchors(part)
            ends = pa.array(np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (anchor, low, high)]
            lists.append(pa.ListArray.from_arrays(ends, pa.array(h)))
            own = batch.slice(part.first, len(part))
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in names[:4]), *lists], names)


def _spread_anchors(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, tuple]]:
    """The suffixes of the wanted anchors of each text."""
    for tid, n, text, wanted, *lists in zip(*(batch.column(c).to_pylist() for c in ("tid", "n", "text", "wanted", "anchor", "low", "high", "hash")), strict=True):
        raw, chosen = text.encode(), set(wanted)
        for anchor, low, high, h in zip(*lists, strict=True):
            if h in chosen:
                yield raw[low : high + WINDOW], n, (tid, anchor, low, high, h)


OPEN = "suffix bigint, tid bigint, low int, before int, mark int, bytes binary"


def _open_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in OPEN.split(", ")][1:]
    for batch in batches:
        rows = []
        for tid, text, found in zip(*(batch.column(c).to_pylist() for c in ("tid", "text", "found")), strict=True):
            raw = text.encode()
            rows += [(tid, x["low"], x["anchor"] - x["low"], x["mark"], raw[x["low"] : x["high"] + WINDOW]) for x in found]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def bands(before: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(band, first window, last window) of a suffix whose anchor stands `before` bytes in; bands count from the anchor."""
    last = size - WINDOW  # windows start at 0..last, before - start bytes left of the anchor
    for band in range((before - last) // BAND, before // BAND + 1):
        yield band, max(0, before - (band + 1) * BAND + 1), min(last, before - band * BAND)


def _cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that all possible windows of a band have in common, as a 64-bit digest with the band's number."""
    for batch in batches:
        suffix, number, digest = [], [], []
        for own, before, raw in zip(*(batch.column(c).to_pylist() for c in ("suffix", "before", "bytes")), strict=True):
            for band, _, _ in bands(before, len(raw)):
                start = before - band * BAND
                core = hashlib.blake2b(raw[start : start + WINDOW - BAND + 1], digest_size=8, key=bytes([band])).digest()
                suffix.append(own)
                number.append(band)
                digest.append(int.from_bytes(core, "little", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(suffix, pa.int64()), pa.array(number, pa.int32()), pa.array(digest, pa.int64())], ["suffix", "band", "core"])


def _band_suffixes(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, tuple]]:
    """From the first window of each wanted band to the end of its last one."""
    for own, tid, low, before, mark, raw, wanted in zip(*(batch.column(c).to_pylist() for c in ("suffix", "tid", "low", "before", "mark", "bytes", "wanted")), strict=True):
        core = {x["band"]: x["core"] for x in wanted}
        for band, first, last in bands(before, len(raw)):
            if band in core:
                yield raw[first : last + WINDOW], 1, (own, band, core[band], mark, tid, low + first, low + last)


def _windows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, tuple | None]]:
    """The windows of the wanted bands; those of settled ones count, but their verdict is not asked for."""
    for tid, low, before, raw, wanted in zip(*(batch.column(c).to_pylist() for c in ("tid", "low", "before", "bytes", "wanted")), strict=True):
        asked = {x["band"]: x["asked"] for x in wanted}
        for band, first, last in bands(before, len(raw)):
            if band in asked:
                for i in range(first, last + 1):
                    yield raw[i : i + WINDOW], 1, (tid, low + i) if asked[band] else None


def _settled_suffixes(texts: DataFrame) -> DataFrame:
    """Stored occurrences (tid, anchor, low, high, hash, mark) of the suffixes whose anchor occurs more than once."""
    held = texts.select("n", F.explode("hash").alias("hash")).groupBy("hash").agg(F.sum("n").alias("n"))
    held = stored(held.where("n > 1").select("hash"))
    shared = texts.select("tid", F.explode(F.array_distinct("hash")).alias("hash")).join(held, "hash", "left_semi")
    wanted = stored(shared.groupBy("tid").agg(F.collect_list("hash").alias("wanted")))  # anchors of one text
    columns = {"tid": "<i8", "anchor": "<i4", "low": "<i4", "high": "<i4", "hash": "<i8"}
    runs = runs_of(texts.drop("key").join(wanted, "tid"), _spread_anchors, columns)
    found = occurrences(runs, columns)
    dropped(held, wanted, runs)
    return found


def _unsettled(found: DataFrame, key: str, asked: Column) -> DataFrame:
    """Stored keys with a string that is asked for and like no other."""
    return stored(found.where((F.col("mark") == ALONE) & asked).select(key).distinct())


def _open(found: DataFrame, key: str, unsettled: DataFrame) -> DataFrame:
    """Of these keys, the strings that are like no other and one of each kind of the others."""
    return found.where(F.col("mark").isin(ALONE, FIRST)).join(unsettled, key, "left_semi")


def _settled_bands(suffixes: DataFrame) -> DataFrame:
    """Stored occurrences (suffix, band, core, of, tid, low, high, mark) of bands whose core is in more suffixes than one."""
    cores = stored(suffixes.select("suffix", "before", "bytes").mapInArrow(_cores, "suffix bigint, band int, core bigint"))
    twice = stored(cores.groupBy("core").count().where("count > 1").select("core"))
    chosen = cores.join(twice, "core", "left_semi").groupBy("suffix").agg(F.collect_list(F.struct("band", "core")).alias("wanted"))
    columns = {"suffix": "<i8", "band": "<i4", "core": "<i8", "of": "<i4", "tid": "<i8", "low": "<i4", "high": "<i4"}
    runs = runs_of(suffixes.join(chosen, "suffix"), _band_suffixes, columns)
    found = occurrences(runs, columns)
    dropped(cores, twice, runs)
    return found


def repeated_windows(texts: DataFrame) -> DataFrame:
    """Stored (tid, low, high): windows low..high of a text start elsewhere too."""
    whole = _settled_suffixes(texts)
    hashes = _unsettled(whole, "hash", F.lit(True))
    rest = _open(whole, "hash", hashes).groupBy("tid").agg(F.collect_list(F.struct("anchor", "low", "high", "mark")).alias("found"))
    suffixes = texts.select("tid", "text").join(rest, "tid").mapInArrow(_open_suffixes, OPEN.split(", ", 1)[1])
    suffixes = stored(suffixes.withColumn("suffix", F.monotonically_increasing_id()))
    banded = _settled_bands(suffixes)
    asked = F.col("of") == ALONE  # not of a representative
    of_band = F.struct("band", (asked & (F.col("mark") == ALONE)).alias("asked"))
    cores = _unsettled(banded, "core", asked)
    rest = _open(banded, "core", cores).groupBy("suffix").agg(F.collect_list(of_band).alias("wanted"))
    columns = {"tid": "<i8", "low": "<i4"}
    runs = runs_of(suffixes.join(rest, "suffix"), _windows, columns)
    single = occurrences(runs, columns)
    again = F.col("mark") != ALONE
    found = whole.where(again).select("tid", "low", "high").unionByName(banded.where(again & asked).select("tid", "low", "high"))
    found = stored(found.unionByName(single.where(again).select("tid", "low", F.col("low").alias("high"))))
    dropped(whole, hashes, suffixes, banded, cores, runs, single)
    return found


def spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes (start, end) that windows starting at low..high cover."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(found):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], high + WINDOW)
        else:
            out.append((low, high + WINDOW))
    return out


RESULTS = "key binary, n_bytes bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept_sha256 string"


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RESULTS.split(", ")]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        sizes, gone, all_spans, digests = [], [], [], []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
            raw = text.encode()
            own = spans([(x["low"], x["high"]) for x in found or ()])
            digest, at = hashlib.sha256(), 0
            for start, end in own:
                digest.update(raw[at:start])
                at = end
            digest.update(raw[at:])
            sizes.append(len(raw))
            gone.append(sum(b - a for a, b in own))
            all_spans.append([{"start": a, "end": b} for a, b in own])
            digests.append(digest.hexdigest())
        columns = [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(all_spans, kind), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256) of each row of docs (doc_id, text); spans are byte ranges."""
    small_batches(docs.sparkSession)
    texts = distinct_texts(docs).withColumn("tid", F.monotonically_increasing_id())
    texts = stored(texts.mapInArrow(_with_anchors, TEXTS))
    windows = repeated_windows(texts)
    found = windows.groupBy("tid").agg(F.collect_list(F.struct("low", "high")).alias("found"))  # windows of one text
    results = texts.select("tid", "key", "text").join(found, "tid", "left").select("key", "text", "found")
    results = stored(results.mapInArrow(_removed, RESULTS))
    dropped(texts, windows)
    return to_documents(docs, results)
