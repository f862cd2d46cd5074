"""Token ids in files of 64-bit words: Simple-8b coding with escapes and per-block offsets.

A word has a 4-bit selector on top and 60 bits for as many ids as fit at one width, the first id lowest.
Ids that need more than `ESCAPE_BITS` bits are escapes: the words hold 0 in their place, and a list beside
them holds position and value. Ids are coded in blocks of `BLOCK` ids that begin with a new word; the
offset of each block's first word is stored, so blocks are decoded side by side as a matrix, or alone.

A record is a run of whole documents of about `RECORD_IDS` ids, or one longer document:

    magic "LMS8", version u32, n_docs u32, n_blocks u32, n_words u64, n_ids u64, n_escapes u64, crc32 u32, 0 u32
    doc_id i64[n_docs], n_tokens u64[n_docs], has_id u8[n_docs], zeros up to a multiple of 8
    first word of each block u64[n_blocks], words u64[n_words], escape position u64[], escape value u64[]

all little-endian; crc32 is of everything behind the header. A file is a Parquet table of records (part,
record, first, n_ids, payload), so any store that Spark reads can hold it, and Spark's committer decides
which attempt of a task counts. `part` is the number of the file in the order of the rows, `first` the number of ids
before the record in its file.

Defined results: a null or empty text has only the end id; rows with a null doc_id come first; rows of the
same doc_id follow each other in the order of their texts.
"""

from __future__ import annotations

import codecs
import json
import os
import string
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.shared import small_batches, stored
from ledgermill.llm.words import SLICE_BYTES, Texts, Words, slices, words

#: How many ids a word holds and their width, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE_BITS = 30
BLOCK, RECORD_IDS = 1024, 1 << 18
_PAD = int(COUNTS.max())
_HEAD = struct.Struct("<4sIIIQQQII")


def _choices(widths: np.ndarray) -> np.ndarray:
    """For each place of each row, the selector that packs the most ids from there on."""
    n = widths.shape[1] - _PAD
    widest, have = {1: widths}, [1]
    for count in sorted(set(COUNTS.tolist()) - {1}):  # the widest of the next `count` ids, from two shorter runs
        half = next(h for h in have if 2 * h >= count)
        span = widest[half]
        widest[count] = np.maximum(span[:, : span.shape[1] - (count - half)], span[:, count - half :])
        have.append(count)
    best = np.full((len(widths), n), len(COUNTS) - 1, np.uint8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        best[widest[int(COUNTS[selector])][:, :n] <= WIDTHS[selector]] = selector
    return best


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block, places of escapes, their values) of ids, all uint64."""
    ids = np.asarray(ids, np.uint64)
    places = np.flatnonzero(ids >> np.uint64(ESCAPE_BITS)).astype(np.uint64)
    escaped = ids[places]
    blocks = -(-len(ids) // BLOCK)
    lanes = np.zeros((blocks, BLOCK + _PAD), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[: len(ids)] = ids
    flat[places] = 0
    lanes[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    widths = np.frexp(lanes.astype(np.float64))[1].astype(np.uint8)  # bits of each id; exact below 2^53
    best = _choices(widths)
    sizes = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(blocks))
    at, live = np.zeros(blocks, np.int64), np.arange(blocks)
    lane, place, chosen = [], [], []
    while len(live):  # one word of every block that isn't through
        selector = best[live, at[live]]
        lane.append(live)
        place.append(at[live])
        chosen.append(selector)
        at[live] += COUNTS[selector]
        live = live[at[live] < sizes[live]]
    if not lane:
        return (np.zeros(0, np.uint64),) * 4
    lane, place, chosen = map(np.concatenate, (lane, place, chosen))
    order = np.argsort(lane.astype(np.uint16) if blocks <= 1 << 16 else lane, kind="stable")  # short keys are sorted by digits
    lane, place, chosen = lane[order], place[order], chosen[order]
    lanes, start = lanes.ravel(), lane * lanes.shape[1] + place
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        if width:
            of = np.flatnonzero(chosen == selector)
            values = lanes[start[of, None] + np.arange(count)]
            words[of] |= np.bitwise_or.reduce(values << (np.arange(count, dtype=np.uint64) * np.uint64(width)), axis=1)
    return words, np.searchsorted(lane, np.arange(blocks)).astype(np.uint64), places, escaped


def decode(words: np.ndarray, first: np.ndarray, places: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The ids that were encoded, n of them."""
    blocks = len(first)
    lanes = np.zeros((blocks, BLOCK + _PAD), np.uint64)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    lane = np.repeat(np.arange(blocks), np.diff(np.r_[first.astype(np.int64), len(words)]))
    ends = np.cumsum(COUNTS[chosen])
    place = ends - COUNTS[chosen]
    if len(words):
        place -= place[first.astype(np.int64)][lane]
    for selector in np.unique(chosen):
        count, width = int(COUNTS[selector]), int(WIDTHS[selector])
        if width:
            of = np.flatnonzero(chosen == selector)
            values = (words[of, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)
            lanes[lane[of, None], place[of, None] + np.arange(count)] = values
    ids = lanes[:, :BLOCK].ravel()[:n].copy()
    ids[places.astype(np.int64)] = escaped
    return ids


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One record."""
    words, first, places, escaped = encode(ids)
    table = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array(lengths, "<u8").tobytes()
    table += bytes(x is not None for x in doc_ids)
    table += bytes(-len(table) % 8)
    body = table + b"".join(x.astype("<u8").tobytes() for x in (first, words, places, escaped))
    return _HEAD.pack(b"LMS8", 1, len(doc_ids), len(first), len(words), len(ids), len(places), zlib.crc32(body), 0) + body


def unpack(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, ids of each document, all ids) of one record; a damaged record raises ValueError."""
    magic, version, n_docs, n_blocks, n_words, n, n_escapes, crc, _ = _HEAD.unpack_from(payload)
    body = memoryview(payload)[_HEAD.size :]
    if magic != b"LMS8" or version != 1 or zlib.crc32(body) != crc:
        raise ValueError("not a record, or a damaged one")
    doc_ids, lengths = np.frombuffer(body, "<i8", n_docs), np.frombuffer(body, "<u8", n_docs, 8 * n_docs).astype(np.int64)
    known = np.frombuffer(body, np.uint8, n_docs, 16 * n_docs)
    at = 17 * n_docs + (-17 * n_docs) % 8
    parts = []
    for size in (n_blocks, n_words, n_escapes, n_escapes):
        parts.append(np.frombuffer(body, "<u8", size, at))
        at += 8 * size
    first, words, places, escaped = parts
    ids = decode(words, first, places, escaped, n)
    return [x if k else None for x, k in zip(doc_ids.tolist(), known, strict=True)], lengths, ids


#: Distinct words whose ids a worker keeps, about 40 bytes each, before it begins anew; changes only the speed.
CACHED_WORDS = 2_000_000
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

#: Words that are encoded as one text.
_LINE = 100

#: The steps before the model that `_letters_alone` knows.
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _byte_letters() -> str:
    """The sign of each byte in the byte-level alphabet; a space stands for itself, upper-case Latin-1 letters are lowered."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}
    signs |= {b: signs[b + 32] for b in range(0x80, 0x9F) if b != 0x97}  # behind 0xC3, as all such bytes of `_letters` are
    return "".join((signs | {32: " "})[b] for b in range(256))


_BYTE_LETTERS = _byte_letters()


def _letters_alone(tokenizer):
    """The tokenizer without the steps that leave lower-case letters as they are, for texts in `_BYTE_LETTERS`; or None.

    These steps, a regular expression among them, cost half the time of a text. The model is the same.
    """
    from tokenizers import Tokenizer

    parts = json.loads(tokenizer.to_str())
    steps = [(parts[k] or {}).get(inner) for k, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    if steps != [_NORMAL, _PIECES] or any(t["content"].isalpha() for t in parts["added_tokens"]):
        return None
    return Tokenizer.from_str(json.dumps(parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))


def _letters(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a lower-case ASCII letter or half of a Latin-1 letter."""
    first, second = data == 0xC3, (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    pair = np.flatnonzero(first[:-1] & second[1:])
    letter = (data >= 97) & (data <= 122)
    letter[pair] = letter[pair + 1] = True
    return letter


class WordTokenizer:
    """The ids of texts, by encoding each distinct word once.

    The tokenizer drops white space, lower-cases, and splits letters and digits from other signs before it
    looks at pieces. So a text's ids are those of its words, and a word that ends in a letter or digit and then
    in ASCII signs has the ids of both parts, unless a special token may end there. `ids_of[begin[i]:begin[i + 1]]`
    are the ids of word i.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.plain = _letters_alone(self.tokenizer)
        self.is_tail = np.zeros(256, bool)
        special = {t.content[-1:] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.is_tail[[ord(c) for c in (string.punctuation if self.plain else ".,;:!?") if c not in special]] = True
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begin, self.ids_of = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Places of sorted fingerprints, -1 for words that are not known."""
        if not len(self.known):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.place[at], -1)

    def learn(self, hashes: np.ndarray, texts: list[bytes], letters: np.ndarray) -> None:
        """Encode words and keep their ids.

        A word of letters is one piece, and the last token of a piece says so. Such words are encoded many
        at a time, which costs half, and the ids are cut behind these tokens.
        """
        encode = lambda some, by=self.tokenizer: [e.ids for e in by.encode_batch_fast(some, add_special_tokens=False)]
        alone, others = np.flatnonzero(letters), np.flatnonzero(~letters)
        lines = [b" ".join([texts[i] for i in alone[k : k + _LINE].tolist()]) for k in range(0, len(alone), _LINE)]
        if self.plain:
            found = encode([codecs.charmap_decode(line, "strict", _BYTE_LETTERS)[0] for line in lines], self.plain)
        else:
            found = encode([line.decode() for line in lines])
        ids = np.fromiter(chain.from_iterable(found), np.uint32)
        ends = np.flatnonzero(self.is_last[ids]) + 1
        if len(ends) != len(alone):  # not this kind of tokenizer
            ids, ends, alone, others = ids[:0], ends[:0], alone[:0], np.arange(len(texts))
        found = encode([texts[i].decode() for i in others])
        sizes = np.concatenate([np.diff(ends, prepend=0), np.array([len(x) for x in found], np.int64)])
        hashes = np.concatenate([hashes[alone], hashes[others]])
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known, self.place = np.insert(self.known, at, hashes[order]), np.insert(self.place, at, order + len(self.begin) - 1)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.ids_of = np.concatenate([self.ids_of, ids, np.fromiter(chain.from_iterable(found), np.uint32)])

    def encode(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a slice, how many each has)."""
        found = words(part)
        letter = _letters(found.data)
        middle = found.end.copy()
        for _ in range(3):
            middle -= (middle > found.start + 1) & self.is_tail[found.data[middle - 1]]
        middle = np.where(letter[middle - 1] | _DIGIT[found.data[middle - 1]], middle, found.end)
        tail = np.flatnonzero(middle < found.end)
        # Words and their tails in order: the tail of word i comes right behind it.
        start, end = np.insert(found.start, tail + 1, middle[tail]), np.insert(middle, tail + 1, found.end[tail])
        row = np.insert(found.row, tail + 1, found.row[tail])
        hashes = Words(found.data, start, end, row, found.first_of, found.prefix).hashes()
        order = np.argsort(hashes)
        starts = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0]) if len(order) else order
        distinct, first = hashes[order[starts]], order[starts]
        index = np.empty(len(order), np.int64)
        index[order] = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(order)]))
        known = self.look_up(distinct)
        new = np.flatnonzero(known < 0)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.forget()
            new = np.arange(len(distinct))
        if len(new):
            data = found.data.tobytes()
            low, high = start[first[new]], end[first[new]]
            strange = np.r_[0, np.cumsum(~letter)]
            self.learn(distinct[new], [data[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)], strange[high] == strange[low])
            known = self.look_up(distinct)
        place = known[index]
        sizes = self.begin[place + 1] - self.begin[place]
        ends = np.cumsum(sizes)
        ids = self.ids_of[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begin[place] - (ends - sizes), sizes)]
        return ids, np.bincount(row, sizes, len(part)).astype(np.int64)


_tokenizers: dict[str, WordTokenizer] = {}


def _writer(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, record = TaskContext.get().partitionId(), 0, 0
        docs, runs, held = [], [], 0
        tokenizer = _tokenizers.setdefault(path, None) or WordTokenizer(path)
        _tokenizers[path] = tokenizer

        def flush() -> pa.RecordBatch:
            nonlocal docs, runs, held, first, record
            ids = np.concatenate(runs)
            row = [[part], [record], [first], [len(ids)], [pack(docs, [len(x) for x in runs], ids)]]
            first, record = first + len(ids), record + 1
            docs, runs, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.int64()), pa.array(row[3], pa.int64()), pa.array(row[4], pa.binary())], names=["part", "record", "first", "n_ids", "payload"])

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for some in slices(batch.column("text"), 2 * SLICE_BYTES):
                ids, sizes = tokenizer.encode(some)
                for i, (end, size) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)):
                    docs.append(doc_ids[some.first + i])
                    runs.append(np.append(ids[end - size : end], np.uint64(end_id)))
                    held += size + 1
                    if held >= RECORD_IDS:
                        yield flush()
        if docs:
            yield flush()

    return run


RECORD_SCHEMA = "part int, record bigint, first bigint, n_ids bigint, payload binary"


def write_ids(docs: DataFrame, tokenizer: str, end_id: int = 1, order: str = "doc_id") -> DataFrame:
    """Encode the whole texts of `docs` (doc_id, text) and write them as files in ascending order of a column.

    Returns the table of records as it stands in the shared folder. Documents are dealt out by ranges
    of the column, so a task writes one stretch of the order; ties are ordered by doc_id and text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *([] if order == "doc_id" else [order]))
    rows = rows.repartitionByRange(n, order).sortWithinPartitions(order, "doc_id", "text").select("doc_id", "text")
    return stored(rows.mapInArrow(_writer(tokenizer, end_id), RECORD_SCHEMA), "none")


def _reader(before: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "payload")), strict=True):
                docs, lengths, ids = unpack(payload)
                ends = np.cumsum(lengths)
                small = ids.astype("<u4")
                crcs = [zlib.crc32(small[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(before[part] + first + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_digests(records: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files. Ids must be below 2^32.

    The driver holds one number for each file: the ids before it.
    """
    sums = records.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for row in sums:
        before[row["part"]] = total
        total += row["n"]
    small_batches(records.sparkSession)
    rows = records.select("part", "first", "payload")
    return rows.mapInArrow(_reader(before), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
