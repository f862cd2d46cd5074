"""Repeated strings, the Merkle manifest and the token alignment against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgermill.llm import alignment, merkle, queries, repeats, suffix_runs
from tests.llm.cases import none, odd, odd_rows

BYTE_LEVEL, PIECES = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def sha(text: bytes | str) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# Sorted runs


@given(st.lists(st.sets(st.binary(min_size=1, max_size=6).map(lambda x: x.replace(b"\xff", b"ab"))), max_size=9), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_merging_front_coded_runs_sorts(sets, piece):
    """Pieces of a run are coded on their own; every string comes out in order, and equal ones are told."""
    runs, strings = [], [sorted(x) for x in sets]
    for own in strings:
        coded = [suffix_runs.front_coded(own[i : i + piece]) for i in range(0, len(own), piece)]
        assert [x for c in coded for x in suffix_runs.decoded(*c)] == own
        runs.append(suffix_runs.Run(coded))
    at, out = [0] * len(runs), []
    for i, same in suffix_runs.merged(runs):
        out.append((strings[i][at[i]], same))
        at[i] += 1
    want = sorted(x for own in strings for x in own)
    assert [x for x, _ in out] == want
    assert [same for _, same in out] == [i > 0 and want[i] == want[i - 1] for i in range(len(want))]


# Repeats


def plain_repeats(texts: list[str | None], window: int = 200) -> list[tuple]:
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + window] for raw in raws for i in range(len(raw) - window + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if seen[raw[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        n_spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(raw), sum(gone), n_spans, sha(kept)))
    return out


def repeating_texts() -> list[str | None]:
    """Passages of 190 to 215 bytes at different places, edited copies, periods, and texts around the window's size."""
    rnd = random.Random(5)
    noise = lambda n: "".join(rnd.choice("abcdefghij klmnop é") for _ in range(n))
    long = noise(900)
    texts: list[str | None] = [None, "", "x" * 199, "y" * 200, "z" * 201, "ab" * 400, "ba" * 150, long, long, long[:400] + "#" + long[400:]]
    for n in (190, 199, 200, 201, 208, 215, 260):
        passage = noise(n)
        texts += [noise(rnd.randrange(200)) + passage + noise(rnd.randrange(200)) for _ in range(4)]
        texts.append(passage + noise(3) + passage)
    for _ in range(60):
        base = list(rnd.choice([t for t in texts if t]))
        for _ in range(rnd.randrange(4)):
            base[rnd.randrange(len(base))] = rnd.choice("XYZ")
        texts.append("".join(base))
    return texts


@pytest.mark.parametrize("small_runs", (False, True))
def test_repeats_are_those_of_the_definition(spark, monkeypatch, small_runs):
    if small_runs:  # many runs, blocks, parts
        for name, value in (("RUN", 64), ("BLOCK", 16), ("PART", 32), ("SAMPLED", 4)):
            monkeypatch.setattr(suffix_runs, name, value)
    texts = repeating_texts()
    rows = repeats.repeated_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows}
    assert got == dict(enumerate(plain_repeats(texts)))
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        gone = [raw[s["start"] : s["end"]] for s in r["spans"]]
        assert sum(map(len, gone)) == r["n_removed"] and all(len(x) >= 200 for x in gone)


def test_repeats_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op11_suffix_repeats(spark, sf_dir).collect()
    want = dict(zip([r["doc_id"] for r in docs], plain_repeats([r["text"] for r in docs]), strict=True))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want


def test_repeats_of_odd_rows(spark):
    assert repeats.repeated_spans(none(spark)).collect() == []
    texts = [r[1] for r in odd_rows()]
    rows = repeats.repeated_spans(odd(spark)).collect()
    got = sorted((r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in rows)
    assert got == sorted(plain_repeats(texts))


# Merkle


def plain_levels(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_siblings(levels: list[list[str]], i: int) -> str:
    out = ""
    for level in levels[:-1]:
        first = i - i % 8
        out += "".join(x for j, x in enumerate(level[first : first + 8], first) if j != i)
        i //= 8
    return out


def plain_leaf(row, lower: bool = False) -> str:
    values = [row[c] for c in merkle.FIELDS]
    if lower and values[-1] is not None:
        values[-1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[-1])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows) -> dict[tuple, list[tuple]]:
    """(doc_id, leaf) to (subroot, root, digest of the proof)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[lang] = plain_levels([plain_leaf(r) for r in groups[lang]])
    top = plain_levels([trees[x][-1][0] for x in order])
    out = defaultdict(list)
    for k, lang in enumerate(order):
        for i, r in enumerate(groups[lang]):
            proof = sha(plain_siblings(trees[lang], i) + plain_siblings(top, k))
            out[r["doc_id"], plain_leaf(r)].append((trees[lang][-1][0], top[-1][0], proof))
    return {k: sorted(v) for k, v in out.items()}


def check_manifest(spark, docs):
    found = defaultdict(list)
    for r in merkle.proofs(merkle.manifest(docs)).select("doc_id", "leaf", "subroot", "root", merkle.digest(F.col("proof")).alias("p"), merkle.folded(F.col("leaf"), F.col("proof")).alias("f")).collect():
        assert r["f"] == r["root"]
        found[r["doc_id"], r["leaf"]].append((r["subroot"], r["root"], r["p"]))
    assert {k: sorted(v) for k, v in found.items()} == plain_manifest(docs.collect())


def test_manifest_of_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_manifest(spark, docs)
    plain = {r["doc_id"]: r for r in docs.collect()}
    for r in queries.op12_merkle_manifest(spark, sf_dir).collect():
        row = plain[r["doc_id"]]
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and plain_leaf(row, lower=True) != r["leaf"]
        assert r["verified"] == (r["folded_root"] == r["root"]) == (not changed)


def test_manifest_of_odd_rows(spark, monkeypatch):
    assert merkle.proofs(merkle.manifest(none(spark))).collect() == []
    check_manifest(spark, odd(spark))
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    sizes = {None: 1, "": 2, "a": 8, "b": 9, "cc": 64, "d": 65, "é": 513, "z1": 600, **{f"one{i}": 1 for i in range(30)}}
    rows = [(n % 200 if lang == "z1" else n, f"text {n % 50} A", lang, None, n) for lang, size in sizes.items() for n in range(size)]
    random.Random(2).shuffle(rows)
    check_manifest(spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"))


# Alignment


def spans_of(ids, pieces):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(pieces[i]), i))
        at += len(pieces[i])
    return out


def plain_alignment(texts: list[str | None]) -> list[tuple]:
    a = Tokenizer.from_file(BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces = alignment.byte_pieces(BYTE_LEVEL), alignment.marked_pieces(b)
    own, held = [], Counter()
    for text in texts:
        ids = (a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or ""))
        raw = (" " + (text or "")).encode()
        if not text or any(b"".join(p[i] for i in side) != raw for p, side in zip(pieces, ids, strict=True)):
            own.append(None)
            continue
        sides = [spans_of(side, p) for p, side in zip(pieces, ids, strict=True)]
        links, groups, i, j, at = [], [], 0, 0, 0
        for low, high, x in sides[0]:
            links += [(x, y) for start, end, y in sides[1] if max(low, start) < min(high, end)]
        for cut in sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]}):
            parts = [[x for s, e, x in side if s >= at and e <= cut] for side in sides]
            groups.append("|".join(",".join(map(str, p)) for p in parts))
            at = cut
        own.append((len(ids[0]), len(ids[1]), groups, links))
        held.update(set(links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for found in own:
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        best = sum(held[x] == most[x[0]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, sum(held[x] for x in links), sha(";".join(groups))))
    return out


SIGNS = ["a", "b", "ing", " ", " ", "  ", "\n", "\t", "'s", "12", ".", "é", "\xa0", "ｘ", " ", "日", "▁", "<s>", "<0x41>", "\x85", "\x1c", "<|endoftext|>", "\U0001f600"]
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("limit", (0, 40, alignment.MAX_FREQUENT))
def test_alignment_is_that_of_whole_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(alignment, "LINE", 3)
    rnd = random.Random(3)
    texts = [None, "", " ", "  ", "a ", " a", "a  ", "x" * 3000 + " y", "Plain words are here, and more words.", "naïve café\nnew line"]
    texts += ["".join(rnd.choice(SIGNS[: rnd.choice((9, 12, len(SIGNS)))]) for _ in range(rnd.randrange(1, 25))) for _ in range(300)]
    texts += [" ".join(rnd.choice(("some", "words", "of", "theirs,", "12", "tokenization.")) for _ in range(30)) for _ in range(20)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    rows = alignment.alignment(docs, BYTE_LEVEL, PIECES, limit).collect()
    assert {r["doc_id"]: tuple(r[c] for c in MEASURES) for r in rows} == dict(enumerate(plain_alignment(texts)))


def test_alignment_of_odd_rows(spark):
    assert alignment.alignment(none(spark), BYTE_LEVEL, PIECES).collect() == []
    rows = odd_rows()
    texts = [r[1] for r in rows if r[0] != 5]
    got = alignment.alignment(odd(spark), BYTE_LEVEL, PIECES).collect()
    assert len(got) == len(rows)
    with_long = alignment.alignment(odd(spark).where("doc_id is null or doc_id <> 5"), BYTE_LEVEL, PIECES).collect()
    assert sorted(tuple(r[c] for c in MEASURES) for r in with_long) == sorted(plain_alignment(texts))
