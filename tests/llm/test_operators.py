"""Operators against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermill.llm import lsa, minmax, mixture, queries, rules, secrets, shards, simple8b, suffix_tree
from ledgermill.llm.components import connected
from ledgermill.llm.words import one_hash, slices, words
from tests.llm.cases import random_texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts, schema="doc_id bigint, text string"):
    return spark.createDataFrame(list(enumerate(texts)), schema)


# Words


@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), max_size=8), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(texts, limit):
    column, found = pa.array(texts, pa.string()), []
    for part in slices(column, limit):
        w = words(part)
        spans = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]
        assert w.hashes().tolist() == [one_hash(s) for s in spans]
        found += [spans[a:b] for a, b in zip(w.first_of[:-1], w.first_of[1:], strict=True)]
    assert found == [[x.encode().lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]


# Simple-8b


@given(st.lists(st.integers(0, 2**64 - 1), max_size=400), st.integers(0, 64))
@settings(max_examples=200, deadline=None)
def test_ids_come_back(ids, shift):
    ids = np.array(ids, np.uint64) >> np.uint64(min(shift, 63))
    ids = np.tile(ids, 9)
    assert (simple8b.decode(*simple8b.encode(ids), len(ids)) == ids).all()
    docs, lengths, again = simple8b.unpack(simple8b.pack([None, 7], [len(ids), 0], ids))
    assert docs == [None, 7] and lengths.tolist() == [len(ids), 0] and (again == ids).all()


def test_damage_is_noticed():
    payload = bytearray(simple8b.pack([1], [3], np.array([5, 6, 7], np.uint64)))
    payload[-3] ^= 1
    with pytest.raises(ValueError):
        simple8b.unpack(bytes(payload))


def test_ids_are_those_of_whole_texts(spark):
    texts = ["Hello, WORLD! it's don't... 3.14 x.y, é, café. ΑΣ. o'clock,", "", None, "a<|endoftext|>b <|startoftext|>, ***. **.", "Źä. é,  x y.\u0085", *random_texts(1, 60)]
    texts += [" ".join(texts[5:25])] * 2
    tokenizer, start = Tokenizer.from_file(TOKENIZER), 0
    got = {r["doc_id"]: r for r in simple8b.read_digests(simple8b.write_ids(frame(spark, texts), TOKENIZER)).collect()}
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_words_before_signs_and_words_of_letters_are_encoded_once():
    texts = ["stung### ëä%%% Stung ËÄ, stung", "foo|> <|endoftext|> x<|endoftext|>### é<|startoftext|>. foo|", "ÀÖØÞß ÿ×÷ Ã\u0338 e\u0301### é' don't' 'S a's$ =\u0338", "É12## 12ÿ*** \u0130## µ## ª. ſ~~~~~"]
    whole, own = Tokenizer.from_file(TOKENIZER), simple8b.WordTokenizer(TOKENIZER)
    (part,) = slices(pa.array(texts[:1]))
    own.encode(part)
    assert len(own.known) == 6  # stung, ###, ëä, %%%, ËÄ and the comma; the signs are no part of a word
    own.forget()
    for some in ([t] for t in texts):
        (part,) = slices(pa.array(some))
        assert own.encode(part)[0].tolist() == whole.encode(some[0], add_special_tokens=False).ids
    assert own.plain.encode("andhathha").ids == whole.encode("Andhathha", add_special_tokens=False).ids


# Near duplicates


def components(texts, size, percent=80):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return [(len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("size", (4, 5))
def test_components_are_those_of_all_pairs(spark, size):
    texts = random_texts(size, 300) + ["A b  c", "a B c", "a b", None, "", "A\tb"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in minmax.near_duplicates(frame(spark, texts), size).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in enumerate(components(texts, size))}


def test_a_family_of_copies_that_straddle_the_threshold(spark):
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(120):
        ws = list(base)
        for j in range(i % 4):
            ws[(7 * i + 13 * j) % 60] = f"own{i}_{j}"
        texts.append(" ".join(ws))
    got = {r["doc_id"]: r["component_id"] for r in minmax.near_duplicates(frame(spark, texts)).collect()}
    assert got == {i: c for i, (_, c) in enumerate(components(texts, 5))}


def near_family(n):
    """Texts near one another, of which many are not linked with the first."""
    rng, base = np.random.default_rng(n), [f"b{i}" for i in range(90)]
    texts = []
    for i in range(n):
        ws = list(base)
        for j in rng.choice(90, i % 6, replace=False):
            ws[j] = f"own{i}_{j}"
        texts.append(" ".join(ws))
    return texts


@pytest.mark.parametrize("at_once", (128, 0))
def test_open_buckets_take_few_rounds(spark, monkeypatch, at_once):
    texts, rounds, confirm = near_family(240), [], minmax._confirm
    monkeypatch.setattr(minmax, "_AT_ONCE", at_once)
    monkeypatch.setattr(minmax, "_confirm", lambda *a: rounds.append(1) or confirm(*a))
    got = {r["doc_id"]: r["component_id"] for r in minmax.near_duplicates(frame(spark, texts), 4).collect()}
    assert got == {i: c for i, (_, c) in enumerate(components(texts, 4))}
    assert len(rounds) == 2 if at_once else 2 <= len(rounds) <= 3


def test_an_id_with_two_texts_joins_them(spark):
    texts = random_texts(3, 1, 40) + ["some other words that stand here for a while", "a third text of its own"]
    docs = spark.createDataFrame([(5, texts[0]), (3, texts[0]), (5, texts[1]), (9, texts[1]), (7, texts[2])], "doc_id bigint, text string")
    got = {(r["doc_id"], r["component_id"]) for r in minmax.near_duplicates(docs).collect()}
    assert got == {(5, 3), (3, 3), (9, 3), (7, 7)}


def test_min_and_max_estimate_without_bias():
    rng, shared = np.random.default_rng(0), []
    for _ in range(60):
        both, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (160, 20, 20))
        x, y = minmax.signature(np.r_[both, a]), minmax.signature(np.r_[both, b])
        shared.append((x == y).mean())
    assert abs(np.mean(shared) - 0.8) < 0.015


def test_sketches_keep_links_between_short_texts():
    rng = np.random.default_rng(3)
    for both, a, b in ((4, 1, 0), (8, 2, 0), (8, 1, 1), (12, 3, 0), (16, 2, 2), (32, 8, 0), (32, 4, 4)):
        for _ in range(150):
            own = rng.integers(0, 2**63, both + a + b, dtype=np.uint64)
            x, y = own[: both + a], np.r_[own[:both], own[both + a :]]
            for permutations, different in ((minmax.PERMUTATIONS, minmax.SKETCH_DIFFERENT), (minmax.FINE_BITS // 2, minmax.FINE_DIFFERENT)):
                apart = minmax.sketch(minmax.signature(x, permutations)) ^ minmax.sketch(minmax.signature(y, permutations))
                assert np.bitwise_count(apart).sum() <= different


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in connected(edges).collect()}
    assert got == {i: 0 for i in range(71)} | {100: 100, 101: 100}


# Suffix tree


@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 9), st.integers(2**64 - 9, 2**64 - 1)), max_size=60), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_places_of_keys(keys, n):
    known = np.array(keys[:n], np.uint64)
    asked = np.array([*keys, *(min(k + 1, 2**64 - 1) for k in keys)], np.uint64)
    hit, place = suffix_tree.Lookup(known)(asked)
    assert hit.tolist() == np.flatnonzero(np.isin(asked, known)).tolist()
    assert (np.unique(known)[place] == asked[hit]).all()


def test_a_lookup_is_sent_as_its_keys():
    known = suffix_tree.Lookup(np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64))
    sent = pickle.dumps(known)
    again = pickle.loads(sent)
    assert len(sent) < 9 * 5000 and sorted(vars(again)) == sorted(vars(known))
    assert all(np.array_equal(x, vars(known)[name]) for name, x in vars(again).items())


def test_runs_are_looked_up_after_contexts_that_may_be_retained():
    text, none, bitmap = "a b c a b", suffix_tree.Lookup(np.zeros(0, np.uint64)), np.zeros(suffix_tree.BITS // 64, np.uint64)
    part = next(slices(pa.array([text])))
    found = words(part)
    tokens, _, place = suffix_tree.sequence(found, found.hashes())
    keys = {}
    for k, at, context in suffix_tree.contexts(tokens, place, 3):
        keys[k] = set(context.tolist()), set(suffix_tree.run_of(context, tokens[at]).tolist())
    for key in set().union(*(runs for _, runs in keys.values()), keys[2][0]):
        bitmap[(key & (suffix_tree.BITS - 1)) >> 6] |= np.uint64(1 << (key & 63))

    class Model:
        value = (none, np.zeros(0), none, np.zeros(0), bitmap, 1, 9.0)

    batch = pa.RecordBatch.from_pydict({"row": [0], "doc_id": [0], "held_out": [False], "text": [text]})
    (out,) = suffix_tree._scorer(Model, 3)(iter([batch]))
    light = {x & (2**64 - 1) for x in out.column("light")[0].as_py()}
    assert keys[2][0] | keys[2][1] <= light and not light & (keys[1][1] | keys[3][1])


# Poisson mixture


def test_poisson_counts(spark):
    for rate in (0.0, 0.3, 1.0, 4.5, 2000.0):
        least, steps = mixture.poisson_steps(rate)
        u = (np.arange(200_000) + 0.5) / 200_000
        counts = least + np.searchsorted(steps, u, side="right") if steps else np.zeros(1)
        assert abs(counts.mean() - rate) < 0.01 * max(rate, 0.1)
        assert not steps or abs(counts.var() - rate) < 0.02 * max(rate, 0.1)


def test_sources_reach_their_weights(spark):
    rows = [(i, "x" * 100, f"s{i % 4}" if i % 3 else "hot") for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixture.mix(docs, {"hot": 0.1, "s0": 0.6}, 0.3).select("d.source", "d.doc_id", "copy", "place").collect()
    n = Counter(r["source"] if r["source"] in ("hot", "s0") else "rest" for r in out)
    for name, share in (("hot", 0.1), ("s0", 0.6), ("rest", 0.3)):
        assert abs(n[name] / 12_000 - share) < 0.02
    assert len({(r["doc_id"], r["copy"]) for r in out}) == len(out)
    assert [r["place"] for r in out] == sorted(r["place"] for r in out)


# Secrets


def plain_scan(text):
    out = [(m.start(), m.end(), "assign") for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), "access") for m in secrets.ACCESS.finditer(text) if len(m[0]) >= 18]
    return out + [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]


@given(st.lists(st.sampled_from(["token", "SECRET", "secret", "passwd", "api_key", "apiKEY", "=", ":", " ", '"', "'", "AKIA", "akia", "ABCDEFGHIJ0123", "0123456789abcdef", "é", "ſ", "İ", "x", "a.b", "\n", "K"]), max_size=25))
@settings(max_examples=400, deadline=None)
def test_base_spans_are_those_of_full_scans(parts):
    text = "".join(parts)
    assert sorted(plain_scan(text)) == sorted(s for s in secrets.scan(text) if s[2] in ("assign", "access", "hex"))


def test_checksums_decide():
    body = "0123456789ABCDEFGHIJKLMNOPQRST"
    good = f"ghp_{body}{secrets.base62_crc(body)}"
    assert (4, 44, "github") in secrets.scan(f"see {good}.")
    assert not [s for s in secrets.scan(f"see {good[:-1]}0.") if s[2] == "github"] or good.endswith("0")
    npm = f"npm_{body}{secrets.base62_crc(body)}"
    assert [s[2] for s in secrets.scan(npm)] == ["npm"]
    raw = bytes.fromhex("0488ade4") + bytes(range(74))
    n = int.from_bytes(raw + hashlib.sha256(hashlib.sha256(raw).digest()).digest()[:4], "big")
    key = ""
    while n:
        n, d = divmod(n, 58)
        key = secrets.BASE58[d] + key
    assert [s[2] for s in secrets.scan(key)] == ["xprv"]
    assert secrets.scan(key[:-1] + ("2" if key[-1] != "2" else "3")) == []
    data = "q" * 52
    checks = [c for c in (data + "".join(secrets.BECH32[i] for i in _polymod_digits(data)),) if secrets.bech32_sum("age-secret-key-", c) == 1]
    assert [s[2] for s in secrets.scan("AGE-SECRET-KEY-1" + checks[0].upper())] == ["age"]
    der = b"\x30\x03\x02\x01\x05"
    import base64

    pem = "-----BEGIN RSA PRIVATE KEY-----\n{}\n-----END RSA PRIVATE KEY-----"
    assert [s[2] for s in secrets.scan(pem.format(base64.b64encode(der).decode()))] == ["pem"]
    assert secrets.scan(pem.format(base64.b64encode(der + b"x").decode())) == []


def _polymod_digits(data):
    state = secrets.bech32_sum("age-secret-key-", data + "qqqqqq") ^ 1
    return [state >> 5 * (5 - i) & 31 for i in range(6)]


# Shards


def plain_schedule(sizes, n):
    """(size, shard) -> groups, one group at a time."""
    loads, got = [0] * n, Counter()
    for size in sorted(sizes, reverse=True):
        shard = loads.index(min(loads))
        loads[shard] += size
        got[size, shard] += 1
    return got


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 90)), max_size=12, unique_by=lambda x: x[0]), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_schedule_is_longest_first(sizes, n):
    placed = {(size, shard): k for size, got in shards.schedule(sizes, n) for shard, k in enumerate(got) if k}
    assert placed == plain_schedule([s for s, k in sizes for _ in range(k)], n)


@pytest.mark.parametrize("slot_rows", (shards.SLOT_ROWS, 7))
def test_placement_is_that_of_the_plain_schedule(spark, monkeypatch, slot_rows):
    monkeypatch.setattr(shards, "SLOT_ROWS", slot_rows)
    texts = random_texts(7, 900) + ["hot text"] * 300 + ["same size %03d" % i for i in range(200)]
    rows = shards.balanced(frame(spark, texts), shards=5, grain=8).collect()
    groups = Counter()
    for text, n in Counter(texts).items():
        groups[text] = n * (len(text.encode()) + 8)
    got = Counter((groups[t], s) for t, s in {(texts[r["doc_id"]], r["shard"]) for r in rows})
    assert len(rows) == len(texts) and got == plain_schedule(list(groups.values()), 5)


def test_groups_stay_together_and_slots_have_no_gaps(spark):
    texts = random_texts(5, 2000) + ["hot text"] * 700 + [None, ""]
    rows = shards.balanced(frame(spark, texts), shards=6, grain=64).collect()
    of_text, loads, slots = {}, Counter(), {}
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert of_text.setdefault(text, r["shard"]) == r["shard"]
        assert r["size"] == len(text.encode()) + 8 and r["text_crc32"] == zlib.crc32(text.encode())
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) - min(loads.values()) < 0.02 * max(loads.values())
    assert sorted(of_text) == sorted({t or "" for t in texts})


# Quality rules


def test_measures_are_those_of_the_definition(spark):
    texts = ["a b c a b c a b c.", "x y\nx y\n\nx y\n #a* |b| $%", "a a a a", "a b c d a b c d e a b", None, "one", "…é ü\r\n…é ü\r"]
    for r in rules.judged(frame(spark, texts)).collect():
        text = texts[r["d"]["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r["n_words"] == len(w) and r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(covered)


def test_failing_lines_go(spark):
    good = lambda i: " ".join(f"word{i}of{j}" for j in range(9)) + "."
    text = "\n".join(["Home | About us | Contact", good(1), "All rights reserved.", good(2), good(1), *(good(i) for i in range(3, 9))])
    kept = rules.clean(spark.createDataFrame([(1, text, len(text), "a")], "doc_id bigint, text string, n_chars bigint, d string")).first()
    assert kept["text"] == "\n".join(good(i) for i in range(1, 9)) and kept["n_chars"] == len(kept["text"]) and kept["d"] == "a"


def test_wrapped_prose_is_kept_and_a_filter_is_cheap(spark):
    rnd = np.random.default_rng(6)
    sentence = lambda: " ".join("".join(chr(97 + c) for c in rnd.integers(0, 26, rnd.integers(2, 10))) for _ in range(18)).capitalize() + "."
    texts = ["\n".join(" ".join(sentence() for _ in range(5)) for _ in range(6)) for _ in range(12)]
    wrapped = ["\n\n".join(textwrap.fill(p, 76) for p in t.split("\n")) for t in texts]
    junk = "\n\n".join("Some heading number %d" % i for i in range(30))
    rows = rules.judged(frame(spark, texts + wrapped + [junk])).where("kept").select("d.doc_id", "n_bad_lines").collect()
    assert {r["doc_id"]: r["n_bad_lines"] for r in rows} == dict.fromkeys(range(24), 0)


# Latent semantic retrieval


def items(n=150):
    rnd = np.random.default_rng(2)
    return [" ".join(f"t{x}" if x > 30 else f"c{x}" for x in np.minimum(rnd.zipf(1.4, k), 5000).tolist()) + "." for k in rnd.integers(14, 60, n)]


def test_copies_and_paraphrases_are_found_and_nothing_else(spark):
    rnd = np.random.default_rng(3)
    wanted, docs, base = set(), [], items()
    noise = lambda k: [f"c{x}" if x < 30 else f"n{rnd.integers(10**6)}" for x in np.minimum(rnd.zipf(1.4, k), 60).tolist()]
    for i in range(600):
        ws = noise(int(rnd.integers(5, 300)))
        if i % 3 == 0:
            own = base[i // 4 % len(base)].split()
            for _ in range(len(own) // 10 * (i % 2)):
                own[int(rnd.integers(len(own)))] = "changed"
            at = int(rnd.integers(len(ws)))
            ws[at:at] = own
            wanted.add((i, i // 4 % len(base)))
        docs.append(" ".join(ws).upper() if i % 5 == 0 else " ".join(ws))
    bench = spark.createDataFrame(list(enumerate(base)), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in lsa.leaks(frame(spark, docs), bench).collect()}
    assert len(wanted & got) >= 0.97 * len(wanted)
    assert not {d for d, _ in got} - {d for d, _ in wanted}


@pytest.mark.parametrize("scale", (1, 1500))
def test_recall_by_length_and_size_of_the_corpus(scale):
    """Copies of items of frequent words, in windows of frequent words; counts as a corpus `scale` times as large has."""
    rnd = np.random.default_rng(11)
    vocabulary = np.unique(np.array([one_hash(b"w%d" % i) for i in range(4000)], np.uint64))
    word_of = {one_hash(b"w%d" % i): b"w%d" % i for i in range(4000)}
    names = [word_of[int(h)] for h in vocabulary]
    held = np.minimum(3000 / np.arange(1, 4001) ** 0.7, 3000)[rnd.permutation(4000)]
    weights = np.log((10_000 * scale + 1) / (held * scale + 1)) + 1e-3
    odds = held / held.sum()
    draw = lambda k: [names[i] for i in rnd.choice(4000, k, p=odds)]
    items = [(k, draw(k)) for k in (5, 8, 12, 20, 30) for _ in range(100)]
    passages = [{"item_id": i, "text": b" ".join(ws).decode(), "low": 0, "high": k} for i, (k, ws) in enumerate(items)]
    blocks = []
    for b in range(0, len(passages), lsa.BLOCK):
        rows = passages[b : b + lsa.BLOCK]
        table = pa.Table.from_pylist([{"block": b, **r} for r in rows], pa.schema([("block", pa.int64()), ("item_id", pa.int64()), ("text", pa.string()), ("low", pa.int32()), ("high", pa.int32())]))
        r = lsa._factored(vocabulary, weights, lsa.RANK)(table).to_pylist()[0]
        blocks.append((r["words"], r["directions"], r["latent"], r["mass"], [tuple(p.values()) for p in r["passages"]]))
    model = lsa._Model(blocks, vocabulary, weights)
    wanted, texts, changed = [], [], []
    for i, (k, ws) in enumerate(items):
        for substituted in (False, True) if k >= 20 else (False,):
            own = list(ws)
            if substituted:
                for at in rnd.choice(k, k // 5, replace=False):
                    own[at] = b"substituted"
            host, at = draw(150), int(rnd.integers(0, 150))
            texts.append(b" ".join(host[:at] + own + host[at:]).decode())
            wanted.append((i, k, substituted))
    hit, tried = Counter(), Counter()
    part = next(iter(slices(pa.array(texts), 1 << 30)))
    seen, n = set(), 0
    for row, at, item_id, _, item in model.candidates(words(part)):
        n += 1
        if item_id == wanted[row][0] and item.share(texts[row].encode().split(), at):
            seen.add(row)
    for row, (_, k, substituted) in enumerate(wanted):
        tried[k, substituted] += 1
        hit[k, substituted] += row in seen
    assert all(hit[key] >= 0.97 * tried[key] for key in tried)


def test_leaks_are_those_of_all_pairs(spark):
    rnd = np.random.default_rng(12)
    odds = 1 / np.arange(1, 301) ** 0.7
    draw = lambda k: [f"t{x}" for x in rnd.choice(300, k, p=odds / odds.sum()).tolist()]
    base = [" ".join(draw(k)) for k in rnd.integers(8, 33, 40)]
    docs = []
    for i in range(120):
        ws = draw(60)
        if i % 2:
            own = base[i % 40].split()
            own[int(rnd.integers(len(own)))] = "changed"
            ws[i % 60 : i % 60] = own
        docs.append(" ".join(ws))
    wanted = set()
    for i, text in enumerate(docs):
        ws = text.encode().split()
        for j, item in enumerate(base):
            own = lsa._Item(item.encode(), 0, len(item.split()))
            if any(own.share(ws, at) for at in range(0, len(ws), lsa.STRIDE)):
                wanted.add((i, j))
    bench = spark.createDataFrame(list(enumerate(base)), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in lsa.leaks(frame(spark, docs), bench).collect()}
    assert len(wanted) >= 60 and got <= wanted and len(got) >= 0.97 * len(wanted)


def test_common_subsequence():
    rnd = np.random.default_rng(4)
    for _ in range(50):
        a, b = (rnd.integers(0, 6, n).tolist() for n in rnd.integers(1, 40, 2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        share = table[-1, -1] / len(a)
        assert lsa.Pattern(a).reaches(b, set(b), 0.0) == share
        assert lsa.Pattern(a).reaches(b, set(b), 0.5) == (share if share >= 0.5 else 0.0)


def test_randomised_directions_keep_the_matrix():
    rnd = np.random.default_rng(5)
    matrix = rnd.standard_normal((60, 12)) @ rnd.standard_normal((12, 300))
    v = lsa.factor(matrix, 20, 0)
    assert np.allclose(v.T @ v, np.eye(v.shape[1]), atol=1e-8) and np.allclose(matrix @ v @ v.T, matrix, atol=1e-6)


# Suffix tree


def test_base_scores_and_better_model(spark):
    texts = random_texts(6, 400) + ["the same line of words again and again"] * 60 + [None]
    train, tokens = Counter(), lambda t: [*(t or "").encode().lower().split(), b"\n"]
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    got = {r["doc_id"]: r for r in suffix_tree.scores(frame(spark, texts), limit=60).collect()}
    for i, t in enumerate(texts):
        ws = tokens(t)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(ws), sum(train[w] > 0 for w in ws), n)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(got[i]["base_score"], sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_distributions_sum_to_one(spark):
    texts = ["a b a b a b c", "a b a b c a", "b a b a", "c c a b"] * 30
    rows = frame(spark, texts).select("text", suffix_tree.F.lit(False).alias("held_out"))
    vocabulary = [b"a", b"b", b"c", b"\n"]
    counts = Counter(w for t in texts for w in [*t.encode().split(), b"\n"])
    n = sum(counts.values())
    root = {one_hash(w): (counts[w] + 1) / (n + 5) for w in vocabulary}
    counted = rows.mapInArrow(suffix_tree._counted(3, 1e-6), suffix_tree._COUNTED).where("kind = 2").groupBy("key", "note").agg(suffix_tree.F.sum("train").alias("train"))
    signed = lambda h: int(np.array([h], np.uint64).view(np.int64)[0])
    known = {signed(h): p for h, p in root.items()}
    tree = suffix_tree._grown(spark, rows, counted, lambda t: known[t], n, 3, 1e-6, 0.001)
    assert tree.retained > 2
    for before in ([b"a"], [b"a", b"b"], [b"c", b"a", b"b"], [b"b", b"b", b"b"], []):
        total = 0.0
        for w in [*vocabulary, b"unknown"]:
            sequence = np.array([suffix_tree.EDGE, *(one_hash(x) for x in [*before, w])], np.uint64)
            base = np.log10([root.get(int(x), 1 / (n + 5)) for x in sequence])
            total += 10 ** tree.log10(sequence, np.arange(len(sequence)), base, 3)[-1]
        assert math.isclose(total, 1, rel_tol=1e-6)


def test_the_outcome_does_not_depend_on_the_split(spark):
    texts = random_texts(8, 300)
    a, b = (sorted((r["doc_id"], round(r["score"], 6)) for r in suffix_tree.scores(frame(spark, texts).repartition(n), limit=40).collect()) for n in (1, 7))
    assert a == b


def test_runs_are_sent_by_their_tokens(spark):
    texts = random_texts(14, 60) + ["the same line of words again and again"] * 9
    rows, own = frame(spark, texts).select("text"), suffix_tree._tokens(3)
    everything = spark.sparkContext.broadcast([np.full(suffix_tree.BITS // 64, -1, np.int64).view(np.uint64)] * 3)
    sent = rows.mapInArrow(suffix_tree._learned(3, everything), f"k tinyint, {', '.join(f'{c} bigint' for c in own)}, n bigint")
    sent = sent.groupBy("k", *own).agg(suffix_tree.F.sum("n").alias("n"))
    for k in (1, 2, 3):
        expected, fingerprints = Counter(), Counter()
        for t in texts:
            ws = np.array([suffix_tree.EDGE, *(one_hash(w) for w in (t or "").encode().lower().split()), suffix_tree.EDGE], np.uint64)
            expected.update(tuple(ws[i - j] for j in range(k + 1)) for i in range(k, len(ws)))
            for j, *columns in suffix_tree._runs_of(ws, np.arange(len(ws)), k):
                if j == k:
                    fingerprints.update(zip(*(c.view(np.int64).tolist() for c in columns), strict=True))
        runs = sent.where(suffix_tree.F.col("k") == k)
        signed = lambda run: tuple(np.array(run, np.uint64).view(np.int64).tolist()) + (0,) * (3 - k)  # noqa: E731, B023
        assert {tuple(r[c] for c in own): r["n"] for r in runs.collect()} == {signed(run): n for run, n in expected.items()}
        named = runs.mapInArrow(suffix_tree._named(k), suffix_tree._RUNS).collect()
        assert {(r["key"], r["context"], r["up"], r["size"]): r["n"] for r in named} == fingerprints


@pytest.mark.parametrize("n_known", [0, 3, 100])
def test_counts_are_moved_packed(spark, n_known):
    texts = random_texts(15, 200) + ["the same line of words again and again"] * 9
    rows, own, expected = frame(spark, texts).select("text").repartition(3), suffix_tree._tokens(3), Counter()
    for t in texts:
        ws = [int(suffix_tree.EDGE), *(one_hash(w) for w in (t or "").encode().lower().split()), int(suffix_tree.EDGE)]
        for k in (1, 2, 3):
            expected.update(tuple(ws[i - j] for j in range(k + 1)) + (0,) * (3 - k) for i in range(k, len(ws)))
    words_ = sorted({w for run in expected for w in run} - {0, int(suffix_tree.EDGE)})[:n_known]
    known = spark.sparkContext.broadcast(suffix_tree.Lookup(np.array(words_, np.uint64)))
    everything = spark.sparkContext.broadcast([np.full(suffix_tree.BITS // 64, -1, np.int64).view(np.uint64)] * 3)
    got = suffix_tree._counts(rows, suffix_tree._learned(3, everything), own, 5, 4, known).collect()
    assert {tuple(r[c] % 2**64 for c in own): r["n"] for r in got} == {run: n for run, n in expected.items() if n >= 4}
    assert len(got) == sum(n >= 4 for n in expected.values()) > 20
    singles = suffix_tree._counts(rows, suffix_tree._candidates(2, spark.sparkContext.broadcast(everything.value[0])), ["key"], 7, 4).collect()
    assert sorted(r["n"] for r in singles) == sorted(n for run, n in expected.items() if n >= 4 and run[2] and not run[3])


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=30), min_size=1, max_size=4))
@settings(max_examples=100, deadline=None)
def test_packed_columns_come_back(columns):
    columns = [np.array(c, np.uint64) for c in columns]
    assert [c.tolist() for c in suffix_tree._unpack(suffix_tree._pack(columns))] == [c.tolist() for c in columns]


def test_rare_contexts_are_kept_whatever_the_corpus(spark):
    rnd = np.random.default_rng(12)
    noise = [" ".join(f"z{x}" for x in rnd.integers(0, 3000, 60)) for _ in range(900)]
    rare = ["quiet amber lantern beside harbour gates"] * 30
    texts = rare + noise
    got = suffix_tree.scores(frame(spark, texts), limit=20).collect()
    rows = frame(spark, texts).select("text", suffix_tree.held_out(suffix_tree.F.col("doc_id")).alias("held_out"))
    counts = Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t.encode().split(), b"\n"])
    n, total = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    signed = lambda h: int(np.array([h], np.uint64).view(np.int64)[0])
    known = {signed(one_hash(w)): (c + 1) / total for w, c in counts.items()}
    runs = rows.where("not held_out").mapInArrow(suffix_tree._counted(3, 1e-9), suffix_tree._COUNTED).where("kind = 2").select("key", "note").distinct()
    tree = suffix_tree._grown(spark, rows, runs, lambda t: known[t], n, 3, suffix_tree.LEAST / n, suffix_tree.DIVERGENCE)
    for r in got:
        ws = [suffix_tree.EDGE, *(one_hash(w) for w in texts[r["doc_id"]].encode().split()), suffix_tree.EDGE]
        sequence = np.array(ws, np.uint64)
        base = np.log10([known.get(signed(int(x)), 1 / total) for x in sequence])
        assert math.isclose(r["score"], tree.log10(sequence, np.arange(len(sequence)), base, 3)[1:].sum(), rel_tol=1e-9)
        assert r["n_contexts"] == tree.retained
    assert all(r["score"] > r["base_score"] + 10 for r in got if r["doc_id"] < len(rare))


# Queries


def test_queries_have_their_columns(spark, sf_dir):
    columns = {
        "op2": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op8": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op9": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op10": "doc_id size text_crc32 law shard slot grown_shard",
    }
    for name, query in queries.queries().items():
        if name.split("_")[0] in columns:
            assert set(columns[name.split("_")[0]].split()) <= set(query(spark, sf_dir).columns)
