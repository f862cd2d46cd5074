"""Secret scans: an Aho-Corasick pass over keywords, anchored patterns at its hits, checksums at the end.

One automaton finds all keywords of a text in one pass. A pattern is tried only where its keyword stands,
anchored at the hit. Since no keyword of a kind holds another, hits come in order of their starts, and
skipping hits inside the last match gives exactly the leftmost non-overlapping matches of a full scan.

Kinds. `assign`, `access` and `hex` are plain patterns (hex runs have no keyword and are scanned for).
Added kinds must pass a check that is part of the secret: `github` and `npm` tokens end in the CRC-32 of
their body in base 62; `xprv` extended keys are Base58Check (double SHA-256); `age` keys are Bech32; `pem`
private keys are base64 of a DER sequence that is as long as its header says, or an OpenSSH key.

Defined results: null and empty texts have no secrets; each row has its own result, whatever its doc_id.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.shared import small_batches

#: Patterns and keywords by kind, in the order in which spans at one place are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
AGE = re.compile(r"AGE-SECRET-KEY-1([QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58})(?![0-9A-Z])")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----([A-Za-z0-9+/=\s]*)-----END \1PRIVATE KEY-----")
KINDS = ("assign", "access", "hex", "github", "npm", "xprv", "age", "pem")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "xprv": ("xprv",),
    "age": ("age-secret-key-1",),
    "pem": ("-----begin ",),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def base62_crc(body: str) -> str:
    """The CRC-32 of a token's body as six digits in base 62."""
    n, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = BASE62[d] + digits
    return digits


def base58_sound(text: str) -> bool:
    """Whether the last four bytes are the double SHA-256 of what stands before."""
    n = 0
    for c in text:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes(82, "big") if n >> 656 == 0 else b""
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:] if raw else False


def bech32_sum(human: str, data: str) -> int:
    """The Bech32 checksum state of a lower-case human part and data; 1 if they belong together."""
    values = [ord(c) >> 5 for c in human] + [0] + [ord(c) & 31 for c in human] + [BECH32.index(c) for c in data]
    state = 1
    for v in values:
        top = state >> 25
        state = (state & 0x1FFFFFF) << 5 ^ v
        for i, step in enumerate(BECH32_STEPS):
            state ^= step if top >> i & 1 else 0
    return state


def der_sound(text: str) -> bool:
    """Whether base64 text is one DER sequence of the length in its header, or an OpenSSH key."""
    try:
        raw = base64.b64decode("".join(text.split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(b"openssh-key-v1\0"):
        return True
    if len(raw) < 4 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    size = raw[1] & 0x7F
    return 0 < size <= 4 and len(raw) == 2 + size + int.from_bytes(raw[2 : 2 + size], "big")


#: Of each keyword kind: its pattern, and what a match must pass.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 12),
    "access": (ACCESS, lambda m: len(m[0]) >= 18),
    "github": (GITHUB, lambda m: base62_crc(m[1]) == m[2]),
    "npm": (NPM, lambda m: base62_crc(m[1]) == m[2]),
    "xprv": (XPRV, lambda m: base58_sound(m[0])),
    "age": (AGE, lambda m: bech32_sum("age-secret-key-", m[1].lower()) == 1),
    "pem": (PEM, lambda m: der_sound(m[2])),
}

_automaton: list[ahocorasick.Automaton] = []


def _keywords() -> ahocorasick.Automaton:
    if not _automaton:
        made = ahocorasick.Automaton()
        for kind, texts in KEYWORDS.items():
            for text in texts:
                made.add_word(text, (kind, len(text)))
        made.make_automaton()
        _automaton.append(made)
    return _automaton[0]


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, by start and then in the order of KINDS; code points, end exclusive."""
    lower = text.encode().lower().decode()  # changes A-Z alone, so places stay
    free = dict.fromkeys(RULES, 0)
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for last, (kind, length) in _keywords().iter(lower):
        start = last - length + 1
        if start < free[kind]:
            continue
        pattern, sound = RULES[kind]
        if m := pattern.match(text, start):
            free[kind] = m.end()
            if sound(m):
                spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
    for batch in batches:
        found = [[{"start": a, "end": b, "kind": k} for a, b, k in scan(t.as_py() or "")] for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "secrets"])


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets) for each row of docs (doc_id, text): an array of (start, end, kind)."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(_scanned, "doc_id bigint, secrets array<struct<start: bigint, end: bigint, kind: string>>")
