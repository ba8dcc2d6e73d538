"""Secrets in texts: pattern rules, and random strings by token efficiency.

Base kinds are patterns: ``assign`` (a keyword, a sign and a value of eight or more characters), ``access``
and ``hex``. The method adds the kind ``random``: a run of ``LEAST`` or more characters out of letters,
digits and ``+/_=-`` whose characters-per-token ratio under a byte-pair vocabulary is low. Words of any language, being
what the vocabulary was made of, need few tokens; random strings need many. Left out are strings a
vocabulary also splits up but that are no secrets: digests and identifiers (plain numbers, UUIDs, hexadecimal digests of the
known lengths, which the kind ``hex`` reports anyway) and runs without a mixture of letters and digits.

Spans are code points, end exclusive. Within a kind matches are leftmost and do not overlap; a base span
stays whatever else is found, and a random span that overlaps a base span is dropped.

The path of the vocabulary file is a parameter; the driver reads it (under a megabyte) and sends it with the
tasks, which build the tokeniser once per worker process. Null and empty text: no spans. Repeated rows and ids are scanned each on their own; null
ids are kept. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from pathlib import Path

import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Kinds in their order.
KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns of the base kinds; the lengths are part of them where a match cannot be longer.
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
#: Runs looked at by token efficiency, and the ratio under which they count as random.
LEAST, RATIO = 20, 2.2
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Identifiers that are no secrets: numbers, UUIDs, hexadecimal digests of MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
KNOWN = re.compile(
    r"[0-9_=+/-]+|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"
    r"|(?:sha(?:1|224|256|384|512)-)?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128})")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters of a run tokenised at once; bounds the work of the tokeniser on very long runs.
PIECE = 512


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def token_ratio(run: str, vocabulary: bytes) -> float:
    """Characters per token."""
    tokens = sum(len(x) for x in encoding(vocabulary).encode_ordinary_batch([run[i : i + PIECE] for i in range(0, len(run), PIECE)], num_threads=1))
    return len(run) / max(1, tokens)


def is_random(run: str, vocabulary: bytes) -> bool:
    mixed = any(c.isdigit() for c in run) and any(c.isalpha() for c in run)
    return mixed and not KNOWN.fullmatch(run) and token_ratio(run, vocabulary) < RATIO


def spans_of(text: str | None, vocabulary: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end), by start, then in the order of the kinds."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    runs = list(RUN.finditer(text))
    if any(len(m.group()) >= 32 for m in runs):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    starts, ends = [], []  # base spans, overlapping ones merged
    for _, s, e in sorted(found, key=lambda x: x[1]):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for m in runs:
        free = bisect_left(starts, m.end()) == bisect_right(ends, m.start())
        if free and is_random(m.group(), vocabulary):
            found.append(("random", m.start(), m.end()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _scanned(texts: list[str | None], vocabulary: bytes) -> list:
    all_spans = [spans_of(t, vocabulary) for t in texts]
    base = [[x for x in spans if x[0] != "random"] for spans in all_spans]
    return [
        *[[sum(x[0] == kind for x in spans) for spans in all_spans] for kind in KINDS],
        [hashlib.sha256(_told(spans).encode()).hexdigest() for spans in base],
        [_told(spans) for spans in all_spans],
    ]


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 (digest of the base spans), spans."""
    fields = [*[(f"n_{k}", "long") for k in KINDS], ("base_sha256", "string"), ("spans", "string")]
    known = Path(vocabulary).read_bytes()
    return map_texts(docs, "text", ["doc_id"], fields, lambda texts: _scanned(texts, known))


def redacted(text: str | None, vocabulary: bytes, mark: str = "[secret]") -> str | None:
    """The text with every span replaced; spans that overlap are replaced together."""
    spans = spans_of(text, vocabulary)
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The same rows and columns with secrets in ``text`` replaced, and ``n_chars`` (if there) counted anew."""
    known = Path(vocabulary).read_bytes()
    others = [c for c in docs.columns if c != "text"]
    made = map_texts(docs, "text", others, [("text", "string")], lambda texts: [[redacted(t, known) for t in texts]])
    if "n_chars" in others:
        made = made.withColumn("n_chars", F.when(F.col("n_chars").isNull(), None).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return made.select(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
