"""Secret scanning: fixed patterns, and guess costs of values in a credential context.

The base patterns find assignments, access keys and runs of hex digits. Beyond them, the
value after any credential word is rated by how many guesses it would take: the cheapest
segmentation into dictionary words, dates, repeats, keyboard walks and brute-force
characters, found by dynamic programming over its positions. A value is a secret of kind ``guess``
if that takes enough guesses, and if it is not much cheaper than trying its characters one
by one: addresses, paths and identifiers made of words are long, not random. No value is too short
or too long to be rated.

Null and empty texts hold none. Each row gets a row, whatever its id.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from math import inf, log2

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import bytes_of, slices, texts_of
from tidemark.llm.periods import word_runs

KINDS = ("assign", "access", "hex", "guess")
# Bits of guessing that make a value a secret, and the least share they have in those of its characters alone. At 36, of 400 random values each, 98% of
# 8 letters of both cases and digits are found, 84% of 8 small letters and digits, 61% of 8 small letters, and of 400 each no
# word, two words joined, word with date or walk; at 38 it is 94, 70 and 0%, at 45 49, 0 and 0%.
BITS = 36.0
SHARE = 0.7
MARK = b"[SECRET]"

# The base patterns and their least lengths.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Credential words, common parts of passwords by falling frequency, keyboard rows.
# A value ends at white space, or at its own quote if it has one; bytes beyond ASCII belong to it.
CONTEXT = re.compile(
    rb"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|(?:api|access|private|secret)[_-]?key)"""
    rb"""["']?\x20*[:=]\x20*(?:"([^"\x00-\x20\x7F]+)"|'([^'\x00-\x20\x7F]+)'|["']?([^"\x00-\x20\x7F]+))""",
    re.I,
)
CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"auth", b"key")
WORDS = (
    "password pass admin welcome login letmein master dragon monkey shadow sunshine princess football baseball "
    "iloveyou superman batman trustno hello freedom whatever secret user test guest root default changeme example "
    "sample demo dummy your here key token api value string none null true false summer winter spring autumn "
    "january february march april may june july august september october november december monday friday "
    "love money god sex home work office server data system company public private access account the and you"
).split()
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("4@310$57!", "aaeiossti")

VOCABULARY = "word_bpe_49k.json"
# Characters that join words cost as much as ten choices.
JOINS = "-_./:"
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
_WALKS = {row[i : i + 3] for line in ROWS for row in (line, line[::-1]) for i in range(len(row) - 2)}


@cache
def _ranks() -> dict[str, int]:
    """Words of three letters or more by falling frequency: the common parts of passwords, then the
    whole words of the tokenizer's vocabulary, whose ids follow their frequency. About 32,000."""
    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    ended = [w.removesuffix("</w>") for w in sorted(ids, key=ids.get) if w.endswith("</w>")]
    words = dict.fromkeys([*WORDS, *(w for w in ended if len(w) > 2 and w.isascii() and w.isalpha())])
    return {word: rank for rank, word in enumerate(words, start=2)}


@cache
def _longest() -> int:
    return max(map(len, _ranks()))


def _kind(c: str) -> int:
    if not c.isascii():
        return 100
    return 10 if c.isdigit() else 26 + c.isupper() if c.isalpha() else 33


def _alphabet(value: str) -> float:
    """Bits of one character out of the classes that the value has: 26 lower, 26 upper, 10, 33, and 100 beyond ASCII."""
    return log2(sum(min(k, 26) if k < 33 else k for k in {_kind(c) for c in value if c not in JOINS}) or 33)


def _folded(value: str) -> str:
    """In lower case and without accents, one character for each."""
    return "".join(f[0] if len(f := unicodedata.normalize("NFD", c).lower()) and f[0].isascii() else c for c in value)


def _repeats(low: str) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all stretches of two units or more, however long, with their least period."""
    (runs,) = word_runs([list(low)], 2)
    return [(start, start + length, period) for start, length, period in runs.tolist()]


def _meanings(value: str, low: str, plain: str, i: int) -> Iterator[tuple[int, float]]:
    """Ends and bits of the words, dates and walks that begin at a place."""
    n, ranks = len(value), _ranks()
    for j in range(i + 3, min(n, i + _longest()) + 1):
        for form, extra in ((low, 0.0), (plain, 1.0)):
            if form[i:j] in ranks:
                case = 0.0 if value[i:j].islower() else 1.0
                yield j, log2(ranks[form[i:j]]) + extra + case
                break
    if m := _DATE.match(value, i):
        yield m.end(), 6.9 if m.end() - i == 4 else 15.5
    j = i + 3
    while j <= n and low[j - 3 : j] in _WALKS:
        yield j, 5.4 + log2(j - i)
        j += 1


def guess_bits(value: str, limit: float = inf, meaning: bool = True) -> float:
    """Bits of the cheapest way to guess the value; one more for each further segment.

    Without ``meaning`` there are no words, dates and walks: characters and repeats only.

    Ends with what the first characters take where that is the ``limit`` already and no segment
    reaches beyond them, since whatever follows only adds to it.
    """
    n, low = len(value), _folded(value)
    plain, ranks = low.translate(LEET), _ranks()
    each = _alphabet(value)
    # A repeat begins at any place of its unit and takes all whole units. The unit where it first begins is
    # rated like a value; elsewhere it may be a word.
    repeats: dict[int, list[tuple[int, float]]] = {}
    for start, end, p in _repeats(low):
        for i in range(start, min(start + p, end - 2 * p + 1)):
            last = i + (end - i) // p * p
            unit = low[i : i + p]
            bits = min(each * p, log2(ranks[unit]) if meaning and unit in ranks else each * p)
            if i == start:
                bits = min(bits, guess_bits(value[i : i + p], meaning=meaning))
            repeats.setdefault(i, []).append((last, bits + log2((last - i) / p)))
    best = [0.0] + [inf] * n
    reach = 0
    for i in range(n):
        if i >= reach and best[i] >= limit:
            return best[i]
        best[i + 1] = min(best[i + 1], best[i] + (log2(10) if value[i] in JOINS else each))
        ends = repeats.get(i, [])
        if meaning:
            ends += _meanings(value, low, plain, i)
        for j, bits in ends:
            best[j] = min(best[j], best[i] + bits + 1)
            reach = max(reach, j)
    return best[n]


def is_secret(value: str, bits: float = BITS, share: float = SHARE) -> bool:
    if len(value) * max(_alphabet(value), log2(10)) < bits:
        return False
    # What has words in it must not be cheap for its length.
    plain = guess_bits(value, meaning=False)
    least = max(bits, share * plain)
    return plain >= bits and guess_bits(value, least) >= least


_HEX_MAP = bytes(1 if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_HEX_RUN = b"\x01" * 16


def find(text: bytes, bits: float = BITS) -> list[tuple[str, int, int, int, int]]:
    """``(kind, start, end, value start, value end)`` in bytes, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", *m.span(), *m.span(2)))
    if b"AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if _HEX_RUN in text.translate(_HEX_MAP):
        found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    if any(w in low for w in CONTEXT_WORDS):
        for m in CONTEXT.finditer(text):
            group = m.lastindex
            value = m.group(group)
            if group == 3:
                value = value.rstrip(b".,;:)]}'")
            shown = value.decode("utf-8", "replace")
            if is_secret(shown, bits):
                end = m.start(group) + len(value)
                found.append(("guess", m.start(group), end, m.start(group), end))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _points(text: bytes, offsets: list[int]) -> dict[int, int]:
    """Code points before each byte offset."""
    out, last, points = {}, 0, 0
    for o in sorted(set(offsets)):
        points += len(text[last:o].decode("utf-8", "replace"))
        out[o], last = points, o
    return out


def scan(docs: DataFrame, bits: float = BITS) -> DataFrame:
    """``doc_id``, counts of the base kinds, digest of the base spans, and all spans, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts: list[list[int]] = [[], [], []]
                digests, spans = [], []
                for text in texts_of(part):
                    found = find(text, bits)
                    at = _points(text, [o for x in found for o in x[1:3]]) if found else {}
                    named = [(x[0], f"{x[0]}:{at[x[1]]}:{at[x[2]]}") for x in found]
                    for k in range(3):
                        counts[k].append(sum(x[0] == KINDS[k] for x in found))
                    base = ",".join(s for kind, s in named if kind != "guess")
                    digests.append(hashlib.sha256(base.encode()).hexdigest())
                    spans.append(",".join(s for _, s in named))
                yield pa.record_batch(
                    [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(spans)],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return bytes_of(docs, "doc_id").mapInArrow(
        run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redact_text(text: bytes, bits: float = BITS) -> bytes:
    """The text with the values of its secrets replaced by a mark, until none is left."""
    while found := find(text, bits):
        out, last = [], 0
        for start, end in sorted((x[3], x[4]) for x in found):
            if start >= last:
                out += [text[last:start], MARK]
            last = max(last, end)
        text = b"".join([*out, text[last:]])
    return text


def redact(docs: DataFrame, bits: float = BITS) -> DataFrame:
    """All documents, the values of their secrets replaced; ``n_chars`` follows where it is a column."""
    names = docs.columns
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    at = names.index("text")
    size = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                columns = list(part.columns)
                old = columns[at].to_pylist()
                new = [t if t is None else redact_text(t.encode(), bits).decode() for t in old]
                columns[at] = pa.array(new, columns[at].type)
                if size is not None:
                    lengths = columns[size].to_pylist()
                    lengths = [n if a == b else len(b) for n, a, b in zip(lengths, old, new)]
                    columns[size] = pa.array(lengths, columns[size].type)
                yield pa.record_batch(columns, names)

    return docs.mapInArrow(run, kinds)
