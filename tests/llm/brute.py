"""Plain versions of the operators' contracts, over lists of rows, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def repeats_removed(rows, size=13):
    """op3: rows of doc_id, text."""
    words = [SPACE_WORDS.findall(t or "") for _, t in rows]
    first: dict[tuple, int] = {}
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), sha(kept)))
    return out


def contaminated(rows, items, size=10):
    """op5: rows of doc_id, text and of item_id, text."""
    windows: dict[tuple, set] = defaultdict(set)
    for item, text in items:
        w = PLAIN_WORDS.findall((text or "").translate(LOWER))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w = PLAIN_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= owners
        names = ",".join(sorted(str(x) for x in found))
        out.append((doc, len(w), len(hit), len(found), sha(names), bool(hit)))
    return out


def bytes_removed(rows, size=400):
    """op6: rows of doc_id, text."""
    texts = [(t or "").encode() for _, t in rows]
    seen: Counter = Counter()
    for t in texts:
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] += 1
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\x01" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((doc, len(t), sum(gone), spans, sha(kept)))
    return out


def simhashes(rows):
    out = []
    for doc, text in rows:
        w = SPACE_WORDS.findall((text or "").translate(LOWER))
        grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        out.append((doc, value))
    return out


def near_duplicate_classes(rows, bits=4):
    """op7: rows of doc_id, text."""
    prints = simhashes(rows)
    distinct = sorted({v for _, v in prints})
    parent = {v: v for v in distinct}

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for doc, v in prints:
        if doc is not None:
            least[root(v)] = min(least.get(root(v), doc), doc)
    return [(doc, f"{v:016x}", least.get(root(v))) for doc, v in prints]


def secret_spans(rows):
    """op9: the base kinds of rows of doc_id, text."""
    kinds = [
        ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 12, 2),
        ("access", re.compile("AKIA[A-Z0-9]+"), 18, 0),
        ("hex", re.compile("[0-9a-f]+"), 16, 0),
    ]
    out = []
    for doc, text in rows:
        spans = []
        for order, (kind, pattern, least, group) in enumerate(kinds):
            for m in pattern.finditer(text or ""):
                if len(m.group(group)) >= least:
                    spans.append((m.start(), order, kind, m.end()))
        spans.sort()
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        out.append((doc, *counts, sha(base), base))
    return out


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def license_phrases(rows):
    """op10: the base part of rows of doc_id, text."""
    out = []
    for doc, text in rows:
        w = PLAIN_WORDS.findall((text or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        first, last = (min(places), max(places)) if places else (None, None)
        out.append((doc, len(w), len(places), first, last, ",".join(sorted(labels))))
    return out


def word_runs(words, least=12):
    """(start, length, period) of every run, by comparing all words one period apart."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def runs_collapsed(rows):
    """op11: rows of doc_id, text."""
    out = []
    for doc, text in rows:
        words = SPACE_WORDS.findall(text or "")
        n = len(words)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = word_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(((-length, s, q) for s, length, q in runs), default=None)
        shown = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(runs), *shown, sha(lines), sha(kept)))
    return out


def mixture(rows, weights=(5, 2, 1), seed=12):
    """op12: rows of doc_id, text, source; shares are handed out round by round."""
    docs = []
    for doc, text, source in rows:
        size = len(SPACE_WORDS.findall(text or ""))
        digest = hashlib.md5(f"{'' if doc is None else f'{doc}:'}{seed}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2**52
        marks = len(re.findall(r"[\x21-\x40\x5B-\x60\x7B-\x7E]", text or ""))
        quality = max(0.05, 1 - marks / len(text) if text else 0.0)
        docs.append((source, -math.log(u) / quality, doc, size))
    sizes = Counter()
    for source, _, _, size in docs:
        sizes[source] += size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, free, left = {s: 0.0 for s in order}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    out = []
    for source in order:
        epochs = min(2, int(target[source] // sizes[source])) if sizes[source] else 0
        rest = math.floor(target[source] - epochs * sizes[source])
        for _, _, doc, size in sorted((d for d in docs if d[0] == source), key=lambda d: (d[1], d[2] is not None, d[2] or 0, d[3])):
            part = min(size, rest)
            rest -= part
            out.append((doc, size, sizes[source], target[source], epochs * size + part))
    return out
