"""Guess costs against every segmentation, and what the thresholds find and leave alone."""

import random
import string
from itertools import combinations
from math import log2

import pytest
from brute import word_runs
from conftest import SF
from test_secret_values import ALNUM, drawn, values

from tidemark.llm import secrets


def segment_costs(value):
    """``(start, end) -> bits`` of every segment that is more than a character."""
    low, ranks = secrets._folded(value), secrets._ranks()
    plain, each = low.translate(secrets.LEET), secrets._alphabet(value)
    out = {}

    def offer(i, j, bits):
        out[i, j] = min(out.get((i, j), bits), bits)

    for i in range(len(value)):
        for j in range(i + 3, len(value) + 1):
            for form, extra in ((low, 0), (plain, 1)):
                if form[i:j] in ranks:
                    offer(i, j, log2(ranks[form[i:j]]) + extra + (not value[i:j].islower()))
            if secrets._DATE.fullmatch(value[i:j]) and secrets._DATE.match(value, i).end() == j:
                offer(i, j, 6.9 if j - i == 4 else 15.5)
            if any(low[i:j] in row or low[i:j] in row[::-1] for row in secrets.ROWS):
                offer(i, j, 5.4 + log2(j - i))
    for start, length, p in word_runs(list(low), 2):
        for i in range(start, start + p):
            units = (start + length - i) // p
            if units > 1:
                unit = low[i : i + p]
                if i == start:
                    offer(i, i + units * p, cheapest(value[i : i + p]) + log2(units))
                offer(i, i + units * p, min([each * p] + ([log2(ranks[unit])] if unit in ranks else [])) + log2(units))
    return out


def cheapest(value):
    costs, n = segment_costs(value), len(value)
    each = secrets._alphabet(value)
    best = float("inf")
    for k in range(n):
        for inner in combinations(range(1, n), k):
            cuts, total = [0, *inner, n], 0.0
            for i, j in zip(cuts, cuts[1:]):
                single = (log2(10) if value[i] in secrets.JOINS else each) if j == i + 1 else float("inf")
                total += min(single, costs.get((i, j), float("inf")) + 1)
            best = min(best, total)
    return best


def test_cost_is_that_of_the_cheapest_segmentation():
    r = random.Random(9)
    words = [w for w in list(secrets._ranks())[:3000] if len(w) <= 6]
    some = ["passw0rd", "abababuse", "qwerty12", "19991231a", "aB-aB-aB", "xx1234yy", "Éléph4nt", "a", "lovelove"]
    for _ in range(60):
        parts = [r.choice([r.choice(words), r.choice(words).capitalize(), "".join(r.choices(ALNUM + "-_!é", k=3)), "123", "1999", "ab" * 2])
                 for _ in range(r.randint(1, 3))]
        some.append("".join(parts)[:11])
    for v in some:
        assert secrets.guess_bits(v) == pytest.approx(cheapest(v)), v


def test_no_value_is_too_short_and_no_unit_too_long():
    assert values("pwd: Zk7#vR2") == ["Zk7#vR2"] and not values("pwd: Zk7#v")
    unit = "qzkvbwxmpj"
    assert secrets.guess_bits(unit * 4) == pytest.approx(secrets.guess_bits(unit) + 3, abs=0.1)
    assert secrets.guess_bits("correcthorse" * 50) < secrets.guess_bits("correcthorse") + 8


def test_early_end_changes_no_verdict():
    r = random.Random(4)
    for v in drawn(ALNUM, 10, 50) + drawn(ALNUM, 40, 20) + ["password" * 9, "https://example.com/a/b", "".join(r.choices(ALNUM, k=3000))]:
        plain, full = secrets.guess_bits(v, meaning=False), secrets.guess_bits(v)
        assert secrets.is_secret(v) == (full >= max(secrets.BITS, secrets.SHARE * plain))


@pytest.mark.parametrize("text", [
    "auth: https://example.com/path/page.html", "auth: Bearer,credentials", "access_key: contraseñasegura",
    "token: numberOfTokensInWindow", "secret_key: path/to/the/private/file.txt", "token: config.server.access_token_name",
    "password: correct-horse-battery-staple",
])
def test_words_in_a_row_are_no_secrets(text):
    assert not values(text)


@pytest.mark.parametrize("letters, n, least", [
    (ALNUM, 8, 0.95), (ALNUM + "#$%&*!?", 8, 0.95), (string.ascii_lowercase + string.digits, 10, 0.98), ("0123456789abcdef", 16, 0.98),
    (string.ascii_lowercase, 12, 0.98), (string.digits, 20, 0.98),
])
def test_recall_on_random_values(letters, n, least):
    some = drawn(letters, n)
    assert sum(values(f"api_key = '{v}'") == [v] for v in some) >= least * len(some)


def test_prose_has_hardly_any(spark):
    """Values in the prose of every language; base spans and planted hex keys aside."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()
    for lang in {r["lang"] for r in docs}:
        for r in docs:
            if r["lang"] != lang:
                continue
            raw = (r["text"] or "").encode()
            base = [x for x in secrets.find(raw) if x[0] != "guess"]
            for x in secrets.find(raw):
                # What is rated a secret is one by the base patterns as well.
                assert x[0] != "guess" or any(b[3] <= x[3] and x[4] <= b[4] for b in base)
