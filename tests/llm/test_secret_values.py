"""Values after credential words: short ones, of one class, beyond ASCII, and cheap ones."""

import random
import string

import pytest

from tidemark.llm import secrets

ALNUM = string.ascii_letters + string.digits


def values(text):
    raw = text.encode()
    return [raw[x[3] : x[4]].decode() for x in secrets.find(raw) if x[0] == "guess"]


def drawn(letters, n, count=300):
    r = random.Random(n)
    return ["".join(r.choices(letters, k=n)) for _ in range(count)]


@pytest.mark.parametrize("n, least", [(8, 0.95), (9, 0.98), (10, 0.99), (12, 1.0)])
def test_short_random_values_are_found(n, least):
    some = drawn(ALNUM, n)
    assert sum(values(f"pwd: {v} and more") == [v] for v in some) >= least * len(some)


def test_short_value_with_symbols():
    assert values("pwd: Zk7#vR2!") == ["Zk7#vR2!"]


def test_words_dates_and_walks_are_none():
    words = [w for w in secrets._ranks() if len(w) >= 8]
    r = random.Random(3)
    for w in r.sample(words, 200):
        assert not values(f"secret: {w.capitalize()}") and not values(f"auth: {w}-{r.choice(words)}")
        assert not values(f"token: {w}{r.randint(1950, 2030)}-0{r.randint(1, 9)}-{r.randint(10, 28)}")
    assert not values("pwd: qwertyuiop1234567890") and not values("secret: Understanding")


def test_long_repeats_are_cheap():
    for filler in ("aB" * 500, "x-" * 150, "=" * 3000, "password" * 200, "ab1" * 90 + "a"):
        assert secrets.guess_bits(filler) < secrets.BITS
    assert not values("token: " + "x-" * 150) and secrets.redact_text(b"pwd: " + b"aB" * 500) == b"pwd: " + b"aB" * 500


@pytest.mark.parametrize("letters", [string.ascii_lowercase, string.ascii_uppercase, string.digits])
def test_values_of_one_class_are_rated(letters):
    for v in drawn(letters, 24, 50):
        assert values(f"private_key: {v}\n") == [v] and values(f'"auth": "{v}", ') == [v]


def test_values_end_at_their_own_quote():
    assert values("""pwd: "Zk7'vR2!qX9" x""") == ["Zk7'vR2!qX9"]
    assert values("""pwd: 'Zk7"vR2!qX9' x""") == ['Zk7"vR2!qX9']
    assert values("auth=Zk7'vR2!qX9 x") == ["Zk7'vR2!qX9"]
    assert values("passphrase: Zk7évR2ßqX9 é") == ["Zk7évR2ßqX9"]
    assert b"vR2" not in secrets.redact_text("passphrase: 'Zk7évR2ßqX9'".encode())
