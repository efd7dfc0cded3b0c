"""Notices wrapped over lines, at every offset, against a plain search."""

import math

from brute import LOWER, PLAIN_WORDS

from tidemark.llm import licenses


def words_of(text):
    return PLAIN_WORDS.findall(text.translate(LOWER))


def plain_matches(text):
    """Labels and best share by lines (of at most a block) and by runs of the whole text."""
    labels, best = set(), 0.0
    lines = [set(words_of(line)) for line in text.splitlines()]
    whole = words_of(text)
    for label, notice in licenses.TEMPLATES:
        w = words_of(notice)
        own, run = set(w), math.ceil(len(w) * (1 + licenses.SLACK))
        held = [len(own & line) for line in lines]
        held += [len(own & set(whole[i : i + run])) for i in range(len(whole))]
        if max(held, default=0) >= math.ceil(len(own) * licenses.CONTAINMENT):
            labels.add(label)
            best = max(best, max(held) / len(own))
    return sorted(labels), best


def wrapped(words, width, mark):
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_wrapped_notices_are_found_at_every_offset(spark):
    rows = []
    for label, notice in licenses.TEMPLATES:
        for offset in range(0, 101, 3 if len(notice) < 100 else 1):
            head = [f"w{i}" for i in range(offset)]
            text = wrapped([*head, *notice.split(), *[f"x{i}" for i in range(offset % 7 * 20)]], 4 + offset % 9, "# ")
            rows.append((len(rows), text, label))
    # Words of a notice far apart are none.
    far = " filler" * 40
    rows.append((len(rows), far.join(licenses.TEMPLATES[1][1].split()), None))
    rows.append((len(rows), "released" + far + "\nunder" + far + "\nthe license" + far, None))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["found"], r["score"]) for r in licenses.scan(docs).collect()}
    assert len(got) == len(rows)
    for i, text, label in rows:
        assert got[i] == plain_matches(text)
        assert label in got[i][0] if label else got[i][0] == []
