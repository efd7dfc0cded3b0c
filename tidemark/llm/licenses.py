"""License scanning by an exact set-similarity join.

Texts are cut into blocks in two ways. Lines, and of long lines overlapping stretches, match
a template if they hold the given share of its distinct words. Beside them the words of the
whole text are cut, whatever the line ends, so that notices wrapped over lines are found: a
text matches if any run of at most ``1 + SLACK`` times a template's words holds that share.
These blocks are as long and overlap as far as the longest template asks for, so that every
such run lies in one. The join works on words ordered by how often they occur in all
lines of the corpus, rarest first, restricted to the templates' vocabulary:

* prefix filter: a match needs ``k`` of a template's ``n`` words, so it holds one of the
  ``n - k + 1`` rarest. Only those are joined.
* length filter: a block with fewer than ``k`` of the vocabulary's words can't match.
* positional filter: the words from a shared one on must suffice, on both sides, for what
  is still missing.

What passes is counted exactly, in blocks of the whole text run by run. All of it is DataFrame
operations.

The base part finds the license phrases word by word. Null and empty texts have no words;
each row gets a row, and rows that repeat id and text the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NOT_WORD, ascii_lower, stored

# The base phrases and labels, and the notices that templates are made of.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
CONTAINMENT = 0.8
BLOCK = 64
# A wrapped notice may hold so many words more than its template, as a share: marks of comments, insertions.
SLACK = 0.5


def _words(text: Column) -> Column:
    return F.filter(F.split(text, NOT_WORD), lambda w: w != "")


def _templates(spark: SparkSession, templates: tuple, containment: float) -> DataFrame:
    rows = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, notice string"
    )
    words = _words(ascii_lower(F.col("notice")))
    run = F.ceil(F.size(words) * (1 + SLACK)).cast("int")
    rows = rows.select("template", "label", run.alias("run"), F.explode(F.array_distinct(words)).alias("word"))
    size = F.count(F.lit(1)).over(Window.partitionBy("template"))
    return rows.withColumn("n", size).withColumn("need", F.ceil(F.col("n") * containment).cast("int"))


def _blocks(words: Column, size: int) -> Column:
    """A line's words as one block, or as stretches that overlap by half."""
    half = size // 2
    starts = F.sequence(F.lit(0), F.ceil((F.size(words) - size) / half).cast("int"))
    cut = F.transform(starts, lambda i: F.slice(words, i * half + 1, size))
    return F.when(F.size(words) <= size, F.array(words)).otherwise(cut)


def _stretches(words: Column, vocabulary: list[str], run: int, least: int) -> Column:
    """All words cut into stretches of twice ``run`` that overlap by half, null where a word is none of
    the vocabulary: each run of so many words lies in one. Those with too few different words are left out."""
    marks = F.transform(words, lambda w: F.when(w.isin(vocabulary), w))

    def cut(m: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(m) / run).cast("int") - 2))
        return F.transform(starts, lambda i: F.slice(m, i * run + 1, 2 * run))

    parts = F.transform(F.array(marks), cut)[0]
    return F.filter(parts, lambda b: F.size(F.array_distinct(F.array_compact(b))) >= least)


def _starts(words: Column, parts: list[str]) -> Column:
    """Where the parts stand one after another, from 0."""

    def at(i: Column) -> Column:
        # The last word is the rarest, so most positions fail at the first comparison.
        test = F.get(words, i + (len(parts) - 1)) == parts[-1]
        for k, part in enumerate(parts[:-1]):
            test = test & (F.get(words, i + k) == part)
        return test

    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), at)
    return F.when(F.size(words) >= len(parts), found).otherwise(F.array().cast("array<int>"))


def _places(words: Column) -> Column:
    """All base phrases, as structs of start and label."""

    def labelled(phrase: str, label: str) -> Column:
        starts = _starts(words, phrase.split())
        return F.transform(starts, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))

    return F.concat(*[labelled(phrase, label) for phrase, label in PHRASES])


def scan(
    docs: DataFrame, templates: tuple = TEMPLATES, containment: float = CONTAINMENT, block: int = BLOCK
) -> DataFrame:
    """``doc_id, text_hash, n_words, places, found, score`` for every row of ``docs (doc_id, text)``.

    ``places`` are the base phrases ``(at, label)``; ``found`` the labels of matched templates;
    ``score`` the largest share of a template's words that one line's block or one run holds, of
    those that match.
    """
    spark = docs.sparkSession
    wanted = _templates(spark, templates, containment)
    vocabulary = sorted({w for r in wanted.select("word").distinct().collect() for w in [r["word"]]})
    least, run = wanted.agg(F.min("need"), F.max("run")).first()
    known = F.array(*[F.lit(w) for w in vocabulary])

    low = ascii_lower(F.coalesce("text", F.lit("")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), low.alias("low"))
    lines = F.filter(F.split("low", "[\n\r]+"), lambda s: s != "")
    blocks = F.flatten(F.transform(lines, lambda s: F.transform(F.array(_words(s)), lambda w: _blocks(w, block))[0]))
    held = F.transform(blocks, lambda b: F.array_intersect(F.array_distinct(b), known))
    words = _words(F.col("low"))
    places = F.when(
        F.contains("low", F.lit(PHRASES[0][0].split()[-1])), F.transform(F.array(words), _places)[0]
    ).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))
    # Only the vocabulary's words are kept of each block: the rest can't take part in an overlap.
    base = stored(
        texts.select(
            "doc_id",
            "text_hash",
            F.size(words).cast("long").alias("n_words"),
            places.alias("places"),
            F.filter(held, lambda b: F.size(b) > 0).alias("blocks"),
            F.transform(F.array(words), lambda w: _stretches(w, vocabulary, run, least))[0].alias("stretches"),
        )
    )
    order = _order(base, wanted)
    found = _matches(base, wanted.join(order, "word"), order, least)
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_hash") == F.col("f_hash"))
    return base.drop("blocks", "stretches").join(found, same, "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        "places",
        F.coalesce("found", F.array().cast("array<string>")).alias("found"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _order(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(word, rank)``: the vocabulary from its rarest word on, counted over all blocks."""
    counts = base.select(F.explode(F.flatten("blocks")).alias("word")).groupBy("word").count()
    counted = wanted.select("word").distinct().join(counts, "word", "left")
    # One row per word of the templates.
    rank = F.row_number().over(Window.orderBy(F.coalesce("count", F.lit(0)), "word"))
    return stored(counted.select("word", rank.cast("long").alias("rank")))


def _most(marks: Column, ranks: Column, run: Column) -> Column:
    """The most different words out of ``ranks`` that a run of the marks' words holds."""
    at = F.filter(
        F.transform(marks, lambda r, i: F.struct(i.alias("at"), r.alias("rank"))),
        lambda x: F.array_contains(ranks, x["rank"]),
    )

    def within(a: Column, x: Column) -> Column:
        near = F.filter(a, lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + run))
        return F.size(F.array_distinct(F.transform(near, lambda y: y["rank"])))

    return F.array_max(F.transform(F.array(at), lambda a: F.array_max(F.transform(a, lambda x: within(a, x)))))


def _matches(base: DataFrame, wanted: DataFrame, order: DataFrame, least: int) -> DataFrame:
    sorted_words = F.array_sort(F.collect_list(F.struct("rank", "word")))
    key = ["template", "label", "run", "n", "need"]
    whole = wanted.groupBy(*key).agg(sorted_words.alias("all"))
    whole = whole.select(*key, F.transform("all", lambda x: x["rank"]).alias("ranks"))
    prefix = F.slice("ranks", 1, F.col("n").cast("int") - F.col("need") + 1)
    index = stored(whole.select(*key, "ranks", F.posexplode(prefix).alias("t_at", "rank")))

    # The templates' words from the rarest on, and those of their prefixes; as many as the given templates hold.
    by_rank = F.array(*[F.lit(r["word"]) for r in order.orderBy("rank").collect()])
    joined = [r["rank"] for r in index.select("rank").distinct().collect()]
    lines = (
        base.select("doc_id", "text_hash", F.explode("blocks").alias("block"))
        .where(F.size("block") >= least)
        .distinct()
        .withColumn("marks", F.transform("block", lambda w: F.array_position(by_rank, w)))
        .select("doc_id", "text_hash", "marks", F.lit(False).alias("cut"))
    )
    # Null stays where a word is none of the vocabulary.
    stretches = base.select("doc_id", "text_hash", F.explode("stretches").alias("block")).select(
        "doc_id",
        "text_hash",
        F.transform("block", lambda w: F.when(w.isNotNull(), F.array_position(by_rank, w))).alias("marks"),
        F.lit(True).alias("cut"),
    )
    probes = lines.unionByName(stretches).withColumn(
        "b_ranks", F.array_sort(F.array_distinct(F.array_compact("marks")))
    )
    placed = F.transform("b_ranks", lambda r, i: F.struct(i.alias("b_at"), r.alias("rank")))
    probes = probes.select("*", F.explode(F.filter(placed, lambda x: x["rank"].isin(joined))).alias("x")).select(
        "doc_id", "text_hash", "marks", "cut", "b_ranks", "x.b_at", "x.rank"
    )
    met = probes.join(index, "rank").where(
        (F.size("b_ranks") >= F.col("need"))
        # The first shared word lies in the prefix; from it on, both sides must still hold enough.
        & (F.least(F.size("b_ranks") - F.col("b_at"), F.col("n") - F.col("t_at")) >= F.col("need") - F.least("b_at", "t_at"))
    )
    held = met.withColumn("shared", F.size(F.array_intersect("b_ranks", "ranks"))).where("shared >= need")
    most = F.when(F.col("cut"), _most(F.col("marks"), F.col("ranks"), F.col("run"))).otherwise(F.col("shared"))
    held = held.withColumn("most", most).where("most >= need")
    return held.groupBy(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash")).agg(
        F.sort_array(F.collect_set("label")).alias("found"), F.max(F.col("most") / F.col("n")).alias("score")
    )
