"""License phrases, and an exact set-similarity join of text blocks with license notices.

Native: DataFrame functions only, all inside one row, so nothing is shuffled.  A block is any run of
consecutive words, across line ends and comment marks, that is no longer than a notice allows: as many
words as the notice has, divided by the threshold.  A notice is found in a block if at least ``threshold``
of its distinct words are there.  The join is exact by three filters.  Words are ordered by how often the
whole corpus has them, rarest first; a block that shares enough words with a notice has one of its first
few (prefix), so only blocks around such a word are looked at.  A surrounding that has fewer of the
notice's words than must be shared is passed over (length).  At a place of the prefix the blocks that hold
it begin within one block's length before it (position).  What is left is counted in full.

The notices are a setting of a few entries, so they become expressions of a row.

Defined results: a null text is empty: no words, no places, empty labels, score 0.  Repeated rows get
the same result each.  A notice that is wrapped, indented or commented is found like one on a line; one that
is cut at the end of a text counts by the words that are there.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.text import GAP, WORD, lower_ascii

#: Phrase and label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label and notice, as licenses ask for them to be written.
NOTICES = {
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction",
    "apache": "Licensed under the Apache License, Version 2.0.",
    "apache-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-text": "This program is free software: you can redistribute it and/or modify it under the terms of the "
    "GNU General Public License as published by the Free Software Foundation",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
THRESHOLD = 0.8

_IN_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"


def notice_words(notice: str) -> list[str]:
    return sorted(set(re.findall(WORD, notice.lower())))


def needed(n_words: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n_words - 1e-9))


def corpus_order(docs: DataFrame, text: str, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` by the number of its occurrences in all texts, rarest first."""
    spark = docs.sparkSession
    known = F.broadcast(spark.createDataFrame([(w,) for w in vocabulary], "known string"))  # a setting of a few hundred
    # Any order gives the same matches; words between blanks, line ends and common marks are close enough for a good one.
    marks = "\n\t\r.,;:!?()\"'/*#-"
    plain = F.translate(F.lower(F.col(text)), marks, " " * len(marks))
    every = docs.select(F.explode(F.split(plain, " ", -1)).alias("word"))
    counted = every.join(known, F.col("word") == F.col("known")).groupBy("known").agg(F.count("*").alias("n"))
    n = {r["known"]: r["n"] for r in counted.collect()}  # at most one row per word of a notice
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def longest_block(notice: str, threshold: float) -> int:
    """Words in the longest block that may stand for a notice."""
    return max(1, math.floor(len(re.findall(WORD, notice.lower())) / threshold + 1e-9))


def containments(words: Column, anchors: Column, notices: Mapping[str, str], order: list[str], threshold: float) -> dict[str, Column]:
    """Per label the best share of its notice's words in one block of ``words``; 0 where it is below the threshold.

    ``anchors`` lists the places (from 0) of words that are in the prefix of some notice.
    """
    rank = {w: i for i, w in enumerate(order)}

    def best(notice: str) -> Column:
        distinct = sorted(notice_words(notice), key=rank.__getitem__)
        least, length = needed(len(distinct), threshold), longest_block(notice, threshold)
        prefix = distinct[: len(distinct) - least + 1]
        listed = F.lit(distinct)

        def shared(block: Column) -> Column:
            return F.size(F.array_intersect(block, listed))

        def around(at: Column) -> Column:
            first = F.greatest(at - (length - 1), F.lit(0))
            return F.slice(words, first + 1, at + length - first)

        def at_anchor(at: Column) -> Column:
            starts = F.sequence(F.greatest(at - (length - 1), F.lit(0)), at)
            counts = F.transform(starts, lambda s: shared(F.slice(words, s + 1, length)))
            return F.when(shared(around(at)) >= least, F.array_max(counts)).otherwise(0)

        mine = F.filter(anchors, lambda at: F.get(words, at).isin(prefix))
        most = F.coalesce(F.array_max(F.transform(mine, at_anchor)), F.lit(0))
        return F.when(most >= least, most / F.lit(float(len(distinct)))).otherwise(0.0)

    return {label: best(notice) for label, notice in notices.items()}


def prefix_words(notices: Mapping[str, str], order: list[str], threshold: float) -> list[str]:
    """Words one of which every block of some notice has."""
    rank = {w: i for i, w in enumerate(order)}
    found = set()
    for notice in notices.values():
        distinct = sorted(notice_words(notice), key=rank.__getitem__)
        found |= set(distinct[: len(distinct) - needed(len(distinct), threshold) + 1])
    return sorted(found)


def with_notices(docs: DataFrame, text: str = "text", notices: Mapping[str, str] = NOTICES, threshold: float = THRESHOLD, name: str = "_notices") -> DataFrame:
    """``docs`` with array<struct<label, containment>> of the notices found in each text, best block each."""
    vocabulary = sorted({w for notice in notices.values() for w in notice_words(notice)})
    order = corpus_order(docs, text, vocabulary)
    prefixes = prefix_words(notices, order, threshold)
    whole = F.coalesce(F.col(text), F.lit(""))
    # A text without any word of a prefix has no notice: two tests, the cheap one first, spare it the cutting into words.
    contained = F.lit(False)
    for word in prefixes:
        contained = contained | F.lower(whole).contains(word)
    possible = contained & whole.rlike(rf"(?i)(?<!{_IN_WORD})(?:{'|'.join(map(re.escape, prefixes))})(?!{_IN_WORD})")
    cut = F.when(possible, F.regexp_extract_all(lower_ascii(whole), F.lit(WORD), F.lit(0)))
    places = F.sequence(F.lit(0), F.size("_cut") - 1)
    anchors = F.filter(places, lambda i: F.get("_cut", i).isin(prefixes))
    # Columns of their own, and tested for null: what is inside a lambda would be evaluated anew per element.
    steps = docs.withColumn("_cut", cut).withColumn("_anchors", F.when(F.size("_cut") > 0, anchors))
    found = F.array(
        *[
            F.struct(F.lit(label).alias("label"), share.alias("containment"))
            for label, share in containments(F.col("_cut"), F.col("_anchors"), notices, order, threshold).items()
        ]
    )
    none = F.expr("array()").cast("array<struct<label:string,containment:double>>")
    there = (F.size("_anchors") > 0) & F.col("_cut").isNotNull()
    steps = steps.withColumn(name, F.when(there, found).otherwise(none))
    return steps.withColumn(name, F.filter(name, lambda f: f["containment"] > 0)).drop("_cut", "_anchors")


def _phrase(phrase: str) -> str:
    inner = GAP.join(re.escape(w) for w in phrase.split())
    return rf"(?i)(?<![0-9A-Za-z\x{{80}}-\x{{10FFFF}}]){inner}(?![0-9A-Za-z\x{{80}}-\x{{10FFFF}}])"


def _starts(words: Column, phrase: str) -> Column:
    """Places, words from 0, where the words of ``phrase`` stand consecutively."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - 1)

    def stands(i: Column) -> Column:
        fits = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            fits = fits & (F.coalesce(F.get(words, i + k), F.lit("")) == part)
        return fits

    return F.filter(places, stands)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: places of the phrases, labels of phrases and notices, best containment."""
    whole = F.coalesce(F.col(text), F.lit(""))
    any_phrase = F.lit(False)
    for phrase in phrases:
        any_phrase = any_phrase | whole.rlike(_phrase(phrase))
    last_words = {phrase.split()[-1] for phrase in phrases}
    possible = F.lit(False)
    for word in sorted(last_words):
        possible = possible | F.lower(whole).contains(word)
    none = F.expr("array()").cast("array<string>")
    cut = F.when(possible & any_phrase, F.regexp_extract_all(lower_ascii(whole), F.lit(WORD), F.lit(0))).otherwise(none)
    marked = with_notices(docs.select(key, text), text, notices, threshold)
    base = marked.select(F.col(key), "_notices", F.regexp_count(whole, F.lit(WORD)).cast("long").alias("n_words"), cut.alias("_words"))
    cases = F.size("_words") > 0
    places = {p: f"_at_{i}" for i, p in enumerate(phrases)}
    ints = F.expr("array()").cast("array<int>")
    base = base.withColumns({c: F.when(cases, _starts(F.col("_words"), p)).otherwise(ints) for p, c in places.items()})
    starts = F.concat(*(F.col(c) for c in places.values()))
    named = F.array_compact(F.array(*(F.when(F.size(c) > 0, F.lit(phrases[p])) for p, c in places.items())))
    base = base.select(
        key,
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(named)).alias("_base"),
        "_notices",
    )
    every = F.array_sort(F.array_distinct(F.concat("_base", F.col("_notices.label"))))
    return base.select(
        key,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.coalesce(F.array_max(F.col("_notices.containment")), F.lit(0.0)).alias("score"),
    )
