"""License scans by diagonal voting over rolling word k-grams.

Every position of every text gives the hashes of the k-grams that start there.
They are joined to the (small, fixed) table of k-gram positions of phrases and
notices; each match votes for the diagonal "text position minus template
position". Neighbouring diagonals of a notice are merged, so inserted or
missing words only shift the rest, and spans are verified by the share of the
notice's k-grams that they hold. A phrase counts where its diagonal has all of
its votes, that is, where its words stand consecutively.

All of it is DataFrame functions. The template table is broadcast; its size is
fixed by the two dictionaries below. Matches, a small share of the positions,
are the only rows that are shuffled, besides one short row for each document.

Defined cases: a null text counts as empty; without words or matches the
counts are 0, the words null, the labels empty and the score 0; repeated rows
get the same result each, one row for each; an empty table gives no rows;
columns other than id and text are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.llm.common import ascii_lower, text_of

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: The opening words of public license notices, and their labels.
NOTICES = {
    "apache-2.0-notice": "licensed under the apache license version 2.0 the license you may not use this file except"
    " in compliance with the license you may obtain a copy of the license at",
    "apache-2.0-line": "licensed under the apache license version 2.0",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu"
    " general public license as published by the free software foundation",
    "gpl-line": "this work is licensed under the gnu general public license version 3",
    "lgpl-notice": "this library is free software you can redistribute it and or modify it under the terms of the gnu"
    " lesser general public license as published by the free software foundation",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction",
    "mit-line": "this software is released under the mit license",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee"
    " is hereby granted provided that the above copyright notice",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "cc-by-notice": "this work is licensed under a creative commons attribution 4.0 international license",
    "unlicense-notice": "this is free and unencumbered software released into the public domain",
}

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same, where letters are not in lower case yet.
_BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column, between: str) -> Column:
    return F.array_remove(F.split(text, between), "")


def template_grams(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str], notice_k: int) -> DataFrame:
    """(h, template, label, phrase, n_grams, k, gram, at): a row for each k-gram of each template.

    A phrase of m words uses k = 2; a phrase of one word is refused.
    """
    rows = []
    for is_phrase, items in ((True, [(label, text) for text, label in phrases.items()]), (False, notices.items())):
        for label, text in items:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
            k = 2 if is_phrase else notice_k
            if len(words) < k:
                raise ValueError(f"{text!r} has fewer than {k} words")
            n = len(words) - k + 1
            rows += [(len(rows), text, label, is_phrase, n, k, words[i : i + k], i) for i in range(n)]
    schema = "i int, template string, label string, phrase boolean, n_grams int, k int, gram array<string>, at int"
    grams = spark.createDataFrame(rows, schema).drop("i")
    hashed = F.when(F.col("k") == 2, F.xxhash64(F.lit(2), F.col("gram")[0], F.col("gram")[1]))
    if notice_k > 2:
        hashed = hashed.otherwise(F.xxhash64(F.lit(notice_k), *[F.get("gram", F.lit(i)) for i in range(notice_k)]))
    return grams.withColumn("h", hashed)


def license_hits(
    docs: DataFrame, phrases: dict[str, str], notices: dict[str, str], *, notice_k: int, slack: int, coverage: float
) -> DataFrame:
    """Verified spans: doc_id, text_hash, label, phrase, first, end, share; words from 0, end exclusive."""
    grams = template_grams(docs.sparkSession, phrases, notices, notice_k)
    words = docs.select("doc_id", F.xxhash64("_text").alias("text_hash"), _split(ascii_lower(F.col("_text")), _BETWEEN).alias("words"))
    starts = words.select("doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "w"))
    following = lambda n: [F.get("words", F.col("pos") + i) for i in range(1, n)]
    hashes = [F.xxhash64(F.lit(k), F.col("w"), *following(k)) for k in sorted({2, notice_k})]
    keyed = starts.select("doc_id", "text_hash", "words", "pos", F.explode(F.array(*hashes)).alias("h"))
    votes = (
        keyed.join(F.broadcast(grams), "h")
        .filter(F.slice("words", F.col("pos") + 1, F.col("k")) == F.col("gram"))
        .select("doc_id", "text_hash", "template", "label", "phrase", "n_grams", "k", "at", "pos")
        .dropDuplicates(["doc_id", "text_hash", "template", "at", "pos"])
    )
    one = ["doc_id", "text_hash", "template", "label", "phrase", "n_grams"]
    lines = votes.groupBy(*one, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("pos").alias("first"), F.max(F.col("pos") + F.col("k")).alias("end")
    )
    # Diagonals of a notice that lie close together are one span with words added or left out.
    by_start = Window.partitionBy(*one).orderBy("first", "diagonal")
    apart = (
        F.col("phrase")
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(by_start)) > slack)
        | (F.col("first") > F.lag("end").over(by_start) + slack)
    )
    spans = (
        lines.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(by_start))
        .groupBy(*one, "span")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("end").alias("end"))
    )
    share = F.least(F.lit(1.0), F.col("votes") / F.col("n_grams"))
    return spans.withColumn("share", share).filter(
        F.when(F.col("phrase"), F.col("votes") == F.col("n_grams")).otherwise(F.col("share") >= coverage)
    )


def scan_licenses(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    notice_k: int = 4,
    slack: int = 3,
    coverage: float = 0.6,
) -> DataFrame:
    """One row for each row of docs: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    base = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    hits = license_hits(
        base, phrases or PHRASES, notices or NOTICES, notice_k=notice_k, slack=slack, coverage=coverage
    )
    of_base = lambda c: F.when(F.col("phrase"), F.col(c))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = hits.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.count(of_base("first")).alias("n_base"),
        F.min(of_base("first")).cast("long").alias("first_word"),
        F.max(of_base("first")).cast("long").alias("last_word"),
        joined(of_base("label")).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    every = base.select(
        "doc_id", F.xxhash64("_text").alias("_text_hash"), F.size(_split(F.col("_text"), _BETWEEN_ANY)).cast("long").alias("n_words")
    )
    return every.join(found, every.doc_id.eqNullSafe(found._id) & (every._text_hash == found._hash), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
