"""License scan by diagonal voting, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from matchcast.llm.common import text_hash

# Phrases whose every place counts, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening sentences of public licence notices, lower-cased words only.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "released under the mit license": "mit",
}

K = 2  # words of a gram; the shortest phrase has two
COVER = 0.8  # share of a notice's grams that a merged span must hold
DRIFT = 3  # diagonals this near belong to one span
GAP = 12  # words that may lie between two pieces of a span
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = -1  # template number of the mark after the last gram of a text


def words(text: Column) -> Column:
    """The text's words after A-Z are lower-cased; a null text has none."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def template_table(spark, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per gram of each template: (template, label, phrase, grams, at, first, second)."""
    rows = []
    for number, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        w = text.split()
        if not K <= len(w) <= 64:
            raise ValueError(f"a template has {K} to 64 words: {text!r}")
        for at in range(len(w) - K + 1):
            rows.append((number, label, number < len(phrases), len(w) - K + 1, at, w[at], w[at + 1]))
    schema = "template int, label string, phrase boolean, grams int, at int, first string, second string"
    return spark.createDataFrame(rows, schema)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """Which licences each document names, and where.

    Each text becomes the hashes of its rolling word pairs, which meet the pairs of all templates
    in a join (the templates are an argument with at most 64 words each, so they are broadcast;
    texts are never moved). A hit votes for its diagonal, place in the text minus place in the
    template. A phrase stands where one diagonal has all its pairs. For a notice, diagonals
    at most ``DRIFT`` apart and pieces at most ``GAP`` words apart are merged to a span, which
    counts if it holds ``COVER`` of the notice's pairs. Hits are compared word by word, so equal
    hashes of other words do not count.

    Returns one row per input row: ``id_col, n_words, n_base, first_word, last_word, base_labels,
    labels, score``. The score is the largest share of a template found (0 without any). A null
    text has no words; ids may be null or repeat; rows equal in id and text get equal results.
    Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    grams = template_table(spark, PHRASES if phrases is None else phrases, NOTICES if notices is None else notices)
    schema = grams.select(F.xxhash64("first", "second").alias("gram"), "*")
    mark = F.xxhash64(F.lit("\x01end of text"))
    ends = spark.range(1).select(
        mark.alias("gram"), F.lit(END).alias("template"), F.lit("").alias("label"), F.lit(False).alias("phrase"),
        F.lit(1).alias("grams"), F.lit(0).alias("at"), F.lit("").alias("first"), F.lit("").alias("second"),
    )
    templates = F.broadcast(schema.unionByName(ends))

    texts = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("h"), words(F.col(text_col)).alias("w"))
    # Each pair carries its own two words, and of the text only the number of words: a text's length is paid once.
    pairs = F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.struct(F.xxhash64(a, b).alias("gram"), a.alias("one"), b.alias("two")))
    last = F.greatest(F.size("w") - (K - 1), F.lit(0))
    none = F.lit(None).cast("string")
    end = F.array(F.struct(mark.alias("gram"), none.alias("one"), none.alias("two")))
    listed_pairs = texts.select("id", "h", F.size("w").alias("size"), last.alias("last"), F.concat(F.slice(pairs, 1, last), end).alias("pairs"))
    exploded = listed_pairs.select("id", "h", "size", "last", F.posexplode("pairs").alias("pos", "pair"))
    places = exploded.select("id", "h", "size", "last", "pos", "pair.*")
    true_hit = F.when(F.col("template") == END, F.col("pos") == F.col("last")).otherwise(
        F.coalesce((F.col("one") == F.col("first")) & (F.col("two") == F.col("second")), F.lit(False))
    )
    hits = places.join(templates, "gram").filter(true_hit)

    votes = hits.groupBy("id", "h", "template", "label", "phrase", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, at))").alias("held"),
        F.min("pos").alias("begin"),
        F.max("pos").alias("end"),
        F.max(F.when(F.col("template") == END, F.col("size"))).alias("n_words"),
        F.count("*").alias("n"),
    )
    one = ["id", "h", "template"]
    before = W.partitionBy(*one).orderBy("begin", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(before)) > DRIFT) | (
        F.col("begin") - F.max("end").over(before.rowsBetween(W.unboundedPreceding, -1)) > GAP
    )
    new = F.when(F.col("phrase") | F.coalesce(apart, F.lit(True)), 1).otherwise(0)
    spans = (
        votes.withColumn("span", F.sum(new).over(before.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*one, "label", "phrase", "grams", "span")
        .agg(
            F.expr("bit_count(bit_or(held))").alias("found"),
            F.min("begin").alias("begin"),
            F.max("n_words").alias("n_words"),
            F.max("n").alias("copies"),
        )
        .withColumn("share", F.col("found") / F.col("grams"))
    )
    counts = (F.col("template") != END) & F.when(F.col("phrase"), F.col("share") == 1).otherwise(F.col("share") >= COVER)
    base = counts & F.col("phrase")

    def listed(which: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    found = spans.groupBy("id", "h").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("begin"))).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(counts).alias("labels"),
        F.coalesce(F.max(F.when(counts, F.col("share"))), F.lit(0.0)).alias("score"),
        F.max(F.when(F.col("template") == END, F.col("copies"))).alias("copies"),
    )
    return found.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
