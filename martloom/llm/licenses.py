"""License scans by diagonal voting.

DataFrame operations only. All rolling word 3-gram hashes of the documents meet
the templates' gram positions (a fixed table of some hundred rows); matches are
verified word by word and vote for their offset diagonal; neighbouring diagonals
are merged and the spans verified by their share of the template's grams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import normal_words, text_key

# Base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Public license notices and opening sentences.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the"
                 " License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
              " General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation;"
              " either version 2 of the License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
            " provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

GRAM = 3
#: Diagonals this near to one another belong to one occurrence (words inserted or left out).
NEAR = 2
#: Share of a template's grams that a span must hold for the template's label.
SHARE = 0.6


def license_grams(spark: SparkSession) -> DataFrame:
    """Gram positions of the templates and the base phrases: their number is fixed by the lists above."""
    ordered = [("base", label, phrase) for phrase, label in BASE_PHRASES]
    ordered += [("vote", label, template) for label, template in TEMPLATES]
    entries = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.lit(label).alias("label"),
                F.lit(number).alias("template"),
                F.lit(text).alias("text"),
            )
            for number, (kind, label, text) in enumerate(ordered)
        )
    )
    last = F.when(F.col("kind") == "vote", F.size("whole") - GRAM).otherwise(0)
    size = F.when(F.col("kind") == "vote", GRAM).otherwise(F.size("whole"))
    return (
        spark.range(1)
        .select(F.explode(entries).alias("e"))
        .select("e.kind", "e.label", "e.template", normal_words(F.col("e.text")).alias("whole"))
        .select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select(
            F.xxhash64(F.slice("whole", F.col("at") + 1, F.lit(GRAM))).alias("gram_hash"),
            F.slice("whole", F.col("at") + 1, size).alias("phrase"),
            "kind",
            "label",
            "template",
            "at",
            (last + 1).alias("grams"),
        )
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """Licenses named in each document.

    One row per different (doc_id, text), so repeated rows are one document:
    doc_id, n_words, n_base (places of base phrases), first_word, last_word,
    base_labels, labels (sorted, comma-joined), score. The score is 1 where a base
    phrase stands, else the greatest share of a template's grams in one merged
    span, 0 without any. Null text is empty.
    """
    grams = license_grams(docs.sparkSession)
    at = (
        docs.select("doc_id", text_key(F.col("text")).alias("text_hash"), normal_words(F.col("text")).alias("words"))
        .select("*", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("start"))
    )
    # Start 0 stands for the document itself, start n for its n-th word.
    fits = (F.col("start") > 0) & (F.col("start") + GRAM <= F.size("words") + 1)
    first = F.greatest("start", F.lit(1))
    at = at.select("*", F.when(fits, F.xxhash64(F.slice("words", first, F.lit(GRAM)))).alias("hash"))
    stands = (F.col("hash") == F.col("gram_hash")) & (F.slice("words", first, F.size("phrase")) == F.col("phrase"))
    key = ["doc_id", "text_hash"]
    hits = (
        at.join(F.broadcast(grams), stands, "left")
        .where((F.col("start") == 0) | F.col("kind").isNotNull())
        .select(
            *key,
            F.size("words").alias("n_words"),
            F.coalesce("kind", F.lit("document")).alias("kind"),
            "label",
            "template",
            (F.col("start") - 1).alias("word"),
            "at",
            "grams",
        )
        .repartition(*key)
    )
    # From here on every step groups within the documents that this one exchange brought together.
    diagonals = (
        hits.withColumn("diagonal", F.when(F.col("kind") == "vote", F.col("word") - F.col("at")))
        .groupBy(*key, "kind", "label", "template", "diagonal")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("grams").alias("grams"),
            F.collect_set("word").alias("places"),
            F.collect_set("at").alias("voted"),
        )
    )
    ordered = Window.partitionBy(*key, "kind", "label", "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(ordered) > NEAR, 1).otherwise(0)
    merged = (
        diagonals.withColumn("apart", apart)
        .withColumn("band", F.sum("apart").over(ordered))
        .groupBy(*key, "kind", "label", "template", "band")
        .agg(
            F.max("n_words").alias("n_words"),
            F.max("grams").alias("grams"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
            F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("votes"),
        )
    )
    # A span longer than its template by half and two words is no occurrence of it.
    length = F.array_max("places") - F.array_min("places") + GRAM
    sound = length <= (F.col("grams") + GRAM - 1) * 1.5 + 2
    share = F.when((F.col("kind") == "vote") & sound, F.col("votes") / F.col("grams"))
    merged = merged.withColumn("share", share)
    base = F.col("kind") == "base"
    named = base | (F.col("share") >= SHARE)
    places = F.flatten(F.collect_list(F.when(base, F.col("places"))))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    return (
        merged.groupBy(*key)
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            places.alias("places"),
            joined(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
            joined(F.collect_set(F.when(named, F.col("label")))).alias("labels"),
            F.greatest(
                F.max(F.when(base, F.lit(1.0))), F.max("share"), F.lit(0.0)
            ).alias("score"),
        )
        .select(
            "doc_id",
            "n_words",
            F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"),
            F.array_max("places").cast("long").alias("last_word"),
            "base_labels",
            "labels",
            "score",
        )
    )
