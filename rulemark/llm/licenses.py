"""License text by diagonal voting, in DataFrame functions only.

Every run of three words of a document is hashed and joined with the places of the
templates' runs. A hit votes for a diagonal: its place in the document less its
place in the template. Diagonals at most ``BAND`` apart are merged, which bridges words
put in or left out, and a merged diagonal counts if its hits cover enough of the template.
The join compares the words themselves besides their hashes, so every hit is verified.

Texts are read once and never shuffled: hits and one header row per document are. The
templates are a fixed table of this module, which makes their broadcast safe.

A null text is empty, with no words. Repeated rows each give their row. A place is the
first word of the phrase. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rulemark.llm.common import query, table

#: The phrases of the contract, with their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
#: Openings of public licenses, which the method finds with gaps and changes.
TEXTS = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
)

GRAM = 3
#: Diagonals at most this far apart are one place.
BAND = 3
#: Share of a template's runs that a place of the method must hold.
COVER = 0.7

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HEADER = -1


def words(text: Column) -> Column:
    """Words with A-Z in lower case. Two letters whose lower case would be ASCII are set apart."""
    kept = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("￿")), F.lit("İ"), F.lit("￿"))
    return F.regexp_extract_all(F.lower(kept), F.lit(WORD), F.lit(0))


def rolling(words: Column) -> Column:
    """Hashes of the runs that start at each word; the last ones are shorter."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))


def gram(name: str, place: Column) -> Column:
    return F.concat_ws(" ", *(F.get(F.col(name), place + d) for d in range(GRAM)))


def templates(spark: SparkSession) -> DataFrame:
    """A row for each run of each template, and the header row that every document meets."""
    values = [(i, label, text, i < len(PHRASES)) for i, (text, label) in enumerate(PHRASES + TEXTS)]
    sql = ", ".join(f"({i}, '{label}', '{text}', {base})" for i, label, text, base in values)
    known = spark.sql(f"SELECT * FROM VALUES {sql} AS t(template, label, text, base)").withColumn("t", words(F.col("text")))
    runs = known.select("template", "label", "base", "t", (F.size("t") - GRAM + 1).alias("runs"), F.posexplode(rolling(F.col("t"))).alias("at", "hash"))
    runs = runs.filter("at < runs").select("hash", "template", "label", "base", "runs", "at", gram("t", F.col("at")).alias("gram"))
    header = spark.sql(f"SELECT {HEADER}L AS hash, -1 AS template, '' AS label, false AS base, 0 AS runs, -1 AS at, '' AS gram")
    return runs.unionByName(header)


def license_places(docs: DataFrame) -> DataFrame:
    """Merged diagonals: ``doc_id``, ``text_hash``, ``n_words``, ``template``, ``label``, ``start``, ``cover``...

    ``template`` -1 is the header of a document, with ``votes`` the number of equal rows.
    """
    header = F.array(F.struct(F.lit(HEADER).cast("bigint").alias("h"), F.lit("").alias("own")))

    def split(w: Column) -> Column:
        """The number of words, and the runs, each with its own words: the text goes no further."""
        own = F.transform(w, lambda first, i: F.concat_ws(" ", first, *(F.get(w, i + d) for d in range(1, GRAM))))
        runs = F.concat(header, F.arrays_zip(rolling(w).alias("h"), own.alias("own")))
        return F.struct(F.size(w).alias("n_words"), runs.alias("runs"))

    # The one-element array binds the words, and its generator keeps the optimizer from repeating them.
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash")
    read = docs.select("doc_id", hashed, F.inline(F.transform(F.array(words(F.col("text"))), split)))
    runs = read.select("doc_id", "text_hash", "n_words", F.posexplode("runs").alias("pos", "run"))
    known = F.broadcast(templates(docs.sparkSession))
    equal = F.when(F.col("pos") == 0, F.col("template") == -1).otherwise(F.col("run.own") == F.col("gram"))
    hits = runs.join(known, (F.col("run.h") == F.col("hash")) & equal).select(
        "doc_id", "text_hash", "n_words", "template", "label", "base", "runs", "at", (F.col("pos") - 1).alias("pos")
    )
    key = ["doc_id", "text_hash", "n_words"]
    voted = (
        hits.withColumn("diagonal", F.col("pos") - F.col("at"))
        .groupBy(*key, "template", "label", "base", "runs", "diagonal")
        .agg(
            F.count("*").alias("votes"),
            F.bit_or(F.expr("shiftleft(1L, greatest(at, 0))")).alias("mask"),
            F.min("pos").alias("start"),
            F.max("pos").alias("last"),
        )
    )
    # One exchange serves all that follows: everything is within a document.
    voted = voted.repartition("doc_id", "text_hash")
    order = W.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > BAND, F.lit(True))
    merged = voted.withColumn("apart", apart.cast("int"))
    merged = merged.withColumn("place", F.when(F.col("base"), F.col("diagonal")).otherwise(F.sum("apart").over(order)))
    places = merged.groupBy(*key, "template", "label", "base", "runs", "place").agg(
        F.sum("votes").alias("votes"),
        F.bit_or("mask").alias("mask"),
        F.min("start").alias("start"),
        (F.max("last") + GRAM).alias("end"),
    )
    return places.withColumn("cover", F.bit_count("mask") / F.greatest("runs", F.lit(1)))


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document with its phrases, labels and the best cover of a template."""
    found = license_places(docs)
    header, base = F.col("template") == -1, F.col("base") & (F.col("cover") == 1)
    method = ~header & (F.col("cover") >= COVER)
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("label")))), ",")
    rows = found.groupBy("doc_id", "text_hash", "n_words").agg(
        F.sum(F.when(header, F.col("votes"))).alias("copies"),
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base | (method & ~F.col("base"))).alias("labels"),
        F.max(F.when(base | (method & ~F.col("base")), F.col("cover"))).alias("score"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.col("n_base").cast("bigint").alias("n_base"),
        F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"),
        "base_labels",
        "labels",
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


@query()
def op4_license_scan(spark, sf):
    return license_scan(table(spark, sf, "documents"))
