"""License scans with DataFrame functions only: MinHash bands over overlapping windows, then exact containment.

Words are runs of `[a-z0-9]` of the lower-cased text; shingles are `SHINGLE` words (a shorter text is one shingle).
Templates of s/2 < t <= s shingles (s a power of two) are sought in windows of 2s shingles, one every s, so that
each stretch of s shingles lies within a window and a template held to `CONTAINED` has a Jaccard similarity of at
least 0.19 with it. With BANDS bands of one minimum each, a window with that similarity meets its template with a
probability over 1 - (1 - 0.19) ** 40 = 0.9998; with the whole template, over 1 - (1 - 0.25) ** 40 = 0.99999.
Retrieved pairs are then compared exactly: the share of the template's shingles that the window holds.

Every shingle of a template holds one of the template's anchor words; windows without any anchor can hold no
shingle of a template and are left out before hashing.

Null and empty texts match nothing. Texts are scanned whole. Rows with the same doc_id are reported together.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 40
CONTAINED = 0.8

# Wording of public license notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("mit", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


#: Words that choose badly as anchors.
COMMON = frozenset("a an and any are as at be by can for from he in is it not of on or other over she so that the their them then there these they this those to under was were which who will with you your".split())


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(own: Column, size: int = SHINGLE) -> Column:
    """Hashes of the runs of `size` words; fewer words, but some: of all of them."""
    many = F.transform(F.sequence(F.lit(1), F.size(own) - size + 1), lambda i: F.xxhash64(F.slice(own, i, F.lit(size))))
    return F.when(F.size(own) >= size, many).when(F.size(own) > 0, F.array(F.xxhash64(own))).otherwise(F.array().cast("array<bigint>"))


def minima(own: Column, bands: int = BANDS) -> Column:
    """The least hash of the shingles for each band, as (band, value)."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), F.array_min(F.transform(own, lambda h: F.xxhash64(h, b))).alias("value")))


def _split(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def anchors(templates: tuple[tuple[str, str], ...], size: int = SHINGLE) -> list[str]:
    """Words so that each template's every shingle holds one: long and uncommon ones where there is a choice."""
    found: set[str] = set()
    for _, text in templates:
        own = _split(text)
        for i in range(max(1, len(own) - size + 1)):
            shingle = own[i : i + size]
            if shingle and not found.intersection(shingle):
                found.add(max(shingle, key=lambda w: (w not in COMMON, len(w), w)))
    return sorted(found)


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...], bands: int = BANDS) -> DataFrame:
    """(license, span, template, minima): span is the template's power of two."""
    rows = F.array(*[F.struct(F.lit(n).alias("license"), F.lit(t).alias("text")) for n, t in templates])
    own = spark.range(1).select(F.explode(rows).alias("t")).select("t.license", F.array_distinct(shingles(words(F.col("t.text")))).alias("template"))
    span = F.pow(F.lit(2), F.ceil(F.log2(F.size("template").cast("double")))).cast("int")
    return own.where(F.size("template") > 0).select("license", span.alias("span"), "template", minima(F.col("template"), bands).alias("minima"))


def matches(documents: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, contained: float = CONTAINED, bands: int = BANDS) -> DataFrame:
    """(doc_id, license, containment, first_word, n_windows) for each document and license found in it."""
    spark = documents.sparkSession
    table = template_table(spark, templates, bands)
    spans = sorted({1 << (max(1, len(_split(t)) - SHINGLE + 1) - 1).bit_length() for _, t in templates if _split(t)})
    sought = anchors(templates)
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(sought), i)), lambda i: i.isNotNull())
    split = documents.select("doc_id", words(F.col("text")).alias("words"))
    held = split.select("doc_id", "words", places.alias("places")).where(F.size("places") > 0)

    def windows(span: int) -> Column:
        """The windows of 2 * span shingles that hold an anchor."""
        length = 2 * span + SHINGLE - 1
        last = F.floor(F.greatest(F.lit(0), F.size("words") - SHINGLE) / span).cast("int")
        numbers = F.transform(
            "places", lambda p: F.sequence(F.greatest(F.lit(0), F.least(last, F.ceil((p - length + 1) / span).cast("int"))), F.least(last, F.floor(p / span).cast("int")))
        )
        return F.transform(
            F.array_distinct(F.flatten(numbers)),
            lambda k: F.struct(F.lit(span).alias("span"), (k * span).alias("at"), F.slice(F.col("words"), k * span + 1, F.lit(length)).alias("own")),
        )

    every = held.select("doc_id", F.explode(F.concat(*[windows(s) for s in spans])).alias("w")).select("doc_id", "w.span", "w.at", shingles(F.col("w.own")).alias("window"))
    hashed = every.select("doc_id", "span", "at", "window", F.explode(minima(F.col("window"), bands)).alias("m"))
    sought_bands = table.select("license", "span", "template", F.explode("minima").alias("m"))
    met = (
        hashed.select("doc_id", "span", "at", "window", "m.band", "m.value")
        .join(sought_bands.select("license", "span", "template", "m.band", "m.value"), ["span", "band", "value"])
        .select("doc_id", "license", "at", "window", "template")
    )
    share = F.size(F.array_intersect("window", "template")) / F.size("template")
    first = F.col("at") + F.array_position(F.transform("window", lambda h: F.array_contains(F.col("template"), h)), True) - 1
    exact = met.select("doc_id", "license", "at", share.alias("containment"), first.alias("first")).where(F.col("containment") >= contained)
    return exact.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("first").cast("long").alias("first_word"), F.countDistinct("at").alias("n_windows")
    )


def report(documents: DataFrame) -> DataFrame:
    return matches(documents)


def _sql() -> str:
    """The fixed templates sought in every window of the table documents."""
    rows = ", ".join(f"""('{n}', '{t.replace("'", "''")}')""" for n, t in TEMPLATES)
    split = "list_filter(regexp_split_to_array(lower(coalesce({0}, '')), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
with templates as (select license, {split.format("text")} as w from (values {rows}) t(license, text)),
sought as (select distinct license, unnest(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) as s from templates),
sizes as (select license, count(*) as m, pow(2, ceil(log2(count(*))))::bigint as span from sought group by license),
cut as (select row_number() over () as k, doc_id, {split.format("text")} as w from documents),
places as (select k, doc_id, w, len(w) as n, unnest(range(0, len(w) - {SHINGLE - 1})) as p from cut where len(w) >= {SHINGLE}),
hits as (
  select k, doc_id, license, p, s, m, span, greatest(n - {SHINGLE}, 0) // span as last
  from (select k, doc_id, n, p, array_to_string(w[p + 1 : p + {SHINGLE}], ' ') as s from places) join sought using (s) join sizes using (license)),
windows as (
  select k, doc_id, license, (p // span - b) * span as place, m, s, p from hits, (values (0), (1)) v(b)
  where p // span - b between 0 and last),
held as (select k, doc_id, license, place, count(distinct s) / any_value(m) as containment, min(p) as first from windows group by k, doc_id, license, place)
select doc_id, license, max(containment) as containment, min(first)::bigint as first_word, count(distinct place)::bigint as n_windows
from held where containment >= {CONTAINED} group by doc_id, license"""


ORACLE = _sql()
