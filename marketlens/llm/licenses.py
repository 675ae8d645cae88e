"""License scan: an exact set-similarity join of text blocks with license templates.

DataFrame functions only.  Tokens are ordered by how often they occur in the
corpus, rarest first.  A block can only hold the wanted share of a template's
tokens if it holds one of the template's rarest (prefix filter), has enough
tokens at all (length filter), and has enough tokens left behind the shared
ones (positional filter); what passes is verified exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import stored
from marketlens.operators.broadcast import bounded_broadcast

#: Keys of texts to look at again are broadcast up to so many, counted first; beyond, texts are shuffled.
BROADCAST_ROWS = 1_000_000

#: Fixed value: what lies between words once A-Z is lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The signs outside ASCII that Java lowers to ASCII letters, and a letter that takes their place.
KELVIN, DOTTED, OTHER = "\u212a", "\u0130", "\u00ff"
#: Phrases whose consecutive words name a license.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Openings of public license notices, by label.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-4", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Blocks are so many consecutive words, each starting half a block behind the last: every run of up to
#: half a block lies whole in one.  Templates must not be longer than that.
BLOCK = 64


def words_of(text: Column) -> Column:
    """The words of a text, with A-Z lowered (letters outside ASCII may be lowered too: they end no word)."""
    odd = text.contains(KELVIN) | text.contains(DOTTED)
    plain = F.when(odd, F.translate(text, KELVIN + DOTTED, OTHER + OTHER)).otherwise(text)
    return F.array_remove(F.split(F.lower(plain), GAP, -1), "")


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def token_ranks(present: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Ranks of the given tokens by the number of texts that hold them (column present), rarest first.

    The tokens are a bounded set (those of the templates), so their counts,
    summed in each task first, are all that reaches the driver.
    """
    count = {r["token"]: r["count"] for r in present.select(F.explode("present").alias("token")).groupBy("token").count().collect()}
    return {t: k for k, t in enumerate(sorted(tokens, key=lambda t: (count.get(t, 0), t)))}


def phrase_starts(words: Column, phrase: str) -> Column:
    """Places (from 0) where the words of a phrase stand consecutively in lowered words."""
    parts = phrase.split()
    last = F.size(words) - len(parts)
    def here(i: Column) -> Column:
        out = F.lit(True)
        for k, p in enumerate(parts):
            out = out & (F.get(words, i + k) == p)
        return out

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def template_blocks(words: DataFrame, ranks: dict[str, int], templates, threshold: float) -> DataFrame:
    """Every block and template with at least ``threshold`` of the template's distinct tokens in the block.

    Takes ``doc_id, text_key, words`` and returns ``doc_id, text_key, block``
    (number of the block in its text), ``label, containment``.
    """
    spark = words.sparkSession
    index, bodies = [], []
    for k, (label, text) in enumerate(templates):
        order = sorted(set(text.split()), key=ranks.__getitem__)
        need = math.ceil(threshold * len(order))
        bodies.append((k, label, [ranks[t] for t in order], need, len(order)))
        index += [(ranks[t], k, place, need, len(order)) for place, t in enumerate(order[:len(order) - need + 1])]
    prefixes = spark.createDataFrame(index, "rank int, template int, place int, need int, total int")
    whole = spark.createDataFrame(bodies, "template int, label string, ranks array<int>, need int, total int")

    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - BLOCK // 2 - 1, F.lit(0)), F.lit(BLOCK // 2))
    block = words.select("doc_id", "text_key", F.posexplode(F.transform(starts, lambda i: F.slice("words", i + 1, BLOCK))).alias("block", "words"))
    rank_of = F.create_map(*[F.lit(x) for t, r in ranks.items() for x in (t, r)])
    known = F.array_sort(F.transform(F.array_intersect("words", strings(ranks)), lambda w: rank_of[w]))
    sized = block.select("doc_id", "text_key", "block", known.alias("known")).withColumn("n", F.size("known"))
    probe = sized.select("*", F.posexplode("known").alias("at", "rank"))
    pair = (probe.join(F.broadcast(prefixes), "rank").where(F.col("n") >= F.col("need"))
            .groupBy("doc_id", "text_key", "block", "template")
            .agg(F.countDistinct("rank").alias("shared"), F.max(F.struct("place", "at")).alias("last"), F.first("known").alias("known"),
                 F.first("n").alias("n"), F.first("need").alias("need"), F.first("total").alias("total")))
    rest = F.least(F.col("total") - F.col("last.place"), F.col("n") - F.col("last.at")) - 1
    passed = pair.where(F.col("shared") + rest >= F.col("need")).select("doc_id", "text_key", "block", "template", "known")
    overlap = F.size(F.array_intersect("known", "ranks"))
    return (passed.join(F.broadcast(whole), "template").where(overlap >= F.col("need"))
            .select("doc_id", "text_key", "block", "label", (overlap / F.col("total")).alias("containment")))


def scan(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = 0.8, name: str = "licenses") -> DataFrame:
    """License phrases and notices of every whole text, a row per input row.

    Takes doc_id and text (other columns are ignored).  Returns ``doc_id,
    n_words, n_base, first_word, last_word, base_labels, labels, score``: base
    values from phrases, ``labels`` with those of templates too, ``score`` the
    largest template containment found, 1 with a base label, 0 with neither.
    A null text counts as empty (no words, empty labels, null places); null
    and repeated ids are carried row by row; an empty table gives an empty
    result.  Only counts of template tokens reach the driver.

    One pass cuts all texts and keeps which tokens of templates and phrases
    each holds; a second looks at the texts that hold enough of them.
    """
    if any(len(text.split()) > BLOCK // 2 for _, text in templates):
        raise ValueError(f"a template has more than {BLOCK // 2} words")
    tokens = sorted({t for _, text in templates for t in text.split()} | {t for p in phrases for t in p.split()})
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("doc_id", "text"))
    cut = rows.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    held = stored(cut.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", strings(tokens)).alias("present")), f"{name}-tokens")

    ranks = token_ranks(held, tokens)
    enough = F.lit(False)
    for parts, share in [(set(text.split()), threshold) for _, text in templates] + [(set(p.split()), 1.0) for p in phrases]:
        enough = enough | (F.size(F.array_intersect("present", strings(sorted(parts)))) >= math.ceil(share * len(parts)))
    wanted = bounded_broadcast(stored(held.where(enough).select("text_key").distinct(), f"{name}-wanted"), BROADCAST_ROWS)
    # Stored, so that the optimizer can't move the cutting of a text into the functions that walk over its words.
    near = stored(rows.join(wanted, "text_key", "left_semi").dropDuplicates(["doc_id", "text_key"])
                  .select("doc_id", "text_key", words_of(F.col("text")).alias("words")), f"{name}-near")

    notices = (template_blocks(near, ranks, templates, threshold).groupBy("doc_id", "text_key")
               .agg(F.collect_set("label").alias("labels"), F.max("containment").alias("containment"), F.lit(None).cast("array<int>").alias("places"), F.lit(None).cast("array<string>").alias("base")))
    starts = near.select("doc_id", "text_key", *[phrase_starts(F.col("words"), p).alias(f"p{k}") for k, p in enumerate(phrases)])
    labels = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values())]), lambda x: x.isNotNull())
    named = starts.select("doc_id", "text_key", labels.alias("labels"), F.lit(None).cast("double").alias("containment"),
                          F.flatten(F.array(*[f"p{k}" for k in range(len(phrases))])).alias("places"), labels.alias("base")).where(F.size("places") > 0)
    found = (notices.unionByName(named).groupBy("doc_id", "text_key")
             .agg(F.array_distinct(F.flatten(F.collect_list("labels"))).alias("labels"), F.max("containment").alias("containment"),
                  F.first("places", ignorenulls=True).alias("places"), F.first("base", ignorenulls=True).alias("base"))
             .select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "labels", "containment", "places", "base"))
    both = held.join(found, held["doc_id"].eqNullSafe(found["found_id"]) & (held["text_key"] == found["found_key"]), "left")
    named_here = F.col("places").isNotNull()
    text_of = lambda column: F.coalesce(F.array_join(F.array_sort(F.array_distinct(column)), ","), F.lit(""))
    return both.select(
        "doc_id", "n_words", F.when(named_here, F.size("places")).otherwise(0).cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"), text_of(F.col("base")).alias("base_labels"), text_of(F.col("labels")).alias("labels"),
        F.when(named_here, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"))
