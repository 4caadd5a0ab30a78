"""Licence scan with a positional index of rare licence words, in DataFrame functions only.

For every template the index holds the places of its words that fewest documents contain. A file looks up every indexed
word it holds: each occurrence votes for (template, file place - template place), and only where enough different places
of one template agree on that shift are its mandatory phrases compared, word by word, at the places the shift gives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.llm.shared import named

# Opening words of public licences and notices, each with phrases that must be there.
TEMPLATES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("apache-2.0-header", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ("apache license version 2 0", "you may not use this file except in compliance with the license")),
    ("apache-2.0-notice", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "are permitted provided that the following conditions")),
    ("cc-by-4.0-notice", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international",)),
    ("cc-by-nc-4.0-notice", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("gpl-3.0-notice", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-header", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("under the terms of the gnu general public license", "published by the free software foundation")),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute this software",)),
    ("mit-notice", "released under the mit license", ("under the mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
)
BASE: tuple[tuple[str, str], ...] = (("apache license", "apache"), ("general public license", "gpl"), ("mit license", "mit"))

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Scan:
    """Places indexed per template, and tenths of a template's places that must agree."""

    places: int = 6
    agree: int = 6


def words_of(text: Column) -> Column:
    """The text's words: runs of 0-9, a-z and characters beyond ASCII, after A-Z became a-z.

    ``lower`` changes other letters too; that moves no word border, and no such letter turns into an ASCII word: the
    Kelvin sign, the one whose lower case is ASCII, is replaced before.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9"))
    return F.array_remove(F.split(F.lower(plain), SEPARATORS), "")


def _words(text: str) -> Column:
    return F.array(*(F.lit(w) for w in text.split()))


def _index(words: DataFrame, scan: Scan) -> DataFrame:
    """One row: the indexed places of all templates as ``(template, at, word, rank, need, size)``."""
    every = sorted({w for _, text, _ in TEMPLATES for w in text.split()})
    held = words.select(F.explode(F.array_intersect("words", F.array(*map(F.lit, every)))).alias("word"))
    counts = held.groupBy("word").agg(F.count("*").alias("n"))
    values = ", ".join(f"({k}, {at}, '{w}')" for k, (_, text, _) in enumerate(TEMPLATES) for at, w in enumerate(text.split()))
    places = words.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(template, at, word)")
    known = places.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    entry = F.struct("n", "at", "word")
    listed = known.groupBy("template").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, scan.places).alias("best"))
    listed = listed.withColumn("size", F.size("best"))
    need = F.expr(f"CAST(ceil({scan.agree} * size / 10) AS INT)").alias("need")
    rows = listed.select("template", "size", need, F.explode("best").alias("x"))
    one = F.struct("template", "x.at", "x.word", "x.n", "need", "size")
    return rows.agg(F.array_sort(F.collect_list(one)).alias("index"))


def _starts(words: str, phrase: str) -> Column:
    """Places where the phrase's words stand one after the other."""
    parts = phrase.split()
    test = " AND ".join(f"get({words}, CAST(i + {k} AS INT)) = '{w}'" for k, w in enumerate(parts[1:], 1))
    return F.expr(f"filter(transform({words}, (w, i) -> CASE WHEN w = '{parts[0]}' AND {test} THEN i END), p -> p IS NOT NULL)")


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scan: Scan = Scan()) -> DataFrame:
    """``id_col, n_words, n_base, first_word, last_word, base_labels, found, labels, score`` of every row.

    The base columns count the places of the ``BASE`` phrases. ``found`` lists verified template places as
    ``(template, start, agreeing, size)``, ordered; ``labels`` are the base labels and the verified templates' names;
    ``score`` is the largest share of a verified template's indexed places that agree, 0.5 for base phrases alone, else 0.

    Two passes read the texts: one counts how many documents hold each template word, one scans. Only the counts are
    shuffled, and the index, of fixed size, reaches the scan as a scalar subquery.

    Work grows with the number of words, however long a text and however many licences it holds. Null and empty texts have
    no words; repeated rows give repeated results; null ids stay; ties in rarity go by place in
    the template; other columns are ignored; an empty table gives no rows.
    """
    picked = docs.select(named(id_col).alias("__id"), named(text_col).cast("string").alias("__text"))
    index = _index(picked.select(words_of(F.col("__text")).alias("words")), scan).scalar()
    rows = picked.select("__id", words_of(F.col("__text")).alias("words")).withColumn("index", index)

    held = F.expr("array_intersect(words, transform(index, e -> e.word))")
    rows = rows.withColumn("held", held).withColumn("licensed", F.array_contains("words", "license"))
    rows = rows.select(
        "*",
        *(F.when(F.col("licensed"), _starts("words", p)).otherwise(F.expr("CAST(array() AS ARRAY<INT>)")).alias(f"base_{b}") for p, b in BASE),
    )
    votes = """CASE WHEN size(held) > 1 THEN array_sort(flatten(transform(
        filter(transform(words, (w, i) -> struct(w AS word, i AS place)), x -> array_contains(held, x.word)),
        x -> transform(filter(index, e -> e.word = x.word),
            e -> struct(e.template AS template, x.place - e.at AS shift, e.at AS at, e.need AS need, e.size AS size)))))
        ELSE array() END"""
    rows = rows.withColumn("votes", F.expr(votes))
    # Votes are sorted, so those of one template and shift are a run, as long as the next run starts later.
    starts = """filter(transform(votes, (v, i) -> CASE WHEN i = 0 OR get(votes, i - 1).template <> v.template
        OR get(votes, i - 1).shift <> v.shift THEN i END), i -> i IS NOT NULL)"""
    counted = """filter(transform(borders, (b, j) -> struct(get(votes, b).template AS template, get(votes, b).shift AS shift,
        get(votes, b).need AS need, get(votes, b).size AS size, coalesce(get(borders, j + 1), size(votes)) - b AS agreeing)),
        x -> x.agreeing >= x.need)"""
    rows = rows.withColumn("borders", F.expr(starts)).withColumn("places", F.expr(counted))
    tests = []
    for k, (_, text, phrases) in enumerate(TEMPLATES):
        own = text.split()
        checks = []
        for phrase in phrases:
            parts = phrase.split()
            at = next(i for i in range(len(own)) if own[i : i + len(parts)] == parts)
            listed = ", ".join(f"'{w}'" for w in parts)
            checks.append(f"(x.shift + {at} >= 0 AND slice(words, greatest(x.shift + {at}, 0) + 1, {len(parts)}) = array({listed}))")
        tests.append(f"WHEN {k} THEN {' AND '.join(checks)}")
    verified = f"filter(places, x -> CASE x.template {' '.join(tests)} END)"
    rows = rows.withColumn("verified", F.expr(verified))
    names = "array(" + ", ".join(f"'{name}'" for name, _, _ in TEMPLATES) + ")"
    found = f"""transform(verified, x -> struct(get({names}, x.template) AS template, CAST(x.shift AS BIGINT) AS start,
        x.agreeing AS agreeing, x.size AS size))"""
    base = F.array_compact(F.array(*(F.when(F.size(f"base_{b}") > 0, b) for _, b in BASE)))
    rows = rows.withColumn("found", F.expr(found)).withColumn("base", base)
    starts = F.concat(*(F.col(f"base_{b}") for _, b in BASE))
    score = "array_max(transform(found, x -> CAST(x.agreeing AS DOUBLE) / CAST(x.size AS DOUBLE)))"
    return rows.select(
        F.col("__id").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        "found",
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.expr("transform(found, x -> x.template)")))), ",").alias("labels"),
        F.coalesce(F.expr(score), F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
