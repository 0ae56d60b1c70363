"""Licence scans (operator 2).

Texts are normalised (lower case, runs of anything but letters and digits become
one space) and compared with licence templates by the Dice coefficient over the
sets of word bigrams: 2 |A and B| / (|A| + |B|).  Each line, each block of lines
between empty lines, and the whole text is a unit of comparison.

Two bounds prune exactly.  From Dice >= t follows |A and B| >= t/2 (|A| + |B|):
a unit whose bigrams are to less than t / (2 - t) among those of all templates
matches none, and a template outside t/(2-t) |A| <= |B| <= (2-t)/t |A| does not
match a unit of |A| bigrams.  What is left is compared exactly.

The templates are a fixed list, so every step is an expression within a row:
nothing is shuffled, and neither copies nor hot sources gather anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exprs import let

#: Licence id -> template text (statements and standard notices).
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
}
THRESHOLD = 0.75


def normalise(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def bigrams(normal: Column) -> Column:
    """Distinct word bigrams; a single word counts as one, no word as none."""
    def pairs(words: Column) -> Column:
        both = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))
        return F.when(F.size(words) == 1, words).otherwise(F.array_distinct(both))

    return F.when(normal == "", F.array().cast("array<string>")).otherwise(let(F.split(normal, " "), pairs))


def template_bigrams(spark: SparkSession, templates: dict[str, str]) -> dict[str, list[str]]:
    """The templates' bigrams, by the same expressions as the texts'."""
    rows = spark.createDataFrame(list(templates.items()), "id string, text string").select("id", bigrams(normalise(F.col("text"))).alias("b")).collect()
    return {r["id"]: list(r["b"]) for r in rows}


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """One row per document and licence found in it: doc_id, license, dice (the
    best unit's), n_units (units that match), unit (normalised text of the best
    unit, ties by text).

    Null and empty texts match nothing; of repeated rows each gives its own.
    Other columns are ignored.  ``templates`` is a fixed list of short texts.
    """
    known = template_bigrams(docs.sparkSession, templates)
    vocabulary = sorted({b for bs in known.values() for b in bs})
    share = threshold / (2 - threshold)
    whole = F.col("text")
    blocks = F.split(whole, r"\n[ \t\r]*\n")
    units = F.array_distinct(F.concat(F.split(whole, "\n"), blocks, F.array(whole)))
    norm = F.array_distinct(F.transform(units, normalise))
    candidates = docs.select("doc_id", F.col(text).alias("text")).filter("text is not null")
    def sized(u: Column) -> Column:
        return let(bigrams(u), lambda g: F.struct(u.alias("unit"), F.when(F.size(F.filter(g, lambda x: x.isin(vocabulary))) >= share * F.size(g), g).alias("grams")))

    near = F.filter(F.transform(F.filter(norm, lambda u: u != ""), sized), lambda u: u["grams"].isNotNull())

    def matches(u: Column) -> Column:
        found = []
        for name, grams in sorted(known.items()):
            n, size = len(grams), F.size(u["grams"])
            inside = (size * share <= n) & (n * share <= size)
            dice = F.when(inside, 2.0 * F.size(F.array_intersect(u["grams"], F.array(*map(F.lit, grams)))) / (size + n))
            found.append(F.struct(F.lit(name).alias("license"), dice.alias("dice"), u["unit"].alias("unit")))
        return F.filter(F.array(*found), lambda m: m["dice"] >= threshold)

    def best(hits: Column) -> Column:
        def of(name: Column) -> Column:
            own = F.filter(hits, lambda m: m["license"] == name)
            top = F.array_max(F.transform(own, lambda m: F.struct(m["dice"].alias("dice"), m["unit"].alias("unit"))))
            return F.struct(name.alias("license"), top["dice"].alias("dice"), F.size(own).cast("long").alias("n_units"), top["unit"].alias("unit"))

        return F.transform(F.array_distinct(F.transform(hits, lambda m: m["license"])), of)

    found = let(F.flatten(F.transform(near, matches)), best)
    return candidates.select("doc_id", F.explode(found).alias("m")).select("doc_id", "m.*")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in every whole text of ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    values = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in TEMPLATES.items())
    norm = r"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
    grams = "CASE WHEN {u} = '' THEN [] WHEN len(string_split({u}, ' ')) = 1 THEN [{u}] ELSE list_distinct([string_split({u}, ' ')[i] || ' ' || string_split({u}, ' ')[i + 1] FOR i IN range(1, len(string_split({u}, ' ')))]) END"
    return f"""
WITH tpl AS (SELECT id, {grams.format(u="n")} AS tb FROM (SELECT id, {norm.format(x="x")} AS n FROM (VALUES {values}) v(id, x))),
raw AS (SELECT doc_id, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), [text])) AS x FROM documents WHERE text IS NOT NULL),
units AS (SELECT DISTINCT doc_id, {norm.format(x="x")} AS u FROM raw),
g AS (SELECT doc_id, u, {grams.format(u="u")} AS b FROM units WHERE u <> ''),
hit AS (SELECT doc_id, id, u, 2.0 * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice FROM g JOIN tpl
  ON len(b) * 0.6 <= len(tb) AND len(tb) * 0.6 <= len(b))
SELECT doc_id, id AS license, max(dice) AS dice, count(*) AS n_units, arg_max(u, (dice, u)) AS unit
FROM hit WHERE dice >= 0.75 GROUP BY doc_id, id
"""


OP2_SQL = _sql()
