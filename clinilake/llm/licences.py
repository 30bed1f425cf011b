r"""Licence scans by an exact set-similarity join, Spark expressions only.

A text is cut into blocks at empty lines.  A block meets a template when it
holds at least ``CONTAINED`` percent of the template's distinct words.  Such
pairs are found without comparing every block to every template:

* words are ordered from the globally rarest to the most frequent one, by
  their count of blocks over the whole corpus;
* *prefix filter*: a template of n words that needs t of them can only be met
  by a block that holds one of the template's n - t + 1 rarest words, so only
  those rows of the template join;
* *length filter*: the block holds t template words at all;
* *positional filter*: behind the joined word, block and template both still
  have enough words to reach t;
* what remains is counted on the full sets.

Only words that occur in some template can count, so blocks carry nothing
else; templates and their words are parameters of fixed size, and the tables
made of them are the only ones broadcast.

Words are runs of ASCII letters and digits and of all characters from U+0080
on, A-Z in lower case.  The base rule looks for whole phrases.

Defined results: a null text is empty; an empty text has no words, no labels
and score 0; rows that repeat a doc_id each get a row; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, let, literal_rows, stored, text_or_empty

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices as their publishers word them, by label.  Wordings of
# several paragraphs are templates as a whole, for texts that run them together,
# and paragraph by paragraph, for texts with the publishers' empty lines.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "apache-2.0-header-grant": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"),
    "apache-2.0-header-disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."),
    "gpl-3.0-notice": "licensed under the GNU General Public License, version 3",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."),
    # All versions of the GPL share these two but for the number, which does not decide at CONTAINED.
    "gpl-header-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."),
    "gpl-header-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details."),
    "mit-notice": "Released under the MIT License",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "mit-permission-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"),
    "mit-permission-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "bsd-conditions-use": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "bsd-conditions-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."),
    "bsd-conditions-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}
CONTAINED = 80

#: Runs of ASCII characters that are neither digits nor small letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A line without a word ends a block.
BLANK = r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n"


def _tokens(lowered: Column) -> Column:
    return F.array_remove(F.split(lowered, BETWEEN), "")


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    """Each template's distinct words, as Spark cuts them (the rule above)."""
    def cut(text: str) -> list[str]:
        spaced = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower())
        return sorted(set(spaced.split()))
    return {label: cut(text) for label, text in templates.items()}


def _places(tokens: Column, phrase: str) -> Column:
    """Starts of a phrase among the words."""
    parts = phrase.split()
    return F.filter(F.transform(tokens, lambda w, i: F.when(
        reduce(lambda a, b: a & b, [F.coalesce(F.get(tokens, i + k) == p, F.lit(False)) if k else w == p
                                    for k, p in enumerate(parts)]), i)), lambda i: i.isNotNull())


def _base(text: Column, vocabulary: list[str]) -> Column:
    """n_words, the base phrases' places, and the blocks' template words."""
    def counted(lowered: Column) -> Column:
        def of(tokens: Column) -> Column:
            # Most texts hold no phrase: one look at the joined words tells.
            joined = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
            found = let(joined, lambda j: F.array(*[
                F.when(F.contains(j, F.lit(f" {p} ")), _places(tokens, p)) for p in PHRASES]))
            return F.struct(F.size(tokens).cast("long").alias("n_words"), found.alias("places"))

        blocks = F.transform(F.split(lowered, BLANK), lambda b: F.array_intersect(
            _tokens(b), F.array(*[F.lit(w) for w in vocabulary])))
        return F.struct(let(_tokens(lowered), of).alias("base"),
                        F.filter(blocks, lambda b: F.size(b) > 0).alias("blocks"))

    return let(ascii_lower(text), counted)


def _ranked(spark: SparkSession, blocks: DataFrame, sets: dict[str, list[str]], percent: int) -> DataFrame:
    """A row for each template's words: label, words, needed, word, place.

    ``place`` counts from the template's globally rarest word; the count of
    blocks is over the whole corpus, the table as long as the templates.
    """
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rows = [(label, w, len(ws), -(-len(ws) * percent // 100)) for label, ws in sets.items() for w in ws]
    given = literal_rows(spark, rows, ("label", "word", "size", "needed"))
    order = Window.partitionBy("label").orderBy("n", "word")
    return given.join(counts, "word", "left").select(
        "label", "word", "size", "needed", F.coalesce("n", F.lit(0)).alias("n")).withColumn(
        "place", F.row_number().over(order))


def scan(documents: DataFrame, templates: dict[str, str] | None = None, percent: int = CONTAINED) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score (the highest containment met, or 0).
    """
    spark = documents.sparkSession
    sets = template_words(templates or TEMPLATES)
    vocabulary = sorted({w for ws in sets.values() for w in ws})
    f = F.col("_found")
    hits = f["base"]["places"]
    every = F.flatten(F.filter(hits, lambda p: p.isNotNull()))
    names = F.array(*[F.when(F.size(F.get(hits, F.lit(i))) > 0, F.lit(label))
                      for i, label in enumerate(PHRASES.values())])
    # One scan of the texts; from here on only counts and template words.
    rows = stored(
        documents.select("doc_id", _base(text_or_empty(), vocabulary).alias("_found"))
        .select("doc_id", F.monotonically_increasing_id().alias("row"), f["base"]["n_words"].alias("n_words"),
                F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
                F.array_max(every).cast("long").alias("last_word"),
                F.array_sort(F.filter(F.array_distinct(names), lambda x: x.isNotNull())).alias("base_names"),
                f["blocks"].alias("blocks")), "licence_words")
    blocks = rows.select("row", F.posexplode("blocks").alias("block", "words"))
    ranked = stored(_ranked(spark, blocks, sets, percent), "ranked_words")

    # Global order of all template words, and each template's prefix.
    order = {r.word: r.n for r in ranked.select("word", "n").distinct().collect()}  # as long as the templates
    rank = {w: i for i, w in enumerate(sorted(order, key=lambda w: (order[w], w)))}
    ordered_vocabulary = F.array(*[F.lit(w) for w in sorted(rank, key=rank.get)])
    prefix = ranked.where("place <= size - needed + 1").select("label", "word", "size", "needed", "place")
    whole = ranked.groupBy("label").agg(F.collect_list("word").alias("template"))
    probe = prefix.join(whole, "label")
    met = (
        blocks.select("row", "block", F.array_intersect(ordered_vocabulary, "words").alias("words"))
        .select("row", "block", "words", F.posexplode("words").alias("at", "word"))
        .join(F.broadcast(probe), "word")
        .where((F.size("words") >= F.col("needed"))
               & (1 + F.least(F.size("words") - 1 - F.col("at"), F.col("size") - F.col("place")) + F.least(
                   F.col("at"), F.col("place") - 1) >= F.col("needed")))
        .select("row", "label", (F.size(F.array_intersect("words", "template"))).alias("both"), "size", "needed")
        .where("both >= needed")
        .groupBy("row").agg(F.collect_set("label").alias("met"), F.max(F.col("both") / F.col("size")).alias("score")))
    return rows.drop("blocks").join(met, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_names", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_names", F.coalesce("met", F.array().cast("array<string>")))),
                     ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
