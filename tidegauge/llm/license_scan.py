"""Licence scan: a positional index of rare licence words, all in built-in column expressions.

Document frequencies of the words of all templates are counted over the whole table. Of each
template's words that a file holds, the rarest are looked up in the template's postings; places
of the file that agree on where the template begins are candidates, and a candidate counts if
the template's mandatory phrases stand near their places.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import ROW, ascii_lower, packed, unpacked

#: Phrases whose every place counts, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Rarest words of a template that are looked up in a file.
RARE = 6
#: Words that a mandatory phrase may stand off its place in the template.
SLACK = 8

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrases: tuple[str, ...]  # all must stand in the file, near their places

    @property
    def words(self) -> list[str]:
        return words_of(self.text)

    @property
    def starts(self) -> list[tuple[list[str], int]]:
        """The words of each phrase and where it first stands in the template."""
        out = []
        for phrase in self.phrases:
            p = words_of(phrase)
            out.append((p, next(i for i in range(len(self.words)) if self.words[i:i + len(p)] == p)))
        return out


#: Notices by which files name their licence.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
             "to deal in the software without restriction", ("permission is hereby granted free of charge", "without restriction")),
    Template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
             ("apache license",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license "
             "as published by the free software foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl", "licensed under the gnu lesser general public license version 3", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
             "conditions are met", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "with or without fee")),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("reserved", "copyright all rights reserved", ("all rights reserved",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def words_of(text: str) -> list[str]:
    """Lower-cased words of a licence text, in order."""
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _words(text: Column) -> Column:
    t = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(ascii_lower(t))
    return F.array_remove(F.split(low, SEPARATORS, -1), "")


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    """Whether the phrase's words stand consecutively from position `at` on (false beyond the ends)."""
    return reduce(lambda a, b: a & b, [F.coalesce(F.get(words, at + k) == w, F.lit(False)) for k, w in enumerate(phrase)])


def _has_all(found: Column, phrase: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.array_contains(found, w) for w in dict.fromkeys(phrase)])


def _longs() -> Column:
    return F.array().cast("array<int>")


def word_ranks(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text_col: str = "text") -> list[str]:
    """The words of all templates, rarest first: by the number of rows of docs that hold the word, then by the word.

    A row sends each licence word that it holds once, summed in every task before the shuffle;
    the result has as many rows as the templates have words.
    """
    every = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_intersect(_texts(every), _words(F.col(f"`{text_col}`")))).alias("w"))
    counts = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(every, key=lambda w: (counts.get(w, 0), w))


def _per_word(word: Column, values: dict[str, Column], other: Column) -> Column:
    return reduce(lambda rest, w: F.when(word == w, values[w]).otherwise(rest), values, other)


def _beginnings(words: Column, chosen: Column, own: list[str]) -> Column:
    """Sorted beginnings of the template that the places of the chosen words ask for, one for each place and posting."""
    posting = {w: [i for i, x in enumerate(own) if x == w] for w in own}
    places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("p"))), lambda h: F.array_contains(chosen, h["w"]))
    return F.array_sort(F.flatten(F.transform(
        places, lambda h: _per_word(h["w"], {w: F.array(*[h["p"] - i for i in at]) for w, at in posting.items()}, _longs()))))


def _agreed(begins: Column, chosen: Column, own: list[str]) -> Column:
    """The beginnings on which half of the chosen words' places in the template, two at least, agree."""
    size = {w: F.lit(own.count(w)) for w in own}
    most = F.aggregate(chosen, F.lit(0), lambda n, c: n + _per_word(c, size, F.lit(0)))
    need = F.greatest(F.lit(2), F.ceil(most / 2).cast("int"))
    # equal ones stand together: one has `need` votes if the value need - 1 places further on is equal
    return F.array_distinct(F.filter(begins, lambda b, i: F.coalesce(F.get(begins, i + need - 1) == b, F.lit(False))))


def _share(words: Column, agreed: Column, template: Template, slack: int) -> Column:
    """The greatest share of the template's words in their places over its verified beginnings; NULL where none."""

    def near(begin: Column, phrase: list[str], at: int) -> Column:
        return F.exists(F.sequence(F.lit(at - slack), F.lit(at + slack)), lambda d: _stands(words, begin + d, phrase))

    def in_place(begin: Column) -> Column:
        hits = F.transform(_texts(template.words), lambda w, i: F.coalesce(F.get(words, begin + i) == w, F.lit(False)))
        return F.size(F.filter(hits, lambda hit: hit)) / F.lit(float(len(template.words)))

    verified = F.filter(agreed, lambda begin: reduce(lambda a, b: a & b, [near(begin, p, at) for p, at in template.starts]))
    return F.array_max(F.transform(verified, in_place))


def license_scan(docs: DataFrame, text_col: str = "text", base: dict[str, str] = BASE,
                 templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE, slack: int = SLACK) -> DataFrame:
    """Adds n_words, places (starts of base phrases, counted from 0, sorted), base_labels, labels, label_shares and score.

    A template counts if at least half of the file's places of its `rare` rarest words (two at
    least) agree on its beginning and every mandatory phrase stands within `slack` words of its
    place from there. label_shares maps each such template's label to the greatest share of its
    words that stand in their places; score is the greatest of these, 0.0 where there is none.
    labels are those of base phrases and of templates. Both label lists are distinct and sorted.

    One aggregate over all rows counts how rare the words are (its result has one row a licence
    word); all else is one projection, without a shuffle. A file without all mandatory words of
    a template is passed over, which leaves none out. NULL and empty texts: no words, no labels,
    score 0.0. Rows are kept as they are, repeated ones too; columns of docs with the names of
    new ones are replaced. Empty table: empty result.
    """
    ranks = word_ranks(docs, templates, text_col)
    phrases = {tuple(words_of(p)): label for p, label in base.items()}
    known = ranks + sorted({w for p in phrases for w in p} - set(ranks))
    words, found = F.col("_words"), F.col("_found")
    split = packed(docs).withColumn("_words", _words(F.col(ROW).getField(text_col)))
    looked = split.withColumn("_found", F.array_intersect(_texts(known), words))

    def places(phrase: tuple[str, ...]) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: _stands(words, i, list(phrase)))
        return F.when(_has_all(found, list(phrase)), at).otherwise(_longs())

    def held(template: Template, value: Column) -> Column:
        """value, for files that hold all words of the template's mandatory phrases."""
        return F.when(_has_all(found, [w for p, _ in template.starts for w in p]), value)

    at = range(len(templates))
    rarest = [_texts([w for w in ranks if w in set(t.words)]) for t in templates]
    steps = looked.withColumn("_chosen", F.array(*[
        held(t, F.slice(F.array_intersect(rarest[k], found), 1, rare)) for k, t in enumerate(templates)]))
    chosen = [F.get("_chosen", F.lit(k)) for k in at]
    steps = steps.withColumn("_begins", F.array(*[
        F.when(chosen[k].isNotNull(), _beginnings(words, chosen[k], t.words)) for k, t in enumerate(templates)]))
    begins = [F.get("_begins", F.lit(k)) for k in at]
    steps = steps.withColumn("_agreed", F.array(*[
        F.when(chosen[k].isNotNull(), _agreed(begins[k], chosen[k], t.words)) for k, t in enumerate(templates)]))
    scanned = steps.select(
        ROW, F.size(words).cast("long").alias("_n"), F.array(*[places(p) for p in phrases]).alias("_places"),
        F.filter(F.array(*[
            F.struct(F.lit(t.label).alias("label"), F.when(
                F.size(F.get("_agreed", F.lit(k))) > 0, _share(words, F.get("_agreed", F.lit(k)), t, slack)).alias("share"))
            for k, t in enumerate(templates)
        ]), lambda m: m["share"].isNotNull()).alias("_matches"))
    base_labels = F.array_sort(F.array_distinct(F.filter(F.transform("_places", lambda p, i: F.when(
        F.size(p) > 0, F.get(_texts(list(phrases.values())), i))), lambda name: name.isNotNull())))
    named = scanned.select(
        ROW, "_n", "_matches", F.array_sort(F.flatten("_places").cast("array<long>")).alias("_stood"), base_labels.alias("_base"),
        F.array_sort(F.array_distinct(F.transform("_matches", lambda m: m["label"]))).alias("_method"))
    result = named.select(ROW, F.struct(
        F.col("_n").alias("n_words"), F.col("_stood").alias("places"), F.col("_base").alias("base_labels"),
        F.array_sort(F.array_union("_base", "_method")).alias("labels"),
        F.map_from_entries(F.transform("_method", lambda name: F.struct(name.alias("key"), F.array_max(
            F.transform(F.filter("_matches", lambda m: m["label"] == name), lambda m: m["share"])).alias("value")))).alias("label_shares"),
        F.coalesce(F.array_max(F.transform("_matches", lambda m: m["share"])), F.lit(0.0)).alias("score")).alias("_result"))
    # a filter on a result would be pushed below all steps and repeat each of them in every use of the next
    kept = result.select(ROW, F.explode(F.array("_result")).alias("_one"))
    return unpacked(kept, docs.columns, {
        c: F.col("_one").getField(c) for c in ("n_words", "places", "base_labels", "labels", "label_shares", "score")})
