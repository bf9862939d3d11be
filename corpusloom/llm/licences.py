"""Licence recognition by sentence rules, in Spark expressions only.

A text is cut into sentences twice: across line breaks, for texts that are wrapped, and line by line,
for notices that stand below or between other text. Normalised sentences that are known become
identifiers; the sequence of identifiers is then matched against licence rules in their order, the
longest first. What a rule has matched is used up, so the sentences that two licences share count for
the one whose rule fits.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Sentences end at these marks before white space or the end, and at empty lines.
SENTENCE_END = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+\z|\n[\x20\x09\x0B-\x0D]*\n[\x20\x09-\x0D]*"
LINE_SENTENCE_END = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+\z|[.!?;:]*\n"

# Sentences of common licences and licence notices, as they are published, and the
# names they get here. Letters and digits count, in any case.
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-title": "The MIT License",
    "mit-title-2": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software"
    ),
    "apache-2-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2-notice-2": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache-2-notice-3": "Released under the Apache License, Version 2.0",
    "apache-2-terms": "you may not use this file except in compliance with the License",
    "apache-2-copy": "You may obtain a copy of the License at",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-2-notice": "This work is licensed under the GNU General Public License, version 2",
    "lgpl-3-notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "agpl-3-notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "gpl-3-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version"
    ),
    "gpl-free": "This program is free software",
    "gpl-3-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
    ),
    "gpl-2-terms": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation"
    ),
    "gpl-2-version": "either version 2 of the License, or (at your option) any later version",
    "cc-by-nc-4-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-4-notice": "Licensed under CC BY 4.0",
    "cc-by-sa-4-notice": "Licensed under CC BY-SA 4.0",
    "cc-by-nc-sa-4-notice": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nd-4-notice": "Licensed under CC BY-ND 4.0",
    "cc0-notice": "Licensed under CC0 1.0",
    "cc-by-4-long": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer"
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution"
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "mpl-2-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    ),
    "unlicense": "This is free and unencumbered software released into the public domain",
    "reserved": "All rights reserved",
}

_TERMS = (
    "you can redistribute it and/or modify it under the terms of the GNU {} General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version"
)
# The same for the terms in published headers.
PUBLISHED: dict[str, str] = {
    "lgpl-3-terms": _TERMS.format("Lesser"),
    "agpl-3-terms": _TERMS.format("Affero"),
}

# Licences and the sentences, next to each other among the known ones, that make them; matched in this order.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl-2-terms", "gpl-2-version")),
    ("Apache-2.0", ("apache-2-notice-2", "apache-2-terms", "apache-2-copy")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition")),
    ("MIT", ("mit-title-2", "mit-grant", "mit-condition")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-terms")),
    ("GPL-3.0-or-later", ("gpl-3-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-2",)),
    ("Apache-2.0", ("apache-2-notice-2",)),
    ("Apache-2.0", ("apache-2-notice",)),
    ("Apache-2.0", ("apache-2-notice-3",)),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("GPL-2.0", ("gpl-2-notice",)),
    ("LGPL-3.0", ("lgpl-3-notice",)),
    ("AGPL-3.0", ("agpl-3-notice",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-long",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-long",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-notice",)),
    ("CC-BY-4.0", ("cc-by-4-long",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("Unlicense", ("unlicense",)),
    ("All-rights-reserved", ("reserved",)),
]
# The same for published headers; their sentences are in no rule above.
PUBLISHED_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("LGPL-3.0-or-later", ("gpl-free", "lgpl-3-terms")),
    ("AGPL-3.0-or-later", ("gpl-free", "agpl-3-terms")),
    ("LGPL-3.0-or-later", ("lgpl-3-terms",)),
    ("AGPL-3.0-or-later", ("agpl-3-terms",)),
]


def normal_form(sentence: str) -> str:
    """Lower case with single spaces between runs of ASCII letters and digits."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.translate(str.maketrans(UPPER, LOWER)))
    return " ".join(kept.split())


def _normalised(value: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(value, UPPER, LOWER), "[^a-z0-9]+", " "))


def cue_words(sentences: Mapping[str, str]) -> list[str]:
    """Few words of which every known sentence has one, the most useful first."""
    open_, cues = [set(normal_form(s).split()) for s in sentences.values()], []
    while open_:
        words = sorted({w for s in open_ for w in s}, key=lambda w: (-sum(w in s for s in open_), -len(w), w))
        # Short words are in every text.
        best = next((w for w in words if len(w) >= 6), words[0])
        cues.append(best)
        open_ = [s for s in open_ if best not in s]
    return cues


def _pieces(sentence: str) -> list[str]:
    """What the cut into sentences makes of a known sentence that has an end mark inside."""
    return [piece for piece in map(normal_form, re.split(r"[.!?;:]+[\x20\x09-\x0D]+", sentence)) if piece]


def _broken(sentences: Mapping[str, str]) -> dict[tuple[str, ...], str]:
    """Sentences that are known by their pieces, next to each other, unless the first is a known sentence of its own."""
    forms = {normal_form(s) for s in sentences.values()}
    broken = {tuple(_pieces(s)): name for name, s in sentences.items() if len(_pieces(s)) > 1}
    return {pieces: name for pieces, name in broken.items() if pieces[0] not in forms}


def _known(value: Column, end: str, sentences: Mapping[str, str]) -> Column:
    forms = {normal_form(s): name for name, s in sentences.items()}
    broken = _broken(sentences)
    names = F.create_map(*[F.lit(x) for pair in forms.items() for x in pair])
    cut = F.transform(F.split(value, end), _normalised)

    def named(all_: Column) -> Column:
        def name_of(piece: Column, i: Column) -> Column:
            name = names[piece]
            for pieces, whole in broken.items():
                rest = [F.get(all_, i + k).eqNullSafe(F.lit(pieces[k])) for k in range(1, len(pieces))]
                name = F.when(reduce(and_, rest, piece == pieces[0]), F.lit(whole)).otherwise(name)
            return name

        return F.transform(all_, name_of)

    # Bound once, as the pieces after one are looked at too.
    found = F.transform(F.array(cut), named)[0]
    return F.filter(found, lambda name: name.isNotNull())


def sentence_ids(text: Column, sentences: Mapping[str, str] = SENTENCES | PUBLISHED) -> tuple[Column, Column]:
    """The known sentences of a text in their order, cut across lines and cut at lines; empty arrays for null."""
    value = F.coalesce(text, F.lit(""))
    # Lossless: a text without any cue word has no known sentence.
    cues = F.regexp_like(value, F.lit("(?i)" + "|".join(cue_words(sentences))))
    none = F.array().cast("array<string>")
    return tuple(
        F.when(cues, _known(value, end, sentences)).otherwise(none) for end in (SENTENCE_END, LINE_SENTENCE_END)
    )


def matched_licences(ids: Column, rules: Sequence[tuple[str, tuple[str, ...]]] = (*PUBLISHED_RULES, *RULES)) -> Column:
    """The licences whose rules match a sequence of identifiers, in the order of the rules; an array without repeats."""
    # Written as ,a,,b, each identifier has its own commas, so rules cannot match across names.
    sequence = F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(","))
    wanted = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("," + ",,".join(parts) + ",").alias("parts")) for name, parts in rules]
    )

    def apply(state: Column, rule: Column) -> Column:
        fits = F.contains(state["left"], rule["parts"])
        return F.when(
            fits,
            F.struct(
                F.replace(state["left"], rule["parts"], F.lit(",-,")).alias("left"),
                F.concat(state["found"], F.array(rule["name"])).alias("found"),
            ),
        ).otherwise(state)

    start = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))
    found = F.aggregate(wanted, start, apply, lambda state: state["found"])
    return F.when(F.size(ids) > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def licence_scan(
    text: Column,
    sentences: Mapping[str, str] = SENTENCES | PUBLISHED,
    rules: Sequence[tuple[str, tuple[str, ...]]] = (*PUBLISHED_RULES, *RULES),
) -> Column:
    """A struct of ``sentences``, the identifiers found line by line, and ``licences``, sorted and without repeats.

    Null, empty and other texts without known sentences have empty arrays. Both tables are part of the
    expression and meant for some hundred entries. A column function: repeated rows and other
    columns stay as they are.
    """
    across, lines = sentence_ids(text, sentences)
    licences = F.array_sort(F.array_union(matched_licences(across, rules), matched_licences(lines, rules)))
    return F.struct(lines.alias("sentences"), licences.alias("licences"))


def oracle_sql(
    sentences: Mapping[str, str] = SENTENCES | PUBLISHED,
    rules: Sequence[tuple[str, tuple[str, ...]]] = (*PUBLISHED_RULES, *RULES),
) -> str:
    """The same for DuckDB over ``documents``: doc_id, n_sentences, sentences and licences, joined by commas."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(normal_form(s))}, {quoted(name)})" for name, s in sentences.items())
    lower, broken = f"translate(s, '{UPPER}', '{LOWER}')", _broken(sentences)

    steps, last = [], "start"
    for i, (name, parts) in enumerate(rules):
        pattern = quoted("," + ",,".join(parts) + ",")
        steps.append(
            f"r{i} as materialized (select doc_id, lines, "
            + ", ".join(
                f"replace({side}, {pattern}, ',-,') as {side}, "
                f"case when contains({side}, {pattern}) then list_append(found_{side}, {quoted(name)}) else found_{side} end as found_{side}"
                for side in ("a", "b")
            )
            + f" from {last})"
        )
        last = f"r{i}"
    return f"""
with known(k, v) as (values {known}),
table_of as (select map_from_entries(list((k, v))) as m from known),
pieces as (
  select doc_id, {_sql_cut(SENTENCE_END, lower, quoted)} as p, {_sql_cut(LINE_SENTENCE_END, lower, quoted)} as q from documents
),
cut as (
  select doc_id, {_sql_known("p", broken, quoted)} as across, {_sql_known("q", broken, quoted)} as lines from pieces, table_of
),
start as (
  select doc_id, lines, ',' || array_to_string(across, ',,') || ',' as a, ',' || array_to_string(lines, ',,') || ',' as b,
    []::varchar[] as found_a, []::varchar[] as found_b
  from cut
),
{", ".join(steps)}
select doc_id, cast(len(lines) as bigint) as n_sentences, array_to_string(lines, ',') as sentences,
  array_to_string(list_sort(list_distinct(list_concat(found_a, found_b))), ',') as licences
from {last}
"""


def _sql_cut(end: str, lower: str, quoted) -> str:
    cut = f"regexp_split_to_array(coalesce(text, ''), {quoted(end)})"
    return f"list_transform({cut}, lambda s: trim(regexp_replace({lower}, '[^a-z0-9]+', ' ', 'g')))"


def _sql_known(cut: str, broken: Mapping[tuple[str, ...], str], quoted) -> str:
    """Names of pieces; where the pieces of a broken sentence follow each other, its name at the first."""
    cases = "".join(
        f"when x = {quoted(first)} " + "".join(f"and {cut}[i + {k}] = {quoted(piece)} " for k, piece in enumerate(rest, 1)) + f"then {quoted(whole)} "
        for (first, *rest), whole in reversed(broken.items())
    )
    return f"list_filter(list_transform({cut}, lambda x, i: case {cases}else m[x] end), lambda n: n is not null)"
