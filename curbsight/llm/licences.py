"""Licence recognition by sentence rules.

A text is split into sentences; each is normalised to its letters and digits
in lower case, so comment marks and bullets go. A line end splits too, but a
rule's sentence may be wrapped: it is found over successive lines as long as
neither punctuation nor a blank line stands between them. A rule is an ordered
list of sentences and matches where these follow one another; list numbers
between them are passed over. A match inside a longer one is not reported.

Rules are a small literal table that goes to the tasks, which look sentences
up by their first word; only recognised sentences are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import documents, map_rows

SENTENCE_END = r"[.!?:;]+(?:\s+|$)|\n+"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: No sentence runs on over these: punctuation, and lines without letters or digits.
_HARD_END = regex.compile(r"[.!?:;]+(?:[ \t\n\f\r]+|$)|\n[^\p{L}\p{N}]*\n")
_NOT_WORD = regex.compile(NOT_WORD)
_NUMBER = r"(?:[0-9]{1,3}|[a-h]|i{1,3}|iv|vi{0,3})"
_LIST_NUMBER = regex.compile(_NUMBER)
_LIST_MARK = regex.compile(rf"[^\p{{L}}\p{{N}}]*{_NUMBER}\)[ \t]+(?=[^\n]*[\p{{L}}\p{{N}}])")

#: The sentences of known licences, in order.
RULES: dict[str, list[str]] = {
    "MIT notice": ["Released under the MIT License."],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "Apache-2.0 notice": ["Licensed under the Apache License, Version 2.0."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\");",
        "you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at",
    ],
    "GPL-3.0 notice": ["This work is licensed under the GNU General Public License, version 3."],
    "GPL-3.0-or-later": [
        "This program is free software:",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ],
    "CC-BY-NC-4.0 notice": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "All rights reserved": ["All rights reserved."],
}


def rule_rows(rules: dict[str, list[str]]) -> list[tuple[str, int, int, str]]:
    """(licence, place of the sentence, number of sentences, sentence) for each sentence of each rule."""
    return [(name, at, len(own), sentence) for name, own in rules.items() for at, sentence in enumerate(own)]


def normalised(sentence: str) -> str:
    return _NOT_WORD.sub(" ", sentence.lower()).strip()


def known_sentences(rules: dict[str, list[str]]) -> dict[str, dict[str, list[tuple[str, int, int, int]]]]:
    """By first word, the rules' sentences, normalised like texts: (licence, place, number of sentences, words before) for each."""
    known: dict[str, dict[str, list[tuple[str, int, int, int]]]] = {}
    for name, own in rules.items():
        before = 0
        for at, sentence in enumerate(map(normalised, own)):
            known.setdefault(sentence.partition(" ")[0], {}).setdefault(sentence, []).append((name, at, len(own), before))
            before += sentence.count(" ") + 1
    return known


def found_in(text: str, known: dict[str, dict[str, list[tuple[str, int, int, int]]]]) -> Iterator[tuple[str, int, int, int, int, int]]:
    """A row per known sentence in a text: ``licence``, ``place``, ``size``, ``origin``, and numbers of its first and last line or sentence.

    ``origin`` is the word at which the whole rule would begin, so sentences
    that follow one another have the same. List numbers have no words.
    """
    number = words = 0
    for part in _HARD_END.split(text.lower()):
        mark = _LIST_MARK.match(part)
        cut = [line for line in map(normalised, part[mark.end() if mark else 0 :].split("\n")) if line]
        if len(cut) == 1 and _LIST_NUMBER.fullmatch(cut[0]) and cut[0] not in known.get(cut[0], ()):
            number += 1
            continue
        for at, line in enumerate(cut):
            for sentence, places in known.get(line.partition(" ")[0], {}).items():
                end, run = at, line
                while len(run) < len(sentence) and end + 1 < len(cut) and sentence.startswith(run + " "):
                    end += 1
                    run += " " + cut[end]
                if run == sentence:
                    yield from ((name, place, size, words - before, number + at, number + end) for name, place, size, before in places)
            words += line.count(" ") + 1
        number += len(cut)


def recognise(df: DataFrame, rules: dict[str, list[str]] | None = None) -> DataFrame:
    """A row per licence found: ``doc_id``, ``licence``, ``first``, ``last`` (numbers of sentences or lines) and ``times`` it stands there.

    Matches run over successive sentences; one that lies inside a longer match
    of the same text is left out. Texts are matched each by itself, also where
    they share an id or have none; matches alike in id and place add up in ``times``.
    Null and empty texts, and texts without known sentences, give no rows;
    matches in rows without an id come with a null id. Texts are read whole;
    columns other than ``doc_id`` and ``text`` play no part.
    """
    known = known_sentences(RULES if rules is None else rules)

    def start():
        def run(rows):
            for doc_id, text in rows:
                hits = list(found_in(text, known))
                own = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest() if hits else b""
                yield from ((doc_id, own, *hit) for hit in hits)

        return run

    fields = [("doc_id", pa.int64()), ("own", pa.binary()), ("licence", pa.string()), *((c, pa.int32()) for c in ("place", "size", "origin", "first", "last"))]
    hits = map_rows(documents(df), start, "doc_id long, own binary, licence string, place int, size int, origin int, first int, last int", fields)
    starts = hits.groupBy("doc_id", "own", "licence", "origin", "size").agg(
        F.count_distinct("place").alias("met"), F.count("*").alias("hits"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    matches = starts.where("met = size").select("doc_id", "own", "licence", "first", "last", F.floor(F.col("hits") / F.col("size")).alias("times"))
    # A text has few matches: they are compared as one short list.
    lists = matches.groupBy("doc_id", "own").agg(F.collect_list(F.struct("licence", "first", "last", "times")).alias("all"))
    outer = F.filter(
        "all",
        lambda m: ~F.exists("all", lambda o: (o["first"] <= m["first"]) & (o["last"] >= m["last"]) & (o["last"] - o["first"] > m["last"] - m["first"])),
    )
    kept = lists.select("doc_id", F.explode(outer).alias("m")).select("doc_id", "m.*")
    return kept.groupBy("doc_id", "licence", "first", "last").agg(F.sum("times").alias("times"))
