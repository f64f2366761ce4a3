"""License scans: an exact set-similarity join of text blocks with notice templates (operator 3).

A block matches a template when it holds at least ``THRESHOLD`` of the template's distinct words.
Blocks are lines and, for notices that are wrapped, runs of words across line ends: as many words
as the template has, and a share of 1 - ``THRESHOLD`` more. Wrapping keeps the order, so a run must
have them in the template's order; words of different notices on neighbouring lines, together all
of a third one's, do not match it. Words are put into one global order: those outside all templates first, then
the templates' words by how many blocks of the corpus have them, rare ones first. A template's
prefix in that order must share a word with every block that matches (prefix filter); the
places of the first shared word bound the overlap from both sides (positional filter); short
blocks are out by their length. What is left is counted exactly.

The templates are a parameter of bounded size, so their index goes to every task; the corpus is
read twice, once for the frequencies, and never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.llm.common import BYTE_CODES, SpanHasher, lower_ascii, map_slices, row_ids, runs, ship_code, slices

THRESHOLD = 0.9

# Phrases whose places are counted, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Usual notices of public licences, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
    ("reserved", "All rights reserved"),
]

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words (ASCII letters and digits and everything beyond ASCII, A-Z
    lower-cased), each text's first word (len+1 offsets), and each word's line."""
    data, offsets = lower_ascii(texts)
    none = np.zeros(0, np.int64)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), none
    starts, ends = runs(_WORD[data])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), none
    stops = data == 10
    stops[offsets[1:] - 1] = True  # a text ends its last line
    line = np.cumsum(stops)[starts]
    return SpanHasher(BYTE_CODES[data])(starts, ends), np.searchsorted(starts, offsets), line


@dataclass
class Index:
    """Templates as ranks in the global order."""

    hashes: np.ndarray  # the templates' words, sorted
    rank: np.ndarray  # of each: 0 is the rarest
    templates: list[frozenset[int]]
    labels: list[str]
    needed: list[int]  # words a matching block must share
    prefixes: dict[int, list[tuple[int, int]]]  # rank -> (template, place) where it is in a prefix
    orders: list[list[int]]  # ranks of each template's words as they are written
    runs: list[int]  # words of a run that may match, repeated ones included

    @classmethod
    def build(cls, templates: list[tuple[str, str]], threshold: float, hashes: np.ndarray, frequency: np.ndarray) -> "Index":
        order = np.lexsort((hashes, frequency))
        rank = np.empty(len(hashes), dtype=np.int64)
        rank[order] = np.arange(len(hashes))
        sets, needed, prefixes, orders, lengths = [], [], {}, [], []
        for k, (_, text) in enumerate(templates):
            word = words([text])[0]
            lengths.append(math.ceil(len(word) / threshold - 1e-9))
            orders.append(rank[np.searchsorted(hashes, word)].tolist())
            own = sorted(set(orders[-1]))
            need = max(1, math.ceil(threshold * len(own) - 1e-9))
            for place, r in enumerate(own[: len(own) - need + 1]):
                prefixes.setdefault(r, []).append((k, place))
            sets.append(frozenset(own))
            needed.append(need)
        return cls(hashes, rank, sets, [label for label, _ in templates], needed, prefixes, orders, lengths)

    def matches(self, word: np.ndarray, line: np.ndarray) -> list[tuple[int, int, float]]:
        """(line, template, containment) of every match among words given line by line."""
        if not len(self.hashes) or not len(word):
            return []
        at = np.minimum(np.searchsorted(self.hashes, word), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == word)
        if not len(hit):
            return []
        # each line's template words, distinct, in global order
        size = len(self.hashes)
        cell = np.unique(line[hit] * size + self.rank[at[hit]])
        rows, ranks = cell // size, cell % size
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        length = np.diff(np.append(first, len(rows)))
        start = np.repeat(first, length)
        end = start + np.repeat(length, length)
        left = end - np.arange(len(rows))  # from here to the block's end
        in_prefix = np.zeros(size, dtype=bool)
        in_prefix[list(self.prefixes)] = True
        seen: set[tuple[int, int]] = set()
        out = []
        for i in np.flatnonzero(in_prefix[ranks]).tolist():
            for k, place in self.prefixes[int(ranks[i])]:
                row = int(rows[i])
                if (row, k) in seen:
                    continue
                seen.add((row, k))  # places of the first shared word: later ones bound no less
                need = self.needed[k]
                if min(int(left[i]), len(self.templates[k]) - place) < need:
                    continue
                own = ranks[int(start[i]) : int(end[i])].tolist()
                overlap = len(self.templates[k].intersection(own))
                if overlap >= need:
                    out.append((row, k, overlap / len(self.templates[k])))
        return out

    def run_matches(self, word: np.ndarray, line: np.ndarray, text: np.ndarray, matched: set[tuple[int, int]]) -> list[tuple[int, int, float]]:
        """(first line, template, containment) of runs across line ends that match, among words
        given with their lines and texts; none where a line of the run matches by itself (``matched``
        has (line, template)). Runs that overlap count once, the best one."""
        if not len(self.hashes) or not len(word):
            return []
        at = np.minimum(np.searchsorted(self.hashes, word), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == word)
        rank, out = self.rank[at[hit]], []
        member = np.zeros(len(self.hashes), dtype=bool)
        for k, own in enumerate(self.templates):
            need, size = self.needed[k], self.runs[k]
            if not own or need < 2:
                continue  # one word is on one line
            member[:] = False
            member[list(own)] = True
            mine = member[rank]
            place, r = hit[mine], rank[mine]  # the template's words
            member[:] = False
            member[sorted(own)[: len(own) - need + 1]] = True
            rare = np.flatnonzero(member[r])
            # length filter: enough of the words, across a line end and in one text, around a rare one
            lo = np.maximum(np.searchsorted(place, place[rare] - size, side="right"), np.searchsorted(text[place], text[place[rare]]))
            hi = np.minimum(np.searchsorted(place, place[rare] + size), np.searchsorted(text[place], text[place[rare]], side="right"))
            likely = (hi - lo >= need) & (line[place[lo]] != line[place[hi - 1]])
            found: dict[tuple[int, int], int] = {}
            checked = -1
            for i, a, b in zip(rare[likely].tolist(), lo[likely].tolist(), hi[likely].tolist()):
                a = max(a, checked + 1)  # runs from earlier words have been looked at
                for x in range(a, i + 1):
                    y = min(int(np.searchsorted(place, place[x] + size)), b)
                    if y - x < need or line[place[x]] == line[place[y - 1]]:
                        continue
                    run = r[x:y].tolist()
                    if len(set(run)) >= need and (overlap := _in_order(run, self.orders[k])) >= need:
                        found[(x, y)] = overlap
                checked = max(checked, i)
            taken = np.zeros(len(place), dtype=bool)
            for (x, y), overlap in sorted(found.items(), key=lambda f: (-f[1], f[0][1] - f[0][0], f[0])):
                if taken[x:y].any() or any((n, k) in matched for n in line[place[x:y]].tolist()):
                    continue
                taken[x:y] = True
                out.append((int(line[place[x]]), k, overlap / len(own)))
        return out


def _in_order(run: list[int], order: list[int]) -> int:
    """Distinct words of a longest common subsequence."""
    best = [[0] * (len(order) + 1) for _ in range(len(run) + 1)]
    for i in range(len(run) - 1, -1, -1):
        for j in range(len(order) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if run[i] == order[j] else max(best[i + 1][j], best[i][j + 1])
    i, j, words = 0, 0, set()
    while i < len(run) and j < len(order):
        if run[i] == order[j]:
            words.add(run[i])
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return len(words)


def _vocabulary(templates: list[tuple[str, str]]) -> np.ndarray:
    return np.unique(np.concatenate([words([text])[0] for _, text in templates] or [np.zeros(0, np.uint64)]))


def block_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """In how many blocks of the corpus each word of the templates is."""
    ship_code(docs.sparkSession)
    size = len(vocabulary)

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in slices(map(len, texts)):
                word, _, line = words(texts[a:b])
                at = np.minimum(np.searchsorted(vocabulary, word), size - 1)
                hit = vocabulary[at] == word
                total += np.bincount(np.unique(line[hit] * size + at[hit]) % size, minlength=size)
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(size), pa.int32()), "n": pa.array(total, pa.int64())})

    out = np.zeros(size, dtype=np.int64)
    if size:
        for r in docs.select("text").mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
            out[r["word"]] = r["n"]
    return out


MATCH_TYPE = "array<struct<label: string, line: int, containment: double>>"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every text's doc_id, n_words, ``phrases`` (label and first word of each place of a phrase)
    and ``matches`` (label, first line, containment of each block and template that match). NULL and
    empty texts: no words, nothing found."""
    vocabulary = _vocabulary(templates)
    index = Index.build(templates, threshold, vocabulary, block_frequencies(docs, vocabulary))
    sent = docs.sparkSession.sparkContext.broadcast(index)
    phrases = [(words([p])[0], label) for p, label in PHRASES.items()]

    def run(texts, rows):
        word, offsets, line = words(texts)
        n = len(texts)
        found: list[list[dict]] = [[] for _ in range(n)]
        text_of = np.repeat(np.arange(n), np.diff(offsets))
        for phrase, label in phrases:
            k = len(phrase)
            if len(word) < k:
                continue
            same = text_of[: len(word) - k + 1] == text_of[k - 1 :]
            for j in range(k):
                same &= word[j : len(word) - k + 1 + j] == phrase[j]
            for i in np.flatnonzero(same).tolist():
                t = int(text_of[i])
                found[t].append({"label": label, "word": int(i - offsets[t])})
        matched: list[list[dict]] = [[] for _ in range(n)]
        if len(word):
            # lines are numbered through all texts of the slice
            first_line = np.concatenate([[0], np.cumsum([t.count("\n") + 1 for t in texts])])
            own = sent.value.matches(word, line)
            for row, k, share in own + sent.value.run_matches(word, line, text_of, {(row, k) for row, k, _ in own}):
                t = int(np.searchsorted(first_line, row, side="right")) - 1
                matched[t].append({"label": sent.value.labels[k], "line": row - int(first_line[t]), "containment": share})
        return {"doc_id": row_ids(rows), "n_words": np.diff(offsets), "phrases": found, "matches": matched}

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, phrases array<struct<label: string, word: long>>, matches {MATCH_TYPE}"
    return map_slices(docs.select("doc_id", "text"), run, schema)


def _labels(column):
    return F.array_join(F.array_sort(F.array_distinct(column)), ",")


def op3_license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks of every
    document. The score is the highest containment of a template in a block, 1 with a phrase.

    NULL and empty texts: no words, nothing found, score 0. Templates that match equally well are
    all reported. Repeated rows give equal rows; other columns are not read; no rows give none."""
    found = scan(docs)
    base, more, at = F.col("phrases.label"), F.col("matches.label"), F.col("phrases.word")
    best = F.coalesce(F.array_max("matches.containment"), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"), _labels(base).alias("base_labels"), _labels(F.concat(base, more)).alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(best).alias("score"),
        F.size(F.array_distinct("matches.line")).cast("long").alias("n_blocks"),
    )
