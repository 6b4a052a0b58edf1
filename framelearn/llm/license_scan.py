"""License scan: phrases counted exactly, and an exact containment join of text blocks with license templates.

A block is a run of at most ``2m`` words of one paragraph that starts at a
multiple of ``m``, ``m`` being the longest template's length, so every run of
``m`` words lies in one block, also one that is wrapped over several lines.
Lines without words end a paragraph, and so does a line of one word with room
for the next. Each line's own blocks are read too. A template of ``t`` distinct words is found in a block
when at least ``ceil(threshold * t)`` of them stand in it.

Words are ordered by their frequency in the whole corpus, rare first. A block
that reaches the threshold must hold one of the template's first
``t - ceil(threshold * t) + 1`` words (prefix filter), have at least
``ceil(threshold * t)`` distinct words (length filter), and have enough words
left in both orders behind the first word they share (positional filter). Only
blocks that pass are counted in full, so none that reaches the threshold is lost.

The templates are a parameter of a few lines, so they travel with the tasks;
the texts are scanned where they lie and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelearn.llm.common import by_batch, narrow

#: Phrase -> label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label -> statements of a license, as word sequences.
TEMPLATES = {
    "all-rights": ["all rights reserved"],
    "apache": ["licensed under the apache license version 2 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "cc": ["licensed under cc by 4 0", "licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "gpl": ["this work is licensed under the gnu general public license version 3", "you can redistribute it and or modify it under the terms of the gnu general public license"],
    "mit": ["released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license version 2 0"],
}

THRESHOLD = 0.85

#: Bytes that belong to a word (after lower-casing): 0-9, a-z and everything outside ASCII; others become spaces.
_WORDS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

SCANNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, split at every other ASCII character that is no digit or letter."""
    return (text or "").encode().lower().translate(_WORDS).split()


def _needed(size: int, threshold: float) -> int:
    """Words of a template of ``size`` distinct words that a block must hold."""
    return max(1, int(np.ceil(threshold * size - 1e-9)))


def word_frequencies(docs: DataFrame, words: list[bytes]) -> dict[bytes, int]:
    """In how many rows each of the given words stands; the words are those of the templates, a bounded list."""
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                for w in wanted.intersection(words_of(text.as_py())):
                    counts[w] = counts.get(w, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"]
        )

    parts = docs.select("text").mapInArrow(count, "w string, n bigint")
    found = parts.groupBy("w").agg(F.sum("n").alias("n")).collect()
    return {r["w"].encode(): r["n"] for r in found}


class Templates:
    """Templates as word ranks in the corpus order, with their prefixes."""

    def __init__(self, templates: dict[str, list[str]], threshold: float, frequency: dict[bytes, int]):
        sets = [(label, sorted(set(words_of(t)))) for label in sorted(templates) for t in templates[label]]
        sets = [(label, s) for label, s in sets if s]
        every = {w for _, s in sets for w in s}
        ordered = sorted(every, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.sets = [(label, sorted(self.rank[w] for w in s), _needed(len(s), threshold)) for label, s in sets]
        self.prefix: dict[int, list[int]] = {}
        for k, (_, ranks, need) in enumerate(self.sets):
            for r in ranks[: len(ranks) - need + 1]:
                self.prefix.setdefault(r, []).append(k)
        self.triggers = frozenset(ordered[r] for r in self.prefix)
        self.step = max([len(words_of(t)) for ts in templates.values() for t in ts] or [1])

    def matches(self, block: list[bytes]) -> dict[int, int]:
        """Template number -> shared words, for the templates that the block reaches.

        Words outside the templates have no rank: they come after all ranked ones
        and only count for the block's length.
        """
        if self.triggers.isdisjoint(block):
            return {}
        distinct = set(block)
        ranks = sorted(self.rank[w] for w in distinct if w in self.rank)
        own = set(ranks)
        tried, found = set(), {}
        for at, r in enumerate(ranks):
            for k in self.prefix.get(r, ()):
                if k in tried:
                    continue
                tried.add(k)
                _, wanted, need = self.sets[k]
                if len(distinct) < need:
                    continue
                # r is the first word they share: none earlier in either order is shared
                if 1 + min(len(wanted) - wanted.index(r) - 1, len(ranks) - at - 1) < need:
                    continue
                shared = sum(w in own for w in wanted)
                if shared >= need:
                    found[k] = shared
        return found


def _paragraphs(text: str) -> Iterator[list[bytes]]:
    """The words of each line, and those of each run of several lines that belong together.

    A line without words ends such a run, and so does a line of one word that
    had room for the next line's first one: a heading or an entry of a list.
    """
    run: list[bytes] = []
    n, only, size = 0, False, 0
    for line in text.split("\n"):
        words = words_of(line)
        shown = line.strip()
        first = len(words[0].decode(errors="replace")) if words else 0
        if n and (not words or only and size + 1 + first <= len(shown)):
            if n > 1:
                yield run
            run, n = [], 0
        if words:
            yield words
            run.extend(words)
            n, only, size = n + 1, len(words) == 1, len(shown)
    if n > 1:
        yield run


def blocks_of(text: str, step: int) -> Iterator[list[bytes]]:
    """Runs of at most ``2 * step`` words, starting at every multiple of ``step`` of a line or of lines that belong together."""
    for words in _paragraphs(text):
        for s in range(0, max(1, len(words) - step), step):
            yield words[s : s + 2 * step]


def _scan(templates: Templates, phrases: list[tuple[bytes, str]]):
    any_phrase = re.compile(rb"(?= (" + b"|".join(re.escape(p) for p, _ in phrases) + rb") )")
    label_of = dict(phrases)
    last_words = frozenset(p.split()[-1] for p, _ in phrases)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = {f.name: [] for f in SCANNED.fields}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            body = text.as_py() or ""
            words = words_of(body)
            base, first, last, found, best = [], None, None, set(), 0.0
            if not last_words.isdisjoint(words):
                joined = b" " + b" ".join(words) + b" "
                hits = [(m.start(), m[1]) for m in any_phrase.finditer(joined)]
                if hits:
                    # spaces before a place = words before it
                    first, last = joined.count(b" ", 0, hits[0][0]), joined.count(b" ", 0, hits[-1][0])
                    found.update(label_of[p] for _, p in hits)
                    base, best = hits, 1.0
            labels = set(found)
            if not templates.triggers.isdisjoint(words):
                for block in blocks_of(body, templates.step):
                    for k, shared in templates.matches(block).items():
                        label, wanted, _ = templates.sets[k]
                        labels.add(label)
                        best = max(best, shared / len(wanted))
            for name, value in zip(
                rows, (doc, len(words), len(base), first, last, ",".join(sorted(found)), ",".join(sorted(labels)), best)
            ):
                rows[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))

    return by_batch(run)


def license_scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, list[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: words, phrase places, labels, score.

    A phrase counts at every place where its words stand in a row, overlaps
    included; ``first_word`` and ``last_word`` are NULL without one. ``labels``
    adds those of the templates that some block contains. The score is 1 with a
    phrase, else the largest containment at or over the threshold, else 0. Two
    phrases that start at one place count once when neither is the other's
    beginning; such phrases are refused. NULL and empty texts have no words and
    no labels; NULL ids, repeated rows and empty tables give the like rows; other
    columns are not read.
    """
    listed = [(b" ".join(words_of(p)), label) for p, label in phrases.items()]
    if any(a != b and b.startswith(a + b" ") for a, _ in listed for b, _ in listed) or not all(p for p, _ in listed):
        raise ValueError("a phrase must have words and not begin with another phrase")
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    words = sorted({w for ts in templates.values() for t in ts for w in words_of(t)})
    known = Templates(templates, threshold, word_frequencies(rows, words))
    return rows.mapInArrow(_scan(known, listed), SCANNED)
