"""License notices in whole texts: consecutive-word phrases, and short notices with a few errors.

A notice may be met with up to ``errors`` insertions, deletions or substitutions of characters in
its normal form (words in lower case, joined by one space). Cut into ``errors + 1`` parts, one part
must then stand unchanged (pigeonhole). One automaton over all parts finds those exact seeds; around
each seed a window just wide enough for the whole notice goes to the regex library's bounded-error
matching, which settles the edits and the span. Each seed's window is searched by itself, and what stands beside
a best match in it again; of overlapping matches of a notice the one with fewer errors, then the first, is kept.

Defined results: a null text counts as empty; a text without words has null first and last word,
empty labels and score 0; every input row has one output row, repeated ids included; other columns
are left out. Words are runs of ASCII letters and digits and of any non-ASCII characters.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from .common import map_texts, with_text

# Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Notice:
    label: str
    text: str      # normal form
    errors: int    # edits of characters allowed


# Short notices in normal form; roughly one edit is allowed for each dozen characters.
NOTICES = (
    Notice("mit", "released under the mit license", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 3),
    Notice("gpl", "licensed under the gnu general public license version", 4),
    Notice("gpl", "this program is free software you can redistribute it and or modify it", 5),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("agpl", "gnu affero general public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("mpl", "subject to the terms of the mozilla public license", 4),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", 1),
    Notice("cc-by", "creative commons attribution 4 0 international", 3),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
)

# ASCII to normal form: capitals become small, every non-word character a space; other bytes stay.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else
                b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def seeds(notice: Notice) -> list[tuple[str, int]]:
    """The notice in ``errors + 1`` contiguous parts, each with its offset."""
    n, k = len(notice.text), notice.errors + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(notice.text[a:b], a) for a, b in zip(cuts, cuts[1:])]


def spaces_before(line: str, places: set[int]) -> dict[int, int]:
    """How many spaces stand before each place, in one sweep over the line."""
    out, at, total = {}, 0, 0
    for place in sorted(places):
        total += line.count(" ", at, place)
        out[place], at = total, place
    return out


class Scanner:
    def __init__(self, phrases: dict[str, str], notices: tuple[Notice, ...]):
        self.phrases = [(f" {p} ", label) for p, label in phrases.items()]
        self.notices = notices
        found: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(notices):
            for part, offset in seeds(notice):
                found.setdefault(part, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for part, where in found.items():
            self.automaton.add_word(part, (len(part), where))
        if notices:
            self.automaton.make_automaton()
        # best match of the whole notice, at the edges of words
        self.patterns = [regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(x.text, literal_spaces=True)}){{e<={x.errors}}}(?![^ ])")
                         for x in notices]

    def base(self, line: str) -> tuple[list[int], list[str]]:
        """Character offsets at which the words of a phrase stand consecutively, and the labels met."""
        at, labels = [], []
        for phrase, label in self.phrases:
            i = line.find(phrase)
            while i >= 0:
                at.append(i)
                labels.append(label)
                i = line.find(phrase, i + 1)
        return at, labels

    def fuzzy(self, line: str) -> list[tuple[int, int, int, int]]:
        """(notice, begin, end, errors) of the verified notices, in characters of ``line``."""
        windows: dict[int, dict[int, int]] = {}
        for last, (length, where) in self.automaton.iter(line):
            for i, offset in where:
                notice = self.notices[i]
                begin = max(0, last + 1 - length - offset - notice.errors - 1)
                end = min(len(line), last + 1 - length - offset + len(notice.text) + notice.errors + 1)
                if end < len(line) and line[end] != " ":       # a word cut by the end is no part of a match
                    end = line.rfind(" ", begin, end) + 1
                mine = windows.setdefault(i, {})
                mine[begin] = max(mine.get(begin, 0), end)
        out = []
        for i, mine in windows.items():
            found = {m for begin, end in mine.items() for m in self.matches(i, line, begin, end)}
            begins, ends = [], []       # of the kept matches, which do not overlap
            for errors, begin, end in sorted(found):
                at = bisect_left(begins, begin)
                if (at == 0 or ends[at - 1] <= begin) and (at == len(begins) or end <= begins[at]):
                    begins.insert(at, begin), ends.insert(at, end)
                    out.append((i, begin, end, errors))
        return out

    def matches(self, i: int, line: str, begin: int, end: int) -> list[tuple[int, int, int]]:
        """(errors, begin, end) of the best match in a stretch, and of those in what is left on both sides."""
        least = max(1, len(self.notices[i].text) - self.notices[i].errors)
        out, left = [], [(begin, end)]
        while left:
            a, b = left.pop()
            m = self.patterns[i].search(line, a, b) if b - a >= least else None
            if m and m.start() < m.end():
                out.append((sum(m.fuzzy_counts), m.start(), m.end()))
                left += [(a, m.start()), (m.end(), b)]
        return out

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()
        if not words:
            return 0, 0, None, None, "", "", 0.0, []
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        at, labels = self.base(line)
        found = self.fuzzy(line) if self.notices else []
        before = spaces_before(line, {*at, *(x for _, begin, end, _ in found for x in (begin, begin + 1, end))})
        spans, score = [], 1.0 if at else 0.0
        for i, begin, end, errors in found:
            first, notice = before[begin + 1] - 1, self.notices[i]
            spans.append((notice.label, first, first + before[end] - before[begin] + 1 - (line[begin] == " "), errors))
            score = max(score, 1.0 - errors / len(notice.text))
        starts = [before[i] for i in at]
        both = sorted(set(labels) | {s[0] for s in spans})
        return (len(words), len(at), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(set(labels))), ",".join(both), score, sorted(set(spans)))


@lru_cache(maxsize=4)
def scanner(phrases: tuple, notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(dict(phrases), notices)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] | None = None,
                  notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Per row: number of words, places and labels of the phrases, all labels, score, verified spans.

    ``spans`` holds (label, first word, word after the last, errors); ``score`` is 1 for an exact
    phrase, else the share of the best notice's characters that stand unchanged, else 0.
    """
    exact = tuple((PHRASES if phrases is None else phrases).items())
    return map_texts(
        with_text(df, id_col, text_col), id_col,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first:int,after:int,errors:int>>",
        lambda texts: [scanner(exact, notices).scan(t) for t in texts])
