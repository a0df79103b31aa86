"""Licence notices in files, by matching statistics over a generalised suffix automaton.

Method. The words of all templates are put into one suffix automaton, built online, each template from the
initial state. A file's words run through it: after each word the state and the match length are the
longest run of words, ending there, that stands in some template. A base phrase stands where it is a suffix
of the match. Runs that cannot be extended and are ``MIN_RUN`` words or longer are matches; those of one
template are chained, in order on both sides and at most ``GAP`` words apart in the file. The chain that
covers most of a template is its span, and its share of the template's words the score. A span names its label
if it covers ``COVER`` of the template and all its numbers (they tell versions apart), and if it does not lie
within a span of another label that covers more words, or as many of a shorter template: the wordings of sibling licences differ by a word.

Scale. One pass over whole texts without a shuffle. The automaton is built from the given templates alone
(``TEMPLATE_WORDS`` bounds them) and sent to the tasks. A word outside all templates resets
the state, so only runs of template words are walked.

Rows: a null or empty text has no words, no label and the score 0. Rows are independent, so repeated rows
and a null doc_id give a row each. Ties between chains go to the earlier place. An empty table gives an
empty result. Only doc_id and text are read.
"""

import numpy as np

from fleetlake.llm.common import alnum_words, map_batches, texts

MIN_RUN, GAP, COVER = 3, 8, 0.75
TEMPLATE_WORDS = 1_000_000

# Phrases that must be found wherever their words stand one after the other.
BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

# The wording by which licences are commonly named in files, label and text.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nd", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("gpl-2", "GNU General Public License version 2"),
    ("gpl-3", "GNU General Public License version 3"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]


class Automaton:
    """Generalised suffix automaton of word sequences; states are numbers, 0 the initial one."""

    def __init__(self, templates, base):
        self.words = {}
        self.templates = [(label, self.coded(text)) for label, text in templates]
        self.base = [(label, self.coded(text)) for label, text in base.items()]
        if sum(len(words) for _, words in self.templates) > TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {TEMPLATE_WORDS} words")
        self.next, self.link, self.length = [{}], [-1], [0]
        for _, words in [*self.templates, *self.base]:
            last = 0
            for word in words:
                last = self._extended(last, word)
        self.ends = self._phrase_ends()
        self.least = min([MIN_RUN, *(len(words) for _, words in self.base)])
        self.places = {}
        for number, (_, words) in enumerate(self.templates):
            for start in range(len(words) - MIN_RUN + 1):
                self.places.setdefault(tuple(words[start:start + MIN_RUN]), []).append((number, start))
        numeric = {code for word, code in self.words.items() if word.isdigit()}
        self.numbers = [frozenset(i for i, word in enumerate(words) if word in numeric) for _, words in self.templates]

    def coded(self, text):
        return [self.words.setdefault(word, len(self.words)) for word in alnum_words(text.encode())]

    def _state(self, length, following, link):
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state, word):
        """The state for the word after ``state`` that is exactly one word longer; cloned if it is longer."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        while state != -1 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        self.link[target] = clone
        return clone

    def _extended(self, last, word):
        if word in self.next[last]:
            return self._split(last, word)
        made, state = self._state(self.length[last] + 1, {}, 0), last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state != -1:
            self.link[made] = self._split(state, word)
        return made

    def _phrase_ends(self):
        """For each state the base phrases among its suffixes: (phrase, its words)."""
        own = {}
        for number, (_, words) in enumerate(self.base):
            state = 0
            for word in words:
                state = self.next[state][word]
            own.setdefault(state, []).append((number, len(words)))
        ends = [()] * len(self.next)
        for state in sorted(range(len(self.next)), key=self.length.__getitem__):
            ends[state] = (*own.get(state, ()), *(ends[self.link[state]] if state else ()))
        return ends

    def statistics(self, codes, start):
        """Walk one run of known words: base places (start, phrase) and maximal matches (start, length)."""
        following, link, length, ends = self.next, self.link, self.length, self.ends
        state = matched = 0
        places, runs = [], []
        for i, word in enumerate(codes):
            before = matched
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched <= before and before >= MIN_RUN:
                runs.append((start + i - before, before))
            for number, size in ends[state]:
                if matched >= size:
                    places.append((start + i - size + 1, number))
        if matched >= MIN_RUN:
            runs.append((start + len(codes) - matched, matched))
        return places, runs

    def scan(self, text):
        """(words, base places, spans); see ``chained`` for spans."""
        words = alnum_words(text)
        get = self.words.get
        codes = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
        known = np.flatnonzero(codes >= 0)
        places, runs = [], []
        if len(known):
            cut = np.flatnonzero(np.diff(known) > 1) + 1
            firsts, sizes = known[np.append(0, cut)], np.diff(np.concatenate([[0], cut, [len(known)]]))
            for first, size in zip(firsts[sizes >= self.least].tolist(), sizes[sizes >= self.least].tolist()):
                found = self.statistics(codes[first:first + size].tolist(), first)
                places += found[0]
                runs += found[1]
        return len(words), sorted(places), self.chained(codes, runs)

    def pieces(self, codes, runs):
        """For each template the places where a run and the template agree: (start, place in the template, words), longest possible."""
        found = {}
        for start, size in runs:
            going = {}
            for i in range(start, start + size - MIN_RUN + 1):
                for number, at in self.places.get(tuple(codes[i:i + MIN_RUN].tolist()), ()):
                    if going.get((number, at - i), -1) >= i:
                        continue
                    template = self.templates[number][1]
                    n = MIN_RUN
                    while i + n < start + size and at + n < len(template) and codes[i + n] == template[at + n]:
                        n += 1
                    going[number, at - i] = i + n - MIN_RUN
                    found.setdefault(number, set()).add((i, at, n))
        return found

    def chained(self, codes, runs):
        """The best chain of each template, matches in order on both sides and at most GAP words apart.

        A span is (template, first word, words up to its end, share covered, named or not).
        """
        spans = []
        for number, found in self.pieces(codes, runs).items():
            best = (0, 0, 0, frozenset())
            open_ = []  # chains that may go on: (covered, first, end in the file, end in the template, numbers covered)
            for start, at, n in sorted(found):
                numbers = self.numbers[number].intersection(range(at, at + n))
                chain = (n, start, start + n, at + n, numbers)
                open_ = [c for c in open_ if start - c[2] <= GAP]
                for c in open_:
                    if c[2] <= start and c[3] <= at and c[0] + n > chain[0]:
                        chain = (c[0] + n, c[1], start + n, at + n, c[4] | numbers)
                open_.append(chain)
                if (chain[0], len(chain[4])) > (best[0], len(best[3])):
                    best = (chain[0], chain[1], chain[2], chain[4])
            spans.append((number, best[1], best[2] - best[1], best[0] / len(self.templates[number][1]), best[0], best[3] == self.numbers[number]))
        return sorted(spans, key=lambda s: (-s[3], s[1], s[0]))

    def named(self, spans, cover):
        """The spans that name their template's label: see the module's text."""
        full = [s for s in spans if s[3] >= cover and s[5]]

        def better(s, t):
            inside = t[1] <= s[1] and s[1] + s[2] <= t[1] + t[2]
            return inside and (t[4], t[3]) > (s[4], s[3]) and self.templates[t[0]][0] != self.templates[s[0]][0]

        return [s for s in full if not any(better(s, t) for t in full)]


def automaton(templates=None, base=None):
    return Automaton(TEMPLATES if templates is None else templates, BASE if base is None else base)


def scanned(docs, templates=None, base=None, cover=COVER):
    """Per document: its words, places of base phrases, and spans that templates cover, with their labels."""
    told = docs.sparkSession.sparkContext.broadcast(automaton(templates, base))

    def scan(columns):
        found = told.value
        out = {name: [] for name in ("doc_id", "n_words", "places", "base_labels", "labels", "spans", "score")}
        for doc_id, text in zip(columns["doc_id"], columns["text"]):
            n, places, spans = found.scan(text)
            base_labels = {found.base[k][0] for _, k in places}
            full = found.named(spans, cover)
            labels = base_labels | {found.templates[s[0]][0] for s in full}
            row = (
                doc_id, n, [at for at, _ in places], sorted(base_labels), sorted(labels),
                [{"label": found.templates[k][0], "first_word": at, "words": size, "covered": share} for k, at, size, share, *_ in full],
                1.0 if base_labels else (spans[0][3] if spans else 0.0),
            )
            for name, value in zip(out, row):
                out[name].append(value)
        return out

    return map_batches(texts(docs), scan, (
        "doc_id long, n_words long, places array<long>, base_labels array<string>, labels array<string>, "
        "spans array<struct<label: string, first_word: long, words: long, covered: double>>, score double"
    ))


def labelled(docs):
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return scanned(docs).selectExpr(
        "doc_id", "n_words", "cast(size(places) as bigint) as n_base", "array_min(places) as first_word",
        "array_max(places) as last_word", "array_join(base_labels, ',') as base_labels", "array_join(labels, ',') as labels", "score",
    )
