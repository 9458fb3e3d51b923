"""License notices by fingerprints and banded alignment.

A notice that covers enough of a template lacks a bounded number of its words, so of one word more at least one is there: so
many of a template's rarer words are its fingerprints, and no notice is missed, wherever words are changed, left out or put in.
The inverted index from fingerprints to template places is small and travels with the tasks; a document's words are looked up
in it, and words are aligned within a band around each diagonal that a hit can belong to, if enough template words are near.
A candidate whose alignment covers enough of the template is reported, if the words that name the license and its version are
there as well: coverage alone would take "under the Elastic License" for a license whose notice differs in that word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows
from tidemark.llm.shingles import words

BAND = 4  # words by which a copy may shift
COVERAGE = 0.8

# Wording of common notices.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Other wordings.  Where licenses differ in one word each has its own, because the longest and fullest match is reported.
_TERMS = "you can redistribute it and/or modify it under the terms of the"
_LATER = "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
NOTICES |= {
    "agpl-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "agpl-notice": f"This program is free software: {_TERMS} GNU Affero General Public License {_LATER.format('3')}",
    "apache-1.1": "Licensed under the Apache Software License, Version 1.1.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-licensed": "Licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": f"This program is free software; {_TERMS} GNU General Public License {_LATER.format('2')}",
    "gpl-3.0-licensed": "Licensed under the GNU General Public License, version 3.",
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "lgpl-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-2.1-notice": f"This library is free software; {_TERMS} GNU Lesser General Public License {_LATER.format('2.1')}",
    "lgpl-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-notice": f"This library is free software: {_TERMS} GNU Lesser General Public License {_LATER.format('3')}",
    "mpl-1.1": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
for _verb in ("Licensed", "Released"):
    for _kind in ("Apache", "BSD", "GPL", "ISC", "LGPL", "zlib", *(["MIT"] if _verb == "Licensed" else [])):
        NOTICES[f"{_kind.lower()}-{_verb.lower()}"] = f"{_verb} under the {_kind} License."
for _kind in ("NonCommercial", "NoDerivatives", "ShareAlike", "NonCommercial-NoDerivatives", "NonCommercial-ShareAlike"):
    NOTICES[f"cc-by-{_kind.lower()}-4.0"] = f"This work is licensed under a Creative Commons Attribution-{_kind} 4.0 International License."
for _kind in ("", "-NonCommercial", "-NoDerivatives", "-ShareAlike", "-NonCommercial-NoDerivatives", "-NonCommercial-ShareAlike"):
    NOTICES[f"cc-by{_kind.lower()}-3.0"] = f"This work is licensed under a Creative Commons Attribution{_kind} 3.0 Unported License."

# Words that name a license, and those of its version.
NAMES = (
    "affero apache attribution bsd cc commons creative general gnu gpl isc lesser lgpl mit mozilla nc noncommercial noderivatives "
    "sharealike zlib"
).split()
VERSIONS = "0 1 2 3 4".split()

# Letters and digits make words; bytes of other scripts count as letters.
_BREAK = np.array([not (b >= 128 or chr(b).isalnum()) for b in range(256)])


# Words that a template's fingerprints avoid; any choice of fingerprints is right.
_FREQUENT = "a an and any are as at be by for from in is it may not of on or that the this to under use with you".split()


def least_words(size: int) -> int:
    """Fewest words of a template of so many that cover enough of it."""
    return math.ceil(COVERAGE * size)


@dataclass(frozen=True)
class Index:
    names: tuple[str, ...]
    hashes: tuple[np.ndarray, ...]  # word hashes of each template
    keys: np.ndarray  # fingerprints in ascending order, once for every place
    template: np.ndarray
    place: np.ndarray
    titles: frozenset[int] = frozenset()  # hashes of words that name licenses
    decisive: frozenset[int] = frozenset()  # and those of versions too


def _hashes(terms: Iterable[str]) -> frozenset[int]:
    return frozenset(words(" ".join(terms).encode(), _BREAK)[1].tolist())


def build(notices: dict[str, str], titles: Iterable[str] = (), versions: Iterable[str] = ()) -> Index:
    """The inverted index of templates: of each as many places, and one more, as a notice may lack.

    A notice has all words of its template that are ``titles`` or ``versions``, in order, and no other of ``titles``.
    """
    names = tuple(sorted(notices))
    hashes = tuple(words(notices[n].encode(), _BREAK)[1] for n in names)
    frequent = _hashes(_FREQUENT)
    holders = Counter(w for h in hashes for w in set(h.tolist()))
    rows = []
    for n, h in enumerate(hashes):
        places = sorted(range(h.size), key=lambda i: (int(h[i]) in frequent, holders[int(h[i])], i))
        rows += [(int(h[i]), n, i) for i in places[: h.size - least_words(h.size) + 1]]
    rows.sort()
    return Index(
        names,
        hashes,
        np.array([r[0] for r in rows], np.uint64),
        np.array([r[1] for r in rows], np.int64),
        np.array([r[2] for r in rows], np.int64),
        _hashes(titles),
        _hashes([*titles, *versions]),
    )


def align(template: np.ndarray, text: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Most template words matched in order within BAND of the diagonal ``shift``; first and last matched text word."""
    width = 2 * BAND + 1
    best = [(0, -1, -1)] * (width + 2)  # of each diagonal: matched words, first and last text word
    for i, word in enumerate(template.tolist()):
        row = [(0, -1, -1)] * (width + 2)
        for d in range(1, width + 1):
            j = i + shift + d - 1 - BAND
            # Skip a template word, or a text word, or match both.
            options = [best[d + 1], row[d - 1]]
            matched, first, last = best[d]
            if 0 <= j < text.size and int(text[j]) == word:
                options.append((matched + 1, j if first < 0 else first, j))
            else:
                options.append(best[d])
            row[d] = max(options, key=lambda o: (o[0], o[1] - o[2]))
        best = row
    return max(best, key=lambda o: (o[0], o[1] - o[2]))


def centres(template: list[int], text: list[int], shifts: set[int], done: set[int], decisive: frozenset[int]) -> list[int]:
    """Diagonals within BAND of ``shifts`` around which enough words of the template lie and all ``decisive`` ones, but for those ``done``."""
    enough = least_words(len(template))
    needed = decisive.intersection(template)

    def near(shift: int, band: int) -> bool:
        there = set(text[max(0, shift - band) : max(0, shift + len(template) + band)])
        return needed <= there and sum(w in there for w in template) >= enough

    wide = [s for s in shifts if near(s, 2 * BAND)]
    return sorted(c for c in {s + d for s in wide for d in range(-BAND, BAND + 1)} - done if near(c, BAND))


def named(index: Index, template: list[int], span: list[int]) -> bool:
    """Whether the words that decide which license it is are those of the template."""
    rest = iter(span)
    return all(w in rest for w in template if w in index.decisive) and index.titles.intersection(span) <= set(template)


def find(index: Index, hashes: np.ndarray, hit: np.ndarray) -> list[tuple[int, int, int, float]]:
    """Notices of one document: ``(template, first word, last word, coverage)``; ``hit`` are places of known words."""
    per: dict[int, set[int]] = defaultdict(set)
    low, high = np.searchsorted(index.keys, hashes[hit], "left"), np.searchsorted(index.keys, hashes[hit], "right")
    for at, a, b in zip(hit.tolist(), low.tolist(), high.tolist()):
        for n in range(a, b):
            per[int(index.template[n])].add(at - int(index.place[n]))
    text = hashes.tolist()
    aligned = set()
    for template, shifts in per.items():
        own = index.hashes[template].tolist()
        size = len(own)
        # A notice word for word is the best alignment of all diagonals that reach it.
        whole = {s for s in shifts if s >= 0 and text[s : s + size] == own}
        aligned |= {(template, s, s + size - 1, 1.0) for s in whole}
        reached = {s + d for s in whole for d in range(-BAND, BAND + 1)}
        for centre in centres(own, text, shifts, reached, index.decisive):
            matched, first, last = align(index.hashes[template], hashes, centre)
            if matched >= least_words(size) and named(index, own, text[first : last + 1]):
                aligned.add((template, first, last, matched / size))
    found = list(aligned)
    # Of overlapping notices the longer match stays, then the fuller, then the denser, then the first, then the first by name.
    found.sort(key=lambda f: (-round(f[3] * index.hashes[f[0]].size), -f[3], f[2] - f[1], f[1], f[0]))
    kept: list[tuple[int, int, int, float]] = []  # none overlaps another, by first word
    for f in found:
        at = bisect(kept, f[1], key=lambda k: k[1])
        if (at == 0 or kept[at - 1][2] < f[1]) and (at == len(kept) or kept[at][1] > f[2]):
            kept.insert(at, f)
    return kept


def scan(docs: DataFrame, notices: dict[str, str] | None = None, titles: Iterable[str] = (), versions: Iterable[str] = ()) -> DataFrame:
    """``doc_id, n_licenses, licenses``: template, span in code points (end exclusive) and coverage of each notice.

    Without ``notices`` those above are looked for, told apart by NAMES and VERSIONS; own ones by ``titles`` and ``versions``.
    One row per input row; null and empty texts have none, rows that repeat repeat, an empty table gives no rows.
    """
    index = build(NOTICES, NAMES, VERSIONS) if notices is None else build(notices, titles, versions)

    def run(part: dict[str, list]) -> dict[str, list]:
        encoded = [(t or "").encode() for t in part["text"]]
        data = b"\n".join([*encoded, b""])
        starts, hashes = words(data, _BREAK)
        ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
        first = np.searchsorted(starts, np.concatenate([[0], ends]))
        if index.keys.size:
            known = index.keys[np.minimum(np.searchsorted(index.keys, hashes), index.keys.size - 1)] == hashes
        else:
            known = np.zeros(hashes.size, bool)
        hits = np.flatnonzero(known)
        out = []
        for n, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            own = hits[np.searchsorted(hits, a) : np.searchsorted(hits, b)] - a
            rows = []
            if own.size:
                begin = int(ends[n]) - len(encoded[n]) - 1
                for template, low, high, coverage in find(index, hashes[a:b], own):
                    start, last = int(starts[a + low]) - begin, int(starts[a + high]) - begin
                    end = last + re.match(rb"[0-9A-Za-z\x80-\xff]+", encoded[n][last:]).end()
                    rows.append(
                        {
                            "license": index.names[template],
                            "start": len(encoded[n][:start].decode()),
                            "end": len(encoded[n][:end].decode()),
                            "coverage": coverage,
                        }
                    )
            out.append(rows)
        return {"doc_id": part["doc_id"], "n_licenses": [len(r) for r in out], "licenses": out}

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, run, "doc_id bigint, n_licenses bigint, licenses array<struct<license:string,start:int,end:int,coverage:double>>", rows=512)


def report(docs: DataFrame) -> DataFrame:
    """``scan`` with the notices as text: ``license:start:end:coverage``."""
    shown = F.transform(
        "licenses",
        lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string"), F.format_string("%.3f", s["coverage"])),
    )
    return scan(docs).select("doc_id", "n_licenses", F.concat_ws(",", shown).alias("licenses"))
