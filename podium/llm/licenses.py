"""Licence scan by sentence rules.

A text is cut into sentences, each is brought into a normal form (lower case, letters, digits and inner
points only, one spelling of licence) and looked up among the known licence sentences. What a document
yields is a short sequence of sentence identifiers with their places. A licence is recognised where a
rule's identifiers follow one another in order, with at most ``gap`` other pieces (lines or sentences)
between two; of rules that start at one place the longest wins, and what it used is not used again.

Short notices ("this project is licensed under ..."), SPDX lines, GNU grants and BSD clauses have slots for
subject, holder, version and further licences; they may be wrapped over several pieces. Covered are the licences
of ``NAMES`` by name, notice, identifier and title, the texts or grants of those in ``RULES``, and reserved rights.

The tables below have a fixed, small size and travel with the code.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import slices

GAP = 4

# Normalised sentences of well-known licences and notices, with the identifiers used here.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache-2.0.short",
    "licensed under the apache license version 2.0 the license": "apache-2.0.grant",
    "you may not use this file except in compliance with the license": "apache-2.0.compliance",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache-2.0.copy",
    "released under the mit license": "mit.short",
    "licensed under the mit license": "mit.short",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit.grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit.notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit.warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd.grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd.source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd.binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd.names",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0.short",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any "
    "later version": "gpl-3.0.grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "gpl.warranty",
    "you should have received a copy of the gnu general public license along with this program": "gpl.copy",
    "licensed under cc by nc 4.0": "cc-by-nc-4.0.short",
    "licensed under cc by 4.0": "cc-by-4.0.short",
    "licensed under cc by sa 4.0": "cc-by-sa-4.0.short",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by-4.0.short",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl-2.0.grant",
    "spdx license identifier apache 2.0": "apache-2.0.short",
    "spdx license identifier mit": "mit.short",
    "spdx license identifier gpl 3.0 only": "gpl-3.0.short",
    "all rights reserved": "reserved",
}
# A licence and the sentences that make it up, in order.
RULES = (
    ("Apache-2.0", ("apache-2.0.grant", "apache-2.0.compliance", "apache-2.0.copy")),
    ("Apache-2.0", ("apache-2.0.grant", "apache-2.0.compliance")),
    ("Apache-2.0", ("apache-2.0.short",)),
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty")),
    ("MIT", ("mit.short",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("GPL-3.0-or-later", ("gpl-3.0.grant", "gpl.warranty", "gpl.copy")),
    ("GPL-3.0-or-later", ("gpl-3.0.grant",)),
    ("GPL-3.0", ("gpl-3.0.short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0.short",)),
    ("CC-BY-4.0", ("cc-by-4.0.short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0.short",)),
    ("MPL-2.0", ("mpl-2.0.grant",)),
)

# How a licence is called in a normalised notice, most particular first. v() is a version.
def v(number: str) -> str:
    return rf"(?: license)?(?: version| v)? ?v?{number}(?![\w.])"


_GPL, _LGPL, _AGPL = (rf"(?:gnu )?(?:{word}general public license|{short})" for word, short in
                      (("", "gpl"), ("(?:lesser |library )", "lgpl"), ("affero ", "agpl")))
_CC = r"(?:creative commons|cc)"
_INTERNATIONAL = r"(?: version| v)? 4(?:\.0)?(?![\w.])(?: international)?"
NAMES = (
    *((f"{name}-{number}", rf"(?:{words}{v(digits)}|version {digits} of the {words})")
      for name, words, versions in (("AGPL", _AGPL, (("3.0", r"3(?:\.0)?"),)),
                                    ("LGPL", _LGPL, (("2.0", r"2(?:\.0)?"), ("2.1", r"2\.1"), ("3.0", r"3(?:\.0)?"))),
                                    ("GPL", _GPL, (("1.0", r"1(?:\.0)?"), ("2.0", r"2(?:\.0)?"), ("3.0", r"3(?:\.0)?"))))
      for number, digits in versions),
    ("Apache-1.1", rf"apache(?: software)?{v(r'1[.]1')}"), ("Apache-2.0", rf"apache(?: software)?{v(r'2(?:[.]0)?')}"),
    ("MIT-0", r"mit (?:no attribution|0)"), ("MIT", r"(?:mit(?: x11| expat)?|expat)(?! no\b| 0\b)"), ("ISC", r"isc"),
    ("0BSD", r"(?:0bsd|(?:bsd )?zero clause bsd|bsd 0 clause)"),
    ("BSD-2-Clause", r"(?:(?:2|two) clause bsd|(?:simplified|freebsd) bsd|bsd (?:2|two) clause|simplified bsd)"),
    ("BSD-4-Clause", r"(?:(?:4|four) clause bsd|original bsd|bsd (?:4|four) clause)"),
    ("BSD-3-Clause", r"(?:(?:3|three) clause bsd|(?:new|modified|revised) bsd|bsd (?:3|three) clause|bsd 3)"),
    ("MPL-1.1", rf"(?:mozilla public|mpl){v(r'1[.]1')}"), ("MPL-2.0", rf"(?:mozilla public|mpl){v(r'2(?:[.]0)?')}"),
    ("EPL-1.0", rf"(?:eclipse public|epl){v(r'1(?:[.]0)?')}"), ("EPL-2.0", rf"(?:eclipse public|epl){v(r'2(?:[.]0)?')}"),
    ("EUPL-1.2", rf"(?:european union public|eupl){v(r'1[.]2')}"), ("CDDL-1.0", rf"(?:common development and distribution|cddl){v(r'1(?:[.]0)?')}"),
    ("BSL-1.0", rf"(?:boost software|boost|bsl){v(r'1(?:[.]0)?')}"), ("Artistic-2.0", rf"artistic{v(r'2(?:[.]0)?')}"),
    ("Zlib", r"(?:zlib(?: libpng)?)"), ("Unlicense", r"(?:unlicense|the unlicense)"), ("WTFPL", r"(?:wtfpl|do what the fuck you want to public)"),
    ("PSF-2.0", rf"(?:python software foundation|psf){v(r'2(?:[.]0)?')}"),
    ("CC0-1.0", rf"(?:{_CC} zero|cc0|{_CC} cc0)(?: license)?(?: v?1(?:\.0)?(?: universal)?(?: public domain dedication)?)?"),
    *((f"CC-{code}-4.0", rf"{_CC} (?:(?:cc )?{code.lower().replace('-', ' ')}|{words}){_INTERNATIONAL}") for code, words in (
        ("BY-NC-SA", "attribution non ?commercial share ?alike"), ("BY-NC-ND", "attribution non ?commercial no ?deriv(?:ative)?s"),
        ("BY-NC", "attribution non ?commercial"), ("BY-SA", "attribution share ?alike"),
        ("BY-ND", "attribution no ?deriv(?:ative)?s"), ("BY", "attribution"))),
)
_LATER = r"(?: license)?(?P<later> or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?)?(?P<only> only)?"
_NAME = [(name, re.compile(rf"(?:{words})(?![\w.]){_LATER}(?: license| public license)?")) for name, words in NAMES]
_BETWEEN = re.compile(r"(?: (?:and|or|either|both|under|the|a|terms|of|with|dual|spdx|license|licenses))* ")
_NOTICE = re.compile(r"\b(?<!not )(?:(?:re)?licensed|released|(?:re)?distributed|published|provided|available|covered|governed|offered|shared|"
                     r"use(?:d)?|modif(?:y|ied)|subject to|usable)(?: \w+){0,2}? (?:under|by|to|per)(?= )|\bspdx license identifier(?= )|"
                     r"\blicense(?: is)?(?= )")
_FREE = re.compile(rf"\bis free software you (?:can|may) redistribute it and or modify it under the terms of (?:version \d(?:\.\d)? of )?the "
                   rf"(?P<agpl>{_AGPL})?(?P<lgpl>{_LGPL})?(?P<gpl>{_GPL})?(?: version (?P<before>\d(?:\.\d)?))?"
                   r"(?: only)? as published by the free software foundation"
                   r"(?: (?:either )?version (?P<after>\d(?:\.\d)?)(?: of the license)?(?P<later> or at your option any later version)?)?")
_SLOTS = (
    ("bsd.names", re.compile(r"\b(?:neither )?the names? of (?:[\w.]+ ){1,16}?(?:nor the names of (?:[\w.]+ ){0,4}?contributors )?(?:may|must) (?:not )?be "
                             r"used to endorse or promote products derived from this software without(?: specific)? prior written permission")),
    ("bsd.source", re.compile(r"\bredistributions? of source code must retain the (?:above )?copyright notices? this list of conditions and the following disclaimer")),
    ("bsd.binary", re.compile(r"\bredistributions? in binary form must reproduce the (?:above )?copyright notices? this list of conditions and the following "
                              r"disclaimer in the documentation and or other materials provided with the distribution")),
    ("reserved", re.compile(r"\ball rights (?:are )?reserved\b")),
)
_HEAD = re.compile(r"licen|gpl|spdx|free software|redistribution|the names? of|rights|\b(?:under|released|distributed|published)\b", re.I)
_REACH = 14  # pieces of a wrapped notice
_TEXTS = {
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
    "copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above "
    "copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd.grant",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it "
    "freely subject to the following restrictions": "zlib.grant",
    "this is free and unencumbered software released into the public domain": "unlicense.grant",
    "the contents of this file are subject to the mozilla public license version 1.1 the license": "mpl-1.1.grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation "
    "covered by this license the software to use reproduce display distribute execute and transmit the software": "bsl-1.0.grant",
    "apache license version 2.0 january 2004": "apache-2.0.short", "mit license": "mit.short", "the mit license": "mit.short",
    "the mit license mit": "mit.short", "isc license": "isc.short", "mozilla public license version 2.0": "mpl-2.0.short",
    "gnu general public license version 2 june 1991": "gpl-2.0.short", "gnu general public license version 3 29 june 2007": "gpl-3.0.short",
    "gnu lesser general public license version 2.1 february 1999": "lgpl-2.1.short",
    "gnu lesser general public license version 3 29 june 2007": "lgpl-3.0.short",
    "gnu affero general public license version 3 19 november 2007": "agpl-3.0.short",
    "eclipse public license v 2.0": "epl-2.0.short", "eclipse public license v 1.0": "epl-1.0.short",
    "boost software license version 1.0 august 17th 2003": "bsl-1.0.short", "cc0 1.0 universal": "cc0-1.0.short",
}
RULES = (
    *RULES, ("ISC", ("isc.grant",)), ("0BSD", ("0bsd.grant",)), ("Zlib", ("zlib.grant",)), ("Unlicense", ("unlicense.grant",)),
    ("MPL-1.1", ("mpl-1.1.grant",)), ("BSL-1.0", ("bsl-1.0.grant",)),
    *((f"{name}{form}", (f"{name.lower()}{form}.{kind}",)) for name, _ in NAMES for form in ("", "-only", "-or-later")
      for kind in ("short", "grant") if "GPL" in name or not form and kind == "short"),
)
# A text's own line of reserved rights belongs to it; alone it is a notice.
RULES = (*RULES, *((name, ("reserved", *ids)) for name, ids in RULES if len(ids) > 1), ("LicenseRef-All-Rights-Reserved", ("reserved",)))

_LAST = re.compile(r"(?<=\d)\+(?!\w)")
_END = re.compile(r"[.!?;:]+(?=\s|$)|\n")
_OTHER = re.compile(r"[^\w.]+|_+")
_POINT = re.compile(r"(?<!\w)\.+|\.+(?!\w)")


def normalised(sentence: str) -> str:
    words = _POINT.sub(" ", _OTHER.sub(" ", _LAST.sub(" or later ", sentence.lower().replace("licence", "license"))))
    return " ".join(words.split())


def slotted(run: str, first: int) -> tuple[int, list[str]]:
    """End and identifiers of a notice with slots that begins within the ``first`` characters of a normalised run."""
    if (m := _FREE.search(run)) and m.start() < first and (number := m["after"] or m["before"]):
        family = "agpl" if m["agpl"] else "lgpl" if m["lgpl"] else "gpl"
        return m.end(), [f"{family}-{number if '.' in number else number + '.0'}{'-or-later' if m['later'] else '-only'}.grant"]
    for name, pattern in _SLOTS:
        if (m := pattern.search(run)) and m.start() < first:
            return m.end(), [name]
    for notice in _NOTICE.finditer(run):
        if notice.start() >= first:
            break
        found, end, at = [], 0, notice.end()
        while gap := _BETWEEN.match(run, at):
            named = next(((name, m) for name, pattern in _NAME if (m := pattern.match(run, gap.end()))), None)
            if not named:
                break
            name, m = named
            form = ("-or-later" if m["later"] else "-only" if m["only"] else "") if "GPL" in name else ""
            found.append(f"{name.lower()}{form}.short")
            end = at = m.end()
        if found:
            return end, found
    return 0, []


class Sentences:
    """Known sentences, and which normalised pieces one of them may start with."""

    def __init__(self, known: dict[str, str]):
        self.known = {normalised(s): name for s, name in known.items()}
        self.longest = max(len(s) for s in self.known)
        self.starts = {" ".join(s.split()[:2]) for s in self.known}

    def scan(self, text: str) -> list[tuple[int, int, str]]:
        """First and last piece and the identifier of every known sentence.

        Pieces end at a line's or a sentence's end. A sentence may run over several pieces, as notices
        are wrapped and hold colons; the longest known run from a piece counts, and is passed over.
        """
        pieces = _END.split(text)
        found, at = [], 0
        while at < len(pieces):
            run, used, name = normalised(pieces[at]), at, None
            if " ".join(run.split(" ", 2)[:2]) in self.starts:
                name, reach = self.known.get(run), at + 1
                while reach < len(pieces) and len(run) < self.longest:
                    run = f"{run} {normalised(pieces[reach])}".rstrip()
                    if run in self.known:
                        name, used = self.known[run], reach
                    reach += 1
            if name:
                found.append((at, used, name))
            elif run and _HEAD.search(pieces[at]):
                used, names = self._notice(pieces, at)
                found += [(at, used, name) for name in names]
            at = used + 1
        return found


    def _notice(self, pieces: list[str], at: int) -> tuple[int, list[str]]:
        """Last piece and identifiers of a notice with slots that begins in a piece."""
        run, ends = "", []
        for piece in pieces[at:at + _REACH]:
            run = f"{run} {normalised(piece)}".strip()
            ends.append(len(run))
        end, names = slotted(run, ends[0])
        return (at + next(k for k, e in enumerate(ends) if e >= end) if names else at), names


def recognised(found: list[tuple[int, int, str]], rules=RULES, gap: int = GAP) -> list[str]:
    """Licences in order of appearance; each sentence serves one rule."""
    licences, used = [], set()
    ranked = sorted(rules, key=lambda rule: -len(rule[1]))
    for start in range(len(found)):
        if start in used:
            continue
        for licence, names in ranked:
            taken = _matched(found, used, start, names, gap)
            if taken:
                used.update(taken)
                licences.append(licence)
                break
    return licences


def _matched(found, used: set[int], start: int, names: tuple[str, ...], gap: int) -> list[int]:
    """Places of the rule's sentences from ``start`` on, or none."""
    if found[start][2] != names[0]:
        return []
    taken = [start]
    for name in names[1:]:
        end = found[taken[-1]][1]
        near = (at for at in range(taken[-1] + 1, len(found))
                if at not in used and found[at][2] == name and found[at][0] - end - 1 <= gap)
        if (at := next(near, None)) is None:
            return []
        taken.append(at)
    return taken


def license_scan(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """``doc_id``, ``licenses`` (distinct, by first appearance), ``sentence_ids`` and ``places`` of every row.

    Whole texts are read. A null, empty or licence-free text has empty lists; repeated rows come back as
    often as they occur; an empty table gives no rows; extra columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences(SENTENCES | _TEXTS)
        for batch in slices(batches):
            found = [sentences.scan(t) if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([list(dict.fromkeys(recognised(f, gap=gap))) for f in found], pa.list_(pa.string())),
                 pa.array([[name for _, _, name in f] for f in found], pa.list_(pa.string())),
                 pa.array([[at for at, _, _ in f] for f in found], pa.list_(pa.int32()))],
                ["doc_id", "licenses", "sentence_ids", "places"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        work, "doc_id bigint, licenses array<string>, sentence_ids array<string>, places array<int>")
