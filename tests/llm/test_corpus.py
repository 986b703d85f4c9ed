"""The corpus operators against brute force, and on awkward rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from podium.llm import decontamination, embeddings, languages, licenses, lines, minhash, mixing, queries, sharding, tokens, warc
from podium.llm.common import ship
from podium.llm.components import components

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, kept string"
RNG = random.Random(11)
VOCABULARY = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(3, 9))) for _ in range(600)]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def changed(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randint(0, 10 ** 9)}" if rng.random() < share else w for w in text.split(" "))


BASE = prose(150, 1)
AWKWARD = [
    (1, BASE, "en", "a", 1, 1, "x"), (2, BASE, "en", "a", 1, 1, "x"), (2, BASE, "en", "a", 1, 1, "x"),
    *[(10 + i, changed(BASE, 0.03, i), "en", "b", 1, 1, None) for i in range(25)],
    (40, None, None, None, None, None, None), (41, "", "en", "c", 0, 0, ""), (42, " \t\n\r\x0b\x0c ", "en", "c", 0, 0, ""),
    (43, "one two", "en", "c", 0, 0, ""), (44, "ONE\x0btwo", "en", "c", 0, 0, ""), (45, "É é ß", "de", "c", 0, 0, ""),
    (None, BASE, "en", "d", 0, 0, ""), (None, None, None, "d", 0, 0, ""),
    (50, "\n".join(prose(20, 100 + i) for i in range(3000)), "en", "e", 1, 1, ""),
    (51, prose(200, 5), "en", "é", 1, 1, ""), (52, "日本 語", "en", "𝒳", 1, 1, ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(AWKWARD, DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], DOCS)


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.ORACLE[name], SF_DIR) is None


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline", n)]
    assert sorted({n.split("_")[0] for n in names}) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 200), rng.randint(100, 200)) for _ in range(60)]
    found = components(spark.createDataFrame([*links, (None, 3), (5, 5)], "a bigint, b bigint"), "a", "b")
    nodes = {n for link in links if link[0] != link[1] for n in link}
    assert {(r.node, r.root) for r in found.collect()} == set(roots_of(nodes, links).items())


def shingled(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + k]) for i in range(max(len(words) - k + 1, min(len(words), 1)))}


def test_near_duplicates(docs, none):
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(AWKWARD)
    texts = {r[0]: shingled(r[1]) for r in AWKWARD if r[0] is not None}
    links = [(a, b) for a in texts for b in texts if a < b and texts[a] and
             100 * len(texts[a] & texts[b]) >= 80 * len(texts[a] | texts[b])]
    root = roots_of(texts, links)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(texts[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    assert minhash.near_duplicates(none).collect() == []
    kept = minhash.without_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 40, 41, None}


def test_chain_of_near_copies(spark):
    """Neighbours are alike, ends are not: the hub's star alone would not hold them together."""
    words, texts = prose(200, 9).split(), []
    for step in range(30):
        texts.append(" ".join(words))
        words = words[4:] + prose(4, 500 + step).split()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [shingled(t) for t in texts]
    links = [(a, b) for a in range(30) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = roots_of(range(30), links)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == root


def test_estimate_keeps_short_near_copies(spark):
    """Four shared shingles of five: similarity 0.8, texts of seven and eight words."""
    rng, lost, n = np.random.default_rng(12), 0, 20_000
    factors, shifts = minhash._permutations()
    for _ in range(10):
        values = rng.integers(0, 1 << 32, (n // 10, 5), np.uint32)
        few = np.full((n // 10, minhash.MINIMA), 0xFFFFFFFF, np.uint32)
        for k in range(4):
            few = np.minimum(few, values[:, k, None] * factors + shifts)
        all_five = np.minimum(few, values[:, 4, None] * factors + shifts)
        a, b = minhash.low_bits(few), minhash.low_bits(all_five)
        planes = (a ^ b).reshape(len(a), minhash.BITS, minhash.PLANE)
        differ = np.bitwise_count(np.bitwise_or.reduce(planes, axis=1).view(np.uint64)).sum(axis=1)
        chance = 2.0 ** -minhash.BITS
        lost += int((((minhash.MINIMA - differ) / minhash.MINIMA - chance) / (1 - chance) < minhash.estimate_cut(0.8)).sum())
    assert lost == 0


def test_estimate_is_corrected(spark):
    rng = np.random.default_rng(1)
    minima = rng.integers(0, 1 << 32, (2, minhash.MINIMA), np.uint32)
    minima[1, :120] = minima[0, :120]
    bits = minhash.low_bits(minima)
    row = spark.createDataFrame([(bits[0].tolist(), bits[1].tolist())], "a array<bigint>, b array<bigint>")
    from pyspark.sql import functions as F
    got = row.select(minhash.estimate(F.col("a"), F.col("b")).alias("s")).first()["s"]
    assert abs(got - 0.75) < 0.12


def test_line_dedup(docs, none, spark):
    a, b, c = (prose(30, 200 + i) for i in range(3))
    rows = spark.createDataFrame([(1, f"head\n{a}\n\n{b}\nfoot"), (2, f"other\n{a}\n\n{b}\nmore"), (3, f"{b}\n{c}\n{a}"),
                                  (4, f"head\n{c}x\nfoot"), (5, f"head\n{a}\n\n{b}\nfoot")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in lines.line_dedup(rows).collect()}
    assert got[1] == f"head\n{a}\n\n{b}\nfoot" and got[2] == "other\nmore" and got[4] == f"head\n{c}x\nfoot" and got[5] == ""
    assert c in got[3] and (a in got[3]) != (b in got[3])  # the aligned one of two swapped lines goes
    found = lines.line_dedup(docs).collect()
    assert len(found) == len(AWKWARD)
    assert all(r.text == "" for r in found if r.doc_id == 2) and all(r.text == BASE for r in found if r.doc_id in (None, 1) and r.text)
    assert lines.line_dedup(none).collect() == []


def test_line_dedup_of_blocks_whose_lines_have_different_first_holders(spark):
    """Four lines of 50 characters stand singly in four old documents, and together in forty later ones."""
    block = [prose(40, 700 + i)[:50] for i in range(4)]
    rows = [(i, f"{prose(9, 800 + i)}\n{block[i]}\n{prose(9, 810 + i)}") for i in range(4)]
    rows += [(10 + i, "\n".join([prose(9, 820 + i), *block[:2], "", *block[2:], f"end {i}"])) for i in range(40)]
    got = {r.doc_id: r for r in lines.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), rare=2).collect()}
    assert all(got[i].n_removed == 0 for i in (0, 1, 2, 3, 10))
    assert all(got[10 + i].text == prose(9, 820 + i) + f"\nend {i}" for i in range(1, 40))


def test_runs_cover_every_common_block():
    rng = random.Random(6)
    for _ in range(300):
        chars = [rng.choice((0, 0, 3, 30, 50, 90)) for _ in range(rng.randint(1, 14))]
        block = [rng.randint(-9 ** 18, 9 ** 18) if c else 0 for c in chars]
        pad = [rng.randint(-9 ** 18, 9 ** 18) for _ in range(rng.randint(0, 9))]
        start, end, whole = lines.runs([*pad, *block, 5], [*([20] * len(pad)), *chars, 70], 160)
        covered = {i for a, b, h in zip(start, end, whole) if h in set(lines.runs(block, chars, 160)[2])
                   for i in range(a - len(pad), b - len(pad))}
        assert covered >= ({i for i, c in enumerate(chars) if c} if sum(chars) >= 160 else set())


def test_repeated_passages_are_common_lines():
    p, q = [101, 102, 103], [104, 105]  # 180 characters
    def found(later, earlier):
        return lines.common_lines(later, earlier, [{101: 60, 102: 60, 103: 60, 104: 90, 105: 90}.get(k, 20) for k in later], 160)
    assert found([1, *p, 2, *p, 3], [8, *p, 9]) == [1, 2, 3, 5, 6, 7]
    assert found([*p, *p], p) == [0, 1, 2, 3, 4, 5]
    assert found([1, *p, 2, *q, *p, 3], [8, *p, 9, *p, *q]) == [1, 2, 3, 5, 6, 7, 8, 9]
    assert found([1, *p, 2, 3, 4, 5, 6], [2, 3, 4, 5, 6, 7, *p]) == [1, 2, 3]  # short lines in another order
    assert found([1, 101, 102, 2, *p[1:], 3], [8, *p, 9]) == []
    rng = random.Random(7)
    for _ in range(300):
        earlier, later = ([rng.randint(0, 9) for _ in range(rng.randint(0, 40))] for _ in range(2))
        chars = [20 * (k % 4) for k in later]
        runs = {i: {i + n for n in range(1, len(later) - i + 1) if sum(chars[i:i + n]) >= 100
                    and any(earlier[j:j + n] == later[i:i + n] for j in range(len(earlier)))} for i in range(len(later))}
        possible = {k for i, ends in runs.items() for end in ends for k in range(i, end)}
        got = set(lines.common_lines(later, earlier, chars, 100))
        assert got <= possible and bool(got) == bool(possible)


def test_alignment_is_common_and_rising():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 30))] for _ in range(2))
        pairs = lines.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert lines.align([1, 2, 3, 4], [9, 2, 3, 8, 4]) == [(1, 1), (2, 2), (3, 4)]


def test_licenses(spark, none):
    mit = [s for s, i in licenses.SENTENCES.items() if i.startswith("mit.") and i != "mit.short"]
    texts = ["Some words here\nLicensed under the Apache License, Version 2.0.\nMore", "# Released under the MIT Licence.",
             "Permission " + mit[0][11:] + ":\n\n" + mit[1].capitalize() + ".\n" + mit[2] + ".", mit[2] + ". " + mit[0] + ". " + mit[1] + ".",
             "Unlicensed under the apache", None, "", "a" * 500_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.licenses for r in licenses.license_scan(rows).collect()}
    assert got == {0: ["Apache-2.0"], 1: ["MIT"], 2: ["MIT"], 3: [], 4: [], 5: [], 6: [], 7: []}
    assert licenses.license_scan(none).collect() == []


def test_license_notices():
    def found(text):
        return list(dict.fromkeys(licenses.recognised(licenses.Sentences(licenses.SENTENCES | licenses._TEXTS).scan(text))))
    wrapped = "# foo is free software; you can redistribute it and/or\n# modify it under the terms of the GNU {}\n# as published by the Free Software Foundation; "
    later = wrapped + "either\n# version {} of the License, or (at your option) any later version."
    bsd = ("Copyright (c) 2020, Foo Inc. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met:\n 1. Redistributions of source code must retain the above copyright notice, this list of conditions "
           "and the following disclaimer.\n 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
           "disclaimer in the documentation and/or other materials provided with the distribution.\n 3. Neither the name of Foo Inc. nor the names of its\n"
           "contributors may be used to endorse or promote products derived from this software without specific prior written permission.")
    for text, expected in (
            ("This project is licensed under the MIT License - see LICENSE for details.", ["MIT"]), ("Distributed under the MIT License.", ["MIT"]),
            ("Released under the terms of the\nGNU GPL v2 or later", ["GPL-2.0-or-later"]), ("Licensed under GPLv3+", ["GPL-3.0-or-later"]),
            ("This file is licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
            ("SPDX-License-Identifier: AGPL-3.0-only", ["AGPL-3.0-only"]), ("// SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]),
            ("SPDX-License-Identifier: CC0-1.0", ["CC0-1.0"]), ("SPDX-License-Identifier: ISC", ["ISC"]), ("SPDX-License-Identifier: Zlib", ["Zlib"]),
            ("SPDX-License-Identifier: EPL-2.0", ["EPL-2.0"]), ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]), ("Licensed under MPL 1.1", ["MPL-1.1"]),
            ("Licensed under either of Apache License, Version 2.0 or MIT license", ["Apache-2.0", "MIT"]),
            ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
            ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
            (later.format("General Public License", 2), ["GPL-2.0-or-later"]), (later.format("Affero General Public License", 3), ["AGPL-3.0-or-later"]),
            (wrapped.format("General Public License") + "version 2 of the License.", ["GPL-2.0-only"]), (bsd, ["BSD-3-Clause"]),
            ("Copyright 2020 Foo, all rights reserved", ["LicenseRef-All-Rights-Reserved"]), ("This is not licensed under the MIT License", []),
            ("We met at MIT and released the birds under an oak", []), ("The driver's license is valid", []), ("under the licence", [])):
        assert found(text) == expected, text


def test_warc(spark, none, tmp_path):
    ship(spark)
    pages = [(1, "http://a/1", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://a/3", None), (4, "u\r\nv", ""), (5, "e", "é" * 70_000),
             (6, "http://a/6", "<p>x</p>"), (6, "http://a/6", "<p>x</p>"), (None, "n", "<p>x</p>")]
    rows = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    first = {"<p>x</p>": 1, "": 3, "é" * 70_000: 5}
    expected = collections.Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        again = page is not None and first[html or ""] != page
        expected[(page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
                  first[html or ""] if again else None)] += 1
    got = collections.Counter(tuple(r)[:5] for r in warc.round_trip(rows).collect())
    assert got == expected
    folder = str(tmp_path / "w")
    warc.write_warc(rows, folder, least_bytes=20)
    read = warc.read_warc(spark, folder)
    assert read.filter("record_type = 'revisit'").count() == 0
    only = warc.read_warc(spark, folder, "page_id bigint, target_uri string").filter("target_uri = 'http://a/3'")
    assert [r.page_id for r in only.collect()] == [3]
    reader = warc.WarcReader(folder, warc.SCHEMA)
    from pyspark.sql.datasource import EqualTo, GreaterThan
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("page_id",), 1)])) == [GreaterThan(("page_id",), 1)]
    assert warc.round_trip(rows.limit(0)).collect() == []


def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in base[i % 30] + 0.07 * (i >= 30) * rng.standard_normal(16)], i % 30 % 3) for i in range(90)]
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 1), (102, None, 0), (103, [0.0] * 16, 0), (104, [float("nan")] * 16, 0),
             (105, [float("inf")] + [0.0] * 15, 0), (106, rows[0][1], None), (107, [None] * 16, 0), (108, [1.0, 2.0], 0),
             (109, [2.0, 4.0], 0), (110, [], 0), (111, [1e-200] * 16, 2), (112, [1e200] * 16, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    usable = [(i, np.array(v), c) for i, v, c in rows if c is not None and v and None not in v and np.all(np.isfinite(v)) and any(v)]
    links = set()
    for i, v, c in usable:
        for j, w, d in usable:
            if i < j and c == d and len(v) == len(w):
                x, y = v / np.abs(v).max(), w / np.abs(w).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93 and {i, j} != {111, 112}:
                    links.add((i, j))
    root = roots_of([r[0] for r in rows], links)
    count = collections.Counter(n for link in links for n in link)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert {i: got[i] for i in got if i < 111} == {i: (count[i], root[i], root[i] == i) for i in root if i < 111}
    assert embeddings.near_vectors(df.limit(0)).collect() == []


def test_decontamination(spark, docs, none):
    items = [(i, f"{prose(25, 90_300 + i)}? {prose(6, 90_400 + i).capitalize()}.") for i in range(40)] + [(90, None), (91, ""), (92, prose(12, 90_777))]
    rows = [(1, f"{prose(300, 1)} {items[3][1].upper()} {prose(400, 2)}"), (2, items[92 - 90 + 40][1]), (3, prose(500, 3)),
            (4, items[5][1].split("?")[0]), (5, None), (6, ""), (7, f"{items[7][1]} {items[8][1]}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(1, 3), (2, 92), (7, 7), (7, 8)}
    assert {r.doc_id for r in decontamination.uncontaminated(df, bench).collect()} == {3, 4, 5, 6}
    assert decontamination.contaminated(df, bench.limit(0)).collect() == []
    assert decontamination.uncontaminated(docs, bench).count() == len(AWKWARD)
    parts = list(decontamination.index_parts(bench, part_words=100))
    assert len(parts) > 3 and sum(len(p.ids) for p in parts) == 41


def test_decontamination_of_edited_copies(spark):
    rng = random.Random(21)
    items = [(i, f"{prose(rng.randint(12, 40), 95_000 + i).capitalize()}? {prose(rng.randint(1, 9), 95_500 + i).capitalize()}.") for i in range(60)]
    rows, clean = [], []
    for i, text in items:
        words = text.split(" ")
        for edits in (1, 2):
            changed_words = list(words)
            for at in rng.sample(range(len(words)), edits):
                changed_words[at] = f"zz{at}" + "?" * words[at].endswith("?")
            rows.append((10 * i + edits, f"{prose(90, 96_000 + i)} {' '.join(changed_words)} {prose(90, 97_000 + i)}"))
        question, answer = text.split("? ")
        rows.append((10 * i + 3, f"{prose(90, 96_000 + i)} {question}. {prose(90, 97_000 + i)}"))
        if len(answer.split()) > 5 and len(question.split()) < 0.85 * len(words):
            clean.append(10 * i + 3)
    rows.append((5000, prose(4000, 98_000)))
    df, bench = (spark.createDataFrame(r, f"{i} bigint, text string") for r, i in ((rows, "doc_id"), (items, "item_id")))
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    assert got >= {(d, d // 10) for d, _ in rows if d < 5000 and d % 10 in (1, 2)}
    left = {d for d, _ in rows} - {d for d, _ in got}
    assert left <= {*clean, 5000} and 5000 in left
    assert {r.doc_id for r in decontamination.uncontaminated(df, bench).collect()} == left


def test_kept_words_counts_edits():
    rng = random.Random(9)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, n))] for n in (9, 25))
        row = [0] * (len(b) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert decontamination.kept_words(a, b) == (len(a) - min(row)) / len(a)


def test_block_max_wand_finds_all():
    rng = random.Random(8)
    for _ in range(60):
        lists = []
        for _ in range(rng.randint(1, 12)):
            held = sorted(rng.sample(range(300), rng.randint(1, 200)))
            lists.append(decontamination.Postings(np.array(held), np.array([rng.random() * 0.3 for _ in held])))
        total = collections.defaultdict(float)
        for p in lists:
            for i, s in zip(p.items, p.shares):
                total[i] += s
        for threshold in (0.2, 0.5, 0.9):
            got = decontamination.block_max_wand(lists, threshold)
            assert [i for i, _ in got] == sorted(i for i, s in total.items() if s >= threshold - 1e-9)


def test_languages(spark, docs, none):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    truth = {r.doc_id: r.lang for r in table.select("doc_id", "lang").collect()}
    odd = {i for i in truth if i % 2}
    held_out = table.withColumn("shown", __import__("pyspark").sql.functions.expr("if(doc_id % 2 = 0, lang, null)"))
    got = {r.doc_id: r for r in languages.identify(held_out, declared="shown").collect()}
    assert sum(got[i].language == truth[i] for i in odd) >= 0.97 * len(odd)
    found = {r.doc_id: r for r in languages.identify(docs).collect()}
    assert found[40].rejected and found[41].rejected and found[42].rejected and not found[1].rejected
    assert languages.identify(none).collect() == []
    assert languages.accepted(docs).columns == docs.columns
    names, model = languages.fitted(table.selectExpr("text", "lang AS label"))
    pages = languages.identify_pages(spark.read.parquet(f"{SF_DIR}/pages.parquet"), names, model)
    assert pages.filter("not rejected").count() > 0.9 * pages.count()


def test_rare_languages_are_known(spark):
    """One language of 3000 rows, most of them copies, and two of a row or two: a sample of 40 has all."""
    rows = [(i, prose(30, 3000 + (i % 900)), "aa") for i in range(3000)]
    rows += [(5000, "żółć gęślą jaźń " * 20, "pl"), (5001, "щука ёж объём " * 20, "ru"), (5002, "щука ёж съезд " * 20, "ru")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("source", __import__("pyspark").sql.functions.lit("h"))
    names, model = languages.fitted(table.selectExpr("text", "lang AS label"), 40)
    assert names == ["aa", "pl", "ru", "und"] and np.isfinite(model).all()
    found = {r.doc_id: r.language for r in languages.identify(table, sample=40).collect()}
    assert (found[5000], found[5001], found[5002], found[7]) == ("pl", "ru", "ru", "aa")
    rows = table.selectExpr("lang AS label", "text", "xxhash64(text, lang) AS draw")
    drawn = collections.Counter(r.label for r in languages._sampled(rows, 40).collect())
    assert drawn == {"aa": 37, "pl": 1, "ru": 2}  # what the small ones leave goes to the large one
    assert languages._even_share([1, 2, 900], 40) == 37 and languages._even_share([5, 5, 5], 2) == 1 and languages._even_share([3, 4], 90) == 4


def test_token_files(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.write_and_read(docs, path).collect())
    expected = collections.Counter()
    for row in AWKWARD:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [2]
        expected[(row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert collections.Counter((d, n, c) for _, d, n, c in got) == expected
    assert [g[0] for g in got] == list(np.cumsum([0, *[g[2] for g in got]])[:-1])
    order = [g[1] for g in got if g[1] is not None]
    assert order == sorted(order)
    assert tokens.write_and_read(none, path).collect() == []


def test_token_files_of_texts_with_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["one <|endoftext|> two", "a<|startoftext|>B<|endoftext|>", "One <|ENDOFTEXT|> two", "<|endof text|> One, TWO!", "ÉÀ <|endoftext|>İx", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokens.write_and_read(rows, path).collect()}
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_words_of_plain_letters_skip_the_librarys_own_splitting(monkeypatch):
    import public_tokenizers
    import tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    library, asked = tokenizers.Tokenizer.from_file(path), []

    class Counted:
        from_file = staticmethod(lambda _: Counted())
        __getattr__ = staticmethod(lambda name: getattr(library, name))

        def encode(self, text, **how):
            asked.append(text)
            return library.encode(text, **how)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    tokens.forget_words()
    try:
        plain = "Ungöß### ciÓnqueÍ!! don't 'sup !'ve x''ll 'Tis 2024-05-01 l'été,$$$ a1b2 ÉÀ÷× ¡no! \x1ca \u017c Ÿ e\u0301t ÿ\u0130 "
        text = plain + " ".join(f"w{i:x}ä{i}." for i in range(500))
        assert tokens._coder(path)(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert 0 < len(asked) < 12  # words with other signs
    finally:
        tokens.forget_words()


def test_huffman_round_trip():
    rng = np.random.default_rng(5)
    for n, kinds in ((1, 1), (700, 1), (5000, 3), (40_000, 3000)):
        ids = np.minimum(rng.zipf(1.3, n), kinds) - 1
        counts = np.bincount(ids, minlength=kinds)
        lengths = tokens.code_lengths(counts, 12)
        assert lengths.max() <= 12 and np.sum(2.0 ** -lengths[lengths > 0].astype(float)) <= 1
        data, block_bits = tokens.pack(ids, tokens.code_words(lengths), lengths)
        assert (tokens.unpack(data, block_bits, n, tokens.decode_table(lengths)) == ids).all()
    assert tokens.code_lengths(np.array([5, 1, 1, 0, 2]), 16).tolist() == [1, 3, 3, 0, 2]


def test_sharding(docs, none, spark):
    got = sharding.shard_documents(docs, shards=4).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in AWKWARD)
    many = spark.createDataFrame([(i, "x" * (i % 97)) for i in range(5000)], "doc_id bigint, text string")
    rows = sharding.records(many)
    sizes = sharding.slot_sizes(rows)
    before = sharding.rebalanced(None, sizes, 5)
    placed = sharding.sharded(rows, before, sizes).collect()
    loads = collections.Counter()
    for r in placed:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 1.01 * min(loads.values())
    for shard in range(5):
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(sum(r.shard == shard for r in placed)))
    after = {r.virtual_slot: r.shard for r in sharding.rebalanced(before, sizes, 6).collect()}
    old = {r.virtual_slot: r.shard for r in before.collect()}
    size = {r.virtual_slot: r.n_bytes for r in sizes.collect()}
    moved = sum(size[s] for s in old if after[s] != old[s]) / sum(size.values())
    assert set(after) == set(old) and 0.15 < moved < 0.18  # a sixth of all bytes, for the sixth shard
    assert sharding.shard_documents(none).collect() == []


def test_mixing(docs, none, spark):
    got = mixing.mix(docs).collect()
    assert len(got) == len(AWKWARD) and all(r.taken <= 3 * r.size for r in got)
    many = spark.createDataFrame([(i, " ".join(["w"] * (1 + i % 9)), "small" if i % 50 == 0 else f"s{i % 3}") for i in range(3000)],
                                 "doc_id bigint, text string, source string")
    for source, rows in _by_source(mixing.mix(many).collect()).items():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 9
        assert rows[0].target <= 3 * rows[0].source_size + 1e-9
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []


def _by_source(rows):
    out = collections.defaultdict(list)
    for r in rows:
        out[r.source].append(r)
    return out


def test_pipeline(spark):
    """Each stage on its own input, against what it should keep."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r.item_id, tuple(decontamination.words_in(r.text))) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)
    known = minhash.stored(steps["language ID"](spark, docs, SF_DIR), "t")
    assert known.columns == docs.columns and known.count() >= 0.99 * docs.count()
    unique = minhash.stored(steps["MinHash near-dedup"](spark, known, SF_DIR), "t")
    sets = {r.doc_id: shingled(r.text, 5) for r in known.collect()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r.doc_id for r in unique.collect()} == set(roots_of(sets, links).values())
    clean = minhash.stored(steps["decontamination"](spark, unique, SF_DIR), "t")
    leaking = {r.doc_id for r in unique.collect() if any(" ".join(w) in " ".join(decontamination.words_in(r.text)) for _, w in items)}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in unique.collect()} - leaking
    mixed = minhash.stored(steps["mixing"](spark, clean, SF_DIR), "t")
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({i: n for i, n in copies.items() if n})
    last = steps["token ids"](spark, mixed, SF_DIR)
    assert last.count() == mixed.count()
