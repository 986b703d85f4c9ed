"""Language evidence: fusion against a plain computation, and many languages at once."""

from __future__ import annotations

import collections
import math
import random

import numpy as np

from podium.llm import languages
from podium.llm.common import ship


def alphabet(k):
    rng = random.Random(k)
    letters = rng.sample("abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþß", 7)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(25)]


def table(spark, n, kinds, hosts):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        k = i % kinds
        rows.append((i, " ".join(rng.choices(alphabet(k), k=rng.randint(8, 30))), f"l{k:03d}" if rng.random() < 0.8 else None,
                     rng.choice([None, f"h{k % hosts}.xy", f"h{i % hosts}.zz", "lone"])))
    rows += [(n, None, "l000", "lone"), (n + 1, " ", None, None), (n + 2, rows[0][1], rows[0][2], rows[0][3])]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")


def test_fusion_against_a_plain_computation(spark):
    ship(spark)
    rows, df = table(spark, 150, 3, 4)
    names, model = languages.fitted(df.selectExpr("text", "lang AS label"))
    own = {}
    for i, text, _, _ in rows:
        total = sum((model[:, codes].sum(axis=1, dtype=float) for codes in languages.trigrams(text)), np.zeros(len(names))) if text and text.strip() else None
        own[i] = None if total is None else total * languages.TEMPER
    vote = {i: int(np.argmax(s)) for i, s in own.items() if s is not None}
    count = collections.Counter()
    for i, _, declared, host in rows:
        if i in vote:
            for key in (("all",), ("host", host), ("suffix", host and host.rsplit(".", 1)[-1]), ("declared", declared)):
                count[(*key, vote[i])] += 1
    kinds = len({k[1] for k in count if k[0] == "declared" and k[1] is not None})
    total = sum(n for k, n in count.items() if k[0] == "all")
    expected = {}
    for i, _, declared, host in rows:
        if i not in vote:
            expected[i] = (languages.UND, 0.0)
            continue

        def less(*key):
            return max(count[key] - (key[-1] == vote[i]), 0) if key[1] is not None else 0
        logs = []
        for k, name in enumerate(names):
            base = languages.UND_PRIOR if name == languages.UND else (1 - languages.UND_PRIOR) / (len(names) - 1)
            p = (count[("all", k)] + languages.SMOOTHING * base) / (total + languages.SMOOTHING)
            for level, value in (("suffix", host and host.rsplit(".", 1)[-1]), ("host", host)):
                n = sum(less(level, value, j) for j in range(len(names)))
                p = (less(level, value, k) + languages.SMOOTHING * p) / (n + languages.SMOOTHING)
            log = own[i][k] + math.log(p)
            if declared is not None:
                log += math.log((less("declared", declared, k) + 1 / kinds) / (max(count[("all", k)] - (k == vote[i]), 0) + 1))
            logs.append(log)
        best = max(range(len(names)), key=lambda k: logs[k])
        expected[i] = (names[best], 1 / sum(math.exp(x - logs[best]) for x in logs))
    got = {r.doc_id: (r.language, r.confidence) for r in languages.identify(df).collect()}
    assert got.keys() == expected.keys()
    for i, (name, confidence) in expected.items():
        assert got[i][0] == name and abs(got[i][1] - confidence) < 1e-6, i


def test_two_hundred_languages(spark):
    ship(spark)
    rows, df = table(spark, 800, 200, 30)
    got = {r.doc_id: r.language for r in languages.identify(df).collect()}
    right = [got[i] == f"l{i % 200:03d}" for i in range(800)]
    assert np.mean(right) > 0.8


def test_the_sample_is_cut_before_it_is_ranked(spark):
    rows = spark.range(60_000).selectExpr("if(id % 10 > 0, 'aa', 'bb') AS label", "cast(id AS string) AS text", "xxhash64(id) AS draw")
    drawn = collections.Counter(r.label for r in languages._sampled(rows, 200).collect())
    assert drawn == {"aa": 100, "bb": 100}
