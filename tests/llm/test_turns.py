"""Conversation repair, prefix trie and quality classifier against brute force, and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import heapq
import math
import os
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from podium.llm import digests, prefixes, quality, repair
from podium.llm.common import ship

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TURNS = "conv_id bigint, turn bigint, role string, text string, key string, rank int, block int"
SPACE = " \t\n\x0b\x0c\r"


def awkward():
    rng = random.Random(3)
    rows = []
    for c in [None, -7, -5, *range(14), 100, 101, *range(200, 230)]:
        for i in range(rng.choice([1, 2, 3, 5, 8, 9, 17, 30])):
            rows.append((c, rng.choice([None, i, i, i]), rng.choice(["user", "assistant", "system", None, "", "tool", "user"]),
                         rng.choice(["Hi.", "Hi.", "a b", "x?", "é!", None, "", " \n", "Z. \t"])))
    for c in range(300, 320):
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(rng.choice([2, 9, 20]))]
    rows.append((400, 0, "user", "long " * 200_000))
    rows += [(401, i, "assistant", f"{i} and") for i in range(700)]
    return rows + rows[:20]


ROWS = awkward()


@pytest.fixture(scope="module")
def turns(spark):
    ship(spark)
    return spark.createDataFrame([r + ("k", 1, 2) for r in ROWS], TURNS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    ship(spark)
    return spark.createDataFrame([], TURNS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_conversation(rows):
    found = collections.defaultdict(list)
    for row in rows:
        found[row[0]].append(row)
    for c in found:
        found[c].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[3])))
    return found


def brute_repair(rows):
    """Uniform-cost search over (cost, audit), rows as (initial, fault)."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    wanted = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit, out
        if (i, q) in done:
            continue
        done.add((i, q))
        state, role = wanted[q]
        heapq.heappush(heap, (cost + 3, audit + "I", i, state, out + ((None, role),)))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, out))
            if fault not in "bd" or not fault:
                more = 3 if fault == "t" else 0
                if (q, initial) in after:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, after[q, initial], out + ((i, None),)))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, state, out + ((i, role),)))


def brute_report(rows):
    def told(value):
        return " " if value is None else str(value)
    left = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{told(c)}:{told(t)}".encode()) % 20
        role, text = "user" if k == 4 else told(role), "" if k == 1 else told(text)
        if k == 2:
            text = "".join(x for x in text if x not in ".!?")
        left += [(c, t, role, text)] * (k != 0) * (2 if k == 3 else 1)
    grouped, out = by_conversation(left), set()
    for c in {r[0] for r in rows}:
        here, seen, states, n = grouped.get(c, []), set(), [], collections.Counter()
        for _, _, role, text in here:
            bare = text.strip(SPACE)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            states.append((role[:1], fault))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(states, states[1:]))
        cost, audit, kept = brute_repair(states)
        ts = [r[1] for r in here if r[1] is not None]
        text = "\n".join(f"{role or here[i][2]}:{'' if i is None else here[i][3]}" for i, role in kept)
        out.add((c, max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, n["b"], n["d"], n["t"], illegal, cost, audit, sha(text)))
    return out


def brute_trie(rows):
    own = by_conversation([(c, t, r or "", x or "") for c, t, r, x in rows if c is not None])
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = [r[2:] for r in own.get(c - int(math.fmod(c, 5)), [])[:h]] + [r[2:] for r in own[c][h:]]
    members = collections.defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    saved, leaves = collections.Counter(), collections.Counter()
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
            leaves[p[:d]] += children[p] == 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p],
                   sha(",".join(str(c) for c in m if len(whole[c]) == len(p)))) for p, m in members.items())


def test_auction_against_search():
    rng = random.Random(5)
    for _ in range(600):
        codes = [rng.choice([0, 1, 2, 1, 2, 3]) * 4 + rng.choice([0, 0, 0, 0, 1, 2, 3, 3])
                 for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 40]))]
        cost, audit, turns = brute_repair([("sua?"[c // 4], ["", "b", "d", "t"][c % 4]) for c in codes])
        for stretch in (1, 3, repair.STRETCH):
            assert repair.cheapest_edits(codes, stretch) == (cost, audit)
        assert tuple(repair.repaired_turns(codes, audit)) == turns


def test_auction_is_linear_in_a_long_conversation():
    rng = random.Random(6)
    codes = bytearray(rng.choice([1, 2]) * 4 + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(30_000))
    cost, audit = repair.cheapest_edits(codes)
    assert len(audit) - audit.count("I") == len(codes) and cost > 0


def test_repair(turns, none):
    assert {tuple(r) for r in repair.repair_report(turns).collect()} == brute_report(ROWS)
    assert repair.repair_report(none).count() == 0


def test_repaired_turns_are_the_hashed_ones(turns):
    report, kept = repair.repair(repair.damage(turns), turns)
    texts = collections.defaultdict(list)
    for r in kept.orderBy("key", "seq").collect():
        texts[r.key].append(f"{r.role}:{r.text}")
    for r in report.collect():
        assert sha("\n".join(texts["" if r.conv_id is None else str(r.conv_id)])) == r.repaired_sha256


@pytest.mark.parametrize("columns", [2, 8])
def test_prefix_trie(turns, none, columns):
    found = prefixes.prefix_trie(*prefixes.rebuilt(turns), columns=columns).fillna(-1, ["parent_conv_id"])
    assert sorted(tuple(r) for r in found.collect()) == brute_trie(ROWS)
    assert prefixes.prefix_trie(*prefixes.rebuilt(none), columns=columns).count() == 0


def test_conversations_without_turns_end_at_the_root(spark):
    ship(spark)
    lone = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:3]
    df = spark.createDataFrame([(c, 0, "user", "x", "", 0, 0) for c in lone], TURNS)
    assert [tuple(r) for r in prefixes.prefix_trie(*prefixes.rebuilt(df)).collect()] == [
        (lone[0], 0, None, 3, 0, 1, 0, sha(",".join(map(str, lone))))]


def test_digest_of_a_hot_group(spark):
    ship(spark)
    rows = spark.range(0, 50_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 100)) AS key", "id AS place",
                                            "concat('p', id) AS piece").repartition(7)
    found = {r.key: r.sha256 for r in digests.ordered_sha256(rows, ",", chunk_bytes=1000).collect()}
    groups = collections.defaultdict(list)
    for i in range(50_000):
        groups["hot" if i % 3 == 0 else f"k{i % 100}"].append(f"p{i}")
    assert found == {k: sha(",".join(v)) for k, v in groups.items()}


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op13_prefix_trie"])
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_features_are_a_unit_vector():
    at, values = quality.features("One one ONE ##one## two\ntwo", quality._Words(), 1 << 10)
    assert len(set(at)) == len(at) and abs(float(values @ values) - 1) < 1e-5
    assert not len(quality.features(" \n", quality._Words())[0]) and not len(quality.features(None, quality._Words())[0])


def test_updates_are_follow_the_regularised_leader():
    """The state form against the plain definition: w minimises the sum of linear terms and the two penalties."""
    rng = np.random.default_rng(1)
    z, n = np.zeros(6), np.zeros(6)
    g_sum, n_ref, drift = np.zeros(6), np.zeros(6), np.zeros(6)
    for _ in range(40):
        at = np.sort(rng.choice(6, 3, replace=False))
        values, label = rng.random(3), int(rng.integers(2))
        w = np.zeros(6)
        for i in range(6):
            linear = g_sum[i] - drift[i]
            if abs(linear) > quality.L1:
                w[i] = -(linear - math.copysign(quality.L1, linear)) / ((quality.BETA + math.sqrt(n_ref[i])) / quality.ALPHA + quality.L2)
        assert np.allclose(w, quality._weights(z, n))
        p = 1 / (1 + math.exp(-float(w[at] @ values)))
        for i, v in zip(at, values):
            g = (p - label) * v
            drift[i] += (math.sqrt(n_ref[i] + g * g) - math.sqrt(n_ref[i])) / quality.ALPHA * w[i]
            n_ref[i] += g * g
            g_sum[i] += g
        quality.learn(z, n, at, values, label)


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    found = entry.queries()["op12_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found.count() == docs.count() and found.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_quality_of_awkward_rows(spark):
    ship(spark)
    schema = "doc_id bigint, text string, score string, label int"
    docs = spark.createDataFrame([(1, "fine words here", "", 0), (1, "fine words here", "", 0), (2, None, "", 0), (3, "", "", 0),
                                  (None, "### $$$", "", 0), (4, "### $$$ %%%", "", 0), (5, "word " * 300_000, "", 0)], schema)
    labels = spark.createDataFrame([(1, 1, "x"), (4, 0, "x"), (3, 1, "x"), (3, 0, "x"), (None, 0, "x"), (5, None, "x"), (2, 7, "x")],
                                   "doc_id bigint, quality int, text string")
    rows = quality.quality(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    empty = [r.score for r in rows if r.doc_id in (2, 3)]
    assert empty[0] == empty[1]
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}


def test_training_sample_is_bounded_and_held_out_rows_are_absent(spark):
    ship(spark)
    docs = spark.range(0, 3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', concat('text ', id)) AS text")
    labels = spark.range(0, 3000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    rows = quality.training_rows(docs, labels, sample=100).collect()
    assert 120 < len(rows) < 290 and len({(r.text, r.label) for r in rows}) == len(rows)
    assert not any(r.text.startswith("text") and zlib.crc32(r.text[5:].encode()) % 4 == 2 for r in rows)
    assert len(quality.training_rows(docs, labels, sample=10_000).collect()) > 1_400
