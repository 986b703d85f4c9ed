"""Vectors of very large and very small components, and sources of one key, against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from podium.llm import decontamination, embeddings, mixing, sharding
from podium.llm.common import ship, stored


def test_vectors_of_any_size(spark):
    ship(spark)
    rng = np.random.default_rng(9)
    base = rng.standard_normal((12, 16))
    near = base + 0.02 * rng.standard_normal((12, 16))
    rows = [(i, [float(x) for x in base[i] * s], 2) for i, s in enumerate([1e-200, 1e200, 1e-300, 1e300, 1.0, 3e-160] * 2)]
    rows += [(100 + i, [float(x) for x in near[i] * s], 2) for i, s in enumerate([1e200, 1e-200, 1.0, 1e-300, 1e307, 1e-150] * 2)]
    rows += [(200, [1e-200] * 16, 2), (201, [2e-200] * 16, 2), (202, [1e200] * 16, 2), (203, [5e-324] * 16, 2), (204, [1.7e308] * 16, 2),
             (205, [1e200] * 8 + [-1e200] * 8, 2), (206, [1e200] * 13 + [-1e200] * 3, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    unit = {}
    for i, v, _ in rows:
        top = max(abs(x) for x in v)
        scaled = np.array([x / 2.0 ** math.floor(math.log2(top)) if top > 1e-300 else x / top for x in v])
        unit[i] = scaled / np.linalg.norm(scaled)
    links = {i: sum(float(unit[i] @ unit[j]) >= 0.93 for j in unit if j != i) for i in unit}
    assert {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()} == links
    assert links[200] == 4 and links[205] == 0


def test_mix_of_one_source_is_not_dealt_by_source(spark):
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat_ws(' ', sequence(0, id % 50)) AS text",
                                        "if(id % 3 = 0, 'hot', concat('s', id % 5)) AS source")
    taken = mixing.mix(rows).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert len(taken) == 6
    for r in taken:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"]


@pytest.mark.parametrize("sources", [["a", None, "a", None]])
def test_mix_of_repeated_rows(spark, sources):
    rows = spark.createDataFrame([(7, "one two three", s) for s in sources], "doc_id bigint, text string, source string")
    assert {(r.source, r.taken) for r in mixing.mix(rows).collect()} <= {(s, n * 3) for s in sources for n in range(4)}


def test_full_cells_are_dealt_to_parts(spark):
    """A label of many near vectors in few cells: small parts and large ones find the pairs of a plain search."""
    ship(spark)
    rng = np.random.default_rng(12)
    base = rng.standard_normal((5, 16))
    rows = [(i, [float(x) for x in base[i % 5] + 0.1 * rng.standard_normal(16)], "x") for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    found = embeddings.classes(df)
    some, many = ({tuple(r) for r in embeddings._candidates(found, 16, 0.97, 8, held=n).collect()} for n in (7, 100_000))
    assert some == many
    keys = {r.vec_id: r.key for r in df.withColumn("key", embeddings._key()).collect()}
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = np.argwhere(np.triu(unit @ unit.T >= 0.97, 1))
    assert len(close) > 500
    assert {tuple(sorted((keys[int(i)], keys[int(j)]))) for i, j in close} <= some


def test_tiles_pass_over_nothing(spark):
    rng = np.random.default_rng(2)
    home, other = rng.standard_normal((700, 8)), rng.standard_normal((900, 8))
    other[:50] = home[:50] + 0.05
    p, q = embeddings._within(home, other, 0.6)
    plain = np.argwhere(((home[:, None] - other[None]) ** 2).sum(axis=2) <= 0.6)
    assert set(zip(p.tolist(), q.tolist())) == {tuple(x) for x in plain.tolist()}


def test_rows_without_id_are_spread(spark, tmp_path):
    """Many rows without id and with one text fill no single slot, and a source without ids meets its target."""
    rows = spark.range(3000, numPartitions=4).selectExpr("cast(null AS bigint) AS doc_id", "'the same few words' AS text", "'a' AS source")
    got = sharding.shard_documents(rows, shards=8)
    counts = [r["count"] for r in got.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 20 and sum(counts) == 3000
    told = spark.range(3000).selectExpr("cast(null AS bigint) AS doc_id", "concat('text number ', id) AS text",
                                        "if(id % 3 = 0, 'a', 'b') AS source")
    taken = mixing.mix(told).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert len(taken) == 2 and all(abs(r["sum(taken)"] - r["max(target)"]) <= 3 for r in taken)
    assert mixing.mixed_documents(told).count() * 3 == sum(r["sum(taken)"] for r in taken)


def test_versions_of_the_slot_map(spark, tmp_path):
    """Every version stays readable; an edit moves whole slots, and a record follows its slot, as a plain loop finds."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', cast(id % 61 AS int)) AS text", "id AS SHARD", "'v' AS Version")
    table = str(tmp_path / "maps")
    first = {r.doc_id: r.shard for r in sharding.shard_documents(docs, shards=4, slots=256, table=table).collect()}
    sizes = stored(sharding.slot_sizes(sharding.records(docs, 256)), "sizes")
    for shards in (5, 3):
        sharding.rebalance(sizes, table, shards)
    maps = [{r.virtual_slot: r.shard for r in sharding.map_version(spark, table, v).collect()} for v in (1, 2, 3)]
    assert sharding.map_version(spark, table, 9).collect() == []
    assert [set(m.values()) for m in maps] == [set(range(4)), set(range(5)), set(range(3))]
    assert {r.version for r in sharding.map_version(spark, table).collect()} == {3}
    slot_of = {r.doc_id: r.virtual_slot for r in sharding.records(docs, 256).collect()}
    assert first == {d: maps[0][s] for d, s in slot_of.items()}
    weight = {r.virtual_slot: r.n_bytes for r in sizes.collect()}
    for known, shards in zip(maps, (4, 5, 3)):
        loads = [sum(weight[s] for s in known if known[s] == i) for i in range(shards)]
        assert max(loads) <= 1.05 * min(loads)
    moved = {r.doc_id: (r.shard, r.new_shard, r.version) for r in sharding.moved_documents(docs, 4, 5, 256).collect()}
    assert moved == {d: (maps[0][s], maps[1][s], 2) for d, s in slot_of.items()}
    kept = sum(weight[s] for s in weight if maps[0][s] == maps[1][s]) / sum(weight.values())
    assert 0.75 < kept < 0.85  # a fifth of all bytes makes the fifth shard
    assert sharding.moved_documents(docs.limit(0)).collect() == []


def test_items_in_many_parts(spark):
    """Documents that hold an item of any part go; rows without id or text and repeated rows are judged one by one."""
    ship(spark)
    words = "amber basil cedar delta ember fjord grove heron inlet jade kelp lotus maple north olive pearl quartz river".split()
    items = [(i, " ".join(words[(i * 5 + k * (i + 1)) % 18] + str(i) for k in range(14)) + "? " + " ".join(f"answer{i}x{k}" for k in range(6)) + ".")
             for i in range(12)]
    rows = [(i, f"before {text} after") for i, text in items] + [(50, "no item in here at all"), (50, "no item in here at all"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "doc_id AS item_id")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert len(list(decontamination.index_parts(bench, part_words=60))) >= 4
    kept = decontamination.uncontaminated(docs, bench, part_words=60)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted(decontamination.uncontaminated(docs, bench).collect(), key=str)
    assert sorted((r.doc_id, r.text) for r in kept.filter("doc_id IS NOT NULL").collect()) == [rows[12], rows[13]]
    assert kept.count() == 4
