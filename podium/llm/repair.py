"""Conversation structure repair: the cheapest edits that give every conversation a well-formed run of roles.

A conversation is a lattice of nodes (rows read, state of the role pattern). Keeping, changing or
deleting a row leads to the next row, inserting a turn stays at the row; costs are small integers. The
shortest path is found by the auction algorithm (Bertsekas 1991): a path grows from its origin along
the arc that attains ``min(cost + price of the head)``; where a node's price is below that minimum, the
price is raised to it and the path gives the node up. Prices never exceed ``cost + price of the head``
(complementary slackness), so when the path arrives, the price of its origin is the distance to the end,
and every arc of every shortest path is tight. The audit is traced along tight arcs in ASCII order.

Prices are raised in small steps, so the auction runs on stretches of ``STRETCH`` rows from the last to the
first: the four nodes where a stretch ends already hold exact distances. That keeps the work in proportion
to the length of a conversation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import stored
from podium.llm.digests import EMPTY, ordered_sha256
from podium.operators.joins import lookup
from podium.operators.windows import global_rank

SPACE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
STRETCH = 16

# States of the pattern (s?(ua)+)?, and what each admits.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_EXPECTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # role of an inserted or changed turn
_AT_END = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
_ROLE = {USER: "user", ASSISTANT: "assistant"}

# A row for the auction is one small number: initial of its role times four plus its fault.
INITIALS = "sua?"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


def _arcs(code: int, state: int) -> list[tuple[int, int, int, str]]:
    """(rows read, next state, cost, letter) of every edit, letters ascending."""
    initial, fault = INITIALS[code // 4], code % 4
    more = UNFINISHED if fault == TRUNCATED else 0
    arcs = [(1, state, DELETE, "D"), (0, _EXPECTED[state], INSERT, "I")]
    if fault not in (BLANK, DUPLICATE):
        if initial in _AFTER[state]:
            arcs.append((1, _AFTER[state][initial], more, "K"))
        arcs.append((1, _EXPECTED[state], REROLE + more, "R"))
    return arcs


_ARCS = [[_arcs(code, state) for state in range(4)] for code in range(16)]


def _auction(price: list[int], codes: Sequence[int], origin: int, goal: int) -> None:
    """Raise prices until a path from node ``origin`` has reached row ``goal``; its price is exact then."""
    path = [origin]
    while (node := path[-1]) < 4 * goal:
        row, best, head = node >> 2, None, 0
        for step, state, cost, _ in _ARCS[codes[row]][node & 3]:
            offer = cost + price[(row + step) * 4 + state]
            if best is None or offer < best:
                best, head = offer, (row + step) * 4 + state
        if price[node] < best:
            price[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)


def cheapest_edits(codes: Sequence[int], stretch: int = STRETCH) -> tuple[int, str]:
    """Cost and audit (letters of the edits, ASCII-least among the cheapest) for one conversation."""
    rows = len(codes)
    price = [0] * (4 * rows) + [_AT_END[state] for state in range(4)]
    for start in range((rows - 1) // stretch * stretch, -1, -stretch):
        goal = min(start + stretch, rows)
        price[4 * start:4 * goal] = [min(price[4 * goal:4 * goal + 4])] * (4 * (goal - start))
        for state in range(4):
            _auction(price, codes, 4 * start + state, goal)
    audit, node = [], START
    while node < 4 * rows:
        row = node >> 2
        goal = min((row // stretch + 1) * stretch, rows)
        for step, state, cost, letter in _ARCS[codes[row]][node & 3]:
            head = (row + step) * 4 + state
            if price[node] == cost + price[head]:
                _auction(price, codes, head, goal)  # a price that was still too low rises, and the arc is not tight
                if price[node] == cost + price[head]:
                    audit.append(letter)
                    node = head
                    break
    while _AT_END[node & 3]:
        audit.append("I")
        node = 4 * rows + _EXPECTED[node & 3]
    return price[START], "".join(audit)


def repaired_turns(codes: Sequence[int], audit: str) -> Iterator[tuple[int | None, str | None]]:
    """(row, new role) of every turn of the repaired conversation; row None: inserted, role None: as it was."""
    row, state = 0, START
    for letter in audit:
        if letter == "K":
            state = _AFTER[state][INITIALS[codes[row] // 4]]
            yield row, None
        elif letter != "D":
            state = _EXPECTED[state]
            yield None if letter == "I" else row, _ROLE[state]
        row += letter != "I"


_EDITED = "key string, seq long, rank long, role string, audit string, cost long, illegal long"


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, rank) to the turns that stay or come in, and a last row a conversation with its audit."""
    schema = pa.schema([("key", pa.string()), ("seq", pa.int64()), ("rank", pa.int64()), ("role", pa.string()),
                        ("audit", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())])
    key, first, codes, out = None, 0, bytearray(), []

    def flushed(least: int) -> Iterator[pa.RecordBatch]:
        if len(out) > least:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()

    def done() -> Iterator[pa.RecordBatch]:
        cost, audit = cheapest_edits(codes)
        for seq, (row, role) in enumerate(repaired_turns(codes, audit)):
            out.append((key, seq, None if row is None else first + row, role, None, None, None))
            yield from flushed(4096)
        pairs = zip(codes, codes[1:])
        illegal = sum(INITIALS[x // 4] + INITIALS[y // 4] not in ("su", "ua", "au") for x, y in pairs)
        out.append((key, None, None, None, audit, cost, illegal))
        yield from flushed(4096)

    for batch in batches:
        for k, rank, code in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if k != key:
                if codes:
                    yield from done()
                key, first, codes = k, rank, bytearray()
            codes.append(code)
    if codes:
        yield from done()
    yield from flushed(0)


def _told(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """The stated damage: ``conv_id``, ``turn``, ``role`` and ``text`` of what is left.

    A null role or text is one space, a null id or turn is one space where the damage is drawn and
    stays null as a column.
    """
    drawn = F.crc32(F.concat(_told("conv_id"), F.lit(":"), _told("turn")).cast("binary")) % 20
    text = (F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    rows = conversations.select("conv_id", "turn", _told("role").alias("role"), _told("text").alias("text"),
                                drawn.alias("drawn")).filter("drawn <> 0")
    return (rows.select("conv_id", "turn", F.when(F.col("drawn") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(F.when(F.col("drawn") == 3, F.array(F.lit(1), F.lit(2)))
                                                      .otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy"))


def repair(rows: DataFrame, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair ``rows`` (conv_id, turn, role, text): a report per conversation, and the repaired turns.

    The report has a row for every ``conv_id`` of ``conversations``, null being one of them, with zeros, an
    empty audit and the hash of nothing where no row is left. The turns have ``key`` (the id as text, empty
    for null), ``seq`` from 0, ``role`` and ``text``; they are stored tables.

    Rows of a conversation stand in order of turn (nulls first), then of role and of the text's SHA-256, which
    settles ties; repeated rows follow one another. Roles and texts are not null, see :func:`damage`. A role
    that is empty or starts with another letter than s, u or a can't be kept. Other columns are ignored. No row
    ends in an empty report if ``conversations`` is empty.

    Order, repetitions and counts are worked out over all tasks. The edits of one conversation depend on one another
    and its audit is one value, so a conversation passes through one task, as one byte a row.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    kept = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "turn", "role", "text",
        F.sha2("text", 256).alias("content"), (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"))
    ranked = stored(global_rank(kept, ["key", F.col("turn").asc_nulls_first(), "role", "content"]), "turns")
    same = ["key", "role", "content"]
    seen = ranked.groupBy(*same).agg(F.min("rank").alias("seen"))
    faults = lookup(ranked.drop("text"), seen, same).withColumn(
        "fault", F.when(F.col("blank"), BLANK).when(F.col("rank") > F.col("seen"), DUPLICATE)
        .when(F.col("open"), TRUNCATED).otherwise(FINE))
    initial = (F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1)
               .when(F.col("role").startswith("a"), 2).otherwise(3))
    marked = stored(faults.select("key", "rank", (initial * 4 + F.col("fault")).cast("int").alias("code"), "turn",
                                  "fault"), "faults")
    edited = stored(marked.select("key", "rank", "code").repartition("key").sortWithinPartitions("key", "rank")
                    .mapInArrow(_repair, _EDITED), "edits")
    told = ranked.select("rank", F.col("role").alias("was"), "text")
    turns = (edited.filter("seq IS NOT NULL").select("key", "seq", "rank", "role").join(told, "rank", "left")
             .select("key", "seq", F.coalesce("role", "was").alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    turns = stored(turns, "repaired")
    digests = ordered_sha256(turns.select("key", F.col("seq").alias("place"),
                                          F.concat("role", F.lit(":"), "text").alias("piece")), "\n")
    counted = {name: F.count(F.when(F.col("fault") == fault, 1))
               for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))}
    by_turn = marked.groupBy("key", "turn").agg(*[c.alias(name) for name, c in counted.items()])
    counts = by_turn.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(name).alias(name) for name in counted])
    ids = conversations.select("conv_id").distinct().withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    summary = edited.filter("seq IS NULL").select("key", "illegal", "cost", "audit")
    report = ids.join(counts, "key", "left").join(summary, "key", "left").join(digests, "key", "left")
    whole = {name: F.coalesce(F.col(name), F.lit(0)).cast("long")
             for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return report.select("conv_id", *[c.alias(name) for name, c in whole.items()],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("sha256", F.lit(EMPTY)).alias("repaired_sha256")), turns


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage every conversation, repair it, and report on it; see :func:`damage` and :func:`repair`."""
    return repair(damage(conversations), conversations)[0]
