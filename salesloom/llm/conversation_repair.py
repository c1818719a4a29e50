"""Repair of conversation structure: cheapest edits by the auction shortest-path algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesloom.llm.shared import by_size, stash, table

#: Rows of a lattice block: prices are settled block by block from a conversation's end.
BLOCK = 32
#: Rows and bytes of text of a segment, the piece of a conversation that travels as one row.
SEGMENT_ROWS, SEGMENT_BYTES = 512, 1 << 20
#: Costs of the edits; an undeleted truncated row adds TRUNCATED.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# A row's code: class of its role's initial in the low two bits, its fault above, GONE for a row that only names its conversation.
INITIALS = {"s": 1, "u": 2, "a": 3}
FAULTS = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
GONE = 255
LEGAL = {(1, 2), (2, 3), (3, 2)}

# States of a repaired prefix: nothing, after system, after user, after assistant. Nothing and after assistant may end it.
START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, 1): SYSTEM, (START, 2): USER, (SYSTEM, 2): USER, (USER, 3): ASSISTANT, (ASSISTANT, 2): USER}
TURN = [USER, USER, ASSISTANT, USER]
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of the edits. A row's step is its own letter after those of the insertions before it.
D, I, K, R = "D", "I", "K", "R"  # noqa: E741


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32(`conv_id:turn`) % 20.

    0 drops the row (it stays as gone, so that its conversation is still known), 1 empties the text, 2 removes its `[.!?]`, 3 repeats the row,
    4 makes the role user. A null is one space: in the key, the role and the text; conv_id and turn themselves stay null.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    plain = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.select("conv_id", "turn", role.alias("role"), F.when(F.col("kind") != 0, text).alias("text"), (F.col("kind") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def _digest(*columns: str) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat_ws(":", *columns).cast("binary"), 256), 1, 32))


def faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text, gone) with their tie, which orders a turn's rows, and their fault: '', blank, duplicate or truncated.

    blank: nothing but ASCII white space; duplicate: role and text stood earlier in the conversation; truncated: the last
    character other than white space is not `[.!?]`. The first that holds counts. Rows of one turn stand in order of a digest of role and
    text, so equal rows are adjacent. Repetitions are found by aggregating digests, never a conversation in one place.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    keyed = rows.withColumn("role_bytes", F.octet_length("role")).withColumn("tie", F.when(~F.col("gone"), _digest("role_bytes", "role", "text"))).withColumn("last", last).drop("role_bytes")
    keyed = keyed.withColumn("copy", F.monotonically_increasing_id())
    stored = stash(keyed, "rows")
    known = stored.where("not gone and last <> ''")
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn", "copy")
    several = known.groupBy("conv_id", "tie").agg(F.count("*").alias("n"), F.min(place).getField("copy").alias("first")).where("n > 1")
    again = known.select("conv_id", "tie", "copy").join(several.withColumnRenamed("conv_id", "c").withColumnRenamed("tie", "t"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("tie") == F.col("t"))).where("copy <> first").select(F.col("copy").alias("again"))
    fault = F.when(F.col("last") == "", "blank").when(F.col("again").isNotNull(), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    return stored.join(again, F.col("copy") == F.col("again"), "left").select("conv_id", "turn", "tie", "copy", "role", "text", "gone", fault.alias("fault"))


# ---------------------------------------------------------------------------------------------------------------- lattice


def _arcs(code: int, base: int) -> list[list[tuple[int, int, str]]]:
    """Arcs (cost, node, letter), in order of their letters, out of a row's four nodes base..base + 3; the next row's follow at base + 4."""
    initial, fault = code & 3, code >> 2
    out = []
    for state in range(4):
        arcs = [(DELETE, base + 4 + state, D), (INSERT, base + TURN[state], I)]
        if fault not in (FAULTS["blank"], FAULTS["duplicate"]):
            extra = TRUNCATED if fault == FAULTS["truncated"] else 0
            if (state, initial) in KEPT:
                arcs.append((extra, base + 4 + KEPT[state, initial], K))
            arcs.append((REROLE + extra, base + 4 + TURN[state], R))
        out.append(arcs)
    return out


def auction(arcs: list[list[tuple[int, int, str]]], price: list[int], origin: int, sink: int) -> None:
    """Prices raised until a shortest path leads from origin to sink, along which every arc is tight.

    price[v] <= cost + price[w] holds for each arc from v to w, before and after. The path is extended along the arc with the least
    cost + price of its last node if that equals the node's price; else the price is raised to it and the path contracts by that node.
    Every cycle has a positive cost, so the path never meets itself, and integer prices rise to distances in finitely many steps.
    """
    path = [origin]
    while path[-1] != sink:
        v = path[-1]
        least, best = min((cost + price[w], w) for cost, w, _ in arcs[v])
        if price[v] < least:
            price[v] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(best)


@dataclass
class Lattice:
    """A block of rows: four nodes a row, four at its end with the costs from there on, a sink."""

    codes: bytes
    ahead: list[int]
    arcs: list = field(init=False)
    price: list[int] = field(init=False)

    def __post_init__(self):
        n = len(self.codes)
        self.least = min(self.ahead)  # prices start at it and rise by what a block adds
        self.ahead = [cost - self.least for cost in self.ahead]
        self.arcs = [arcs for i, code in enumerate(self.codes) for arcs in _arcs(code, 4 * i)]
        self.sink = 4 * n + 4
        self.arcs += [[(cost, self.sink, "")] for cost in self.ahead]
        self.price = [0] * (self.sink + 1)

    def settle(self, states) -> list[int]:
        """Exact costs from these states at the block's start to the conversation's end; prices of others are bounds."""
        for state in states:
            auction(self.arcs, self.price, state, self.sink)
        return [self.least + p for p in self.price[:4]]

    def trace(self, state: int) -> tuple[list[str], int]:
        """Letters of each row's step (insertions before it, then its own) on the ASCII-least tight path, and the state it ends in."""
        price, arcs, end = self.price, self.arcs, 4 * len(self.codes)
        leads = [False] * end + [price[end + k] == self.ahead[k] for k in range(4)] + [True]
        tight = lambda v: [(w, letter) for cost, w, letter in arcs[v] if price[v] == cost + price[w]]
        for base in range(end - 4, -1, -4):
            for _ in range(3):  # insertions stay in their row: at most two of them follow each other
                for v in range(base, base + 4):
                    leads[v] = leads[v] or any(leads[w] for w, _ in tight(v))
        steps, now, v = [], "", state
        while v < end:
            w, letter = next((w, letter) for w, letter in tight(v) if leads[w])
            now += letter
            if letter != I:
                steps.append(now)
                now = ""
            v = w
        return steps, v - end


def edits(codes: bytes) -> tuple[list[str], str, int]:
    """Each row's step, the insertions after the last row, and the cost of a conversation's cheapest edits.

    The lattice is cut into blocks of BLOCK rows. From the last block to the first, prices are settled for every state that a block
    can be entered in, with the next block's prices as costs at its end; those are exact distances, so the blocks' tight arcs together
    are those of the whole lattice, traced from the start.
    """
    missing = [0, 2, 1, 0]  # rows to insert at the end
    cuts = range(0, len(codes), BLOCK)
    ends = [[n * INSERT for n in missing]]
    for at in reversed(cuts):
        if at:
            ends.append(Lattice(codes[at : at + BLOCK], ends[-1]).settle(range(4)))
    steps, state, cost = [], START, 0
    for at, ahead in zip(cuts, reversed(ends)):
        block = Lattice(codes[at : at + BLOCK], ahead)
        here = block.settle([state])[state]
        cost = here if not at else cost
        traced, state = block.trace(state)
        steps += traced
    return steps, I * missing[state], cost


# ----------------------------------------------------------------------------------------------------------------- Spark


SEGMENTS = "part long, nth long, codes binary, low long, high long, turns long, first_turn long, last_turn long, roles array<string>, texts array<string>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range as segments of one conversation each."""
    part, nth = TaskContext.get().partitionId(), 0
    for batch in by_size(batches, "text", SEGMENT_BYTES):
        conv, turns = batch.column("conv_id"), batch.column("turn").to_pylist()
        new = np.ones(batch.num_rows, bool)
        new[1:] = ~np.asarray(pc.fill_null(pc.equal(conv[1:], conv[:-1]), False)) & ~np.asarray(pc.and_(pc.is_null(conv[1:]), pc.is_null(conv[:-1])))
        starts = [int(x) for a, b in zip(np.flatnonzero(new), [*np.flatnonzero(new)[1:], batch.num_rows]) for x in range(a, b, SEGMENT_ROWS)]
        codes, roles, texts = batch.column("code").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist()
        columns: list[list] = [[] for _ in range(10)]
        for a, b in zip(starts, [*starts[1:], batch.num_rows]):
            own = [t for t, c in zip(turns[a:b], codes[a:b]) if t is not None and c != GONE]
            here = [i for i in range(a, b) if codes[i] != GONE]
            row = (part, nth, bytes(codes[i] for i in here), min(own, default=None), max(own, default=None), len(set(own)), own[0] if own else None, own[-1] if own else None, [roles[i] for i in here], [texts[i] for i in here])
            for column, value in zip(columns, row):
                column.append(value)
            nth += 1
        types = [pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.list_(pa.string()), pa.list_(pa.string())]
        yield pa.RecordBatch.from_arrays([conv.take(pa.array(starts, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]], ["conv_id", *[x.split()[0] for x in SEGMENTS.split(", ")]])


def segments(rows: DataFrame) -> DataFrame:
    """Rows of faults() as segments: a conversation's rows in order, in pieces of SEGMENT_ROWS rows or SEGMENT_BYTES of text that (part, nth) order.

    Rows are dealt by ranges of conversation, turn and tie, so a large conversation spreads over tasks.
    """
    initial = F.substring("role", 1, 1)
    code = F.lit(0)
    for letter, k in INITIALS.items():
        code = F.when(initial == letter, k).otherwise(code)
    fault = F.lit(0)
    for name, k in FAULTS.items():
        fault = F.when(F.col("fault") == name, k).otherwise(fault)
    plain = rows.select("conv_id", "turn", "tie", "copy", F.when(F.col("gone"), GONE).otherwise(code + 4 * fault).alias("code"), "role", "text")
    order = ["conv_id", "turn", "tie", "copy"]
    kind = rows.schema["conv_id"].dataType.simpleString()
    return stash(plain.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, f"conv_id {kind}, {SEGMENTS}"), "segments")


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
STEPS = f"part long, nth long, steps array<string>, begins boolean, ends boolean, state int, {REPORT}"


class _Conversation:
    """What is kept of a conversation while its segments pass: a byte a row and each segment's place."""

    def __init__(self, conv):
        self.conv, self.places, self.codes = conv, [], bytearray()
        self.low = self.high = self.last = None
        self.turns = 0

    def add(self, part, nth, codes, low, high, turns, first, last) -> None:
        self.places.append((part, nth, len(codes)))
        self.codes += codes
        if low is not None:
            self.turns += turns - (first == self.last)
            self.low, self.high, self.last = low if self.low is None else self.low, high, last

    def rows(self) -> list[tuple]:
        codes = bytes(self.codes)
        steps, after, cost = edits(codes)
        fault = [sum(c >> 2 == k for c in codes) for k in (1, 2, 3)]
        illegal = sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:]))
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        out, at, state = [], 0, START
        for k, (part, nth, n) in enumerate(self.places):
            ends = k == len(self.places) - 1
            own = [*steps[at : at + n], *([after] if ends and after else [])]
            out.append((self.conv, part, nth, own, k == 0, ends, state, *((gaps, *fault, illegal, cost) if ends else [None] * 6)))
            state = _replay(state, codes[at : at + n], own)
            at += n
        return out


def _replay(state: int, codes: bytes, steps: list[str]) -> int:
    for i, step in enumerate(steps):
        for letter in step:
            if letter == K:
                state = KEPT[state, codes[i] & 3]
            elif letter != D:
                state = TURN[state]
    return state


def _solve(kind: pa.DataType):
    names = ["conv_id", *[x.split()[0] for x in STEPS.split(", ")]]
    types = [kind, pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.int32(), *[pa.int64()] * 6]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv != conv:
                    out += now.rows() if now else []
                    now = _Conversation(conv)
                now.add(*rest)
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
        out += now.rows() if now else []
        if out:
            yield batch_of(out)

    return run


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """segments(rows) and, by (part, nth), their steps and, at a conversation's last segment, its report.

    Of each conversation one task sees a byte a row, in order, and settles the lattice; texts do not travel there. Null and repeated conv_id, turns and
    rows are as faults() orders them; a conversation whose rows are all gone has a report of zeros; an empty table gives no rows. Other columns are not read.
    """
    pieces = segments(rows)
    kind = pieces.schema["conv_id"].dataType
    narrow = pieces.select("conv_id", "part", "nth", "codes", "low", "high", "turns", "first_turn", "last_turn")
    # a fixed number of partitions: rows of some bytes take long to solve, joined up by their size they would fill one task
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = narrow.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "part", "nth")
    solved = sorted_.mapInArrow(_solve(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, {STEPS}")
    return pieces, stash(solved, "steps")


def _apply(state: int, steps: list[str], roles: list[str], texts: list[str]) -> Iterator[tuple[str, str | None, str | None]]:
    """(letter, role, text) of each edit; a deletion keeps the row's own."""
    for i, step in enumerate(steps):
        for letter in step:
            if letter == D:
                yield D, roles[i], texts[i]
            elif letter == I:
                state = TURN[state]
                yield I, NAMES[state], ""
            else:
                kept = roles[i] if letter == K else NAMES[TURN[state]]
                state = KEPT[state, INITIALS[roles[i][0]]] if letter == K else TURN[state]
                yield letter, kept, texts[i]


def _joined(pieces: DataFrame, solved: DataFrame) -> DataFrame:
    return pieces.select("part", "nth", "roles", "texts").join(solved, ["part", "nth"])


def repaired_rows(pieces: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, part, nth, place, edit, role, text): every edit in order of part, nth and place; those other than D are the repaired conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in ("state", "steps", "roles", "texts")}
                found = list(_apply(**row))
                n = len(found)
                own = [batch.column(c).take(pa.array([k] * n, pa.int64())) for c in ("conv_id", "part", "nth")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(range(n), pa.int64()), *[pa.array([x[j] for x in found], pa.string()) for j in range(3)]], ["conv_id", "part", "nth", "place", "edit", "role", "text"])

    kind = pieces.schema["conv_id"].dataType.simpleString()
    return _joined(pieces, solved).select("conv_id", "part", "nth", "state", "steps", "roles", "texts").mapInArrow(run, f"conv_id {kind}, part long, nth long, place long, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by conversation: the running hash of the repaired rows, given out with the last segment. No text is kept."""
    fixed = ["conv_id", *[x.split()[0] for x in REPORT.split(", ")]]
    audit, running, first = [], hashlib.sha256(), True
    for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
        at, audits, hashes = [], [], []
        for k, (begins, ends, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("begins", "ends", "state", "steps", "roles", "texts")))):
            if begins:
                audit, running, first = [], hashlib.sha256(), True
            audit.append("".join(row[1]))
            for letter, role, text in _apply(*row):
                if letter != D:
                    running.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            if ends:
                at.append(k)
                audits.append("".join(audit))
                hashes.append(running.hexdigest())
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in fixed], pa.array(audits, pa.string()), pa.array(hashes, pa.string())], [*fixed, "audit", "repaired_sha256"])


def reports(pieces: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    The digest of a conversation is one SHA-256 over its rows, so they pass through one task in order; only the hash's state is held.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    sorted_ = _joined(pieces, solved).repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    return sorted_.mapInArrow(_digests, f"conv_id {kind}, {REPORT}, audit string, repaired_sha256 string")


def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of all `conversations`, damaged."""
    return reports(*repair(faults(damage(table(spark, sf_dir, "conversations")))))


def _sql() -> str:
    """The same in SQL: best suffixes of a conversation for each of the four states, from its last row to its first."""
    option = lambda cost, letter, after, row: f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 'r': {row}{after}.r}}"
    least = lambda options: f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"
    own, edge = [], []
    for state in range(4):
        to, name = TURN[state], NAMES[TURN[state]]
        keep = [f"CASE WHEN kept AND initial = '{letter}' THEN {option('late', K, f'f[{KEPT[state, k] + 1}]', '[role || chr(58) || text] || ')} END" for letter, k in INITIALS.items() if (state, k) in KEPT]
        row = f"['{name}' || chr(58) || text] || "
        own.append(least([option(DELETE, D, f"f[{state + 1}]", ""), *keep, f"CASE WHEN kept THEN {option(f'{REROLE} + late', R, f'f[{to + 1}]', row)} END"]))
        once = option(INSERT, I, f"o[{to + 1}]", f"['{name}:'] || ")
        twice = option(2 * INSERT, I + I, f"o[{TURN[to] + 1}]", f"['{name}:', '{NAMES[TURN[to]]}:'] || ")
        edge.append(least([f"o[{state + 1}]", once, twice]))
    return f"""
WITH RECURSIVE k AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || chr(58) || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda s: CAST(ord(s) AS BIGINT)),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind FROM conversations),
m AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM k)),
p AS (SELECT *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last, left(role, 1) AS initial,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(sha256(strlen(role) || chr(58) || role || chr(58) || text), 32)) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM m),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM p),
r AS (SELECT *, last <> '' AND nth = 1 AS kept, CAST(last <> '' AND nth = 1 AND last NOT IN ('.', '!', '?') AS BIGINT) AS late, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || '>' || initial, 's>u') NOT IN ('s>u', 'u>a', 'a>u') AS illegal FROM n),
f AS (SELECT conv_id, n + 1 AS i, [{{'c': CAST(0 AS BIGINT), 'a': '', 'r': CAST([] AS VARCHAR[])}}, {{'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']}}, {{'c': 2, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': []}}] AS f FROM r WHERE i = n
  UNION ALL
  SELECT conv_id, i, [{', '.join(edge)}] FROM (SELECT r.conv_id, r.i, [{', '.join(own)}] AS o FROM f JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i - 1)),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (last = '') AS blank, count(*) FILTER (last <> '' AND nth > 1) AS duplicate, sum(late) AS truncated, count(*) FILTER (illegal) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated, coalesce(s.illegal, 0) AS illegal,
  coalesce(f.f[1].c, 0) AS cost, coalesce(f.f[1].a, '') AS audit, sha256(coalesce(array_to_string(f.f[1].r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = 1
"""


OP11_SQL = _sql()
