"""Repair the structure of conversations by the cheapest edits.

A conversation should be ``(s?(ua)+)?``: perhaps a system message, then user and assistant
in turn. Messages are kept (K), given the role that is due (R), deleted (D), and empty ones
are inserted (I). Blank messages and repeated ones must go; a truncated one that stays costs
extra. The cheapest edits are a shortest path in a lattice of (messages read, role due next);
among equally cheap ones the least audit, the edits' initials in order, is taken.

The path is searched from both ends (bidirectional Dijkstra): a heap of forward costs and
one of backward costs take turns until no path as cheap as the best crossing can be missing.
Each label holds the least audit of its cost, before or after its node. All crossings of the
least cost are then joined, and the least joined audit wins. No label of a node begins with
another one of the same cost, so the least parts make the least whole.

Messages of a conversation are numbered by a sort in ranges and cut into segments of
``SEGMENT`` messages. Within a segment the search runs in one task. Conversations of several
segments are joined by their costs from each role due at the beginning to each at the end:
products of 4 x 4 matrices, ``FAN`` at a time over as many levels as it takes, then back
down the costs that are left after each segment, up the roles that follow from that, and
down the role each segment begins with. So the search never holds a whole conversation.
An insertion belongs to the segment of the message it comes before.

Only ids, roles, marks of texts and one letter for each message take part in that. At the
end the messages pass, sorted, through a task that applies the audit as it reads: a digest
of a whole conversation can only be made in order, message by message, in bounded memory.

Cases: a null role or text counts as one blank. Messages are ordered by turn, missing turns
first, then role and a hash of the text; equal messages may change places. Messages without
a conversation are one conversation. Repeated rows are repeated messages. A conversation
that loses all messages has an empty audit of D's and no text. Roles are told by their first
letter; other than s, u, a must be changed or go. An empty table gives an empty result.
Further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import AT, BLOCK, HALO, in_blocks, in_order, with_halo
from tickloom.workspace import settle

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SEGMENT = 512
FAN = 256
# More than any cost.
NEVER = 1 << 60

# What may be due: a system or user message, a user message after it, an assistant message,
# a user message or the end.
BEGIN, USER_DUE, ASSISTANT_DUE, DONE = range(4)
STATES = 4
ENDS = (0, NEVER, NEVER, 0)
_KEPT = {(BEGIN, "s"): USER_DUE, (BEGIN, "u"): ASSISTANT_DUE, (USER_DUE, "u"): ASSISTANT_DUE, (ASSISTANT_DUE, "a"): DONE, (DONE, "u"): ASSISTANT_DUE}
_NEXT = (ASSISTANT_DUE, ASSISTANT_DUE, DONE, ASSISTANT_DUE)
_ROLE = ("user", "user", "assistant", "user")

# One letter for a message: its role's initial; in upper case if it must go; as a digit if
# it is truncated.
ROLES, MUST_GO, CUT = "suax", "SUAX", "1234"


def _moves(code: str, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a message: initial, state afterwards, cost."""
    yield "D", state, DELETE
    if code in MUST_GO:
        return
    extra = TRUNCATED if code in CUT else 0
    role = ROLES[CUT.index(code)] if extra else code
    if (state, role) in _KEPT:
        yield "K", _KEPT[state, role], extra
    yield "R", _NEXT[state], REROLE + extra


@lru_cache(maxsize=64)
def _lattice(code: str) -> tuple[tuple, tuple]:
    """Edits of a message by the state before, and by the state after."""
    forward = tuple(tuple(_moves(code, s)) for s in range(STATES))
    backward = tuple(tuple((e, s, c) for s in range(STATES) for e, t, c in forward[s] if t == end) for end in range(STATES))
    return forward, backward


_BEFORE = tuple(tuple(s for s in range(STATES) if _NEXT[s] == end) for end in range(STATES))


def cheapest(codes: str, start: int = BEGIN, ends: tuple[int, ...] = ENDS, tail: bool = True) -> tuple[int, str, int] | None:
    """Least cost, least audit and last state of a path through the messages.

    ``ends`` are the costs after each last state; ``tail`` lets messages be inserted after
    the last one. None where no end can be reached.
    """
    if len(codes) <= 32:
        return _remembered(codes, start, ends, tail)
    return _search(codes, start, ends, tail)


@lru_cache(maxsize=20_000)
def _remembered(codes: str, start: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str, int] | None:
    return _search(codes, start, ends, tail)


def _search(codes: str, start: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str, int] | None:
    n = len(codes)
    # Labels: cost and audit; going back, the state at the end as well.
    ahead: dict[tuple[int, int], tuple[int, str]] = {(0, start): (0, "")}
    back: dict[tuple[int, int], tuple[int, str, int]] = {(n, s): (c, "", s) for s, c in enumerate(ends) if c < NEVER}
    # Of equal costs, those that may still better the others come first: edits that cost
    # nothing lead on to the next message.
    forward, backward = [(0, 0, start)], [(label[0], -n, s) for (_, s), label in back.items()]
    heapq.heapify(backward)
    done_ahead, done_back = set(), set()
    best = NEVER

    def crossed(node: tuple[int, int]) -> None:
        nonlocal best
        if node in ahead and node in back:
            best = min(best, ahead[node][0] + back[node][0])

    for node in back:
        crossed(node)
    while forward and backward:
        if forward[0][0] + backward[0][0] > best:
            break
        if forward[0][0] <= backward[0][0]:
            cost, i, s = heapq.heappop(forward)
            if (i, s) in done_ahead:
                continue
            done_ahead.add((i, s))
            audit = ahead[i, s][1]
            steps = [(e, (i + 1, t), c) for e, t, c in _lattice(codes[i])[0][s]] if i < n else []
            if i < n or tail:
                steps.append(("I", (i, _NEXT[s]), INSERT))
            for edit, node, price in steps:
                label = (cost + price, audit + edit)
                if node not in ahead or label < ahead[node]:
                    if node not in ahead or label[0] < ahead[node][0]:
                        heapq.heappush(forward, (label[0], *node))
                    ahead[node] = label
                    crossed(node)
        else:
            cost, i, s = heapq.heappop(backward)
            i = -i
            if (i, s) in done_back:
                continue
            done_back.add((i, s))
            _, audit, last = back[i, s]
            steps = [(e, (i - 1, t), c) for e, t, c in _lattice(codes[i - 1])[1][s]] if i else []
            if i < n or tail:
                steps += [("I", (i, t), INSERT) for t in _BEFORE[s]]
            for edit, node, price in steps:
                label = (cost + price, edit + audit, last)
                if node not in back or label < back[node]:
                    if node not in back or label[0] < back[node][0]:
                        heapq.heappush(backward, (label[0], -node[0], node[1]))
                    back[node] = label
                    crossed(node)
    if best >= NEVER:
        return None
    crossings = (v for v, label in ahead.items() if v in back and label[0] + back[v][0] == best)
    audit, last = min((ahead[v][1] + back[v][1], back[v][2]) for v in crossings)
    return best, audit, last


# ------------------------------------------------------------------ conversations as tables


def messages(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key`` (never null), ``turn``, ``role``, ``text``, ``mark`` (a digest of the text)."""
    blank = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))
    rows = df.select(conversation_key(conv).alias("key"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    return rows.withColumn("mark", F.unhex(F.md5("text")))


def conversation_key(conv: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("none"))


def faults(rows: DataFrame) -> DataFrame:
    """Written messages in order with the first fault of each: ``blank``, ``duplicate``,
    ``truncated`` or none."""
    visible = "[^\\x20\\x09-\\x0D]"
    blank = ~F.col("text").rlike(visible)
    cut = ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    light = rows.select("key", "turn", "role", "mark", blank.alias("blank"), cut.alias("cut"))
    placed = in_order(light, ["key"], ["turn", "role", "mark"])
    # The first of equal messages, by its place alone: no group is brought together.
    firsts = placed.groupBy("key", "role", "mark").agg(F.min(AT).alias(AT)).select(AT, F.lit(True).alias("first"))
    marked = placed.join(firsts, AT, "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return settle(marked.withColumn("fault", fault).drop("blank", "cut", "first"), "faults")


def _code() -> Column:
    at = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)), F.lit(4))
    at = F.when(F.length("role") == 0, F.lit(4)).otherwise(at)
    letters = F.when(F.col("fault") == "truncated", CUT).when(F.col("fault").isNotNull(), MUST_GO).otherwise(ROLES)
    return F.substr(letters, at, F.lit(1))


def segments(faulty: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``key``, ``block``, ``codes`` of its messages, ``before`` (code of the message before
    the first), ``first`` (what tells the place of the first message) and ``last`` (whether
    it is the last segment), written."""
    numbered = in_blocks(faulty.withColumn("code", _code()), ["key"], size)
    rows = with_halo(numbered, 1, size)
    own = ~F.col(HALO)
    letters = F.collect_list(F.when(own, F.struct(AT, "code")))
    place = F.min(F.when(own, F.struct(AT, "turn", "role", "mark"))).alias("first")
    made = rows.groupBy("key", F.col(BLOCK).alias("block")).agg(
        F.sort_array(letters).alias("letters"), F.max(F.when(F.col(HALO), F.col("code"))).alias("before"), place
    )
    made = made.filter(F.size("letters") > 0)
    codes = F.array_join(F.transform("letters", lambda x: x["code"]), "").alias("codes")
    made = settle(made.select("key", "block", codes, "before", "first"), "segments")
    ends = made.filter("block > 0").groupBy("key").agg(F.max("block").alias("end"))
    last = F.col("block") == F.coalesce("end", F.lit(0))
    return settle(made.join(ends, "key", "left").withColumn("last", last).drop("end"), "segments")


_PLACE = "struct<_at: bigint, turn: {turn}, role: string, mark: binary>"


def _mapped(rows: DataFrame, columns: list[str], schema: str, of_row: Callable[..., Iterator[tuple]]) -> DataFrame:
    """Rows that a function makes of each row."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [new for row in zip(*(column.to_pylist() for column in batch.columns)) for new in of_row(*row)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in found], kinds)

    result = rows.select(*columns)
    kinds = pa.schema([(n, {"string": pa.string(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}[p.split()[1]]) for n, p in zip(names, schema.split(", "))])
    return result.mapInArrow(run, schema)


def _costs(codes: str, last: bool) -> list[int]:
    """Least costs from each state to each; of the last segment, to the end (as state 0)."""
    found = []
    for start in range(STATES):
        if last:
            path = cheapest(codes, start)
            found += [path[0] if path else NEVER, NEVER, NEVER, NEVER]
        else:
            for end in range(STATES):
                path = cheapest(codes, start, tuple(0 if s == end else NEVER for s in range(STATES)), tail=False)
                found.append(path[0] if path else NEVER)
    return found


def _after(matrix: list[int], rest: list[int]) -> list[int]:
    """Least costs from each state through a matrix and on."""
    return [min(NEVER, *(matrix[4 * s + t] + rest[t] for t in range(STATES))) for s in range(STATES)]


def _product(matrices: list[list[int]]) -> list[int]:
    result = matrices[-1]
    for matrix in reversed(matrices[:-1]):
        columns = [_after(matrix, result[t::4]) for t in range(STATES)]
        result = [columns[t][s] for s in range(STATES) for t in range(STATES)]
    return result


def _composed(maps: list[list[int]]) -> list[int]:
    result = list(range(STATES))
    for step in maps:
        result = [step[s] for s in result]
    return result


def _levels(rows: DataFrame, joined: Callable[[list[list[int]]], list[int]], fan: int) -> list[DataFrame]:
    """``key``, ``block``, ``v`` of segments, of groups of ``fan`` of them, and so on."""
    levels = [rows]
    while levels[-1].filter("block > 0").limit(1).count():
        grouped = _grouped(levels[-1], fan)
        up = _mapped(grouped, ["key", "up", "v"], "key string, block bigint, v array<bigint>", lambda key, up, v: [(key, up, joined(v))])
        levels.append(settle(up, "level"))
    return levels


def _grouped(level: DataFrame, fan: int) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct("block", "v")))
    grouped = level.groupBy("key", F.floor(F.col("block") / fan).alias("up")).agg(parts.alias("parts"))
    return grouped.select("key", "up", F.transform("parts", lambda x: x["block"]).alias("blocks"), F.transform("parts", lambda x: x["v"]).alias("v"))


def _down(levels: list[DataFrame], top: list[int], handed: Callable[[list, list], list[list[int]]], fan: int) -> DataFrame:
    """``key``, ``block``, ``given`` of the segments: what the top is given, handed down."""
    given = levels[-1].select("key", "block", F.array(*map(F.lit, top)).cast("array<bigint>").alias("given"))
    for level in reversed(levels[:-1]):
        parents = given.select("key", F.col("block").alias("up"), "given")
        rows = _grouped(level, fan).join(parents, ["key", "up"])
        schema = "key string, block bigint, given array<bigint>"
        down = _mapped(rows, ["key", "blocks", "v", "given"], schema, lambda key, blocks, v, given: ((key, b, x) for b, x in zip(blocks, handed(v, given))))
        given = settle(down, "given")
    return given


def _rests(matrices: list[list[int]], rest: list[int]) -> list[list[int]]:
    """Costs after each of some segments, by the state it ends in."""
    found = [rest]
    for matrix in reversed(matrices[1:]):
        found.append(_after(matrix, found[-1]))
    return found[::-1]


def _begins(maps: list[list[int]], begin: list[int]) -> list[list[int]]:
    """The state each of some segments begins with."""
    found = [begin]
    for step in maps[:-1]:
        found.append([step[found[-1][0]]])
    return found


def _path(codes: str, last: bool, start: int, rest: list[int]) -> tuple[int, str, int]:
    """Own cost, audit and last state of a segment on the cheapest way to the end."""
    if last:
        cost, audit, end = cheapest(codes, start)
        return cost, audit, end
    cost, audit, end = cheapest(codes, start, tuple(rest), tail=False)
    return cost - rest[end], audit, end


def audits(parts: DataFrame, fan: int = FAN) -> DataFrame:
    """``key``, ``block``, ``cost``, ``audit`` of each segment."""
    many = parts.filter("block > 0").select("key").distinct()
    schema = "key string, block bigint, cost bigint, audit string"
    one = parts.join(many, "key", "left_anti")
    found = _mapped(one, ["key", "block", "codes"], schema, lambda key, block, codes: [(key, block, *cheapest(codes)[:2])])
    several = settle(parts.join(many, "key", "left_semi").select("key", "block", "codes", "last"), "several")
    if several.isEmpty():
        return found
    values = "key string, block bigint, v array<bigint>"
    costs = _mapped(several, ["key", "block", "codes", "last"], values, lambda key, block, codes, last: [(key, block, _costs(codes, last))])
    rests = _down(_levels(settle(costs, "costs"), _product, fan), [0, NEVER, NEVER, NEVER], _rests, fan)
    rests = settle(several.join(rests, ["key", "block"]).withColumnRenamed("given", "rest"), "rests")

    def steps(key: str, block: int, codes: str, last: bool, rest: list[int]) -> Iterator[tuple]:
        yield key, block, [0 if last else _path(codes, last, s, rest)[2] for s in range(STATES)]

    maps = settle(_mapped(rests, ["key", "block", "codes", "last", "rest"], values, steps), "steps")
    begins = _down(_levels(maps, _composed, fan), [BEGIN], _begins, fan)
    rows = rests.join(begins, ["key", "block"])
    ways = _mapped(
        rows, ["key", "block", "codes", "last", "rest", "given"], schema,
        lambda key, block, codes, last, rest, given: [(key, block, *_path(codes, last, given[0], rest)[:2])],
    )
    return found.unionByName(ways)


def repair_plan(rows: DataFrame, size: int = SEGMENT, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Faults, segments and audits of messages given by :func:`messages`, all written."""
    faulty = faults(rows)
    parts = segments(faulty, size)
    return faulty, parts, settle(audits(parts, fan), "audits")


def _replayed(rows: DataFrame, parts: DataFrame, ways: DataFrame) -> DataFrame:
    """Messages of each conversation in order, each segment's audit before its messages."""
    kind = rows.schema["turn"].dataType
    plan = parts.join(ways, ["key", "block"]).select(
        "key", F.col("first.turn").cast(kind).alias("turn"), F.col("first.role").alias("role"), F.col("first.mark").alias("mark"),
        F.lit(0).alias("kind"), "block", F.col("audit").alias("text"),
    )
    read = rows.select("key", "turn", "role", "mark", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("block"), "text")
    both = plan.unionByName(read).repartition("key").sortWithinPartitions("key", "turn", "role", "mark", "kind", "block")
    return both.select("key", "role", "kind", "text")


def _edits(stream: Iterator[tuple[str, str, int, str]]) -> Iterator[tuple[str, str, str, str] | tuple[str, None, None, None]]:
    """``key, edit, role, text`` of what is kept or inserted; after each conversation its
    key alone. Holds the audits of at most a few segments."""
    key, state, queue = None, BEGIN, deque()

    def inserted() -> Iterator[tuple]:
        nonlocal state
        while queue and queue[0] == "I":
            queue.popleft()
            yield key, "I", _ROLE[state], ""
            state = _NEXT[state]

    for own, role, kind, text in stream:
        if own != key:
            if key is not None:
                yield from inserted()
                yield key, None, None, None
            key, state = own, BEGIN
            queue.clear()
        if kind == 0:
            queue.extend(text)
            continue
        yield from inserted()
        edit = queue.popleft()
        if edit == "K":
            yield key, edit, role, text
            state = _KEPT[state, role[:1]]
        elif edit == "R":
            yield key, edit, _ROLE[state], text
            state = _NEXT[state]
    if key is not None:
        yield from inserted()
        yield key, None, None, None


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, str]]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def repaired_messages(df: DataFrame, size: int = SEGMENT, fan: int = FAN, **columns: str) -> DataFrame:
    """The repaired conversations: ``key`` (see :func:`conversation_key`), ``position``,
    ``edit`` (K, R or I), ``role`` and ``text`` of each message."""
    rows = messages(df, **columns)
    _, parts, ways = repair_plan(rows, size, fan)

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, position, names = [], 0, ["key", "position", "edit", "role", "text"]
        for key, edit, role, text in _edits(_stream(batches)):
            if edit is None:
                position = 0
                continue
            found.append((key, position, edit, role, text))
            position += 1
            if len(found) == 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in found])
                found = []
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in found])

    return _replayed(rows, parts, ways).mapInArrow(replay, "key string, position bigint, edit string, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, digests, digest, empty = [], [], hashlib.sha256(), True
    for key, edit, role, text in _edits(_stream(batches)):
        if edit is None:
            keys.append(key)
            digests.append(digest.hexdigest())
            digest, empty = hashlib.sha256(), True
            continue
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
        empty = False
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "repaired_sha256"])


def repair_report(df: DataFrame, conversations: DataFrame, conv: str = "conv_id", size: int = SEGMENT, fan: int = FAN) -> DataFrame:
    """For each conversation of ``conversations`` what was wrong with its messages in ``df``
    and what its repair took: gaps, faults, illegal neighbours, cost, audit and a digest of
    the repaired conversation. Conversations without messages have none of these."""
    rows = messages(df, conv)
    faulty, parts, ways = repair_plan(rows, size, fan)
    of = lambda name: F.sum((F.col("fault") == name).cast("bigint")).alias(name)
    counted = faulty.groupBy("key").agg(of("blank"), of("duplicate"), of("truncated"))
    turns = faulty.groupBy("key", "turn").agg(F.count(F.lit(1)).alias("n"))
    span = (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint")
    turns = turns.groupBy("key").agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    plain = F.translate(F.concat(F.coalesce("before", F.lit("")), "codes"), MUST_GO + CUT, ROLES + ROLES)
    neighbours = F.when(F.length("line") < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.length("line") - 1))
    wrong = F.filter(neighbours, lambda i: ~F.substr("line", i, F.lit(2)).isin("su", "ua", "au"))
    illegal = parts.withColumn("line", plain).groupBy("key").agg(F.sum(F.size(wrong)).cast("bigint").alias("illegal"))
    ordered = F.sort_array(F.collect_list(F.struct("block", "audit")))
    told = ways.groupBy("key").agg(F.sum("cost").alias("cost"), F.array_join(F.transform(ordered, lambda x: x["audit"]), "").alias("audit"))
    digests = _replayed(rows, parts, ways).mapInArrow(_digests, "key string, repaired_sha256 string")
    result = conversations.select(F.col(conv), conversation_key(conv).alias("key")).distinct()
    for part in (counted, turns, illegal, told, digests):
        result = result.join(part, "key", "left")
    zero = lambda name: F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
    nothing = hashlib.sha256().hexdigest()
    return result.select(
        conv, *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", kinds: int = 20) -> DataFrame:
    """Conversations with faults, told by the CRC-32 of ``conv:turn``: messages left out,
    emptied, without their ends of sentences, repeated, and given the role ``user``."""
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn)).cast("binary")) % kinds
    rows = df.select(F.col(conv), F.col(turn), shown(role).alias(role), shown(text).alias(text), kind.alias("kind")).filter("kind <> 0")
    words = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    roles = F.when(F.col("kind") == 4, "user").otherwise(F.col(role))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(conv, turn, roles.alias(role), words.alias(text), F.explode(copies).alias("copy")).drop("copy")
