"""Conversation structure repair: the cheapest edits that give every
conversation the shape ``(s?(ua)+)?`` of role initials.

Edits: K(eep) 0, R(erole) to user or assistant 3, D(elete) 4, I(nsert) an empty
user or assistant row 3. Blank and repeated rows must go; a truncated row that
stays costs 3 more. Of equally cheap repairs the one whose edits, written as
letters in order, come first in ASCII is taken.

The search is a Viterbi pass over narrow rows (turn, role initial, faults, no
text) in the order of the conversation. The survivors of the four states hang
in a tree of back pointers; a node counts what refers to it, and once all
survivors descend from one child of the root that child's edits are final and
leave the tree, so what is held is the unresolved part alone. Ties compare the
survivors' complete unresolved suffixes: the ranks of these are carried from row
to row, as two survivors' rows never are each other's beginning.

Conversations are dealt by range of (conversation, turn, role, digest), so a
conversation with very many rows lies in many tasks. A task that holds only a
part of one runs it from every state that it may be entered in; the parts are
stitched by cost and edits. Only the last step, which puts texts to the edits,
streams a conversation's texts through one task (a digest of the repaired
conversation has to read them in order).

Defined results: rows are taken by turn, nulls first, rows of one turn by role
and then by the SHA-256 of the text. Rows equal in turn, role and text are
copies: the first counts, the others are duplicates. Null roles and texts are
one space; a null conversation id is a conversation of its own; a conversation
none of whose rows is left has zeros and no edits; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulaframe.llm.common import crc32_sql, cut, table

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# states: nothing yet, after the system row, after a user row, after an assistant row
START, SYSTEM, USER, ASSISTANT = range(4)
_INSERTED = ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT))


def _moves(initial: str, faulty: bool, extra: int) -> dict[int, tuple]:
    """By state: the edits a row allows as (letter, next state, cost)."""
    out = {}
    for state in range(4):
        turn = ASSISTANT if state == USER else USER
        moves = [("D", state, DELETE)]
        if not faulty:
            moves.append(("R", turn, REROLE + extra))
            if initial == "ua"[turn == ASSISTANT]:
                moves.append(("K", turn, extra))
            if initial == "s" and state == START:
                moves.append(("K", SYSTEM, extra))
        out[state] = tuple(moves)
    return out


_MOVES = {(i, f, x): _moves(i, f, TRUNCATED * x) for i in ("s", "u", "a", "") for f in (False, True) for x in (False, True)}


class _Node:
    """Edits of one row, pointing back to those before it. ``refs`` counts the
    nodes and survivors that point here."""

    __slots__ = ("up", "edits", "kids", "refs")

    def __init__(self, up, edits):
        self.up, self.edits, self.kids, self.refs = up, edits, [], 0
        if up is not None:
            up.kids.append(self)
            up.refs += 1


class Survivors:
    """The cheapest way into each state, from one state at the beginning.

    ``alive[state]`` = (cost, rank, inserts, node): the edits are those up to
    ``node`` and then so many inserts; ``rank`` orders the nodes' whole edits.
    """

    def __init__(self, state: int):
        self.root = _Node(None, "")
        self.root.refs = 1
        self.done: list[str] = []
        self.alive = {state: (0, 0, 0, self.root)}
        self._insert()

    def _insert(self) -> None:
        alive = self.alive
        for _ in range(2):
            for state, to in _INSERTED:
                if state in alive:
                    cost, rank, k, node = alive[state]
                    if to not in alive or (cost + INSERT, rank, k + 1) < alive[to][:3]:
                        if to in alive:
                            self._release(alive[to][3])
                        alive[to] = (cost + INSERT, rank, k + 1, node)
                        node.refs += 1
        # A start that costs more than 4 above the assistant's state can't win:
        # what follows it may follow there as well, without its system row. A
        # system row in front may be followed by nothing else than what may
        # follow an assistant row. Equal costs stay, for the tie's sake.
        most = alive[ASSISTANT][0]
        for state, more in ((START, DELETE), (SYSTEM, 0)):
            if state in alive and alive[state][0] > most + more:
                self._release(alive.pop(state)[3])

    def _release(self, node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.up is not None:
            node.up.kids.remove(node)
            node = node.up
            node.refs -= 1

    def step(self, moves: dict[int, tuple]) -> None:
        best: dict[int, tuple] = {}
        for state, (cost, rank, k, node) in self.alive.items():
            for letter, to, price in moves[state]:
                way = (cost + price, rank, "I" * k + letter)
                if to not in best or way < best[to][0]:
                    best[to] = (way, node)
        order = {x: i for i, x in enumerate(sorted({way[1:] for way, _ in best.values()}))}
        nodes: dict[int, _Node] = {}
        old, self.alive = self.alive, {}
        for to, ((cost, rank, edits), node) in best.items():
            r = order[rank, edits]
            if r not in nodes:
                nodes[r] = _Node(node, edits)
            nodes[r].refs += 1
            self.alive[to] = (cost, r, 0, nodes[r])
        for *_, node in old.values():
            self._release(node)
        self._insert()
        while self.root.refs == 1 and self.root.kids:  # all survivors share this child
            self.root = self.root.kids[0]
            self.root.up = None
            self.done.append(self.root.edits)

    def ends(self) -> dict[int, tuple[int, str]]:
        """By state: cost and edits."""
        out, before = {}, "".join(self.done)
        for state, (cost, _, k, node) in self.alive.items():
            back = []
            while node is not self.root:
                back.append(node.edits)
                node = node.up
            out[state] = (cost, before + "".join(reversed(back)) + "I" * k)
        return out


def _best(ends: dict[int, tuple[int, str]]) -> tuple[int, str]:
    return min(ends[s] for s in (START, ASSISTANT) if s in ends)


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "min_turn", "max_turn", "first", "last")
_COUNT_TYPES = "blank long, duplicate long, truncated long, illegal long, turns long, min_turn long, max_turn long, first string, last string"


class _Part:
    """One task's part of a conversation."""

    def __init__(self, conv, open_start: bool):
        self.conv = conv
        self.ways = {s: Survivors(s) for s in (range(4) if open_start else (START,))}
        self.c = dict.fromkeys(_COUNTS[:5], 0) | dict.fromkeys(_COUNTS[5:])

    def row(self, turn, initial, n, blank, dup, truncated) -> None:
        if not n:
            return
        c = self.c
        c["illegal"] += n - 1 + (c["last"] is not None and c["last"] + initial not in ("su", "ua", "au"))
        c["first"], c["last"] = initial if c["first"] is None else c["first"], initial
        if turn is not None:
            c["turns"] += turn != c["max_turn"]
            c["min_turn"], c["max_turn"] = turn if c["min_turn"] is None else c["min_turn"], turn
        if blank:
            c["blank"] += n
        else:
            c["duplicate"] += n - (not dup)
            c["truncated"] += truncated and not dup
        moves = _MOVES[initial if initial in ("s", "u", "a") else "", blank or dup, truncated]
        # the other copies go; inserts come before or after all of them
        rest = {s: (("D" * (n - 1), s, DELETE * (n - 1)),) for s in range(4)} if n > 1 else None
        for way in self.ways.values():
            way.step(moves)
            if rest:
                way.step(rest)

    def out(self, part: int, open_end: bool):
        counts = tuple(self.c.values())
        for entry, way in self.ways.items():
            ends = way.ends()
            if open_end or len(self.ways) > 1:
                for state, (cost, edits) in ends.items():
                    yield self.conv, part, entry, state, cost, edits, *counts
            else:
                cost, edits = _best(ends)
                yield self.conv, part, entry, -1, cost, edits, *counts


def _records(rows, schema: pa.Schema, size: int = 2000):
    buffer = []
    for r in rows:
        buffer.append(r)
        if len(buffer) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), schema.types)], schema=schema)
            buffer = []
    if buffer:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*buffer), schema.types)], schema=schema)


def _solve(schema: pa.Schema):
    def parts(batches):
        part, cur = TaskContext.get().partitionId(), None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if cur is None or row[0] != cur.conv:
                    if cur is not None:
                        yield from cur.out(part, False)
                    cur = _Part(row[0], cur is None)
                cur.row(*row[1:])
        if cur is not None:
            yield from cur.out(part, True)

    return lambda batches: _records(parts(batches), schema)


def _total(parts) -> tuple:
    """Counts, cost and edits of a conversation from its parts in order."""
    c: dict = {}
    for p in parts:
        p = dict(zip(_COUNTS, p))
        if not c:
            c = p
            continue
        if p["first"] is None:
            continue
        joint = c["last"] is not None and c["last"] + p["first"] not in ("su", "ua", "au")
        same_turn = p["min_turn"] is not None and p["min_turn"] == c["max_turn"]
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            c[k] += p[k]
        c["illegal"] += joint
        c["turns"] -= same_turn
        c["first"], c["min_turn"] = (p[k] if c[k] is None else c[k] for k in ("first", "min_turn"))
        c["last"], c["max_turn"] = p["last"], c["max_turn"] if p["max_turn"] is None else p["max_turn"]
    return tuple(c.values())


def _stitch(schema: pa.Schema):
    """Parts of split conversations, in order, to whole ones."""
    def whole(batches):
        for b in batches:
            for conv, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ways, counts, at = {START: (0, "")}, [], None
                by: dict[int, list] = {}
                for p in parts:
                    by.setdefault(p["part"], []).append(p)
                for at in sorted(by):
                    ends: dict[int, tuple[int, str]] = {}
                    for p in by[at]:
                        if p["entry"] in ways:
                            cost, edits = ways[p["entry"]]
                            way = (cost + p["cost"], edits + p["edits"])
                            if p["exit"] not in ends or way < ends[p["exit"]]:
                                ends[p["exit"]] = way
                    ways = ends
                    counts.append([by[at][0][k] for k in _COUNTS])
                yield conv, *_best(ways), *_total(counts)

    return lambda batches: _records(whole(batches), schema)


def _slim(rows: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text): copies ``n`` and
    faults; ``dup``: an earlier turn has the role and text."""
    key = ["conv", "turn", "role", "digest"]
    alone = rows.groupBy(*key).agg(F.sum("copies").alias("n"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    first = alone.filter("n > 0").groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("m"))
    # the first row of each text is marked by a row of its own that the next
    # count takes in, so no join meets a hot key
    marks = first.select("conv", F.col("m.turn").alias("turn"), "role", "digest", F.lit(0).cast("long").alias("n"),
                         F.lit(None).cast("boolean").alias("blank"), F.lit(None).cast("boolean").alias("truncated"), F.lit(True).alias("new"))
    return alone.withColumn("new", F.lit(False)).unionByName(marks).groupBy(*key).agg(
        F.sum("n").alias("n"), F.max("blank").alias("blank"), (~F.max("new")).alias("dup"), F.max("truncated").alias("truncated"))


def _prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Columns conv, turn, role, t, copies, digest, blank, truncated."""
    space = F.lit(" ")
    out = rows.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("t"),
                      (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"))
    end = F.right(F.rtrim("t", F.lit(BLANKS)), F.lit(1))
    return out.withColumn("digest", F.unhex(F.sha2("t", 256))).withColumn("blank", end == "") \
        .withColumn("truncated", (end != "") & ~end.isin(".", "!", "?"))


def plan_repairs(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 copies: str | None = None, partitions: int | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit (the edits' letters). ``copies`` names a column with the number
    of times a row stands in its conversation (0: only the id counts)."""
    spark = rows.sparkSession
    kind = rows.schema[conv_id].dataType.simpleString()
    order = ["conv", "turn", "role", "digest"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = _slim(_prepared(rows, conv_id, turn, role, text, copies).drop("t")) \
        .repartitionByRange(n, *order).sortWithinPartitions(*order) \
        .select("conv", "turn", F.substring("role", 1, 1).alias("initial"), "n", "blank", "dup", "truncated")
    empty = spark.createDataFrame([], f"conv {kind}, part int, entry int, exit int, cost long, edits string, {_COUNT_TYPES}")
    solved = cut(slim.mapInArrow(_solve(_arrow(empty)), empty.schema))
    edge = solved.filter("exit >= 0").groupBy("conv").agg(F.collect_list(F.struct("part", "entry", "exit", "cost", "edits", *_COUNTS)).alias("parts"))
    whole = spark.createDataFrame([], f"conv {kind}, cost long, edits string, {_COUNT_TYPES}")
    out = solved.filter("exit < 0").select(*whole.columns).unionByName(edge.mapInArrow(_stitch(_arrow(whole)), whole.schema))
    wide = "decimal(38,0)"
    gaps = F.expr(f"try_cast(cast(max_turn as {wide}) - cast(min_turn as {wide}) + 1 - turns as bigint)")
    return out.select(F.col("conv").alias("conv_id"), F.when(F.col("max_turn").isNull(), F.lit(0).cast("long")).otherwise(gaps).alias("gaps"),
                      "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"))


def _arrow(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def _apply(schema: pa.Schema):
    """Texts to edits: a conversation's plan comes first, its rows follow."""
    def repaired(batches):
        conv, audit, at, last, place = None, "", 0, "", 0

        def inserts():
            nonlocal at, last, place
            while at < len(audit) and audit[at] == "I":
                at, last = at + 1, "assistant" if last[:1] == "u" else "user"
                yield conv, place, None, last, "", "I"
                place += 1

        for b in batches:
            for c, planned, turn, role, text, copies in zip(*(x.to_pylist() for x in b.columns)):
                if planned:
                    yield from inserts()
                    conv, audit, at, last, place = c, text, 0, "", 0
                    continue
                for _ in range(copies):
                    yield from inserts()
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    last = role if edit == "K" else "assistant" if last[:1] == "u" else "user"
                    yield conv, place, turn, last, text, edit
                    place += 1
        yield from inserts()

    return lambda batches: _records(repaired(batches), schema)


def repaired_rows(rows: DataFrame, plan: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", copies: str | None = None) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), turn (null for an
    inserted row), role, text, edit. A conversation's rows are in one partition,
    in order; its texts are shuffled once, together with its plan."""
    kind = rows.schema[conv_id].dataType.simpleString()
    texts = _prepared(rows, conv_id, turn, role, text, copies).filter("copies > 0").withColumn("planned", F.lit(False)) \
        .select("conv", "planned", "turn", "role", "t", "copies", "digest")
    none = F.lit(None)
    plans = plan.select(F.col("conv_id").alias("conv"), F.lit(True).alias("planned"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                        F.col("audit").alias("t"), none.cast("long").alias("copies"), none.cast("binary").alias("digest"))
    dealt = plans.unionByName(texts).repartition("conv").sortWithinPartitions("conv", F.desc("planned"), "turn", "role", "digest").drop("digest")
    out = rows.sparkSession.createDataFrame([], f"conv_id {kind}, place long, turn long, role string, text string, edit string")
    return dealt.mapInArrow(_apply(_arrow(out)), out.schema)


def _digests(schema: pa.Schema):
    def whole(batches):
        conv, digest = None, None
        for b in batches:
            for c, place, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "place", "role", "text"))):
                if place == 0:
                    if digest:
                        yield conv, digest.hexdigest()
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
        if digest:
            yield conv, digest.hexdigest()

    return lambda batches: _records(whole(batches), schema)


def damage(rows: DataFrame) -> DataFrame:
    """The query's damage, by crc32 of ``conv_id:turn`` modulo 20, with the
    number of copies that are left of a row (0: dropped)."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = or_space("text")
    return rows.select("conv_id", "turn", h.alias("h"), or_space("role").alias("role"), text.alias("text")).select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("h") == 0, 0).when(F.col("h") == 3, 2).otherwise(1).alias("copies"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damage(table(spark, sf_dir, "conversations"))
    plan = cut(plan_repairs(rows, copies="copies"))
    out = spark.createDataFrame([], f"conv {rows.schema['conv_id'].dataType.simpleString()}, sha string")
    digests = repaired_rows(rows, plan, copies="copies").mapInArrow(_digests(_arrow(out)), out.schema)
    return plan.join(digests, plan["conv_id"].eqNullSafe(digests["conv"]), "left") \
        .select(*plan.columns, F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _oracle() -> str:
    """The same repair as a fold over each conversation's rows: a list of
    (state, cost, audit, text) with the least (cost, audit) of each state."""
    least = ("list_filter(list_transform(['', 's', 'u', 'a'], lambda k: list_min(list_transform(list_filter({0}, lambda x: x.st = k), "
             "lambda x: {{'cost': x.cost, 'audit': x.audit, 'st': x.st, 'out': x.out}}))), lambda x: x IS NOT NULL)")
    line = "x.out || CASE WHEN x.out = '' THEN '' ELSE chr(10) END || "
    nxt = "CASE WHEN x.st = 'u' THEN 'a' ELSE 'u' END"
    said = "CASE WHEN x.st = 'u' THEN 'assistant:' ELSE 'user:' END"
    state = lambda cost, edit, st, out: f"{{'cost': x.cost + {cost}, 'audit': x.audit || '{edit}', 'st': {st}, 'out': {out}}}"
    bind = lambda value, name, body: f"list_transform([{value}], lambda {name}: {body})[1]"
    insert = lambda v: least.format(f"list_concat({v}, list_transform({v}, lambda x: {state(3, 'I', nxt, line + said)}))")
    closed = lambda v: bind(insert(v), "c1", insert("c1"))
    keep = state("r.extra", "K", "r.i", line + "r.role || ':' || r.text")
    legal = f"(r.i = {nxt} OR (r.i = 's' AND x.st = ''))"
    step = ("flatten(list_transform(acc, lambda x: list_concat("
            f"[{state(4, 'D', 'x.st', 'x.out')}], "
            f"CASE WHEN r.faulty THEN [] ELSE [{state('3 + r.extra', 'R', nxt, line + said + ' || r.text')}] END, "
            f"CASE WHEN r.faulty OR NOT {legal} THEN [] ELSE [{keep}] END)))")
    start = "[{'cost': 0::BIGINT, 'audit': '', 'st': '', 'out': ''}]"
    return f"""
WITH src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                    {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS h FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
o AS (SELECT *, left(role, 1) AS i, row_number() OVER w AS k, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS e,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, lag(left(role, 1)) OVER w AS before
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, unhex(sha256(text)), copy)),
f AS (SELECT *, e = '' AS blank, e <> '' AND again AS dup, e NOT IN ('', '.', '!', '?') AND NOT again AS cut FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
             count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal,
             list({{'i': i, 'role': role, 'text': text, 'faulty': blank OR dup, 'extra': CASE WHEN cut THEN 3::BIGINT ELSE 0::BIGINT END}} ORDER BY k) AS rows
      FROM f GROUP BY conv_id),
v AS (SELECT *, list_reduce(list_concat([{{'acc': {closed(start)}, 'r': NULL}}], list_transform(rows, lambda r: {{'acc': NULL, 'r': r}})),
                            lambda a, b: {{'acc': {bind('a.acc', 'acc', bind('b.r', 'r', bind(least.format(step), 'c0', closed('c0'))))}, 'r': NULL}}).acc AS ways FROM g),
b AS (SELECT *, list_min(list_filter(ways, lambda x: x.st IN ('', 'a'))) AS best FROM v)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(best.out, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


OP11_SQL = _oracle()
