"""Conversation structure repair: generalised LR repair over the role grammar.

A conversation's rows, by turn, should read ``(s?(ua)+)?`` in role initials
(s system, u user, a assistant).  The grammar C -> (nothing) | P, P -> s u a |
u a | P u a has a small LR(0) automaton.  All repairs are followed at once over
a graph-structured stack: its nodes are shared, a shift pushes a state, a
completed production pops its states and pushes P, and equal stacks are one
node, which keeps only the least (cost, audit) that leads to it.  Between rows
and around them a user or assistant may be inserted.

Edits: Keep costs 0; Rerole to user or assistant 3; Delete 4, required for blank
and duplicate rows; Insert an empty text 3; a truncated row that is not deleted
adds 3.  The audit is the edits' initials in order; among the cheapest repairs
the ASCII-least audit wins.  (Two audits of one cost that reach the same stack
after the same rows never begin with one another, since what one has beyond the
other would be insertions, which cost; so the lesser prefix stays the lesser.)

Spark deals the rows by ranges of (conversation, turn, ...) into buckets of equal
counts and a task walks its bucket in order.  A conversation inside one bucket
is repaired there.  Those at the edges of a bucket, and those with more than LONG
rows, are *open*: their rows (a semi join) are dealt again, their duplicates are
found by a partial aggregate over (conversation, role, text digest) and joined,
and a task turns up to PIECE rows of a conversation into the least (cost, audit)
from every stack to every stack, which are then chained in order, one row per
piece.  So no task holds a conversation's texts, even if it has a third of all
rows.  What remains in sequence is its SHA-256, which a task computes as the rows
stream by, and its audit, which is one cell of the result.

Edge cases: a null role or text counts as one space, and so does a null id or
turn in the text that decides the damage; rows with a null conv_id form one
conversation; null turns come first; rows of one turn are ordered by role, then
by the SHA-256 of their text, so repeated rows are neighbours; a role that is
none of s, u, a by its initial, or is empty, cannot be kept; a conversation
without rows has zeros, an empty audit and the hash of an empty string; an empty
table gives no rows; very long texts are hashed as they stream by; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLE = {"u": "user", "a": "assistant"}
SPACES = " \t\n\v\f\r"
#: rows of a conversation that a task repairs as a whole
LONG = 20_000
#: rows of an open conversation that become one piece
PIECE = 2048
#: fixed: states of C -> . | P, P -> s u a | u a | P u a
SHIFTS = {0: {"s": 1, "u": 2}, 1: {"u": 4}, 2: {"a": 5}, 3: {"u": 6}, 4: {"a": 7}, 6: {"a": 8}}
#: state with a completed production -> its length
REDUCTIONS = {5: 2, 7: 3, 8: 3}
P_STATE, FINAL = 3, (0, 3)


#: a node of the graph-structured stack: (state, node below); equal stacks are equal values
Stack = tuple
START: Stack = (0, None)
_shifted: dict = {}
_moves: dict = {}


def shift(stack: Stack, symbol: str) -> Stack | None:
    """The stack after the symbol and all reductions; None if it is refused."""
    if (stack, symbol) not in _shifted:
        to = SHIFTS.get(stack[0], {}).get(symbol)
        top = None if to is None else (to, stack)
        while top is not None and top[0] in REDUCTIONS:
            base = top
            for _ in range(REDUCTIONS[top[0]]):
                base = base[1]
            # P is pushed on the start state; a P that was popped with it is part of the new one
            top = (P_STATE, base)
        _shifted[stack, symbol] = top
    return _shifted[stack, symbol]


def all_stacks() -> list[Stack]:
    """Every stack that can stand between two rows, in the order they are found."""
    found = [START]
    for s in found:
        for symbol in "sua":
            t = shift(s, symbol)
            if t is not None and t not in found:
                found.append(t)
    return found


def merged(tops: dict, stack: Stack, cost: int, audit: str) -> bool:
    """Merge an equal stack top by the least (cost, audit)."""
    held = tops.get(stack)
    if held is None or (cost, audit) < held:
        tops[stack] = (cost, audit)
        return True
    return False


def with_insertions(tops: dict) -> dict:
    """Close a frontier under insertions."""
    work = list(tops)
    while work:
        stack = work.pop()
        cost, audit = tops[stack]
        for symbol in ROLE:
            to = shift(stack, symbol)
            if to is not None and merged(tops, to, cost + INSERT, audit + "I"):
                work.append(to)
    return tops


def moves(stack: Stack, fault: str, initial: str) -> tuple:
    """(stack, cost, audit) of all edits of one row and insertions after it."""
    key = (stack, fault, initial)
    if key not in _moves:
        tops = {stack: (DELETE, "D")}
        if fault not in ("blank", "duplicate"):
            extra = TRUNCATED if fault == "truncated" else 0
            for letter, cost, symbol in (("K", KEEP, initial), ("R", REROLE, "u"), ("R", REROLE, "a")):
                to = shift(stack, symbol)
                if to is not None:
                    merged(tops, to, cost + extra, letter)
        _moves[key] = tuple((s, *x) for s, x in with_insertions(tops).items())
    return _moves[key]


class Frontier:
    """The tops of the stack after some rows, with the least (cost, audit) of
    each; what all audits begin with is kept once."""

    def __init__(self, tops: dict):
        self.tops, self.shared, self.rows = tops, [], 0

    def row(self, fault: str, initial: str) -> None:
        tops: dict = {}
        for stack, (cost, audit) in self.tops.items():
            for to, more, letters in moves(stack, fault, initial):
                merged(tops, to, cost + more, audit + letters)
        self.tops = tops
        self.rows += 1
        if self.rows % 64 == 0:
            same = commonprefix([a for _, a in tops.values()])
            self.shared.append(same)
            self.tops = {s: (c, a[len(same) :]) for s, (c, a) in tops.items()}

    def ends(self) -> dict:
        begin = "".join(self.shared)
        return {s: (c, begin + a) for s, (c, a) in self.tops.items()}


def least_final(ends: dict) -> tuple[int, str]:
    return min(x for s, x in ends.items() if s[0] in FINAL)


def repair(rows: Iterable[tuple[str, str]]) -> tuple[int, str]:
    """Least (cost, audit) of a conversation's (fault, role initial) rows."""
    frontier = Frontier(with_insertions({START: (0, "")}))
    for fault, initial in rows:
        frontier.row(fault, initial)
    return least_final(frontier.ends())


def fault_of(role: str, text: str, seen: set) -> str:
    """First fault of a row; ``seen`` holds (role, text) of earlier rows."""
    last = text.rstrip(SPACES)[-1:]
    again = (role, text) in seen
    seen.add((role, text))
    return "blank" if not last else "duplicate" if again else "truncated" if last not in ".!?" else ""


class Walk:
    """Applies an audit to rows that stream by; ``out`` gets (role, text, edit)."""

    def __init__(self, audit: str, out):
        self.audit, self.at, self.before, self.out = audit, 0, "", out

    def emit(self, edit: str, role: str | None, text: str) -> None:
        if role is None:
            role = ROLE["a" if self.before == "u" else "u"]
        self.before = role[:1]
        self.out(role, text, edit)

    def insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.emit("I", None, "")

    def row(self, role: str, text: str) -> None:
        self.insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.emit(edit, role if edit == "K" else None, text)


class Hash:
    """SHA-256 of the repaired rows, newline-joined."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def __call__(self, role: str, text: str, edit: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True


LEGAL = {"su", "ua", "au"}


class Counts:
    """What is counted along a run of rows in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = None

    def row(self, turn, fault: str, initial: str) -> None:
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


ORDER = ["conv_id", "turn", "role", "fp", "row_id", "copy"]
ROWS = "conv_id long, turn long, role string, text string, copy int, fp binary, row_id long"
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
FIELDS = [x.split()[0] for x in RESULT.split(", ")]


def or_space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy of the rows after the damage."""
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return (
        conversations.withColumn("__kind", kind)
        .filter(F.col("__kind") != 0)
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.when(F.col("__kind") == 4, F.lit("user")).otherwise(or_space("role")).alias("role"),
            F.when(F.col("__kind") == 1, F.lit("")).when(F.col("__kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
            F.explode(F.when(F.col("__kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
    )


def plain_rows(conversations: DataFrame) -> DataFrame:
    """The same columns of the rows as they are."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), or_space("role").alias("role"), or_space("text").alias("text"), F.lit(0).alias("copy")
    )


def in_order(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER)


def closed_or_open(long: int):
    """Rows of a bucket in order -> one row per conversation; those at the
    edges of the bucket or with more than ``long`` rows come out as open."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        run: list[tuple] = []
        key, n_run, first = None, 0, True

        def finish(edge: bool) -> None:
            if not n_run:
                return
            if edge or n_run > long:
                done.append((key, True, *[None] * (len(FIELDS) - 1)))
                return
            seen, counts, faults = set(), Counts(), []
            for turn, role, text in run:
                faults.append((fault_of(role, text, seen), role[:1]))
                counts.row(turn, *faults[-1])
            cost, audit = repair(faults)
            sha = Hash()
            walk = Walk(audit, sha)
            for _, role, text in run:
                walk.row(role, text)
            walk.insertions()
            done.append((key, False, counts.gaps(), counts.blank, counts.duplicate, counts.truncated, counts.illegal, cost, audit, sha.sha.hexdigest()))

        for b in batches:
            for conv, turn, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")], strict=True):
                if n_run and conv != key:
                    finish(first)
                    run, n_run, first = [], 0, False
                key, n_run = conv, n_run + 1
                if n_run <= long:
                    run.append((turn, role, text))
                elif run:
                    run = []
            if done:
                yield batch_of(done, OPEN)
                done = []
        finish(True)
        if done:
            yield batch_of(done, OPEN)

    return work


OPEN = "conv_id long, open boolean, " + RESULT.partition(", ")[2]
MOVES = "array<struct<from_stack:int,to_stack:int,cost:long,audit:string>>"
PIECES = f"conv_id long, bucket int, piece int, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string, moves {MOVES}"
ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
    MOVES: pa.list_(pa.struct([("from_stack", pa.int32()), ("to_stack", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])),
}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], ARROW[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def cut_pieces(size: int):
    """Rows (with fault) of a bucket in order -> pieces of at most ``size`` rows
    of one conversation, each from every stack to every stack."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stacks = all_stacks()
        bucket, done, n_pieces = TaskContext.get().partitionId(), [], 0
        key, counts, frontiers, n = None, None, None, 0

        def finish() -> None:
            nonlocal n, n_pieces
            if n:
                found = [{"from_stack": i, "to_stack": stacks.index(s), "cost": c, "audit": a} for i, f in enumerate(frontiers) for s, (c, a) in f.ends().items()]
                c = counts
                done.append((key, bucket, n_pieces, c.blank, c.duplicate, c.truncated, c.illegal, c.turns, c.low, c.high, c.first, c.last, found))
                n_pieces, n = n_pieces + 1, 0

        for b in batches:
            for conv, turn, initial, fault in zip(*[b.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")], strict=True):
                if n and (conv != key or n >= size):
                    finish()
                    if len(done) >= 64:
                        yield batch_of(done, PIECES)
                        done = []
                if not n:
                    key, counts, frontiers = conv, Counts(), [Frontier({s: (0, "")}) for s in stacks]
                n += 1
                counts.row(turn, fault, initial)
                for f in frontiers:
                    f.row(fault, initial)
        finish()
        if done:
            yield batch_of(done, PIECES)

    return work


def chain_pieces(pieces: pa.Table) -> pa.Table:
    """The pieces of one conversation -> its result, without the hash."""
    stacks = all_stacks()
    tops = {stacks.index(s): x for s, x in with_insertions({START: (0, "")}).items()}
    total, rows = Counts(), pieces.sort_by([("bucket", "ascending"), ("piece", "ascending")])
    for r in rows.to_pylist():
        for c in ("blank", "duplicate", "truncated", "illegal"):
            setattr(total, c, getattr(total, c) + r[c])
        total.illegal += total.last is not None and total.last + r["first"] not in LEGAL
        total.last = r["last"]
        if r["low"] is not None:
            total.turns += r["turns"] - (total.high == r["low"])
            total.low = r["low"] if total.low is None else total.low
            total.high = r["high"]
        after: dict = {}
        for m in r["moves"]:
            if m["from_stack"] in tops:
                cost, audit = tops[m["from_stack"]]
                merged(after, m["to_stack"], cost + m["cost"], audit + m["audit"])
        tops = after
    cost, audit = least_final({stacks[i]: x for i, x in tops.items()})
    row = (rows.column("conv_id")[0].as_py(), total.gaps(), total.blank, total.duplicate, total.truncated, total.illegal, cost, audit, None)
    return pa.Table.from_batches([batch_of([row], RESULT)])


def faults_of_open(rows: DataFrame) -> DataFrame:
    """rows with initial and fault, duplicates found without gathering a group."""
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn", "row_id", "copy")
    groups = rows.groupBy("conv_id", "role", "fp").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    again = written(groups.filter(F.col("n") > 1).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("fp").alias("f"), "first"), "repeated-turns")
    marked = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("fp") == F.col("f")), "left")
    last = F.substring(F.rtrim("text", F.lit(SPACES)), -1, 1)
    fault = (
        F.when(last == "", "blank")
        .when(F.col("first").isNotNull() & (order > F.col("first")), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return marked.select(*ORDER, F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def streamed(rows: DataFrame, audits: DataFrame, schema: str, make) -> DataFrame:
    """Walk whole conversations in order, each behind its audit; ``make(conv)``
    gives (out, finish): the sink of the repaired rows and its result rows."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    head = audits.select("conv_id", F.col("audit"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("text", "string"), ("copy", "int"), ("fp", "binary"), ("row_id", "long"))])
    body = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(head)
    body = body.withColumn("is_row", F.col("audit").isNull())
    body = body.repartition(n, "conv_id").sortWithinPartitions("conv_id", "is_row", *ORDER[1:])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = finish = None
        for b in batches:
            done: list[tuple] = []
            for conv, audit, role, text in zip(*[b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")], strict=True):
                if audit is not None:
                    if walk is not None:
                        walk.insertions()
                        done += finish()
                    out, finish = make(conv)
                    walk = Walk(audit, out)
                else:
                    walk.row(role, text)
            done += finish(False) if walk is not None else []
            if done:
                yield batch_of(done, schema)
        if walk is not None:
            walk.insertions()
            done = finish()
            if done:
                yield batch_of(done, schema)

    return body.select("conv_id", "audit", "role", "text").mapInArrow(work, schema)


def hashed(conv):
    sha = Hash()
    return sha, lambda end=True: [(conv, sha.sha.hexdigest())] if end else []


def listed(conv):
    """Repaired rows; what is ready goes out after each batch."""
    ready: list[tuple] = []
    place = 0

    def out(role: str, text: str, edit: str) -> None:
        nonlocal place
        ready.append((conv, place, role, text, edit))
        place += 1

    def finish(end: bool = True) -> list[tuple]:
        rows = ready.copy()
        ready.clear()
        return rows

    return out, finish


class Repairs:
    """Repairs of a table of rows (:func:`damaged` or :func:`plain_rows`)."""

    def __init__(self, rows: DataFrame, long: int = LONG, piece: int = PIECE):
        spark = rows.sparkSession
        rows = rows.withColumn("fp", F.unhex(F.sha2("text", 256))).withColumn("row_id", F.monotonically_increasing_id())
        self.rows = written(rows, "conversation-rows")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        first = written(in_order(self.rows, n).select("conv_id", "turn", "role", "text").mapInArrow(closed_or_open(long), OPEN), "closed-conversations")
        open_ids = first.filter("open").select(F.col("conv_id").alias("c")).distinct()
        mine = self.rows.join(open_ids, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
        light = in_order(faults_of_open(mine), n).select("conv_id", "turn", "initial", "fault")
        pieces = written(light.mapInArrow(cut_pieces(piece), PIECES), "conversation-pieces")
        chained = written(pieces.groupBy("conv_id").applyInArrow(chain_pieces, RESULT), "open-conversations")
        hashes = streamed(mine, chained, "conv_id long, sha string", hashed).withColumnRenamed("conv_id", "c")
        late = chained.join(hashes, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("repaired_sha256", F.col("sha"))
        #: one row per conversation that has rows
        self.summary = first.filter(~F.col("open")).select(FIELDS).unionByName(late.select(FIELDS))

    def turns(self) -> DataFrame:
        """The repaired rows: conv_id, place from 0, role, text, edit (K, R or I)."""
        schema = "conv_id long, place int, role string, text string, edit string"
        return streamed(self.rows, self.summary, schema, listed)


def repaired(conversations: DataFrame, rows: DataFrame | None = None, long: int = LONG, piece: int = PIECE) -> DataFrame:
    """One row per conv_id of ``conversations``; ``rows`` are its rows after
    the damage (default: :func:`damaged`)."""
    summary = Repairs(damaged(conversations) if rows is None else rows, long, piece).summary.withColumnRenamed("conv_id", "c")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = ids.join(summary, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in FIELDS[1:7]]
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(table(spark, sf_dir, "conversations"))


#: the same repairs in SQL: a recursive walk over the rows with the four states
#: that a text of the grammar can be in (E: nothing, S: after s, U: after u, A: after a)
ORACLE_SQL = r"""
WITH RECURSIVE bits(b, k, v) AS (
  SELECT x, 0, x FROM (SELECT unnest(range(256)) AS x)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc_table AS MATERIALIZED (SELECT b, v FROM bits WHERE k = 8),
src AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') AS key,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
crc(name, i, v) AS (
  SELECT DISTINCT name, 0, CAST(4294967295 AS BIGINT) FROM src
  UNION ALL
  SELECT crc.name, crc.i + 1, xor(crc.v >> 8, t.v)
  FROM crc JOIN crc_table t ON t.b = xor(crc.v, CAST(ord(substr(crc.name, crc.i + 1, 1)) AS BIGINT)) & 255 WHERE crc.i < length(crc.name)),
kinds AS MATERIALIZED (SELECT name, xor(v, 4294967295) % 20 AS kind FROM crc WHERE i = length(name)),
damaged AS MATERIALIZED (
  SELECT row_id, key, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM src JOIN kinds USING (name), (VALUES (0), (1)) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text), row_id, copy) AS n,
         row_number() OVER (PARTITION BY key, role, text ORDER BY turn NULLS FIRST, row_id, copy) AS nth,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last, substr(role, 1, 1) AS initial
  FROM damaged),
marked AS MATERIALIZED (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY key ORDER BY n) AS before
  FROM numbered),
counts AS MATERIALIZED (
  SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY key),
shift(f, sym, t) AS (VALUES ('E', 's', 'S'), ('E', 'u', 'U'), ('S', 'u', 'U'), ('A', 'u', 'U'), ('U', 'a', 'A')),
ins AS MATERIALIZED (
  SELECT DISTINCT f, f AS t, 0 AS cost, '' AS letters FROM shift
  UNION ALL SELECT f, t, 3, 'I' FROM shift WHERE sym <> 's'
  UNION ALL SELECT a.f, b.t, 6, 'II' FROM shift a JOIN shift b ON a.t = b.f WHERE a.sym <> 's' AND b.sym <> 's'),
edits AS MATERIALIZED (
  SELECT DISTINCT f, f AS t, 'D' AS letter, 4 AS cost, '' AS sym FROM shift
  UNION ALL SELECT f, t, 'K', 0, sym FROM shift
  UNION ALL SELECT f, t, 'R', 3, sym FROM shift WHERE sym <> 's'),
walk(key, n, st, best) AS (
  SELECT key, CAST(0 AS BIGINT), t, struct_pack(cost := CAST(cost AS BIGINT), audit := letters) FROM counts, ins WHERE f = 'E'
  UNION ALL
  SELECT w.key, w.n + 1, i.t,
         min(struct_pack(cost := CAST(w.best.cost + e.cost + i.cost + CASE WHEN m.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END AS BIGINT),
                         audit := w.best.audit || e.letter || i.letters))
  FROM walk w JOIN marked m ON m.key = w.key AND m.n = w.n + 1
  JOIN edits e ON e.f = w.st AND (e.letter = 'D' OR (m.fault NOT IN ('blank', 'duplicate') AND (e.letter = 'R' OR e.sym = m.initial)))
  JOIN ins i ON i.f = e.t
  GROUP BY w.key, w.n, i.t),
least AS MATERIALIZED (
  SELECT w.key, min(w.best) AS best FROM walk w JOIN counts c ON c.key = w.key AND c.n = w.n WHERE w.st IN ('E', 'A') GROUP BY w.key),
letters AS (
  SELECT key, substr(audit, i, 1) AS letter, length(replace(substr(audit, 1, i), 'I', '')) AS n, length(replace(substr(audit, 1, i), 'D', '')) AS place
  FROM (SELECT key, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS i FROM least)),
kept AS (
  SELECT l.*, m.role, CASE WHEN l.letter = 'I' THEN '' ELSE m.text END AS text,
         max(CASE WHEN l.place = 1 AND l.letter = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.key) AS system
  FROM letters l LEFT JOIN marked m ON m.key = l.key AND m.n = l.n WHERE l.letter <> 'D'),
hashes AS (
  SELECT key, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                chr(10) ORDER BY place)) AS sha
  FROM kept GROUP BY key)
SELECT s.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(l.best.cost, 0) AS cost,
       coalesce(l.best.audit, '') AS audit, coalesce(h.sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM src) s LEFT JOIN counts c USING (key) LEFT JOIN least l USING (key) LEFT JOIN hashes h USING (key)
"""
