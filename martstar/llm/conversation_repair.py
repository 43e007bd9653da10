"""Repair of conversation structure by weighted interval parsing.

A conversation should read (s?(ua)+)?: an optional system turn, then pairs of user
and assistant turns. With the states 0 (start), 1 (after s), 2 (after u) and
3 (after a, or accept with 0) the repair grammar in Chomsky normal form is

    S    -> X0,0 | X0,3
    Xp,q -> Xp,r Xr,q                 for all states r
    Xp,q -> edit of one row           Keep, Rerole or Delete leads from p to q

and every cell is closed under insertions (Xp,q for the empty span: the turns to
insert between p and q). A cell of a span holds the least (cost, audit) of every
Xp,q. As the Xp,q compose, each way to split a span gives the same cell, so one
split per span is enough: spans of one row, two, four and so on are combined
bottom-up, n - 1 times for n rows. Concatenation keeps the order of audits:
two audits of a span with the same cost and states are never one the prefix of the
other, as the letters of the same edits cost the same and insertions cost more.

The rows are range-partitioned by (conversation, turn), once. A conversation that
lies inside one partition is parsed, walked and hashed there. Those cut by the
border of a partition (at most two per task, however long) are marked and go a
longer way: their duplicates are found by a grouped minimum, each partition gives
the cells of its span, the spans of a conversation are combined in order, and the
repaired text is hashed as a stream, since SHA-256 takes its bytes in order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martstar.llm.common import id_text, keep
from martstar.session import scratch_path

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
SPACES = " \t\n\x0b\x0c\r"
STATES = range(4)
START, ACCEPT = 0, (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
DUE = {0: "user", 1: "user", 2: "assistant", 3: "user"}  # the turn that is inserted, or made of another
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3  # first fault of a row

SPAN_ROWS = 4096  # rows whose cells a task holds one by one

RESULT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")

Cell = list  # of (cost, audit) or None, at 4 * p + q


# -- the grammar ------------------------------------------------------------
def _least(cells) -> Cell:
    out: Cell = [None] * 16
    for at, item in cells:
        if out[at] is None or item < out[at]:
            out[at] = item
    return out


def _insertions():
    for p in STATES:
        q, n = p, 0
        while n < 3:
            yield 4 * p + q, (INSERT * n, "I" * n)
            q, n = STEP[q, DUE[q][0]], n + 1


NOTHING = _least(_insertions())  # the empty span
_RULES = [(4 * p + q, 4 * p + r, 4 * r + q) for p in STATES for r in STATES for q in STATES]


def join(a: Cell, b: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = [None] * 16
    for pq, pr, rq in _RULES:
        x, y = a[pr], b[rq]
        if x is None or y is None:
            continue
        cost, best = x[0] + y[0], out[pq]
        if best is None or cost < best[0]:
            out[pq] = (cost, x[1] + y[1])
        elif cost == best[0]:
            out[pq] = min(best, (cost, x[1] + y[1]))
    return out


def _edits(fault: int, initial: str):
    more = TRUNCATED if fault == CUT else 0
    for p in STATES:
        yield 5 * p, (DELETE, "D")
        if fault in (SOUND, CUT):
            yield 4 * p + STEP[p, DUE[p][0]], (REROLE + more, "R")
            if (p, initial) in STEP:
                yield 4 * p + STEP[p, initial], (KEEP + more, "K")


LEAVES = {(f, i): join(join(NOTHING, _least(_edits(f, i))), NOTHING)
          for f in (SOUND, BLANK, DUPLICATE, CUT) for i in ("s", "u", "a", "")}


def leaf(fault: int, role: str) -> Cell:
    """The cell of one row; a role that starts with none of s, u, a can't be kept."""
    return LEAVES[fault, role[:1] if role[:1] in ("s", "u", "a") else ""]


def parse(spans: list[Cell]) -> Cell:
    """The cell of a row of spans, combined bottom-up by length."""
    while len(spans) > 1:
        pairs = [join(a, b) for a, b in zip(spans[::2], spans[1::2])]
        spans = pairs + spans[2 * len(pairs):]
    return spans[0] if spans else NOTHING


def root(cell: Cell) -> tuple[int, str]:
    return min(cell[4 * START + q] for q in ACCEPT if cell[4 * START + q])


class Walk:
    """The repaired conversation as an audit tells it, hashed turn by turn."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.hash, self.first = hashlib.sha256(), True

    def _turn(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False
        self.state = STEP[self.state, role[0]]

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._turn(DUE[self.state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._turn(role if edit == "K" else DUE[self.state], text)

    def end(self) -> str:
        self._inserted()
        return self.hash.hexdigest()


class Tally:
    """What is counted along the rows of a conversation, or of a piece of one."""

    def __init__(self):
        self.n = [0, 0, 0, 0]
        self.illegal = 0
        self.first = self.last = None  # role initials
        self.turns = 0
        self.least = self.most = None

    def row(self, fault: int, role: str, turn: int | None) -> None:
        self.n[fault] += 1
        i = role[:1]
        if self.last is None:
            self.first = i
        else:
            self.illegal += self.last + i not in ("su", "ua", "au")
        self.last = i
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn

    def then(self, other: Tally) -> None:
        """Count another piece, which follows this one."""
        self.n = [a + b for a, b in zip(self.n, other.n)]
        if other.first is not None:
            if self.last is None:
                self.first = other.first
            else:
                self.illegal += self.last + other.first not in ("su", "ua", "au")
            self.last = other.last
        self.illegal += other.illegal
        if other.least is not None:
            self.turns += other.turns - (self.most == other.least)
            self.least = other.least if self.least is None else self.least
            self.most = other.most

    def counts(self) -> tuple:
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, 2**63 - 1)
        return gaps, self.n[BLANK], self.n[DUPLICATE], self.n[CUT], self.illegal


# -- Spark ------------------------------------------------------------------
def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage; a dropped one stays as a mark (``gone``) of its conversation."""
    kind = F.crc32(F.concat_ws(":", _or_space("conv_id"), _or_space("turn")).cast("binary")) % F.lit(20)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(_or_space("text"), ".!?", "")).otherwise(_or_space("text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        (kind == 0).alias("gone"), F.when(kind == 4, F.lit("user")).otherwise(_or_space("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """The rows with their fault as far as a row tells it, and a number each."""
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(core == "", BLANK).when(~F.right(core, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(SOUND))
    return rows.select("*", fault.alias("fault"), F.monotonically_increasing_id().alias("uid"))


def _order() -> list[Column]:
    # the text's head and digest settle the order of rows of one turn without whole texts in the range borders
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"),
            F.left(F.col("text"), F.lit(32)), F.md5(F.col("text").cast("binary")), F.col("uid")]


def _ordered(rows: DataFrame) -> DataFrame:
    return (rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
            .select(id_text("conv_id").alias("conv_id"), id_text("turn").alias("turn"), "gone", "role", "text", "fault"))


def _rows(batches: Iterator[pd.DataFrame]):
    for b in batches:
        for conv, turn, gone, role, text, fault in zip(*(b[c].tolist() for c in b.columns)):
            yield conv, None if turn is None else int(turn), gone, role, text, fault


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Results of the conversations inside a partition; only a mark of its first and last one."""
    names = [f.split()[0] for f in RESULT.split(", ")] + ["cut"]
    out, held, now, first = [], [], None, True

    def done() -> tuple:
        seen, tally, cells = set(), Tally(), []
        for i, (turn, role, text, fault) in enumerate(held):
            if fault != BLANK and (role, text) in seen:
                fault = DUPLICATE
            seen.add((role, text))
            tally.row(fault, role, turn)
            cells.append(leaf(fault, role))
        cost, audit = root(parse(cells))
        walk = Walk(audit)
        for _, role, text, _ in held:
            walk.row(role, text)
        return (now, *tally.counts(), cost, audit, walk.end(), False)

    def mark() -> tuple:
        return (now, *[None] * (len(names) - 2), True)

    started = False
    for conv, turn, gone, role, text, fault in _rows(batches):
        if not started:
            started, now = True, conv
        elif conv != now:
            out.append(mark() if first else done())
            first, now, held = False, conv, []
            if len(out) >= 500:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if not gone and not first:
            held.append((turn, role, text, fault))
    if started:
        out.append(mark())
        yield pd.DataFrame(out, columns=names, dtype=object)


_SPAN = ("conv_id string, part int, costs array<long>, audits array<string>, n array<long>, illegal long, "
         "first string, last string, turns long, least string, most string")


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cell and the counts of each conversation's rows in this partition."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    names = [f.split()[0] for f in _SPAN.split(", ")]
    out, spans, cells, now, tally = [], [], [], None, None

    def done() -> tuple:
        cell = parse([*spans, parse(cells)])
        as_text = lambda v: None if v is None else str(v)
        return (now, part, [x[0] if x else -1 for x in cell], [x[1] if x else "" for x in cell], tally.n,
                tally.illegal, tally.first, tally.last, tally.turns, as_text(tally.least), as_text(tally.most))

    for conv, turn, gone, role, _, fault in _rows(batches):
        if tally is None or conv != now:
            if tally is not None:
                out.append(done())
            spans, cells, now, tally = [], [], conv, Tally()
        if not gone:
            tally.row(fault, role, turn)
            cells.append(leaf(fault, role))
            if len(cells) == SPAN_ROWS:
                spans.append(parse(cells))
                cells = []
    if tally is not None:
        out.append(done())
        yield pd.DataFrame(out, columns=names, dtype=object)


def _combine(key: tuple, spans: pd.DataFrame) -> pd.DataFrame:
    """The spans of a conversation, at most one per partition, in order."""
    spans = spans.sort_values("part")
    total, cells = Tally(), []
    for s in spans.itertuples():
        cells.append([(int(c), a) if c >= 0 else None for c, a in zip(s.costs, s.audits)])
        t = Tally()
        t.n, t.illegal, t.first, t.last, t.turns = [int(x) for x in s.n], int(s.illegal), s.first, s.last, int(s.turns)
        t.least, t.most = (None if v is None else int(v) for v in (s.least, s.most))
        total.then(t)
    cost, audit = root(parse(cells))
    return pd.DataFrame([(key[0], *total.counts(), cost, audit, None)], columns=[f.split()[0] for f in RESULT.split(", ")],
                        dtype=object)


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """conv_id, repaired_sha256 of sorted rows; a conversation's first row brings its audit as text."""
    now, walk, out = None, None, []
    for b in batches:
        for conv, is_row, gone, role, text in zip(*(b[c].tolist() for c in b.columns)):
            if not is_row:
                if walk:
                    out.append((now, walk.end()))
                now, walk = conv, Walk(text)
            elif not gone:
                walk.row(role, text)
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "repaired_sha256"])
            out = []
    if walk:
        yield pd.DataFrame([(now, walk.end())], columns=["conv_id", "repaired_sha256"])


def _across_partitions(rows: DataFrame) -> DataFrame:
    """Results of conversations of any length, none of them held by a task."""
    same = [F.col("conv_id"), F.col("role"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")]
    at = F.struct("turn", "uid")  # nulls sort first in a struct
    repeated = (rows.where("not gone").groupBy(*same).agg(F.min(at).alias("earliest"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").drop("n"))
    a, b = rows.withColumn("digest", same[2]).alias("a"), repeated.alias("b")
    match = (F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.role") == F.col("b.role"))
             & (F.col("a.digest") == F.col("b.digest")))
    later = F.col("b.earliest").isNotNull() & (F.struct("a.turn", "a.uid") != F.col("b.earliest"))
    flagged = a.join(b, match, "left").select(
        "a.conv_id", "a.turn", "a.gone", "a.role", "a.text", "a.uid",
        F.when(later & (F.col("a.fault") != BLANK), DUPLICATE).otherwise(F.col("a.fault")).alias("fault"))
    results = keep(_ordered(flagged).mapInPandas(_spans, _SPAN).groupBy("conv_id").applyInPandas(_combine, RESULT))
    told = results.select(F.col("conv_id").cast("long").alias("conv_id"), F.lit(False).alias("is_row"),
                          F.lit(None).cast("long").alias("turn"), F.lit(False).alias("gone"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(0).cast("long").alias("uid"))
    stream = (rows.select("conv_id", F.lit(True).alias("is_row"), "turn", "gone", "role", "text", "uid").unionByName(told)
              .repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "is_row", *_order()[1:])
              .select(id_text("conv_id").alias("conv_id"), "is_row", "gone", "role", "text"))
    hashes = stream.mapInPandas(_hashes, "conv_id string, repaired_sha256 string")
    return (results.drop("repaired_sha256").alias("r")
            .join(hashes.alias("h"), F.col("r.conv_id").eqNullSafe(F.col("h.conv_id")))
            .select("r.*", "h.repaired_sha256"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text [, gone]): the columns of ``RESULT``.

    Rows with ``gone`` only name their conversation. Order: turn (nulls first), then
    role, then text (by its first 32 characters, then its MD5). A null role or
    text counts as one space; a null conv_id is a conversation like any other. A role
    that starts with none of s, u, a (an empty one too) can't be kept. Repeated rows
    are duplicates, or blank if they have no text. ``gaps`` ends at the largest
    long. An empty table gives an empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    base = scratch_path(spark, f"repair-{uuid.uuid4().hex}")
    faults(rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       gone.alias("gone"), _or_space("role").alias("role"), _or_space("text").alias("text"))
           ).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    done = keep(_ordered(rows).mapInPandas(_whole, f"{RESULT}, cut boolean"))
    # a task marks two conversations at most
    cut = done.where("cut").select(F.col("conv_id").cast("long").alias("cut_id")).distinct()
    (rows.join(F.broadcast(cut), F.col("conv_id").eqNullSafe(F.col("cut_id")), "left_semi")
     .write.parquet(f"{base}/cut"))
    both = done.where("not cut").drop("cut").unionByName(_across_partitions(spark.read.parquet(f"{base}/cut")))
    return both.withColumn("conv_id", F.col("conv_id").cast("long"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """:func:`repair` of conversations after :func:`damaged`; every conversation has its row."""
    return repair(damaged(conversations))
