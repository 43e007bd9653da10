"""Interval parsing against every edit sequence; both paths against rows by hand; SQL."""

import hashlib
import itertools
import random
import re
import zlib

import __spark_entry__ as E
import duckdb
import pytest
from martstar.llm import conversation_repair as C
from scripts.oracle_check import digest

GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, costs int, part int, gone boolean, uid string, cut string"


def every_repair(rows):
    """The least (cost, audit) of all edit sequences with at most two insertions a gap, and its turns."""
    best = None
    per_row = [[("D", 2, None)] if f in (C.BLANK, C.DUPLICATE) else
               [("D", 2, None), ("K", 5 * (f == C.CUT), role)] + [("R", 1 + 5 * (f == C.CUT), r) for r in ("user", "assistant")]
               for f, role in rows]
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for edits in itertools.product(*per_row):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[1] for e in edits) + 5 * sum(map(len, ins))
            if best and cost > best[0]:
                continue
            turns, audit = [], ""
            for i, g in enumerate(ins):
                turns += [(r, None) for r in g]
                audit += "I" * len(g)
                if i < len(edits):
                    audit += edits[i][0]
                    turns += [(edits[i][2], i)] * (edits[i][0] != "D")
            if any(r[:1] not in "sua" or not r for r, _ in turns) or not GOOD.fullmatch("".join(r[0] for r, _ in turns)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, turns)
    return best


def test_cells_hold_the_least_of_all_repairs():
    r = random.Random(5)
    cases = [[]] + [[(f, role)] for f in range(4) for role in ("system", "user", "assistant", "tool", "", " ")]
    cases += [[(r.choice([0, 0, 0, 1, 2, 3]), r.choice(["system", "user", "assistant", "tool"])) for _ in range(n)]
              for n in (2, 3) for _ in range(25)]
    for rows in cases:
        cost, audit = C.root(C.parse([C.leaf(f, role) for f, role in rows]))
        want = every_repair(rows)
        assert (cost, audit) == want[:2], rows
        walk = C.Walk(audit)
        for i, (_, role) in enumerate(rows):
            walk.row(role, f"t{i}")
        lines = "\n".join(f"{role}:{'' if i is None else f't{i}'}" for role, i in want[2])
        assert walk.end() == hashlib.sha256(lines.encode()).hexdigest(), rows


def test_any_split_gives_the_same_cell():
    r = random.Random(6)
    leaves = [C.leaf(r.choice([0, 0, 1, 2, 3]), r.choice(["system", "user", "assistant"])) for _ in range(40)]
    one_by_one = C.NOTHING
    for x in leaves:
        one_by_one = C.join(one_by_one, x)
    at = [C.join(C.parse(leaves[:k]), C.parse(leaves[k:])) for k in (0, 1, 7, 39, 40)]
    assert all(c == one_by_one for c in [C.parse(leaves), *at])


def by_hand(conversations, damage=True):
    """Results by a walk over the rows with a table of the four states (no spans)."""
    convs = {}
    for conv, turn, role, text in conversations:
        rows = convs.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damage else 9
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rows:
            core = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append(C.BLANK if not core else C.DUPLICATE if (role, text) in seen
                          else C.CUT if core[-1] not in ".!?" else C.SOUND)
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        best = {0: (0, "", ())}
        for (_, role, text), fault in [*zip(rows, faults), (("", "", ""), None)]:
            nxt, more = {}, 5 * (fault == C.CUT)
            for p0, (cost, audit, lines) in best.items():
                for p, ins in {0: [(0, ()), (2, ("user:",)), (3, ("user:", "assistant:"))], 1: [(1, ()), (2, ("user:",)), (3, ("user:", "assistant:"))],
                               2: [(2, ()), (3, ("assistant:",))], 3: [(3, ()), (2, ("user:",))]}[p0]:
                    due = "assistant" if p == 2 else "user"
                    to = 3 if p == 2 else 2
                    options = [(p, 0, "", ())] if fault is None else [(p, 2, "D", ())]
                    if fault in (C.SOUND, C.CUT):
                        options.append((to, 1 + more, "R", (f"{due}:{text}",)))
                        if role[:1] == due[0] or p == 0 and role[:1] == "s":
                            options.append((1 if role[:1] == "s" else to, more, "K", (f"{role}:{text}",)))
                    for q, c, letter, line in options:
                        x = (cost + 5 * len(ins) + c, audit + "I" * len(ins) + letter, lines + ins + line)
                        nxt[q] = min(nxt.get(q, x), x)
            best = nxt
        cost, audit, lines = min(best[q] for q in (0, 3) if q in best)
        n = [faults.count(k) for k in (C.BLANK, C.DUPLICATE, C.CUT)]
        out.append((conv, gaps, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def some(seed, n_convs, hot=0):
    r = random.Random(seed)
    texts = ["Well.", "Why?", "no end", "", " \t", "Again!", None, "Ünï cödé.", "x" * 40 + "a.", "x" * 40 + "b."]
    rows = []
    for c in range(n_convs):
        for t in range(r.randint(0, 7)):
            rows.append((c, r.choice([t, t, t, t + 1, None]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), r.choice(texts)))
    rows += [(77_000, t, r.choice(["user", "assistant"]), r.choice([f"own {t}.", "Well."])) for t in range(hot)]
    rows += [(None, 1, "user", "null id."), (None, 2, "assistant", "yes."), (5, -(2**63), "user", "far."), (5, 2**63 - 1, "user", "far away.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, None, "u", "c") for r in rows], SCHEMA)


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_conversations_by_hand_across_partition_borders(spark, parts):
    rows = some(parts, 120, hot=600)
    df = frame(spark, rows).drop("gone").repartition(3)
    before, aqe = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted((tuple(r) for r in C.repair_damaged(df).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    want = by_hand(rows)
    assert [g[:1] + (min(g[1], 2**63 - 1),) + g[2:] for g in got] == [w[:1] + (min(w[1], 2**63 - 1),) + w[2:] for w in want]


def test_rows_without_damage_and_marks(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "user", None), (3, 0, "user", "x")]
    got = sorted((tuple(r) for r in C.repair(frame(spark, rows).drop("gone")).collect()), key=str)
    assert got == by_hand(rows, damage=False)
    gone = frame(spark, rows).withColumn("gone", C.F.lit(True))
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in C.repair(gone).collect()} == {(c, 0, 0, 0, 0, 0, 0, "", empty) for c in (1, 2, 3)}


def test_a_long_conversation_and_a_long_text(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(9000)]
    rows += [(2, 0, "user", "long " * 400_000 + "."), (2, 1, "assistant", "short.")]
    df = frame(spark, rows).drop("gone")
    assert sorted((tuple(r) for r in C.repair(df).collect()), key=str) == by_hand(rows, damage=False)


def test_empty(spark):
    assert C.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_sql(spark):
    d = "/root/testdata/sf0.001"
    rows = E.queries()["op13_conversation_repair"](spark, d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet')")
    cur = con.execute(E.oracle_sql()["op13_conversation_repair"])
    cols = [c[0] for c in cur.description]
    assert digest(rows.columns, [tuple(r) for r in rows.collect()])[0] == digest(cols, cur.fetchall())[0]
