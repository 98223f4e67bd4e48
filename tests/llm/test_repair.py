import functools
import hashlib
import random
import re
import zlib

import pytest

from salesguard.llm import queries, repair

KIND = "conv_id long, turn long, role string, text string"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
PUT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}
LAST = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for r, x in rows:
        marks = LAST.findall(x)
        out.append("blank" if not marks else "duplicate" if (r, x) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def cheapest(rows):
    """Least (cost, audit) and the repaired turns, by trying every edit at every place."""
    bad = faults(rows)

    after = None
    for i in range(len(rows), -1, -1):
        here = {}
        for put in (3, 2, 1, 0):                           # turns put in here so far
            for state in ("", "s", "u", "a"):
                ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
                if put < 3:
                    c, a, t = here[PUT[state], put + 1]
                    ways.append((c + 2, "I" + a, ((NAME[PUT[state]], ""), t)))
                if i < len(rows):
                    role, text = rows[i]
                    c, a, t = after[state, 0]
                    ways.append((c + 3, "D" + a, t))
                    if bad[i] in ("", "truncated"):
                        late = bad[i] == "truncated"
                        c, a, t = after[PUT[state], 0]
                        ways.append((c + 2 + late, "R" + a, ((NAME[PUT[state]], text), t)))
                        if (state, role[:1]) in AFTER:
                            c, a, t = after[AFTER[state, role[:1]], 0]
                            ways.append((c + late, "K" + a, ((role, text), t)))
                here[state, put] = min(ways, key=lambda w: w[:2], default=(10 ** 9, "", ()))
        after = here
    cost, audit, rest = after["", 0]
    kept = []
    while rest:
        kept.append(rest[0])
        rest = rest[1]
    return cost, audit, kept


def plain(conv, rows):
    """The report of rows (turn, role, text) in order."""
    bad = faults([r[1:] for r in rows])
    turns = sorted({r[0] for r in rows if r[0] is not None})
    cost, audit, kept = cheapest([r[1:] for r in rows]) if rows else (0, "", ())
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (conv, turns[-1] - turns[0] + 1 - len(turns) if turns else 0, *(bad.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def expected(rows, damaged=True):
    convs = {}
    for c, t, r, x in rows:
        keep = convs.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damaged else 9
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            keep += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return {plain(c, in_order(v)) for c, v in convs.items()}


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def made(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t + (rng.random() < 0.1), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         rng.choice([f"Say {t}.", f"Say {t}", "Again!", "", " \n", None, "Why? ", "é"])))
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=[False, True])
def chunked(request, spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    if request.param:
        spark.conf.set("spark.sql.shuffle.partitions", 13)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_solver_against_every_edit():
    rng = random.Random(2)
    solver = repair.Solver()
    for _ in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool", "user"]), rng.choice(["A.", "B.", f"{k}.", f"{k}", "x", ""]))
                for k in range(rng.randrange(0, 9))]
        part = repair.Fragment()
        for k, ((role, text), bad) in enumerate(zip(rows, faults(rows))):
            initial = repair.INITIALS.find(role[0])
            part.add(initial if initial >= 0 else repair.OTHER, k, 1, bad == "blank", text[-1:] not in ".!?", bad == "duplicate")
        runs = list(zip(part.symbols, part.sizes))
        due, audits, states = solver.solve(runs, repair.END, range(1))
        cost, audit, _ = cheapest(rows)
        assert (due[0], audits[0] + repair.ENDING[states[0]]) == (cost, audit), rows


def test_long_runs_by_powers():
    solver = repair.Solver()
    for symbol in range(12):
        for n in (1, 2, 3, 63, 64, 65, 1000):
            end = repair.END
            for _ in range(n):
                end = repair._back(symbol, 1, end)
            due, audits, _ = solver.solve([(symbol, n)], repair.END, range(4))
            assert due == end and all(sum(x != "I" for x in a) == n for a in audits)
            assert repair.run_matrix(symbol, n) == functools.reduce(repair.times, [repair.power(symbol, 0)] * n)


def test_damaged_conversations(spark, chunked):
    rows = made(1, 120, 8)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    assert got(repair.repaired_report(df, repair.damage(df), "n")) == expected(rows)


def test_long_conversations_and_copies(spark, chunked):
    rows = [(7, t, "user" if t % 3 else "assistant", f"Line {t % 40}" + "." * (t % 5 > 0)) for t in range(400)]
    rows += [(8, 0, "user", "the same.")] * 200 + [(8, t, "assistant", "the same.") for t in range(1, 90)]
    rows += [(None, 0, "user", "Nobody's."), (None, None, "assistant", "Nobody's."), (9, None, None, None), (9, None, "user", "A."),
             (9, None, "user", "B."), (6, 3, "system", "Be kind.")]
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], KIND + ", n int, chunk string")
    assert got(repair.repaired_report(df, df)) == expected(rows, damaged=False)
    assert got(repair.repaired_report(df, repair.damage(df), "n")) == expected(rows)


def test_repaired_turns(spark, chunked):
    rows = made(4, 60, 9)
    df = spark.createDataFrame(rows, KIND).repartition(3)
    report, repaired = repair.repair(df)
    turns = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.chunk, r.at)):
        turns.setdefault(r.conv_id, []).append(r)
    for r in report.collect():
        mine = turns.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in mine))
        assert "".join(t.edit for t in mine) == r.audit.replace("D", "")
        assert all(t.turn is None and t.text == "" for t in mine if t.edit == "I")


def test_empty_and_all_dropped(spark):
    empty = spark.createDataFrame([], KIND)
    report, repaired = repair.repair(empty)
    assert report.collect() == repaired.collect() == repair.repaired_report(empty, empty).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "x")], KIND)
    assert got(repair.repaired_report(df, empty)) == {(1, 0, 0, 0, 0, 0, 0, "", repair.NOTHING)}


def test_registered_query(spark):
    found = queries.QUERIES["op11_structure_repair"](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(found) == expected(rows)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 7 + ["string"] * 2
