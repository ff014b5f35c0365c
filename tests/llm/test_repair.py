import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from conftest import SF_MID
from dockhand.llm import queries, repair
from dockhand.llm.repair import cheapest_audit, damaged, repair_all

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def after(state, initial):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))


def plain_repair(rows, start=0, goals=(0, 3)):
    """(cost, audit, lines) by trying every edit at every row; rows are (role, text, fault)."""

    @lru_cache(None)
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in goals else []
        made = 3 if state == 2 else 2
        if inserted < 3:
            if (rest := best(i, made, inserted + 1)) is not None:
                ways.append((rest[0] + 2, "I" + rest[1], (("user" if made == 2 else "assistant") + ":", *rest[2])))
        if i < len(rows):
            role, text, fault = rows[i]
            if (rest := best(i + 1, state, 0)) is not None:
                ways.append((rest[0] + 3, "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                kept = after(state, role[:1])
                if kept is not None and (rest := best(i + 1, kept, 0)) is not None:
                    ways.append((rest[0] + extra, "K" + rest[1], (f"{role}:{text}", *rest[2])))
                if (rest := best(i + 1, made, 0)) is not None:
                    ways.append((rest[0] + 2 + extra, "R" + rest[1], (("user" if made == 2 else "assistant") + f":{text}", *rest[2])))
        return min(ways) if ways else None

    return best(0, start, 0)


def faults(rows):
    """(role, text, fault) of ordered (role, text) rows."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def mark(role, text):
    return hashlib.md5((f"{len(role.encode())}:{role}{text}").encode()).digest()


def plain_answer(conv, rows):
    """The contract's row of one conversation from its (turn, role, text) rows after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1].encode(), mark(*r[1:])))
    told = faults([r[1:] for r in rows])
    turns = {r[0] for r in rows if r[0] is not None}
    count = lambda f: sum(x[2] == f for x in told)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
    cost, audit, lines = plain_repair(tuple(told))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, count("blank"), count("duplicate"), count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def key(r):
    return (r[0] is not None, r[0])


def test_cheapest_audit_is_least_among_all():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), f"t{k}.", rng.choice(["", "", "", "truncated", "blank"])) for k in range(rng.randint(0, 7))]
        steps = []
        for role, _, fault in rows:
            if fault == "blank" and steps and steps[-1][0] == "D":
                steps[-1] = ("D", steps[-1][1] + 1)
            else:
                steps.append(("D", 1) if fault == "blank" else (role[:1] if role[:1] in "sua" else "?", int(fault == "truncated")))
        for start, goals in ((0, (0, 3)), (2, (3,)), (1, (2,)), (3, (3,))):
            plain = plain_repair(tuple(rows), start, goals)
            assert cheapest_audit(steps, start, goals) == plain[:2]
    assert cheapest_audit([], 2, (0,)) is None


def random_rows(rng, convs, most):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Fine.", "What?", "cut off", "", " \n", "done!", None, "x. \x0b"]
    out = []
    for c in [*range(convs), None]:
        for t in range(rng.randint(1, most)):
            turn = rng.choice([t, t, t, t + 1, None])
            text = rng.choice(texts) if rng.random() < 0.6 else f"reply {rng.randint(0, 30)}" + rng.choice([".", "", "?"])
            out.append((c, turn, rng.choice(roles), text))
    return out


@pytest.mark.parametrize("piece", [512, 3])
def test_repair_equals_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)  # 3: conversations are searched in pieces and chained
    rows = random_rows(random.Random(piece), 60, 12)
    rows += [(1000, t, ["user", "assistant"][t % 2], f"turn {t}" + "." * (t % 7 > 0)) for t in range(90)]
    rows += [(1001, t, "user", "again.") for t in range(40)] + [(1002, 5, "user", "same.")] * 30
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = repair_all(damaged(table), table)
    assert got.columns == COLUMNS
    wanted = [plain_answer(c, r) for c, r in plain_damage(rows).items()]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)


def test_query_over_the_fixture(spark):
    table = spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    wanted = [plain_answer(c, r) for c, r in plain_damage([tuple(r) for r in table]).items()]
    assert sorted(map(tuple, queries.op12_edit_lattice(spark, SF_MID).collect()), key=key) == sorted(wanted, key=key)


def test_awkward_tables(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "gone."), (None, None, None, None), (7, None, "user", "Long. " * 50_000)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cost", "'x' as audit", "2 as copies", "3 as mark", "4 as kind")
    got = {r["conv_id"]: r for r in repair_all(damaged(table), table).collect()}
    assert set(got) == {dropped, None, 7}
    assert tuple(got[dropped])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = table.where("false")
    assert repair_all(damaged(empty), empty).count() == 0
