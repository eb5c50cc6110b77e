import functools
import hashlib
import random
import re

from vellum.llm import chat_repair as cr
from vellum.llm.queries import damaged

TURNS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """Digests of one conversation's (turn, role, text) rows, by a search from the end."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        last = [c for c in text if WORD.match(c)][-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        nxt = "a" if state == "u" else "u"
        role = "assistant" if nxt == "a" else "user"
        if inserted < 3:
            c, e, out = best(i, nxt, inserted + 1)
            found.append((c + 3, "I" + e, (f"{role}:",) + out))
        if i < len(rows):
            extra = 3 if faults[i] == "truncated" else 0
            c, e, out = best(i + 1, state, 0)
            found.append((c + 4, "D" + e, out))
            if faults[i] not in ("blank", "duplicate"):
                to = go[state].get(rows[i][1][:1])
                if to:
                    c, e, out = best(i + 1, to, 0)
                    found.append((c + extra, "K" + e, (f"{rows[i][1]}:{rows[i][2]}",) + out))
                c, e, out = best(i + 1, nxt, 0)
                found.append((c + 3 + extra, "R" + e, (f"{role}:{rows[i][2]}",) + out))
        return min(found) if found else (10 ** 9, "", ())

    cost, audit, out = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def repaired(spark, rows):
    got = cr.digests(cr.repair(spark.createDataFrame(rows, TURNS))).collect()
    return {r.conv_id: tuple(r)[1:-1] for r in got}


def test_repair_equals_search_from_the_end(spark):
    rng = random.Random(3)
    rows, want = [], {}
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "u", "agent"]
    texts = ["Yes.", "No!", "why?\n", "cut", "", " \t", None, "a.b", "é …", "ok.  "]
    for conv in [None, *range(250)]:
        own = [(rng.choice([None, *range(8)]) if rng.random() < 0.2 else i, rng.choice(roles),
                rng.choice(texts) if rng.random() < 0.6 else f"said {i}.") for i in range(rng.randint(1, 9))]
        rows += [(conv, *r) for r in own]
        want[conv] = brute(own)
    assert repaired(spark, rows) == want


def test_runs_of_unknown_roles_and_long_conversations(spark):
    tools = [(i, "tool", f"t{i}." if i % 7 else f"cut {i}") for i in range(90)]
    mixed = [(i, ["user", "assistant", "system", "user", "tool"][(i * i) % 5], f"x {i}.") for i in range(120)]
    got = repaired(spark, [(1, *r) for r in tools] + [(2, *r) for r in mixed])
    assert got == {1: brute(tools), 2: brute(mixed)}
    long = [(5, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(20_000)]
    gaps, blank, duplicate, truncated, illegal, cost, audit, sha = repaired(spark, long)[5]
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0,) * 6 and audit == "K" * 20_000
    assert sha == hashlib.sha256("\n".join(f"{r}:{x}" for _, _, r, x in long).encode()).hexdigest()


def test_open_stretch_stays_short_and_ties_take_the_least_string():
    tree, out, longest = cr.Survivors(), [], 0
    for i in range(5000):
        role = ("user", "assistant")[i % 2] if i % 11 else "user"
        out += tree.push((1, i, role, "x.", ""), role[0], i % 13 == 0, i % 17 == 0)
        longest = max(longest, max(b[1].depth for b in tree.best if b) - tree.root.depth)
    assert longest < 60
    out += tree.finish()
    assert len([n for n in out if n.edit != "I"]) == 5000
    # a run that may be read in either phase stays open until the end decides
    tree = cr.Survivors()
    for i in range(4001):
        assert tree.push((1, i, "tool", "x.", ""), "t", False, False) == [] or i < 3
    audit = "".join(n.edit for n in tree.finish())
    assert len(audit.replace("I", "")) == 4001 and audit == min(audit, "R" * 4001 + "I")


def test_damage_edges_and_empty_table(spark):
    rows = [(None, None, None, None), (1, 0, "user", None), (1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS edit", "'y' AS later", "'z' AS first")
    assert {r.conv_id for r in cr.digests(cr.repair(frame)).collect()} == {None, 1}
    assert cr.digests(cr.repair(spark.createDataFrame([], TURNS))).count() == 0
    assert damaged(spark.createDataFrame([], TURNS)).columns == ["conv_id", "turn", "role", "text"]
    # edits are rows of their own: what is kept, given a new role, deleted or inserted
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", " "), (1, 2, "user", "Cut"), (1, 3, "user", "End.")]
    edits = cr.repair(spark.createDataFrame(rows, TURNS)).collect()
    assert [(e.step, e.edit, e.turn, e.was_role, e.role, e.text, e.fault, e.cost) for e in edits] == [
        (0, "K", 0, "user", "user", "Hi.", "", 0), (1, "D", 1, "user", None, " ", "blank", 4),
        (2, "D", 2, "user", None, "Cut", "truncated", 4), (3, "R", 3, "user", "assistant", "End.", "", 3)]
    alone = cr.repair(spark.createDataFrame(rows[:1], TURNS)).collect()
    assert [(e.edit, e.turn, e.role, e.text) for e in alone] == [("K", 0, "user", "Hi."), ("I", None, "assistant", "")]
