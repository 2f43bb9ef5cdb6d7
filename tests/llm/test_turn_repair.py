import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pytest

from transitlens.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, audit string, c string, fp int, open int, n int"
sys.setrecursionlimit(20_000)
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, 1, 1) for r in rows], SCHEMA)


def brute_repair(rows):
    """All edit sequences by plain search, least (cost, audit)."""

    @lru_cache(None)
    def best(i, before, inserted):
        # before: what the accepted initials end with ('' at first, 's', 'u', 'a')
        out = []
        if i == len(rows):
            if before in ("", "a"):
                out.append((0, ""))
        else:
            fault, initial = rows[i]
            rest = best(i + 1, before, 0)
            if rest:
                out.append((4 + rest[0], "D" + rest[1]))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                for letter, cost, role in (("K", 0, initial), ("R", 3, "u"), ("R", 3, "a")):
                    if role and before + role in ("s", "u", "su", "ua", "au"):
                        rest = best(i + 1, role, 0)
                        if rest:
                            out.append((cost + extra + rest[0], letter + rest[1]))
        if inserted < 2:
            for role in "ua":
                if before + role in ("u", "su", "ua", "au"):
                    rest = best(i, role, inserted + 1)
                    if rest:
                        out.append((3 + rest[0], "I" + rest[1]))
        return min(out, default=None)

    return best(0, "", 0)


def damage(rows):
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            yield from [(c, t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def brute(rows, damaged=True):
    groups = defaultdict(list)
    for r in damage(rows) if damaged else rows:
        groups[r[0]].append(r[1:])
    out = []
    for c in {r[0] for r in rows}:
        mine = sorted(groups[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in mine:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last[-1] in ".!?" else "truncated")
            seen.add((role, text))
        n = Counter(faults)
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit = brute_repair([(f, r[1][:1]) for f, r in zip(faults, mine, strict=True)])
        repaired, at, initials = [], iter(mine), ""
        for edit in audit:
            row = next(at) if edit != "I" else (None, None, "")
            if edit != "D":
                role = row[1] if edit == "K" else "assistant" if initials[-1:] == "u" else "user"
                initials += role[:1]
                repaired.append(f"{role}:{row[2]}")
        assert GRAMMAR.match(initials)
        out.append((c, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return Counter(out)


def conversations(n, seed=1, most=9, roles=("user", "assistant", "assistant", "user", "system", "narrator", None, "")):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, most)):
            role = ("user", "assistant")[t % 2] if r.random() < 0.6 else r.choice(roles)
            text = r.choice(["Yes.", "No", "", " \t", None, f"text {r.randint(0, 3)}!", "long " * 50 + "end?"])
            rows.append((c, t if r.random() < 0.9 else r.choice([None, t + 3, 0]), role, text))
    r.shuffle(rows)
    return rows


def got(df):
    return Counter(map(tuple, df.select(tr.FIELDS).collect()))


@pytest.mark.parametrize("long,piece", [(20_000, 2048), (3, 2), (0, 1)])
def test_matches_brute_force(spark, long, piece):
    rows = conversations(120) + [(None, 0, "user", "Hm."), (None, None, "assistant", "Oh."), (None, None, "assistant", "Oh.")]
    assert got(tr.repaired(frame(spark, rows).repartition(5), long=long, piece=piece)) == brute(rows)


def test_one_conversation_with_most_rows(spark):
    r = random.Random(3)
    hot = [(7, t, r.choice(["user", "assistant"]), r.choice(["Same text.", f"text {t}.", f"text {t}", ""])) for t in range(700)]
    rows = hot + conversations(30, seed=5)
    assert got(tr.repaired(frame(spark, rows), piece=50)) == brute(rows)


def test_rows_as_they_are_and_a_conversation_that_loses_all(spark):
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(lost, 0, "user", "Gone."), (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (2, 0, "assistant", "Hello")]
    c = frame(spark, rows)
    plain = {r["conv_id"]: r for r in tr.repaired(c, tr.plain_rows(c)).collect()}
    assert (plain[1]["cost"], plain[1]["audit"], plain[1]["illegal"]) == (0, "KKK", 0)
    assert (plain[2]["cost"], plain[2]["audit"]) == (4, "D")
    assert plain[2]["truncated"] == 1 and plain[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    empty = [r for r in tr.repaired(c).collect() if r["conv_id"] == lost][0]
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table_and_long_text(spark):
    assert tr.repaired(frame(spark, [])).count() == 0
    rows = [(1, 0, "user", "word " * 200_000 + "."), (1, 1, "assistant", " " * 300_000)]
    assert got(tr.repaired(frame(spark, rows))) == brute(rows)


def test_least_audit_equals_search_over_all_edits():
    r = random.Random(6)
    for _ in range(400):
        rows = [(r.choice(["", "", "blank", "duplicate", "truncated"]), r.choice(["u", "a", "s", "n", " ", ""])) for _ in range(r.randint(0, 9))]
        assert tr.repair(rows) == brute_repair(tuple(rows)), rows


def test_equal_stacks_are_one_node():
    stacks = tr.all_stacks()
    assert sorted(s[0] for s in stacks) == [0, 1, 2, 3, 4, 6]

    def after(symbols, stack=tr.START):
        for x in symbols:
            stack = tr.shift(stack, x)
        return stack

    assert after("ua") == after("uaua") == after("sua")
    assert tr.shift(tr.START, "a") is None


def test_repaired_turns_follow_the_grammar(spark):
    rows = conversations(40, seed=9)
    c = frame(spark, rows)
    repairs = tr.Repairs(tr.damaged(c), long=4, piece=2)
    by = defaultdict(list)
    for r in repairs.turns().collect():
        by[r["conv_id"]].append((r["place"], r["role"], r["text"], r["edit"]))
    for r in repairs.summary.collect():
        turns = sorted(by[r["conv_id"]])
        assert [t[0] for t in turns] == list(range(len(turns)))
        assert GRAMMAR.match("".join(t[1][:1] for t in turns))
        assert "".join(t[3] for t in turns) == r["audit"].replace("D", "")
        assert hashlib.sha256("\n".join(f"{t[1]}:{t[2]}" for t in turns).encode()).hexdigest() == r["repaired_sha256"]
