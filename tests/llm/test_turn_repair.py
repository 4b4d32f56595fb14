import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest

from fairwake.llm.catalog import QUERIES
from fairwake.llm.turn_repair import Automaton, audits, damaged, repaired

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "conv_id bigint, turn bigint, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def text(value):
    return " " if value is None else str(value)


def after_damage(rows):
    """conversation -> rows (turn, role, text) in order."""
    out = {}
    for conv, turn, role, body in rows:
        kept = out.setdefault(conv, [])
        role, body = text(role), text(body)
        fate = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            body = ""
        if fate == 2:
            body = re.sub("[.!?]", "", body)
        if fate == 4:
            role = "user"
        kept += [(turn, role, body)] * (2 if fate == 3 else 1)
    for kept in out.values():
        content = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, content(r)))
    return out


def fault(row, earlier):
    body = re.sub(r"[\x20\x09-\x0D]", "", row[2])
    if not body:
        return "blank"
    if row[1:] in earlier:
        return "duplicate"
    return "" if body[-1] in ".!?" else "truncated"


def cheapest(rows, faults):
    """Cost, audit and repaired rows by search over (rows used, roles so far), cheapest and ASCII-least first."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        # what may follow depends on the last role and on whether there is one
        state = (at, roles[-1:], "u" in roles)
        if at == len(rows) and GOOD.fullmatch(roles):
            return cost, audit, out
        if (state, audit) in done or len(roles) > 2 * len(rows) + 4:
            continue
        done.add((state, audit))

        def go(more, edit, used, role=None, body=""):
            initials = roles + role[:1] if role is not None else roles
            if any(GOOD.fullmatch(initials + rest) for rest in ("", "a", "ua")):
                added = (f"{role}:{body}",) if role is not None else ()
                heapq.heappush(heap, (cost + more, audit + edit, at + used, initials, out + added))

        for role in ("user", "assistant"):
            go(2, "I", 0, role)
        if at < len(rows):
            go(3, "D", 1)
            if faults[at] not in ("blank", "duplicate"):
                extra = faults[at] == "truncated"
                if rows[at][1][:1] in ("s", "u", "a"):
                    go(extra, "K", 1, rows[at][1], rows[at][2])
                for role in ("user", "assistant"):
                    go(2 + extra, "R", 1, role, rows[at][2])
    raise AssertionError


def expected(rows):
    out = {}
    for conv, kept in after_damage(rows).items():
        faults, earlier = [], set()
        for row in kept:
            faults.append(fault(row, earlier))
            earlier.add(row[1:])
        cost, audit, lines = cheapest(kept, faults)
        turns = [r[0] for r in kept if r[0] is not None]
        pairs = zip(kept, kept[1:])
        counts = Counter(faults)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            counts["blank"],
            counts["duplicate"],
            counts["truncated"],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


def test_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_conversation_repair"](spark, FOLDER)) == expected(rows)


@pytest.fixture(scope="module")
def mixed():
    rng = random.Random(4)
    rows = []
    for conv in range(400):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "User", "auditor"][: rng.choice([3, 8])])
            body = rng.choice(["Yes.", "No", "  ", "", None, "é!\t\n", "What? ", "x"])
            number = rng.choice([turn, turn, turn, turn * 2, None, turn // 2])
            rows.append((rng.choice([conv, conv, conv, None]) if conv == 7 else conv, number, role, body))
    return rows


def test_against_search(spark, mixed):
    table = spark.createDataFrame(mixed, COLUMNS)
    assert found(repaired(damaged(table))) == expected(mixed)
    wide = table.withColumns({c: table["conv_id"] for c in ("content", "kind", "fate", "gone", "copy", "signature", "sha_id")})
    assert found(repaired(damaged(wide))) == expected(mixed)


def test_no_rows_left_and_empty_table(spark):
    key = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(key, 0, "user", "Hi.")], COLUMNS)
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(repaired(damaged(table))) == {key: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert repaired(damaged(table.where("false"))).count() == 0


def test_repeated_rows_and_a_very_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}." + "x" * (t % 50)) for t in range(6000)]
    rows += rows[:40] + [(2, 0, "user", "y" * 3_000_000), (2, 1, "assistant", "z.")]
    kept = after_damage(rows)
    out = found(repaired(damaged(spark.createDataFrame(rows, COLUMNS))))
    for conv, lines in kept.items():
        faults, earlier = [], set()
        for row in lines:
            faults.append(fault(row, earlier))
            earlier.add(row[1:])
        counts = Counter(faults)
        assert out[conv][1:4] == (counts["blank"], counts["duplicate"], counts["truncated"])
        audit = out[conv][6]
        assert len(audit) - audit.count("I") == len(lines)
        assert all(edit == "D" for edit, f in zip(audit.replace("I", ""), faults) if f in ("blank", "duplicate"))
        cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit)
        cost += sum(e != "D" and f == "truncated" for e, f in zip(audit.replace("I", ""), faults))
        assert out[conv][5] == cost


def test_each_suffix_is_made_once():
    rng = random.Random(9)
    signatures = {"".join(rng.choices("suaoSUAOx", k=rng.randint(0, 6))) for _ in range(3000)}
    automaton, alone = Automaton(), {}
    for letters in sorted(s[::-1] for s in signatures):
        alone[letters] = Automaton().audit(letters)
        assert automaton.audit(letters) == alone[letters]
    suffixes = {s[i:] for s in signatures for i in range(len(s))}
    assert automaton.made == len(suffixes)


def test_audits_of_one_table(spark):
    table = spark.createDataFrame([("su",), ("s",), ("",), ("xx",), ("uA",), ("uu",)], "signature string")
    got = {r["signature"]: (r["cost"], r["audit"]) for r in audits(table).collect()}
    assert got == {"su": (2, "KKI"), "s": (3, "D"), "": (0, ""), "xx": (6, "DD"), "uA": (1, "KK"), "uu": (2, "KR")}
