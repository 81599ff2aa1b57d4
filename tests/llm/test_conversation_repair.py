from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from conftest import SMALL
from llm_support import paths

from gaugemill.llm.conversation_repair import damaged, digests, repair_conversations
from gaugemill.llm.queries import QUERIES
from gaugemill.llm.turn_edits import edits_of

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("of_conv_id", T.DoubleType()),
    ]
)
ORDER = re.compile("(s?(ua)+)?")


def shortest(rows):
    """All cheapest edits by a search over audits, the least first: cost, audit and turns."""
    todo, best = [(0, "", 0, "")], {}
    while todo:  # by cost, then by audit
        todo.sort(key=lambda path: (path[0], path[1]))
        cost, audit, at, roles = todo.pop(0)
        # What may follow depends on the last role only, or on there being none.
        state = at, roles[-1:]
        if (at, state) in best and best[at, state] < (cost, audit):
            continue
        best[at, state] = cost, audit
        if at == len(rows) and ORDER.fullmatch(roles):
            return cost, audit
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[roles[-1:]]
        if at < len(rows):
            role, extra, gone = rows[at]
            todo.append((cost + 3, audit + "D", at + 1, roles))
            if not gone:
                if role[:1] and role[0] in follows:
                    todo.append((cost + extra, audit + "K", at + 1, roles + role[0]))
                for new in "ua":
                    if new in follows:
                        todo.append((cost + 2 + extra, audit + "R", at + 1, roles + new))
        todo += [(cost + 2, audit + "I", at, roles + new) for new in "ua" if new in follows]
    raise AssertionError


def brute(rows):
    """Audit of all edit sequences, by trying every one of them: for few turns."""
    found = []

    def go(at, cost, audit, roles, inserted):
        if at == len(rows):
            for extra in range(3):
                for tail in itertools.product("ua", repeat=extra):
                    if ORDER.fullmatch(roles + "".join(tail)):
                        found.append((cost + 2 * extra, audit + "I" * extra))
            return
        role, extra, gone = rows[at]
        go(at + 1, cost + 3, audit + "D", roles, 0)
        if not gone:
            if role[:1]:
                go(at + 1, cost + extra, audit + "K", roles + role[0], 0)
            for new in "ua":
                go(at + 1, cost + 2 + extra, audit + "R", roles + new, 0)
        if inserted < 2:
            for new in "ua":
                go(at, cost + 2, audit + "I", roles + new, inserted + 1)

    go(0, 0, "", "", 0)
    return min(found)


def code(role, extra, gone):
    from gaugemill.llm.turn_edits import code_of

    return code_of(role, bool(extra), gone)


def test_cheapest_least_audit_of_all():
    roles = ["system", "user", "assistant", "tool"]
    for size, tries in ((0, 1), (1, 12), (2, 60), (3, 60), (4, 12)):
        for seed in range(tries):
            rng = random.Random(f"{size} {seed}")
            rows = [(rng.choice(roles), rng.randrange(2), rng.random() < 0.3) for _ in range(size)]
            blocks, after, cost = edits_of([code(*row) for row in rows])
            assert (cost, "".join(blocks) + "I" * after) == brute(rows), rows


def test_long_conversations_equal_a_plain_search():
    for seed in range(150):
        rng = random.Random(seed)
        roles = ["system", "user", "assistant", "x", ""][: rng.randrange(2, 6)]
        rows = [
            (rng.choice(roles), rng.randrange(2), rng.random() < rng.choice((0.1, 0.6, 0.95)))
            for _ in range(rng.randrange(1, 24))
        ]
        blocks, after, cost = edits_of([code(*row) for row in rows])
        assert (cost, "".join(blocks) + "I" * after) == shortest(rows), rows


def expected(rows):
    """Damage, faults and repair of a list of conv_id, turn, role, text, by the contract."""
    conversations = {}
    for conv, turn, role, text in rows:
        kept = conversations.setdefault(conv, [])
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        role = "user" if fault == 4 else role
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    result = []
    for conv, kept in conversations.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(x[2])))
        seen, plain, counts = set(), [], dict(blank=0, duplicate=0, truncated=0, illegal=0)
        for _, role, text in kept:
            shown = re.sub("[\x20\x09-\x0d]", "", text)
            cut = bool(shown) and shown[-1] not in ".!?"
            gone = not shown or (role, text) in seen
            if not shown:
                counts["blank"] += 1
            elif gone:
                counts["duplicate"] += 1
            elif cut:
                counts["truncated"] += 1
            seen.add((role, text))
            plain.append((role, int(cut), gone))
        initials = [role[:1] for _, role, _ in kept]
        for pair in zip(initials, initials[1:]):
            counts["illegal"] += pair not in {("s", "u"), ("u", "a"), ("a", "u")}
        cost, audit = shortest(plain)
        numbers = {turn for turn, _, _ in kept if turn is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        lines, left, last = [], list(kept), ""
        for letter in audit:
            if letter == "D":
                left.pop(0)
                continue
            role, text = ("", "") if letter == "I" else left.pop(0)[1:]
            if letter != "K":
                role = "assistant" if last == "u" else "user"
            lines.append(f"{role}:{text}")
            last = role[0]
        result.append(
            (conv, gaps, *counts.values(), cost, audit, sha("\n".join(lines)))
        )
    return sorted(result, key=repr)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def odd_conversations(seed, count=30):
    rng = random.Random(seed)
    texts = ["yes.", "no!", "and then", "", " \n", None, "why?", "\x0b.\x0c ", "é … "]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for conv in [None, *range(count)]:
        for turn in range(rng.randrange(1, 14)):
            number = rng.choice([turn, turn, turn, turn + 5, None, 3])
            role = roles[turn % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = f"turn {turn}." if rng.random() < 0.5 else rng.choice(texts)
            rows += [(conv, number, role, text)] * rng.choice((1, 1, 1, 2))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 0.5) for row in rows], SCHEMA).repartition(3)


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


@pytest.mark.parametrize("limits", [{}, {"split_rows": 4, "step_turns": 3}, {"split_bytes": 40}])
def test_equals_the_contract(spark, tmp_path, limits):
    rows = odd_conversations(str(limits))
    repaired = repair_conversations(damaged(table(spark, rows)), paths(tmp_path), **limits)
    found = [tuple(row[name] for name in COLUMNS) for row in digests(repaired).collect()]
    assert sorted(found, key=repr) == expected(rows)
    assert (repaired.audits is None) == (not limits)


def test_one_conversation_of_many_equal_turns(spark, tmp_path):
    rows = [(1, i // 40, "user", "yes." if i % 3 else "no") for i in range(2400)]
    rows += [(2, i, "assistant", "same.") for i in range(50)]
    repaired = repair_conversations(damaged(table(spark, rows)), paths(tmp_path), 100, 10**9, 16)
    found = [tuple(row[name] for name in COLUMNS) for row in digests(repaired).collect()]
    assert sorted(found, key=repr) == expected(rows)


def test_turns_are_returned(spark, tmp_path):
    rows = [(5, 0, "user", "one."), (5, 1, "user", "two."), (6, 0, "system", "go")]
    repaired = repair_conversations(table(spark, rows), paths(tmp_path))
    turns = {row["conv_id"]: row["turns"] for row in repaired.whole.collect()}
    assert [tuple(turn) for turn in turns[5]] == [
        ("user", "one."),
        ("assistant", "two."),
    ]
    assert turns[6] == []


def test_no_rows(spark, tmp_path):
    repaired = repair_conversations(damaged(table(spark, [])), paths(tmp_path))
    assert digests(repaired).collect() == []


def test_whole_table(spark):
    rows = [
        tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet")
        .select("conv_id", "turn", "role", "text").collect()
    ]
    found = QUERIES["op12_conversation_repair"](spark, SMALL).select(*COLUMNS).collect()
    assert sorted((tuple(row) for row in found), key=repr) == expected(rows)
