"""Conversation repair against a plain version that tries every state for every row."""

import hashlib
import random
import zlib
from itertools import product

import duckdb
import pandas as pd
import pytest

from tillroll.llm import conversations
from tillroll.llm.queries import ORACLE, QUERIES
from tillroll.llm.tables import table

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fault == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def solve(rows):
    """(cost, audit, lines) by the best of every state after every row; rows: (role, text, kind)."""
    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                to = "a" if state == "u" else "u"
                role = {"u": "user", "a": "assistant"}[to]
                option = (cost + 5, audit + "I", [*lines, f"{role}:"])
                if to not in states or option < states[to]:
                    states[to] = option
        return states

    states = {"": (0, "", [])}
    for role, text, kind in rows:
        found = {}

        def offer(state, option):
            if state not in found or option < found[state]:
                found[state] = option

        for state, (cost, audit, lines) in inserted(states).items():
            offer(state, (cost + 2, audit + "D", lines))
            if kind not in ("blank", "duplicate"):
                extra = 5 if kind == "truncated" else 0
                due = "a" if state == "u" else "u"
                if role[:1] == due or role[:1] == "s" and state == "":
                    offer(role[:1], (cost + extra, audit + "K", [*lines, f"{role}:{text}"]))
                name = {"u": "user", "a": "assistant"}[due]
                offer(due, (cost + 1 + extra, audit + "R", [*lines, f"{name}:{text}"]))
        states = found
    states = inserted(states)
    return min(states[state] for state in ("", "a") if state in states)


def plain(given):
    conversations_, out = {row[0]: [] for row in given}, []
    for row in damage(given):
        conversations_[row[0]].append(row)
    for conv_id, rows in conversations_.items():
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in rows:
            core = text.rstrip(BLANK)
            kind = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            if kind:
                counts[kind] += 1
            seen.add((role, text))
            kinds.append((role, text, kind))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        turns = [r[1] for r in rows if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = solve(kinds)
        out.append((conv_id, gaps, *counts.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, out))


def test_search_equals_all_states_on_every_short_sequence():
    kinds = {None: conversations.NORMAL, "truncated": conversations.BROKEN, "blank": conversations.UNUSABLE}
    roles = [("user", None), ("assistant", None), ("system", None), ("tool", None), ("user", "truncated"),
             ("assistant", "truncated"), ("user", "blank")]
    for length in range(5):
        for rows in product(roles, repeat=length):
            found = conversations.repair([(role[0], kinds[kind]) for role, kind in rows])
            assert found == solve([(role, "x", kind) for role, kind in rows])[:2], rows


@pytest.mark.parametrize("segment", [1, 2, 7, 256])
def test_segments_do_not_change_the_repair(monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    chance = random.Random(segment)
    for _ in range(150):
        rows = [(chance.choice("uuuaaast"), chance.choice([0, 0, 0, 0, 1, 2])) for _ in range(chance.randrange(40))]
        names = [(role, "x", [None, "truncated", "blank"][kind]) for role, kind in rows]
        assert conversations.repair(rows) == solve(names)[:2], rows


def test_a_long_conversation_is_repaired_in_parts():
    chance = random.Random(5)
    rows = [(chance.choice("ua"), chance.choice([0, 0, 0, 1, 2])) for _ in range(20_000)]
    cost, letters = conversations.repair(rows)
    assert sum(letter != "I" for letter in letters) == len(rows)
    state, spent = "", 0
    at = iter(rows)
    for letter in letters:
        due = "a" if state == "u" else "u"
        if letter == "I":
            spent, state = spent + 5, due
            continue
        initial, kind = next(at)
        if letter == "D":
            spent += 2
            continue
        assert kind != 2 and (letter == "R" or initial == due)
        spent, state = spent + (letter == "R") + 5 * (kind == 1), due
    assert spent == cost and state == "a"


def awkward():
    chance, rows = random.Random(3), []
    texts = ["Hello.", "Yes!", "No", "", " \n", None, "Why?  ", "ok.\t\n", "x", "ß…"]
    for conv in [*range(60), None]:
        for _ in range(chance.randrange(1, 14)):
            rows.append((conv, chance.choice([None, *range(-1, 8)]), chance.choice(["user", "assistant", "system", "tool", None, ""]),
                         chance.choice(texts)))
    rows += [(900, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(1_000)]
    rows += [(901, 4, "user", "the same.")] * 700 + [(901, 5, "assistant", "the same.")] * 3
    rows += [(902, t, "user", "again and again") for t in range(300)]
    rows += [(903, None, "user", "long " * 50_000), (903, None, "assistant", "Fine.")]
    return rows


def test_awkward_rows_equal_the_plain_version(spark):
    rows = awkward()
    given = spark.createDataFrame([(*row, 1, "z") for row in rows], "conv_id long, turn int, role string, text string, kind int, letters string")
    found = conversations.repair_conversations(conversations.damaged(given.repartition(7)))
    kept = {row[0] for row in damage(rows)}
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(
        line for line, conv in zip(plain(rows), [eval(line)[0] for line in plain(rows)]) if conv in kept)


def test_text_ids_and_no_rows(spark):
    schema = "conv_id string, turn long, role string, text string"
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Ho."), ("a", 3, "user", "Hm.")]
    found = conversations.repair_conversations(conversations.damaged(spark.createDataFrame(rows, schema)))
    assert sorted(map(str, map(tuple, found.collect()))) == plain(rows)
    assert conversations.repair_conversations(conversations.damaged(spark.createDataFrame([], schema))).count() == 0
    with pytest.raises(ValueError, match="whole numbers"):
        conversations.repair_conversations(spark.createDataFrame(
            [("a", 1.5, "user", "Hi.", 1)], "conv_id string, turn double, role string, text string, times int"))


def test_query_equals_the_plain_version(spark):
    given = table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op12_conversation_repair"](spark, SF).collect()
    assert sorted(map(str, map(tuple, found))) == plain(list(map(tuple, given)))
    assert {row["audit"] for row in found} & {"", "KK"}


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_equals_its_sql(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    expected = connection.execute(ORACLE["op12_conversation_repair"]).fetchall()
    assert sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, folder).collect())) == sorted(expected)


def test_sql_of_awkward_rows_equals_the_plain_version():
    rows = pd.DataFrame([row for row in awkward() if row[0] is None or row[0] < 900], columns=["conv_id", "turn", "role", "text"], dtype=object)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [tuple(row) for row in rows.itertuples(index=False)])
    found = connection.execute(ORACLE["op12_conversation_repair"]).fetchall()
    assert sorted(map(str, found)) == plain([tuple(row) for row in rows.itertuples(index=False)])
