"""Conversations in windows: against the plain rules over lists, and on awkward rows."""

import hashlib
import re
from urllib.parse import quote_plus

import pytest

from shelfmark.llm import chat

ROWS = "conv_id long, turn long, role string, text string, block int, span string, start int, loss string"
SMALL = "/root/testdata/sf0.01"
TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 1, "l") for r in rows], ROWS).repartition(3)


def escape(text):
    text = text.replace("\\", "\\\\")
    text = re.sub("#(?=#)", r"#\\", text)
    return text.replace("</turn>", "<\\/turn>")


def plain_windows(turns, budget, history):
    """Windows of one conversation of fewer turns than a block, as (n_repeated, text, tokens)."""
    turns = sorted(turns)
    cost = [len(TOKEN.findall(text)) + chat.MARKERS for _, _, text in turns]
    end = [sum(cost[: i + 1]) for i in range(len(turns))]
    start = [e - c for e, c in zip(end, cost)]
    system = next((i for i, t in enumerate(turns) if t[1] == "system"), None)
    room = max(budget // 4, budget - history - (cost[system] if system is not None else 0))
    slots = {}
    for i in range(len(turns)):
        slots.setdefault((end[i] - 1) // room, []).append(i)
    spans = []
    for slot, members in sorted(slots.items()):
        first = members[0]
        if start[first] // room < slot and end[members[-1]] - start[first] > room:
            spans += [[first], members[1:]]
        else:
            spans.append(members)
    for own in filter(None, spans):
        begin = own[0]
        near = [i for i in range(begin) if turns[i][1] != "system" and start[i] >= start[begin] - history]
        shown = ([system] if system is not None and system < begin else []) + near[-chat.HISTORY_TURNS :]
        text = "".join(f"### {quote_plus(turns[i][1], safe='*-._')}: {escape(turns[i][2])}</turn>\n" for i in shown + own)
        yield len(shown), text, sum(cost[i] for i in shown + own)


def given(conversations):
    by: dict = {}
    for conv, turn, role, text in conversations:
        by.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return by


def talk(n, conv=1, system=True):
    rows = [(conv, 0, "system", "be kind")] if system else []
    for t in range(1, n):
        rows.append((conv, t, ("user", "assistant")[t % 2], " ".join(f"w{t}" for _ in range(t * 7 % 40))))
    return rows


AWKWARD = [
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (2, 2, None, "no role"),
    (3, None, "user", "no number"), (3, 0, "system", "late"), (3, 1, "assistant", "x"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "at all"),
    (4, 0, "user", "\\### Assistant: </turn> ok"), (4, 1, "assistant", "\\### Assistant: </turn> ok"),
    (5, 0, "a: b\n### c %", "####\\</turn>\n</turn"), (5, 1, "assistant", "ends in \\"), (5, 2, "assistant", "<</turn>\n\\"),
    (6, 0, "user", "long " * 30_000), (6, 1, "assistant", "\U0001f600 long " * 3_000), (6, 2, "user", "ä"),
    (7, 5, "assistant", "alone"), (7, -3, "user", "before"),
]


@pytest.mark.parametrize("budget,history", [(64, 16), (200, 50), (1024, 128)])
def test_windows_follow_the_rules(spark, budget, history):
    rows = talk(50) + talk(40, 8, False) + AWKWARD
    found: dict = {}
    for r in chat.windows(table(spark, rows), budget, history).orderBy("conv_id", "block", "span").collect():
        found.setdefault(r["conv_id"], []).append((r["n_repeated"], r["text"], r["tokens"]))
    for conv, turns in given(rows).items():
        if conv in (3, 7):  # their turns lie in two blocks
            assert len(found[conv]) == 2
            continue
        assert found[conv] == list(plain_windows(turns, budget, history)), conv


def test_read_back_gives_every_turn_once(spark):
    rows = talk(300) + AWKWARD
    formatted = chat.windows(table(spark, rows), 128, 32)
    back: dict = {}
    learned: dict = {}
    for r in chat.read_back(formatted).orderBy("conv_id", "block", "span").collect():
        back.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
        learned.setdefault(r["conv_id"], []).extend(r["learned"])
    for conv, turns in given(rows).items():
        turns.sort()
        assert back[conv] == [t[1:] for t in turns]
        assert learned.get(conv, []) == [t[2] for t in turns if t[1] == "assistant"]


def test_blocks_repeat_the_system_turn_and_history(spark):
    rows = chat.windows(table(spark, talk(200)), 128, 64).orderBy("block", "span").collect()
    assert {r["block"] for r in rows} == {0, 1, 2, 3}
    for r in rows[1:]:
        assert r["text"].startswith("### system: be kind</turn>\n")
        assert r["n_repeated"] > 1 or r["tokens"] > 64
    for before, r in zip(rows, rows[1:]):
        pieces, earlier = r["text"].split(chat.END), before["text"].split(chat.END)[:-1]
        history = pieces[1 : r["n_repeated"]]
        assert history == earlier[len(earlier) - len(history) :]
        head = sum(len(p) + len(chat.END) for p in pieces[: r["n_repeated"]])
        assert all(s["start"] >= head for s in r["loss"])
    # No window is over the budget but those of a single long turn.
    assert all(r["tokens"] <= 128 or len(r["text"].split(chat.END)) - 1 - r["n_repeated"] == 1 for r in rows)


def test_no_rows(spark):
    assert chat.read_back(chat.windows(table(spark, []))).collect() == []


def test_query_on_the_table(spark):
    found = {r["conv_id"]: r for r in chat.op13_chat(spark, SMALL).collect()}
    said = chat.conversations_and_one(spark, SMALL).collect()
    by = given([tuple(r) for r in said])
    assert set(found) == set(by)
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t[2] for t in turns if t[1] == "assistant")
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        r = found[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(learned))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(w[1]) for w in plain_windows(turns, chat.BUDGET, chat.HISTORY))


def test_native(spark):
    plan = chat.op13_chat(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions|CartesianProduct|NestedLoop", plan)
