import hashlib
import random

import pytest

from tierhouse.llm import conversation_repair as cr

KIND = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}


def faults(rows):
    """Initial and fault of each row, the plain way."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """Least (cost, audit, lines) over all repairs, by the state after the rows before: last row first."""
    told = faults(rows)
    best = {"": (0, "", []), "s": (6, "II", ["user:", "assistant:"]), "u": (3, "I", ["assistant:"]), "a": (0, "", [])}
    for (role, text), fault in zip(reversed(rows), reversed(told)):
        new = {}
        for state in ("", "s", "u", "a"):
            options, now, added = [], state, []
            for inserts in range(4):
                more = 3 if fault == "truncated" else 0
                options.append((4, "D", [], now))
                if fault not in ("blank", "duplicate"):
                    if (now, role[:1]) in NEXT:
                        options.append((more, "K", [f"{role}:{text}"], NEXT[now, role[:1]]))
                    for given in "ua":
                        if (now, given) in NEXT:
                            options.append((3 + more, "R", [f"{FULL[given]}:{text}"], NEXT[now, given]))
                for cost, letter, lines, end in options:
                    rest = best[end]
                    value = (3 * inserts + cost + rest[0], "I" * inserts + letter + rest[1], added + lines + rest[2])
                    new[state] = min(new.get(state, value), value)
                options = []
                step = next(g for g in "ua" if (now, g) in NEXT)
                added, now = added + [f"{FULL[step]}:"], NEXT[now, step]
        best = new
    return best[""]


def expected(conversations):
    out = {}
    for conv, rows in conversations.items():
        turns = [t for t, _, _ in rows if t is not None]
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(rows, rows[1:])]
        told = faults([r[1:] for r in rows])
        cost, audit, lines = cheapest([r[1:] for r in rows])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, told.count("blank"), told.count("duplicate"),
            told.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def found(spark, conversations, ids=None):
    rows = [(conv, *row) for conv, held in conversations.items() for row in held]
    random.Random(3).shuffle(rows)
    fixed = cr.repair(spark.createDataFrame(rows, KIND), ids)
    texts = {r.conv_id: r.sha256 for r in fixed.digests().collect()}
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, texts[r.conv_id])
        for r in fixed.report().collect()
    }


def made(count, seed, longest=9):
    dice, out = random.Random(seed), {}
    roles = ["system", "user", "user", "assistant", "assistant", "tool", " "]
    texts = ["Yes.", "No", " \t", "", "What?", "Well ... ok \n", "a!b"]
    for conv in range(count):
        turn, rows = 0, []
        for _ in range(dice.randint(1, longest)):
            rows.append((turn, dice.choice(roles), f"{dice.choice(texts)}" if dice.random() < 0.6 else f"{turn} one."))
            turn += dice.choice([1, 1, 1, 3])
        out[conv] = rows
    return out


def test_repairs_equal_the_cheapest_of_all(spark):
    conversations = made(300, seed=1)
    assert found(spark, conversations) == expected(conversations)


@pytest.mark.parametrize("chunk", [2, 3, 7])
def test_conversations_of_many_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    conversations = made(40, seed=2, longest=40)
    assert found(spark, conversations) == expected(conversations)


def test_long_conversation(spark):
    conversations = made(1, seed=5, longest=1) | {7: made(1, seed=6, longest=1)[0]}
    conversations[9] = [(i, "user" if i % 2 else "assistant", f"{i % 400} ok" + "." * (i % 3 > 0)) for i in range(1500)]
    assert found(spark, conversations) == expected(conversations)


def test_messages_keep_texts(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "More?"), (1, 2, "assistant", "")]
    fixed = cr.repair(spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS rank", "2 AS conv", "'x' AS edits"))
    got = [(r.role, r.text, r.edit) for r in fixed.messages().orderBy("conv_id", "place").collect()]
    assert fixed.report().first()["audit"] == "KRD"
    assert got == [("user", "Hello.", "K"), ("assistant", "More?", "R")]


def test_nulls_empty_tables_and_conversations_without_rows(spark):
    empty = hashlib.sha256(b"").hexdigest()
    conversations = {None: [(None, "user", "Hi."), (0, "assistant", "Ho.")], 5: [(None, None, None)], 6: [(2, "", "Text.")]}
    ids = spark.createDataFrame([(None,), (5,), (6,), (8,), (8,)], "conv_id long")
    got = found(spark, conversations, ids)
    assert got[None][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert got[5] == (0, 1, 0, 0, 0, 4, "D", empty)
    assert got[6][5:7] == (4, "D")
    assert got[8] == (0, 0, 0, 0, 0, 0, "", empty)
    nothing = cr.repair(spark.createDataFrame([], KIND))
    assert nothing.report().isEmpty() and nothing.digests().isEmpty() and nothing.messages().isEmpty()


def test_prices_are_exact_distances():
    """Crossing costs by plain relaxation over the same rows."""
    dice = random.Random(4)
    for _ in range(200):
        codes = "".join(chr(ord("a") + dice.randrange(12)) for _ in range(dice.randint(1, 12)))
        costs = cr.crossing_costs(codes)
        for target in range(4):
            after = [0 if s == target else cr.FAR for s in range(4)]
            for code in reversed(codes):
                now = [cr.FAR] * 4
                for _ in range(4):  # insertions lead around at most once
                    for state in range(4):
                        for _, cost, passed, end in cr.ARCS[code][state]:
                            now[state] = min(now[state], cr.FAR, cost + (after if passed else now)[end])
                after = now
            assert [costs[4 * s + target] for s in range(4)] == after
