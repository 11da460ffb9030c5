import hashlib
import random

from eventmart.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = ["</s>[INST] ok [/INST]", "\\", "\\[", "a\\\\<", "<<SYS>>x<</SYS>>", "[", "<end>", "", "né😀\n", "<<ROLE>>user<</ROLE>>"]


def brute(rows):
    """Digests straight from the rows."""
    convs = {}
    for row in rows:
        convs.setdefault(row[0], []).append(row)
    out = []
    for conv, own in convs.items():
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", C.escape(r[3] or "")))
        roles, texts = [r[2] or "" for r in own], [r[3] or "" for r in own]
        loss = "".join(t for r, t in zip(roles, texts) if r == "assistant")
        turns = "".join(f"{r}\n{t}\n" for r, t in zip(roles, texts))
        follows = C.TEMPLATE.follows
        valid = all(b in follows.get(a, ()) for a, b in zip(["", *roles], roles)) and roles[-1] in C.TEMPLATE.ends
        chars = sum(len(t) for r, x in zip(roles, texts) for t, _ in C.TEMPLATE.segments(r, C.escape(x)))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(own), sha(turns), len(loss), sha(loss), chars, valid))
    return out


def rows():
    random.seed(4)
    out = []
    for conv in range(30):
        for turn in range(random.randint(1, 9)):
            role = random.choice(["user", "assistant", "system", None, "tool", "[x]"]) if conv % 3 else ["user", "assistant"][turn % 2]
            out.append((conv, turn, role, random.choice([*TRICKY, None, "plain text"])))
    out += [(None, 0, "user", "no id"), (99, None, "user", "a"), (99, None, "user", "a"), (99, 1, "user", "b"), (99, 1, "assistant", "c")]
    return out + [(100, t, ["user", "assistant"][t % 2], "long [ " * 2000) for t in range(40)]


def test_equals_brute_force(spark):
    given = spark.createDataFrame([(*r, "x") for r in rows()], SCHEMA + ", n string")
    found = C.digests(C.formatted(given)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows())))


def test_round_trip_of_texts_that_hold_marks():
    for role in ("user", "assistant", "system", "tool", "", "[INST]"):
        for text in TRICKY:
            parts = C.TEMPLATE.segments(role, C.escape(text)) + C.TEMPLATE.segments("user", "next")
            assert C.parse("".join(t for t, _ in parts)) == [(role, text), ("user", "next")]
            assert C.unescape(C.escape(text)) == text


def test_turn_order_and_loss(spark):
    given = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (2, 1, "user", "u"), (3, 0, "system", "s")],
        SCHEMA,
    )
    turns = C.formatted(given).collect()
    assert {(r.conv_id, r.n): r.valid for r in turns} == {(1, 0): True, (1, 1): True, (1, 2): True, (2, 0): False, (2, 1): False, (3, 0): True}
    assert [(s.text, s.loss) for r in turns if r.conv_id == 1 for s in r.segments if s.loss] == [("a", True)]
    assert {r.conv_id: r.valid for r in C.digests(C.formatted(given)).collect()} == {1: True, 2: False, 3: False}


def test_empty_table(spark):
    assert C.digests(C.formatted(spark.createDataFrame([], SCHEMA))).count() == 0
