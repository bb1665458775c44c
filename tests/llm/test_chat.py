import random

from curbsight.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows):
    """By comparing the turns of every pair of conversations."""
    said = {}
    for conv, turn, role, text in rows:
        said.setdefault(conv, set()).add((turn is None, turn, role or "", text or ""))
    logs = {c: sorted(t, key=str) for c, t in said.items()}
    steps = {c: [sorted(x for x in t if x[:2] == k) for k in sorted({x[:2] for x in t}, key=lambda k: (k[0], k[1] or 0))] for c, t in logs.items()}
    number = lambda c: -1 if c is None else c
    result = {}
    for c, own in steps.items():
        same = [o for o in steps if steps[o] == own]
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in steps.values())
        if not longer and c == min(same, key=number):
            out = "".join(f"<|im_start|>{(r or 'unknown').strip().lower()}\n{t}<|im_end|>\n" for step in own for _, _, r, t in step)
            result[c] = (out, len(same), sum(map(len, own)))
    return result


def whole(found):
    texts = {}
    for r in sorted(found, key=lambda r: r.part):
        text, n = texts.get(r.conv_id, ("", 0))[0], texts.get(r.conv_id, ("", 0))[-1]
        texts[r.conv_id] = (text + r.text, r.copies, n + r.n_turns)
    return texts


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    monkeypatch.setattr(chat, "PART", 3)
    rng, rows = random.Random(5), []
    for conv in range(60):
        base = random.Random(conv % 7)
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, base.choice(["user", "Assistant ", None, ""]), base.choice(["hi", "ho", None, ""])))
    rows += rng.sample(rows, 20)
    assert whole(chat.render(frame(spark, rows)).collect()) == expected(rows)


def test_odd_rows(spark):
    long = "x" * 300_000
    rows = [(1, 0, "user", "a"), (1, None, "user", "last"), (2, 0, "user", "a"), (None, 0, "user", "a"), (3, 5, "user", long), (4, 5, "user", long), (4, 5, "tool", "same turn")]
    found = whole(chat.render(frame(spark, rows)).collect())
    assert found == expected(rows)
    assert set(found) == {1, 3, 4}
    assert chat.render(frame(spark, [])).collect() == []


def test_nothing_but_native_operators(spark):
    text = chat.render(frame(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "ExternalRDD" not in text
