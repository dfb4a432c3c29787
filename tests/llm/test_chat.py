import hashlib
import random

import numpy as np

from tidemart.llm import chat
from tidemart.llm.queries import CONTROL, QUERIES


def expected(turns):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    whole, _ = chat.render([(r or "", t or "") for r, t in turns])
    return len(turns), digest(said), len(learned), digest(learned), len(whole)


def results(rows):
    return {r[0]: tuple(r)[1:] for r in chat.read_back(chat.formatted(rows)).collect()}


def test_escaping_round_trips():
    random.seed(3)
    for _ in range(3000):
        text = "".join(random.choice(["\\", "<|", "<", "|", ">", "<|end|>", "<|turn|>", "a", "é", "<\\|"]) for _ in range(random.randrange(8)))
        assert chat.unescaped(chat.escaped(text)) == text
        assert "<|" not in chat.escaped(text)
        turns = [("user", text), ("assistant", text), (text, "")]
        assert chat.parse(chat.render(turns)[0]) == turns


def test_mask_is_interval_intersection():
    random.seed(4)
    for _ in range(300):
        cuts = sorted(random.sample(range(60), 8))
        spans = list(zip(cuts[::2], cuts[1::2], strict=True))
        tokens = np.array([(a, a + random.randrange(4)) for a in sorted(random.choices(range(60), k=20))])
        want = [any(max(a, s) < min(b, e) for s, e in spans) for a, b in tokens]
        assert chat.loss_mask(tokens, spans).tolist() == want


def test_hand_made_conversations(shipped):
    nasty = ["<|end|>", "\\", "<|", "x<|text|>y\\", "😀 é ‍中", "  lead", "trail \n", "", None, CONTROL, "a" * 5000]
    rows = [(i, k, role, t) for i, t in enumerate(nasty) for k, role in enumerate(["system", "user", "assistant", "assistant", None, "<|turn|>"])]
    made = shipped.createDataFrame([r + (1, 2) for r in rows] + [(None, None, None, None, 1, 2)], "conv_id long, turn long, role string, text string, formatted int, ids int")
    got = results(made)
    for i, t in enumerate(nasty):
        assert got[i] == expected([(r[2], r[3]) for r in rows if r[0] == i]), t
    assert got[None] == expected([(None, None)])
    assert results(made.where("false")) == {}


def test_repeated_and_tied_turns(shipped):
    made = shipped.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "first")], "conv_id long, turn long, role string, text string")
    assert results(made)[1] == expected([("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")])


def test_given_conversations(shipped):
    from tests.conftest import TINY

    got = {r[0]: tuple(r)[1:] for r in QUERIES["op3_chat_formatting"](shipped, TINY).collect()}
    turns = {-7: [("user", CONTROL), ("assistant", CONTROL)]}
    for r in shipped.read.parquet(f"{TINY}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {k: expected(v) for k, v in turns.items()}
