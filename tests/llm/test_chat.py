import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trafficlake.llm import chat
from trafficlake.llm.frames import read
from trafficlake.llm.queries import HOSTILE, op2_chat_formatting

SCHEMA = "conv_id long, seq long, turn long, kind string, role string, text string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "\n", "<", "s>", "/", "[", "a", "é😀", "\\<"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a\nb", "<s>", "\\"]), st.lists(st.sampled_from(PIECES), max_size=9).map("".join)), max_size=5))
def test_round_trip_of_hostile_texts(turns):
    formatted, loss = chat.render(turns)
    assert chat.parse(formatted) == turns
    assert chat.under_loss(formatted, loss) == "".join(t for r, t in turns if r == "assistant")
    for _, text in turns:
        assert not any(c in chat.escape(text) for c in PIECES[:6])
    assert formatted.count("</s>") == len(turns)


def brute(events):
    """Fold one event after the other."""
    state = {}
    for e in sorted(set(events), key=lambda e: (e[1] is not None, e[1] or 0, e[3] or "", e[5] or "")):
        conv, _, turn, kind, role, text = e
        turns = state.setdefault(conv, {})
        if kind == "delete":
            turns[turn] = None
        elif kind in ("start", "edit", "regenerate", "delta"):
            now = turns.get(turn)
            if kind == "start":
                turns[turn] = [role, ""]
            elif turn not in turns or now is not None:
                now = now or ["", ""]
                turns[turn] = [now[0], {"edit": text or "", "regenerate": "", "delta": now[1] + (text or "")}[kind]]
    return {c: [tuple(m) for _, m in sorted(t.items()) if m] for c, t in state.items() if any(t.values())}


def test_fold_like_replay(spark):
    draw = random.Random(8)
    events = []
    for conv in range(12):
        for turn in range(3):
            seq = draw.randrange(3) * 1000
            events.append((conv, seq, turn, "start", draw.choice(["user", "assistant"]), None))
            for k in range(draw.randrange(0, 8)):
                kind = draw.choice(["delta", "delta", "delta", "edit", "regenerate", "delete", "odd"])
                events.append((conv, seq + k + 1, turn, kind, None, draw.choice(["x", "yz", "", None])))
    events += draw.sample(events, 30)
    df = spark.createDataFrame(events, SCHEMA).repartition(5)
    # whatever follows a deletion belongs to a message that is not there
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.fold(df).collect()}
    assert got == brute(events)


def test_edge_rows(spark):
    rows = [(None, None, None, "start", None, None), (1, 1, 0, "delta", "user", "a"), (1, 1, 0, "delta", "user", "a"), (2, 1, 0, None, "user", "a"),
            (3, 1, 0, "start", "user", None), (3, 2, 0, "delta", None, "z" * 500_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit(1)).withColumn("conv", F.lit("c"))
    got = {r.conv_id: (r.formatted, [tuple(s) for s in r.loss]) for r in chat.format_log(df).collect()}
    assert got[None] == ("<s>\n</s>", []) and got[1] == ("<s>\na</s>", []) and 2 not in got
    assert len(got[3][0]) == 500_000 + len("<s>user\n</s>")
    assert chat.format_log(df.limit(0)).count() == 0


def test_query_like_given_conversations(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = {-1: [("user", HOSTILE), ("assistant", HOSTILE)]}
    for r in sorted(read(spark, sf_dir, "conversations").collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.conv_id: r for r in op2_chat_formatting(spark, sf_dir).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        learnt = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{t}\n" for a, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), sha(learnt))
        assert r.formatted_chars == len(chat.render(turns)[0])


def test_one_conversation_and_one_message_with_very_many_rows(spark):
    hot = [(1, k, 0, "delta", "user", f"{k} ") for k in range(3000)] + [(1, 1500, 0, "regenerate", None, None)]
    hot += [(2, 0, k, "start", "assistant", None) for k in range(2000)] + [(2, 1, k, "delta", None, f"<s>{k}") for k in range(2000)]
    got = {r.conv_id: r.x for r in chat.fold(spark.createDataFrame(hot, SCHEMA).repartition(7)).select("conv_id", chat.checked(F.col("turns")).alias("x")).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    # equal seq: ordered by kind, so the delta of the regeneration's seq comes before it
    assert got[1].turns_sha256 == sha("\n" + "".join(f"{k} " for k in range(1501, 3000)) + "\n")
    assert (got[2].n_turns, got[2].turns_sha256) == (2000, sha("".join(f"assistant\n<s>{k}\n" for k in range(2000))))
    assert got[2].loss_sha256 == sha("".join(f"<s>{k}" for k in range(2000)))
