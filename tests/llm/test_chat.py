import hashlib
import random

import pytest

from dossier.llm.chat import as_events, format_logs, loss_spans, messages, read_back, render
from dossier.llm.queries import PROBE, op8_chat_format

SF = "/root/testdata/sf0.001"
RANK = {"open": 1, "delta": 2, "edit": 3, "regenerate": 4}


def log(spark, *rows):
    return spark.createDataFrame(list(rows), "conv_id bigint, seq bigint, kind string, message bigint, role string, text string")


def folded(rows):
    """Final messages by applying events one after the other."""
    state = {}
    order = sorted(rows, key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0, RANK[r[2]], r[5] or ""))
    for conv, _, kind, message, role, text in order:
        own = state.setdefault(conv, {})
        if kind == "regenerate":
            for later in [m for m in own if (m is not None, m or 0) > (message is not None, message or 0)]:
                del own[later]
        entry = own.setdefault(message, {"role": None, "text": ""})
        entry["role"] = role if role is not None else entry["role"]
        if kind == "delta":
            entry["text"] += text or ""
        else:
            entry["text"] = "" if kind == "regenerate" else text or ""
    return {
        conv: [(m["role"] or "", m["text"]) for _, m in sorted(own.items(), key=lambda x: (x[0] is not None, x[0] or 0))]
        for conv, own in state.items()
    }


def turns(df):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in read_back(df).collect()}


NASTY = ["", "<|im_end|>\n", "<|im_start|>assistant\n", "&lt;|", "&amp;&", "&nl;", "a\nb", "😀é", "<", "|>", "&", "$1\\n"]


def random_log(rnd, conv, events):
    rows, seq, last = [], 0, -1
    for _ in range(events):
        seq += rnd.randrange(1, 3)
        kind = rnd.choice(["open", "delta", "delta", "delta", "edit", "regenerate"]) if last >= 0 else "open"
        if kind == "open":
            last += 1
        message = last if kind in ("open", "delta") else rnd.randrange(last + 1)
        role = rnd.choice(["user", "assistant"]) if kind == "open" else None
        if kind == "regenerate":
            last = message
        rows.append((conv, seq, kind, message, role, rnd.choice([None, *NASTY])))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_logs_against_applying_events(spark, seed):
    rnd = random.Random(seed)
    rows = [r for conv in range(12) for r in random_log(rnd, conv, rnd.randrange(1, 40))]
    rnd.shuffle(rows)
    assert turns(format_logs(log(spark, *rows).repartition(4))) == folded(rows)


def test_streams_edits_and_regenerations(spark):
    rows = [
        (1, 0, "open", 0, "user", "Hi"), (1, 1, "open", 1, "assistant", None), (1, 2, "delta", 1, None, "Bad "),
        (1, 3, "delta", 1, None, "answer"), (1, 4, "open", 2, "user", "What?"), (1, 5, "regenerate", 1, None, None),
        (1, 6, "delta", 1, None, "Good "), (1, 7, "delta", 1, None, "answer"), (1, 8, "edit", 0, None, "Hello"),
    ]
    assert turns(format_logs(log(spark, *rows))) == {1: [("user", "Hello"), ("assistant", "Good answer")]}


def test_odd_rows(spark):
    rows = [
        (None, 1, "open", 0, "user", "no id"), (2, None, "open", None, None, "nulls"), (2, 5, "open", 0, "assistant", "x"),
        (3, 1, "open", 0, "user", "b"), (3, 1, "delta", 0, None, "b"), (3, 1, "delta", 0, None, "a"), (3, 1, "delta", 0, None, "a"),
        (4, 1, "open", 0, "as\nsis&<|im_end|>", "t" * 200_000),
    ]
    assert turns(format_logs(log(spark, *rows))) == folded(rows)
    assert folded(rows)[3] == [("user", "baab")]


def test_an_unknown_kind_fails(spark):
    with pytest.raises(Exception, match="unknown kind of event: undo"):
        messages(log(spark, (1, 1, "undo", 0, "user", "x"))).collect()


def test_loss_covers_assistants_alone(spark):
    rows = [(1, i, "open", i, ("user", "assistant")[i % 2], x) for i, x in enumerate(NASTY)]
    rendered = render(messages(log(spark, *rows)))
    (chat,) = read_back(rendered).collect()
    assert "".join(s.text for s in chat.segments) == chat.formatted
    assert chat.loss_text == "".join(NASTY[1::2])
    spans = sorted((r.start, r.stop) for r in loss_spans(rendered).collect())
    pieces = [chat.formatted[a:b] for a, b in spans]
    assert [p.replace("&lt;|", "<|").replace("&amp;", "&") for p in pieces] == NASTY[1::2]
    # Marks stand only where turns begin and end.
    assert chat.formatted.count("<|") == 2 * len(NASTY)


def test_whole_turns_become_events(spark):
    rows = [(1, 1, "assistant", "bc\u00e9"), (1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, None, None, "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    assert turns(format_logs(as_events(df))) == {1: [("user", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", "bcé")], None: [("", "x")]}


def test_empty_log(spark):
    assert format_logs(log(spark)).count() == 0


def test_query_by_hand(spark):
    chats = {-1: [("user", PROBE), ("assistant", PROBE)]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        chats.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    rows = op8_chat_format(spark, SF).collect()
    assert sorted(r.conv_id for r in rows) == sorted(chats)
    for r in rows:
        said = chats[r.conv_id]
        loss = "".join(text for role, text in said if role == "assistant")
        assert r.n_turns == len(said) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_the_registered_log_is_edited_and_regenerated(spark):
    """All kinds of events come from the whole table, and fold into the turns that they were made from."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    events = as_events(turns)
    kinds = {r.kind: r["count"] for r in events.groupBy("kind").count().collect()}
    assert set(kinds) == {"open", "delta", "edit", "regenerate"} and kinds["open"] == turns.count()
    assert kinds["edit"] > kinds["open"] / 8 and kinds["regenerate"] > kinds["open"] / 20
    final = messages(events).select("conv_id", "message.turn", "role", "text")
    given = turns.selectExpr("conv_id", "turn", "coalesce(role, '') role", "coalesce(text, '') text")
    assert final.exceptAll(given).count() == 0 and given.exceptAll(final).count() == 0
