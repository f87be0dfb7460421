import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopsignals.llm import chat_format as cf
from tests.llm import helpers as h

DDL = "conv_id long, turn long, role string, text string"
TEMPLATE = cf.Template()
CODEC = cf.Codec(cf.vocabulary_path(), TEMPLATE)
MARKS = {role: (a, z) for role, a, z in TEMPLATE.marks}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shown(role, text):
    """A turn as formatted, written apart."""
    e = TEMPLATE.escape
    a, z = MARKS.get(role, (f"[ROLE]{e(role)}[/ROLE]", "</s>"))
    return a + e(text) + z


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[:2])
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss), sum(len(shown(r, t)) for _, _, r, t in turns)))
    return sorted(out, key=str)


def talk(n=30):
    rng = random.Random(6)
    odd = ["</s>", "[INST]", "<\\/s>", "<\\\\/s>x", "<", "<<SYS>> <</SYS>>", "<<SYS>", "[/INST]]", "[ROLE]tool[/ROLE]", "\\", "🙂 ﬁ é é", "<|endoftext|>", "", "\n\n  \t", "\x00", "Ünï 日本語"]
    return [
        (conv, turn, rng.choice(["user", "assistant", "assistant", "system", "tool", "[INST]", ""]), rng.choice([rng.choice(odd), rng.choice(odd) + h.sentence(rng, 6) + rng.choice(odd), None]))
        for conv in range(n) for turn in range(rng.randrange(1, 9))
    ]


@pytest.mark.parametrize(("chunk_tokens", "train"), [(1 << 15, False), (5, True)])
def test_matches_brute_force(spark, chunk_tokens, train):
    """Also in chunks of a few ids, and with one conversation that holds a third of all rows."""
    rows = talk() + [(99, t, "user" if t % 2 else "assistant", f"line {t} </s>") for t in range(90)] + [(None, 0, "user", "x"), (None, 1, None, None), (4, None, "system", "first")]
    df = spark.createDataFrame(rows, DDL).repartition(6)
    table = cf.formatted(h.clashing(df).withColumnRenamed("value", "a.b"), chunk_tokens=chunk_tokens, train_on_close=train)
    assert sorted(map(tuple, cf.read_back(table).collect()), key=str) == brute(rows)
    for r in table.collect():
        assert len(r["ids"]) == len(r["mask"])
    assert table.where("whole").count() > 0 and table.where("NOT whole").count() > 0


def test_query_adds_the_conversation_of_control_strings(spark):
    df = spark.createDataFrame([(3, 0, "user", "hi"), (3, 1, "assistant", "there")], DDL)
    got = {r["conv_id"]: r for r in cf.chat_formatting(df).collect()}
    assert set(got) == {3, -1} and got[-1]["loss_chars"] == len(cf.CONTROL_TEXT) and got[-1]["loss_sha256"] == sha(cf.CONTROL_TEXT)
    assert got[-1]["formatted_chars"] > 2 * len(cf.CONTROL_TEXT) and got[3]["loss_chars"] == 5
    assert [r["conv_id"] for r in cf.chat_formatting(spark.createDataFrame([], DDL)).collect()] == [-1]


def test_repeated_turns_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(cf, "PIECE", 7)
    rows = [(1, 0, "user", "same text")] * 3 + [(1, 1, "assistant", "long é " * 5000)]
    assert sorted(map(tuple, cf.read_back(cf.formatted(spark.createDataFrame(rows, DDL))).collect())) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "[/ROLE]", ""]), st.lists(st.sampled_from(["<", ">", "\\", "/s>", "s>", "[INST]", "</s>", "<<SYS>>", "[", "INST]", "a", "é"]), max_size=8).map("".join)), min_size=1, max_size=5))
def test_any_turns_come_back(turns):
    coded = [(r, [] if r in MARKS else CODEC.encode(TEMPLATE.escape(r)), CODEC.encode(TEMPLATE.escape(t))) for r, t in turns]
    ids, mask = cf.assemble(CODEC, coded)
    text = CODEC.text(ids.tolist())
    assert text == "".join(shown(r, t) for r, t in turns)
    back = list(cf.parsed(CODEC, ids, mask))
    assert [(r, t) for r, t, _, _ in back] == turns
    assert "".join(m for _, _, m, _ in back) == "".join(t for r, t in turns if r == "assistant")
    for _, t in turns:
        assert not any(c in TEMPLATE.escape(t) for c in TEMPLATE.controls) and TEMPLATE.unescape(TEMPLATE.escape(t)) == t


def test_mask_covers_the_assistant_text_and_its_close_on_request():
    coded = [("user", [], CODEC.encode("hi")), ("assistant", [], CODEC.encode("there")), ("assistant", [], [])]
    ids, mask = cf.assemble(CODEC, coded)
    assert CODEC.text([i for i, m in zip(ids.tolist(), mask) if m]) == "there"
    _, mask = cf.assemble(CODEC, coded, train_on_close=True)
    assert CODEC.text([i for i, m in zip(ids.tolist(), mask) if m]) == "there</s></s>"


def test_templates_that_cannot_be_read_back_are_refused():
    for marks in ((("user", "[A", "[A]"),), (("a", "", "</s>"), ("b", "", "</s>")), (("a", "<\\x>", "</x>"),), (("a", "", "</t>"),)):
        with pytest.raises(ValueError):
            cf.Template(marks=marks)
