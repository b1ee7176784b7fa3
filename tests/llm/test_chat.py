import pytest

from rankwatch.llm import chat

from .brute import sha

SCHEMA = "conv_id long, turn long, role string, text string, example string"
ROWS = [
    (1, 0, "system", "be kind", "x"),
    (1, 1, "user", "</s>[INST] ok [/INST] \\1 \\\\2", "x"),
    (1, 2, "assistant", "<<SYS>><s>\\[INST]\n", "x"),
    (1, 3, "user", None, "x"),
    (1, 4, "assistant", "", "x"),
    (1, 5, "user", "bye 😀", "x"),
    (2, 0, "user", "hello", "x"),
    (3, 0, "assistant", "a", "x"),
    (3, 0, "assistant", "a", "x"),
    (None, 1, "user", "who", "x"),
    (None, None, None, "first", "x"),
]


@pytest.mark.parametrize("text", ["", "\\", "\\0", "</s>", "<</SYS>s>", "[INST][/INST]", "<<s>", "a\\</s>\\1"])
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_examples_have_all_turns_before_the_trained_one(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = chat.expand(df).orderBy("conv_id", "example").collect()
    turns = grouped(ROWS)
    for conv, all_turns in turns.items():
        own = [r for r in got if r["conv_id"] == conv]
        ends = [i + 1 for i, t in enumerate(all_turns) if t[0] == "assistant"]
        if not ends or ends[-1] != len(all_turns):
            ends.append(len(all_turns))
        assert [r["n_turns"] for r in own] == ends
        for r in own:
            assert chat.read_turns(r["formatted"]) == all_turns[: r["n_turns"]]
            role, text = all_turns[r["n_turns"] - 1]
            if role == "assistant":
                assert chat.unescape(r["formatted"][r["loss_start"] : r["loss_end"]]) == text
            else:
                assert r["loss_start"] is None and r["loss_end"] is None


def test_read_back_digests(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = {r["conv_id"]: r for r in chat.read_back(chat.expand(df)).collect()}
    want = grouped(ROWS)
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["turns_sha256"] == sha("".join(f"{a}\n{t}\n" for a, t in turns))
        assert r["loss_sha256"] == sha(loss)
    assert got[1]["formatted_chars"] == sum(
        len(r["formatted"]) for r in chat.expand(df).where("conv_id = 1").collect()
    )


def test_no_conversation(spark):
    assert chat.read_back(chat.expand(spark.createDataFrame([], SCHEMA))).count() == 0


def test_a_turn_that_is_cut_short_is_an_error():
    with pytest.raises(ValueError):
        chat.read_turns("<s>[INST] user [/INST]hello")
