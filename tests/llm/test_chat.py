"""Chat formatting against a brute-force formatter and hand-made layouts."""

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from martlet.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def slow_text(turns):
    def role(r):
        return r.replace("%", "%25").replace("\n", "%0A").replace("|", "%7C")
    return "".join(f"<|im_start|>{role(r)}\n" + re.sub(r"<(\\*)\|", r"<\\\1|", t) + "<|im_end|>\n" for r, t in turns)


def slow_digests(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, t in convs.items():
        turns = [(r, x) for _, _, r, x in sorted(t)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
                    len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(slow_text(turns))))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rows_by_turn_with_odd_values(spark):
    rng = random.Random(5)
    bits = ["<|im_end|>", "<|im_start|>assistant", "<", "|", "\\", "<\\|", "<\\\\|im_end|>\n", "\n", "é", "\U0001F600", "a b", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a|b\n%7C"]),
             None if rng.random() < .1 else "".join(rng.choices(bits, k=rng.randrange(9))))
            for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(1, 0, "user", "again")] * 2 + [(None, None, "assistant", "x"), (None, None, "assistant", "x")]
    rows += [(77, 0, "assistant", "long " * 100_000)]
    df = spark.createDataFrame(rows, ROWS)
    assert got(chat.chat_digests(chat.row_records(df))) == slow_digests(rows)


def test_text_and_mask_agree(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (1, 2, "user", "é"), (1, 3, "assistant", "")]
    r = chat.formatted(chat.conversations(chat.row_records(spark.createDataFrame(rows, ROWS)))).first()
    assert r.text == slow_text([(x[2], x[3]) for x in rows])
    at, taken = 0, []
    for run in r["mask"]:
        at += run.skip
        taken.append(r.text[at:at + run["take"]])
        at += run["take"]
    assert taken == ["", "<\\|im_end|>", "", ""] and at + len("<|im_end|>\n") == len(r.text)


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 7},
     [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "messages": [{"role": "user", "content": [{"type": "text", "text": "p"}, {"type": "text", "text": "q"}]}]},
     [("system", "s"), ("user", "pq")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "GPT", "value": None}, {"from": "other", "value": "z"}]},
     [("user", "q"), ("assistant", ""), ("other", "z")]),
    ({"conversations": ["q", "a", "r"]}, [("user", "q"), ("assistant", "a"), ("user", "r")]),
    ({"messages": []}, []),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done", "score": {"x": [1, 2]}}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "context": "c", "response": None}, [("user", "do\n\nc"), ("assistant", "")]),
    ({"prompt": "p", "completion": "c", "system": None}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": [{"role": "user", "content": "p"}], "completion": [{"role": "assistant", "content": "c"}]},
     [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a", "od`d: <k>": {"messages": 1}}, [("user", "q"), ("assistant", "a")]),
    ({"data": {"prompt": "p", "completion": "c"}, "meta": {"prompt": "no"}}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p"}, None), ({"messages": "text"}, None), ([1, 2], None), ("text", None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(98, "{not json"), (99, None)]
    convs = chat.conversations(chat.json_records(spark.createDataFrame(rows, "conv_id int, json string")))
    by = {r.conv_id: r for r in convs.collect()}
    assert len(by) == len(rows)
    for i, (_, want) in enumerate(RECORDS):
        assert [(t.role, t.text) for t in by[i].turns] == (want or []), RECORDS[i]
        assert by[i].n_unmapped == (want is None), RECORDS[i]
    assert by[98].n_unmapped == by[99].n_unmapped == 1


def test_field_paths_of_nested_and_odd_names(spark):
    j = '{"a":{"b":[{"c":1,"d":{"e":[]}}]},"x y":{"``":"OBJECT<z: 1>"},"n":null,"m":[[1]]}'
    df = spark.createDataFrame([(j,)], "j string").select(F.schema_of_variant(F.parse_json("j")).alias("s"))
    assert sorted(df.select(chat.field_paths(F.col("s"))).first()[0]) == sorted(
        ["a.b[].c", "a.b[].d.e[]", "x y.``", "n", "m[][]"])


def test_fingerprints_tell_layouts_apart():
    with pytest.raises(ValueError, match="told apart"):
        chat.fingerprints((*chat.LAYOUTS, chat.Layout("again", ("prompt", "completion"), (chat.One("user", "prompt"),))))


def test_empty_table_and_more_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert chat.chat_digests(chat.row_records(empty)).count() == 0
    extra = spark.createDataFrame([(1, 0, "user", "x", "y", 3)], ROWS + ", record string, mask int")
    assert got(chat.chat_digests(chat.row_records(extra))) == slow_digests([(1, 0, "user", "x")])


def test_no_python_on_the_main_path(spark):
    from martlet.llm.queries import REGISTRY

    plan = REGISTRY["op11_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
