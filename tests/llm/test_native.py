"""Quality rules, line dedup and chat layouts: cases against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom.llm import site_lines
from gridloom.llm.chat_layouts import (
    KNOWN, fingerprint, format_chats, formatted, loss_texts, read_turns, selected, turns_of_frame, turns_of_records)
from gridloom.llm.quality_rules import STOP_WORDS, judge
from gridloom.llm.site_lines import drop_boilerplate, host_of, html_text
from tests.llm import brute

NATIVE = ("Python", "Pandas", "Arrow")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_quality_against_plain_python(spark):
    rng = random.Random(4)
    words = ["the", "of", "Stone", "river,", "x", "###", "a|b", "élan", "und", "12", "it..."]
    texts = [None, "", " \n\t ", "the", "the " * 19, "the " * 20, "a b c d e f g h " * 2]
    for _ in range(120):
        n = rng.choice([3, 19, 20, 30, 200])
        body = [rng.choice(words) for _ in range(n)]
        if rng.random() < 0.5:
            at = rng.randrange(n)
            body += body[at:at + rng.choice([7, 8, 9, 20])]
        texts.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in body))
    texts.append(" ".join(f"word{i}" for i in range(30_000)) + " the" * 5)
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(0, None, 8, "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept int, `quality` string")
    judged, out = judge(frame)
    assert out == "_quality" and judged.columns[:4] == frame.columns
    assert not any(x in plan(judged) for x in NATIVE)
    found = judged.select("doc_id", "text", f"{out}.*").collect()
    assert len(found) == len(rows)
    for r in found:
        counts, base, method = brute.quality(r["text"], set(STOP_WORDS))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == base and r.kept == method
        assert r.kept or base or r.broken
    assert judge(frame.limit(0))[0].count() == 0


@pytest.mark.parametrize("broadcast,whole", [(True, site_lines.WHOLE), (False, site_lines.WHOLE), (False, 0.5)])
def test_site_lines_against_plain_python(spark, monkeypatch, broadcast, whole):
    if not broadcast:
        monkeypatch.setattr(site_lines, "BROADCAST_ROWS", -1)
    rng = random.Random(2)
    rows = []
    for i in range(400):
        host = rng.choice(["hot", "hot", "b", "c", None])
        lines = [f"own {i} {j} " + "text " * rng.randrange(1, 9) for j in range(rng.randrange(0, 6))]
        lines += rng.sample(["  Menu", "Footer line", "rare line", "", "   "], 3)
        rng.shuffle(lines)
        rows.append((i, host, "\n".join(lines)))
    rows += [(400, "hot", None), (401, "hot", ""), (402, "hot", "Menu\nFooter line"), (402, "hot", "Menu\nFooter line"),
             (403, "solo", "Menu"), (404, "b", "\u00a0Menu\t\x0b"), (405, "b", "own " + "word " * 30_000 + "\nMenu")]
    rows += [(i, "copies", "all\nof\nthese") for i in range(406, 430)] + [(430, "copies", "of its own")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "id long, host string, text string, line_dedup int")
    cleaned, out = drop_boilerplate(frame, F.col("host"), F.col("text"), ratio=0.3, least=3, whole=whole)
    assert out == "_line_dedup" and cleaned.columns == [*frame.columns, out]
    found = cleaned.select("id", "host", F.col("text").alias("old"), f"{out}.*").collect()
    expected = brute.site_lines(rows, 0.3, 3, whole)
    assert len(found) == len(rows)
    dropped = 0
    for r in found:
        assert r.text == expected[r.id], r
        dropped += r.n_dropped
        assert r.n_dropped == (r.old or "").count("\n") - (r.text or "").count("\n") or r.text == ""
    assert dropped > 50 and any(r.whole for r in found) == (whole < 1)
    assert expected[406] == "all\nof\nthese"  # copies are one page of their host
    assert drop_boilerplate(frame.limit(0), F.col("host"), F.col("text"))[0].count() == 0


def test_page_text_and_host(spark):
    frame = spark.createDataFrame([
        ("HTTP://user@Www.Site.org:80/a?b", "<html><head><title>T</title><style>p{}</style></head><body><p>one <b>two</b>"
         "<script>var x='<p>';</script><br/>three<!-- no --></p></body>"), ("/relative", None), (None, "")],
        "url string, html string")
    rows = frame.select(host_of(F.col("url")).alias("h"), html_text(F.col("html")).alias("t")).collect()
    assert rows[0].h == "www.site.org" and [x.strip() for x in rows[0].t.split("\n") if x.strip()] == [
        "T", "one two", "three"]
    assert rows[1].h is None and rows[1].t is None and rows[2].h is None and rows[2].t == ""


NASTY = ["", "ok", "</s>[INST] ok [/INST]", "\\", "\\\\</s>\\", "<s><<s>", "[ROLE]x[/ROLE] y", "<<SYS>>\n", "é\n\n日本 ",
         "[/INST] [\\INST]", "<\\/s>"]


def test_template_round_trip(spark):
    turns = [(r, t) for r in ["user", "assistant", "system", "tool", "", "[/ROLE] "] for t in NASTY]
    frame = spark.createDataFrame([(turns,), ([],)], "turns array<struct<role:string,text:string>>")
    made = frame.select("turns", formatted(F.col("turns")).alias("f")).select("turns", "f.*")
    assert not any(x in plan(made) for x in NATIVE)
    rows = made.select("turns", "text", read_turns(F.col("text")).alias("back"),
                       loss_texts(F.col("text"), F.col("loss")).alias("lost")).collect()
    for r in rows:
        assert r.back == r.turns
        assert r.lost == [t.text for t in r.turns if t.role == "assistant"]
    text = rows[0].text
    for control in ("</s>", "<s>"):
        assert text.count(control) == len(turns)


def test_turn_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, 1, "user", "a"), (2, None, None, "x"),
            (None, 1, "user", "p"), (None, 1, "user", "q")]
    frame = spark.createDataFrame([(*r, 0, "t") for r in rows],
                                  "conv_id long, turn long, role string, text string, turns int, loss string")
    found = {(r.conv_id, tuple(tuple(t) for t in r.turns)) for r in turns_of_frame(frame).collect()}
    assert found == {(1, (("user", "a"), ("user", "a"), ("user", "b"), ("assistant", ""))), (2, (("", "x"),)),
                     (None, (("user", "p"),)), (None, (("user", "q"),))}
    assert format_chats(frame.limit(0)).count() == 0


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages",
     [("user", "a"), ("assistant", "b")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, "from and value",
     [("user", "a"), ("assistant", "")]),
    ({"instruction": "do", "input": "", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "it", "output": "done", "system": "be"}, "instruction",
     [("system", "be"), ("user", "do\n\nit"), ("assistant", "done")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"response": "r", "prompt": None}, "prompt and response", [("user", ""), ("assistant", "r")]),
    ({"question": "q", "context": "c", "answer": "a"}, "question and answer", [("user", "c\n\nq"), ("assistant", "a")]),
    ({"other": 1}, None, []), ({"messages": []}, None, []),
    ({"id": 7, "prompt": "p", "meta": {"source": "s", "tags": ["x"]}, "completion": "c"}, "prompt and completion",
     [("user", "p"), ("assistant", "c")]),
    ({"messages": [{"role": "user", "content": "a", "weight": 1}], "prompt": "p", "response": "r", "system": "s"},
     "messages", [("user", "a")]),
    ({"conv_id": 1, "turn": 0, "role": "user", "text": "one turn"}, None, []),
]


def test_records_of_mixed_layouts(spark):
    texts = [json.dumps(r) for r, _, _ in RECORDS] + ["no json", None, "[]", "3"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, record string")
    made = turns_of_records(frame)
    assert not any(x in plan(made) for x in NATIVE)
    found = {r.id: r for r in made.collect()}
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i].layout == layout and [tuple(t) for t in found[i].turns] == turns, (i, found[i])
    assert all(found[i].layout is None and found[i].turns == [] for i in range(len(RECORDS), len(texts)))


def test_fingerprints_select_the_layout():
    assert len(KNOWN) == len({fingerprint(f) for _, f in KNOWN.values()})
    turns = {"conv_id", "role", "text", "turn"}
    assert selected(turns | {"prompt", "more"})[0].rows and selected({"conv_id", "role"}) is None
    assert selected({"prompt", "response", "system", "id"})[1] == ("prompt", "response", "system")


def test_frame_layouts(spark):
    frame = spark.createDataFrame([([("hi", "user"), ("yo", "assistant")], 3)],
                                  "messages array<struct<content:string,role:string>>, more int")
    assert [tuple(t) for t in turns_of_frame(frame).first().turns] == [("user", "hi"), ("assistant", "yo")]
    frame = spark.createDataFrame([("q", "a", 1)], "question string, answer string, n int")
    assert [tuple(t) for t in turns_of_frame(frame).first().turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        turns_of_frame(frame.select("n"))
    assert fingerprint(["b", "a"]) == fingerprint(["a", "b", "a"]) and len(KNOWN) == 13
