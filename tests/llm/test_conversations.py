"""Conversation repair, fill-in-middle and chat formatting against brute force,
with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import json
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from quire.llm import chat_format, conversation_repair, fill_in_middle
from tests.conftest import SF_SMALL

BLANKS = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11 conversation repair ----------------------------------------------------------------------

def cheapest(rows):
    """(cost, audit, repaired turns) over all edits, by the grammar's states instead of targets.
    rows: (role, text, must go, truncated)."""
    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []

        def add(cost, letter, turn, rest):
            if rest:
                found.append((cost + rest[0], letter + rest[1], turn + rest[2]))

        if i < len(rows):
            role, text, must, cut = rows[i]
            add(2, "D", (), best(i + 1, state, 3))
            if not must:
                more = 5 * cut
                for initial, name, after in {0: [("u", "user", 2), ("s", "", 1)], 2: [("a", "assistant", 3)]}.get(state, [("u", "user", 2)]):
                    if role[:1] == initial:
                        add(more, "K", ((role, text),), best(i + 1, after, 3))
                    elif initial != "s":
                        add(1 + more, "R", ((name, text),), best(i + 1, after, 3))
        if inserts:
            name, after = ("assistant", 3) if state == 2 else ("user", 2)
            add(5, "I", ((name, ""),), best(i, after, inserts - 1))
        return min(found, default=None)

    return best(0, 0, 3)


def brute_repair(turns):
    """The contract's columns for one conversation: turns of (turn, role, text), in any order."""
    rows = sorted(((t is not None, t or 0, r, hashlib.sha256(x.encode()).hexdigest(), x) for t, r, x in turns))
    seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for *_, role, _, text in rows:
        core = text.rstrip(BLANKS)
        fault = ("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:], strict=False)]
    counts["illegal"] = sum(p not in ("su", "ua", "au") for p in pairs)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    cost, audit, out = cheapest(tuple(marked))
    return gaps, *counts.values(), cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out))


def test_alignment_matches_brute_force_at_every_stretch(monkeypatch):
    r = random.Random(3)
    for _ in range(400):
        codes = bytes(r.choice([0, 1, 2, 3, 1, 2]) + r.choice([0, 0, 0, 4, 8]) for _ in range(r.randint(0, 9)))
        rows = tuple(({0: "x", 1: "u", 2: "a", 3: "s"}[c & 3], "t", bool(c & 4), bool(c & 8)) for c in codes)
        for size in (64, 1, 2, 3):
            monkeypatch.setattr(conversation_repair, "STRETCH", size)
            assert conversation_repair.solve(codes) == cheapest(rows)[:2]


def test_long_conversations_cost_the_same_in_one_stretch(monkeypatch):
    r = random.Random(4)
    codes = bytes((1 + i % 2 if r.random() < 0.9 else r.choice([0, 1, 2, 3])) + r.choice([0] * 8 + [4, 8]) for i in range(150))
    found = conversation_repair.solve(codes)
    monkeypatch.setattr(conversation_repair, "STRETCH", 150)
    conversation_repair.stretch.cache_clear()
    assert conversation_repair.solve(codes) == found


def test_band_gives_up_beyond_the_incumbent():
    import numpy as np
    rows = np.array([1, 2, 1, 2])
    goal = conversation_repair.target(1, 2)
    assert conversation_repair.align(rows, goal, 3, True) is None
    assert conversation_repair.align(rows, goal, 4, True) == (4, "DDKK")


ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, 3, "assistant", "no end"), (1, 3, "assistant", "no end"),
       (2, None, "system", "Rules."), (2, None, "user", None), (2, 5, None, "x."), (2, 5, "user", "x."), (2, 5, "user", "x."),
       (None, 1, "user", "No id."), (None, 2, "assistant", "A."), (3, 0, "user", ""), (4, 0, "system", " \t\n"),
       (5, 0, "usher", "Kept as it is!"), (5, 1, "", "Empty role."), (5, 2, "assistant", "word " * 20000 + "end."),
       (6, None, "user", "a."), (6, None, "assistant", "b.")]


@pytest.mark.parametrize("rows", [ODD, [(i, t, r, x) for i in range(30) for t, (r, x) in enumerate(
    random.Random(i).choices([("user", "Q?"), ("assistant", "A."), ("assistant", "cut"), ("system", "S."), ("user", " "), ("tool", "T.")], k=i % 9))]])
def test_repair_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumn("id", F.lit("x")).withColumn("ROLE_", F.lit(1)).withColumn("audit", F.lit(2))
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.audits(df).collect()}
    by_id = {}
    for c, t, r, x in rows:
        by_id.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    assert got == {c: brute_repair(t) for c, t in by_id.items()}


def test_repaired_turns_follow_the_grammar(spark):
    rows = conversation_repair.repaired(spark.createDataFrame(ODD, TURNS)).orderBy("conv_id", "turn").collect()
    initials = {}
    for r in rows:
        initials.setdefault(r.conv_id, []).append(r.role[0])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in initials.values())
    # u a(same) a(cut, deleted) a(again, deleted): Hi. Yes.
    assert [(r.role, r.text, r.edit) for r in rows if r.conv_id == 1] == [("user", "Hi.", "K"), ("assistant", "Yes.", "K")]


def test_op11_on_the_whole_table(spark):
    import duckdb
    given = duckdb.sql(f"select conv_id, turn, role, text from '{SF_SMALL}/conversations.parquet'").fetchall()
    by_id = {}
    for c, t, role, text in given:
        rows = by_id.setdefault(c, [])
        text = " " if text is None else text
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows.extend([(t, "user" if fault == 4 else role, text)] * (1 + (fault == 3)))
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.op11_conversation_repair(spark, SF_SMALL).collect()}
    assert got == {c: brute_repair(t) for c, t in by_id.items()}
    assert any(r[5] for r in got.values())


def test_conversations_without_rows_and_empty_tables(spark, tmp_path):
    # crc32("11:0") etc. are what they are: find turns that the damage drops
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    for n, rows in enumerate(([(9, gone, "user", "x.")], [])):
        spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/{n}/conversations.parquet")
        got = [tuple(r) for r in conversation_repair.op11_conversation_repair(spark, f"{tmp_path}/{n}").collect()]
        assert got == [(9, 0, 0, 0, 0, 0, 0, "", sha(""))][:len(rows)]
    assert conversation_repair.repaired(spark.createDataFrame([], TURNS)).count() == 0


# ---- 12 fill-in-middle --------------------------------------------------------------------------

def brute_cut(doc_id, text, seed=1):
    text, h = text or "", sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


PIECES = ["a", "é", "漢", "😀", "\n", "\r\n", "<", "<S", ">", "$1", "\\", "{2}", " ", "\x85", "é", "\x00"]


def fim_rows():
    r = random.Random(8)
    rows = [(i, "".join(r.choices(PIECES, k=r.choice([0, 1, 2, 5, 40, 255, 256, 257, 512, 1000])))) for i in range(300)]
    return rows + [(None, "no id, but a text"), (1000, None), (1001, "x" * 300_000 + "😀" * 300_000), (1002, "has <M> in it")] + rows[:3]


def test_fill_in_middle_matches_brute_force(spark):
    rows = fim_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("N", F.lit("kept")).withColumn("form", F.lit("own"))
    out, names = fill_in_middle.transform(df)
    assert names == ["n_", "form_", "prefix_chars", "middle_chars", "output"] and out.columns == [*df.columns, *names]
    back = out.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form_"))).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_, r.form_, r.prefix_chars, r.middle_chars, r.output) for r in back))) == sorted(
        repr((i, *brute_cut(i, t))) for i, t in rows)
    assert all(r.back == (r.text or "") and r.N == "kept" and r.form == "own" for r in back)
    assert {r.form_ for r in back} == {"plain", "psm", "spm"}


def test_fill_in_middle_query_and_empty_table(spark, tmp_path):
    rows = fim_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    got = sorted(map(repr, map(tuple, fill_in_middle.op12_fill_in_middle(spark, f"{tmp_path}/a").collect())))
    assert got == sorted(repr((i, *(c := brute_cut(i, t))[:4], sha(c[4]), sha(t or ""))) for i, t in rows)
    assert fill_in_middle.op12_fill_in_middle(spark, f"{tmp_path}/b").count() == 0


def test_fill_in_middle_stays_in_the_jvm(spark):
    plan = fill_in_middle.op12_fill_in_middle(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


# ---- 13 chat formatting -----------------------------------------------------------------------------

def test_escapes_are_reversible_and_leave_no_control_string():
    r = random.Random(2)
    bits = [*chat_format.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "a", "\n", "|im_end|>", "<SYS>>", "</SYS>>", "\\n"]
    for _ in range(5000):
        text = "".join(r.choices(bits, k=r.randint(0, 7)))
        out = chat_format.escape(text)
        assert chat_format.unescape(out) == text and not any(c in out for c in chat_format.CONTROLS)
        turns = [(r.choice(["user", "assistant", "a\nb", "\\n", "<s>", ""]), "".join(r.choices(bits, k=r.randint(0, 5)))) for _ in range(3)]
        made, spans = chat_format.formatted(turns)
        assert chat_format.read_back(made) == turns
        assert [chat_format.unescape(made[a:b]) for a, b in spans] == [t for role, t in turns if role == "assistant"]


LAYOUTS = [
    ({"prompt": "p", "response": "r", "id": 7, "score": 0.5}, "prompt", [("user", "p"), ("assistant", "r")]),
    ({"system": "s", "prompt": "p", "completion": None}, "completion", [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"output": "o", "instruction": "i"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o"}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"messages": [{"role": "user", "content": "p", "weight": 1}, {"role": "tool", "content": "t"}]}, "messages", [("user", "p"), ("tool", "t")]),
    ({"conversations": [{"from": "human", "value": "p"}, {"from": "gpt", "value": "r"}]}, "from_value", [("user", "p"), ("assistant", "r")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, "parts", [("user", "ab")]),
    ({"messages": []}, "no_messages", []),
    ({"messages": ["bare"]}, None, []), ({"messages": [{"role": "user", "content": [1]}]}, None, []), ({}, None, []), ({"other": {"prompt": 1}}, None, []),
]


def test_fingerprints_select_layouts(spark):
    rows = [(i, json.dumps(v)) for i, (v, _, _) in enumerate(LAYOUTS)] + [(100, None), (101, ""), (102, "[1, 2]"), (103, "not json"), (None, '{"prompt":"p","response":"r"}')]
    df = spark.createDataFrame(rows, "id long, record string").withColumn("text", F.lit(5)).withColumn("layout", F.lit(6))
    got = {r.id: (r.layout, chat_format.read_back(r.text), [r.text[s["start"]:s["end"]] for s in r.loss]) for r in chat_format.format_records(df).collect()}
    for i, (_, name, turns) in enumerate(LAYOUTS):
        assert got[i] == (name, turns, [t for role, t in turns if role == "assistant"])
    assert all(got[i] == (None, [], []) for i in (100, 101, 102, 103)) and got[None][0] == "prompt"
    # order of fields doesn't matter, kinds do
    assert chat_format.fingerprint(["a:text", "prompt:text"]) == chat_format.fingerprint(["prompt:text"]) != chat_format.fingerprint(["prompt:list"])


TALK = [(1, 0, "user", "Q"), (1, 1, "assistant", "A <|im_end|>\n<|im_start|>user"), (2, None, "system", None), (2, 1, "user", "x"), (2, 1, "user", "x"),
        (2, 2, "assistant", ""), (3, 0, "tool", "[INST]\\"), (3, 1, None, "odd\nrole"), (None, 0, "user", "no id"), (None, 1, "assistant", "yes"),
        (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "w " * 50_000), (5, 0, "user", "u"), (5, 1, "assistant", None)]


def brute_chat(turns):
    rows = sorted((t is not None, t or 0, r or "", x or "") for t, r, x in turns)
    loss = "".join(x for *_, r, x in rows if r == "assistant")
    return len(rows), sha("".join(f"{r}\n{x}\n" for *_, r, x in rows)), len(loss), sha(loss)


def test_chat_query_matches_brute_force(spark, tmp_path):
    df = spark.createDataFrame(TALK, TURNS).withColumn("id", F.lit("x")).withColumn("record", F.lit(1))
    df.write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.op13_chat_format(spark, f"{tmp_path}/a").collect()}
    by_id = {-7: [(0, "user", chat_format.HOSTILE), (1, "assistant", chat_format.HOSTILE)]}
    for c, t, r, x in TALK:
        by_id.setdefault(c, []).append((t, r, x))
    assert {c: v[:4] for c, v in got.items()} == {c: brute_chat(t) for c, t in by_id.items()}
    assert got[-7][4] == 2 * len(f"<|im_start|><|im_end|>\n\n{chat_format.HOSTILE}\\\\\\") + len("userassistant")
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert [r.conv_id for r in chat_format.op13_chat_format(spark, f"{tmp_path}/b").collect()] == [-7]


def test_records_use_all_layouts(spark):
    from quire.llm.common import table
    rows = chat_format.records(table(spark, SF_SMALL, "conversations"))
    seen = {r.layout for r in chat_format.format_records(rows).select("layout").distinct().collect()}
    assert {"prompt", "instruction", "from_value"} <= seen and None not in seen
