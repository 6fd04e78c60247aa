"""Conversation repair against plain strings and against all edit sequences."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from asterloom.llm.conversations import Audit, EditTree, damaged, repair_conversations, summaries
from asterloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "conv_id long, turn long, role string, text string"


def faults_of(turns):
    seen, out = set(), []
    for role, text in turns:
        stripped = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not stripped else "duplicate" if (role, text) in seen else "" if stripped[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def apply(turns, faults, audit):
    """(cost, repaired) of an edit string, or None where it can't be applied or doesn't fit."""
    cost, left, done, shape = 0, list(zip(turns, faults)), [], ""
    for edit in audit:
        expected = "assistant" if shape.endswith("u") else "user"
        if edit == "I":
            done.append((expected, ""))
            shape, cost = shape + expected[0], cost + 2
            continue
        if not left:
            return None
        (role, text), fault = left.pop(0)
        if edit == "D":
            cost += 3
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += (fault == "truncated") + (2 if edit == "R" else 0)
        done.append((expected if edit == "R" else role, text))
        shape += done[-1][0][:1]
    if left or not re.fullmatch(r"(s?(ua)+)?", shape):
        return None
    return cost, done


def strings(turns, faults):
    """The same search over whole strings, for conversations of any length."""
    step = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    expected = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(3):
            for place, (cost, audit) in list(best.items()):
                to = expected[place]
                best[to] = min(best.get(to, (9**9, "")), (cost + 2, audit + "I"))
        return best

    best = inserted({"": (0, "")})
    for (role, _), fault in zip(turns, faults):
        found = {}
        for place, (cost, audit) in best.items():
            options = [(place, cost + 3, "D")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                options.append((expected[place], cost + 2 + more, "R"))
                if (place, role[:1]) in step:
                    options.append((step[place, role[:1]], cost + more, "K"))
            for to, c, edit in options:
                found[to] = min(found.get(to, (9**9, "")), (c, audit + edit))
        best = inserted(found)
    return min(best[p] for p in ("", "a") if p in best)


def expected_row(conv, rows):
    """A conversation's whole row, from its (turn, role, text) in order."""
    turns = [(role, text) for _, role, text in rows]
    faults = faults_of(turns)
    cost, audit = strings(turns, faults)
    checked = apply(turns, faults, audit)
    assert checked[0] == cost
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(turns, turns[1:])]
    lines = "\n".join(f"{r}:{t}" for r, t in checked[1])
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def shown(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted([tuple(r[n] for n in names) for r in df.collect()], key=repr)


def test_cheapest_of_all_edit_strings():
    """Every string of up to two edits more than turns, for short conversations."""
    rng = random.Random(5)
    texts = ["a.", "b", "", "c?"]
    for _ in range(120):
        turns = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(texts)) for _ in range(rng.randint(0, 4))]
        faults = faults_of(turns)
        options = []
        for n in range(len(turns), len(turns) + 4):
            for edits in product("DIKR", repeat=n):
                if len(edits) - edits.count("I") == len(turns):
                    done = apply(turns, faults, "".join(edits))
                    if done:
                        options.append((done[0], "".join(edits)))
        audit = Audit()
        for k, ((role, _), fault) in enumerate(zip(turns, faults)):
            audit.add(k, role[:1], ("", "blank", "duplicate", "truncated").index(fault))
        assert audit.result()[5:7] == min(options) == strings(turns, faults)


def test_long_conversations_of_equal_costs():
    rng = random.Random(7)
    for roles in (["tool"], ["user"], ["user", "assistant"], ["system", "tool", "assistant"]):
        turns = [(rng.choice(roles), f"{k}.") for k in range(400)]
        faults = [rng.choice(["", "", "truncated", "blank"]) for _ in turns]
        audit = Audit()
        for k, ((role, _), fault) in enumerate(zip(turns, faults)):
            audit.add(k, role[:1], ("", "blank", "duplicate", "truncated").index(fault))
        assert audit.result()[5:7] == strings(turns, faults)


def test_strings_compare_through_the_tree():
    rng, tree = random.Random(1), EditTree()
    nodes = {"": 0}
    for _ in range(300):
        word = rng.choice(list(nodes)) + rng.choice("DK")
        if word not in nodes:
            nodes[word] = tree.add(nodes[word[:-1]], ord(word[-1]))
    words = list(nodes)
    for _ in range(2000):
        a, b = rng.choice(words), rng.choice(words)
        assert tree.less(nodes[a], nodes[b]) == (a < b)
        assert tree.text(nodes[a]) == a


def test_whole_table(spark):
    want, groups = [], {}
    for row in pq.read_table(f"{FOLDER}/conversations.parquet").to_pylist():
        groups.setdefault(row["conv_id"], []).append(row)
    for conv, rows in groups.items():
        kept = []
        for row in sorted(rows, key=lambda r: r["turn"]):
            kind = zlib.crc32(f"{conv}:{row['turn']}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", row["text"]) if kind == 2 else row["text"]
            kept += [(row["turn"], "user" if kind == 4 else row["role"], text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        want.append(expected_row(conv, kept))
    got = QUERIES["op12_conversation_repair"](spark, FOLDER)
    assert shown(got) == sorted(want, key=repr)
    assert {e for row in want for e in row[7]} == set("KRDI")


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, one turn twice, a role of its own, long texts."""
    groups = {
        None: [(None, "user", "x."), (1, "assistant", "y.")],
        1: [(None, " ", " "), (5, "user", "q?\n"), (5, "user", "q?\n"), (9, "assistant", "é" * 200_000)],
        2: [(0, "tool", "t.")] + [(k, "user", f"{k}.") for k in range(1, 9)],
        3: [(0, "system", "only.")],
        4: [(2, "assistant", "b."), (2, "user", "a.")],
    }
    rows = [(c, t, None if r == " " else r, None if x == " " else x) for c, ts in groups.items() for t, r, x in ts]
    # Columns that share the names used inside.
    df = spark.createDataFrame(rows, COLUMNS).withColumn("step", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("kind", F.lit(2))
    got = shown(summaries(repair_conversations(df.repartition(5))))
    assert got == sorted([expected_row(c, ts) for c, ts in groups.items()], key=repr)


def test_nothing_left_and_empty_tables(spark):
    lost = spark.createDataFrame([(7, 0, "user", "a."), (7, 1, "assistant", "b.")], COLUMNS)
    nothing = hashlib.sha256(b"").hexdigest()
    got = shown(summaries(repair_conversations(lost, lost=F.lit(True))))
    assert got == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]
    empty = spark.createDataFrame([], COLUMNS)
    log = repair_conversations(damaged(empty), lost=F.col("lost"))
    assert log.count() == 0 and summaries(log).count() == 0


def test_log_holds_the_repaired_turns(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "user", "b"), (1, 2, "user", "b")]
    log = repair_conversations(spark.createDataFrame(rows, COLUMNS)).filter("step > 0").orderBy("step")
    assert [(r.edit, r.fault, r.role, r.text) for r in log.collect()] == [
        ("I", None, "user", ""), ("K", None, "assistant", "a."), ("D", "truncated", "user", "b"), ("D", "duplicate", "user", "b"),
    ]


@pytest.mark.parametrize("columns", [{"conv_col": "c", "turn_col": "n", "role_col": "who", "text_col": "said"}])
def test_other_names(spark, columns):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], "c long, n long, who string, said string")
    (row,) = shown(summaries(repair_conversations(df, **columns)))
    assert row[7] == "KK" and row[6] == 0
