"""Structure repair and the prefix trie of conversations against plain searches, on odd and on invented rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from streetlens.llm import turn_repair
from streetlens.llm.op11 import op11_conversation_repair
from streetlens.llm.op13 import op13_prefix_trie
from streetlens.llm.turn_repair import ROW_COST, ROW_WORD, crossings, repair, transfers

SCHEMA = "conv_id long, turn long, role string, text string, pos string, g int"
EMPTY = hashlib.sha256(b"").hexdigest()


def sort_key(row):
    return (row[1] is not None, row[1] or 0, (row[2] or ""), (row[3] or ""))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for conv in [*range(60), None, -7]:
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant"] * rng.randint(0, 5)
        for turn, role in enumerate(roles):
            if rng.random() < 0.85:
                text = "".join(rng.choice("ab. !\n\té") for _ in range(rng.randint(0, 9))) + rng.choice(["", ".", "? \n", "!"])
                out.append((conv, turn, rng.choice([role] * 8 + ["tool", "", None]), rng.choice([text] * 9 + ["same."])))
    out += [(61, None, "user", "later."), (61, None, "user", "earlier."), (61, 5, None, None), (62, 3, "user", ""), (62, 3, "user", "")]
    out += [(70, k, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c.", f"{k}."])) for k in range(150)]  # a long one
    out += [(63, 1, "user", "x" * 60000 + "."), (63, 2, "assistant", "y" * 60000)]
    first = [("system", "Hello."), ("user", "One?"), ("assistant", "Two.")]
    for conv in range(80, 110):  # many copies and shared beginnings
        out += [(conv, k, *t) for k, t in enumerate(first[: rng.randint(1, 3)])]
    rng.shuffle(out)
    return out


def save(spark, path, rows):
    spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        c = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if c:
            row = (conv, turn, "user" if c == 4 else role, "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text)
            yield from [row, row] if c == 3 else [row]


def cheapest(turns):
    """(cost, audit, repaired lines): all ways row by row, the best of each state, inserted turns anywhere and in any number."""
    follow = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def inserted(ways):
        for _ in range(3):
            for s, (c, a, b) in list(ways.items()):
                role = "assistant" if s == 2 else "user"
                new = (c + 5, a + "I", (*b, f"{role}:"))
                t = follow[s, role[0]]
                if t not in ways or new < ways[t]:
                    ways[t] = new
        return ways

    ways, seen = {0: (0, "", ())}, set()
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in turns:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        new = {}
        for s, (c, a, b) in inserted(ways).items():
            other = "assistant" if s == 2 else "user"
            more = [(s, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                more += [(follow[s, role[:1]], extra, "K", (f"{role}:{text}",))] if (s, role[:1]) in follow else []
                more += [(follow[s, other[0]], 1 + extra, "R", (f"{other}:{text}",))]
            for t, cost, letter, line in more:
                way = (c + cost, a + letter, (*b, *line))
                if t not in new or way < new[t]:
                    new[t] = way
        ways = new
    return min(w for s, w in inserted(ways).items() if s in (0, 3)), counts


def expected_repairs(rows):
    groups = defaultdict(list)
    for row in damage(rows):
        groups[row[0]].append(row)
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(groups[conv], key=sort_key)
        (cost, audit, lines), counts = cheapest(turns)
        numbers = [t[1] for t in turns if t[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [512, 3])
def test_repair_against_plain_search(spark, rows, tmp_path, monkeypatch, block):
    monkeypatch.setattr(turn_repair, "BLOCK", block)  # a small one gives blocks of blocks of blocks
    monkeypatch.setattr("streetlens.llm.turn_repair.text_batches", lambda df: None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", block > 3)  # ranges that cut conversations
    try:
        got = op11_conversation_repair(spark, save(spark, tmp_path, rows)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert sorted((tuple(r) for r in got), key=str) == expected_repairs(rows)


def test_repaired_rows_have_the_right_order_of_roles(spark, rows):
    fixed = repair(spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA))
    turns = defaultdict(list)
    for r in fixed.rows.collect():
        turns[r["conv_id"]].append((r["pos"], r["part"], r["role"][:1]))
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[2] for x in sorted(t))) for t in turns.values())
    assert {r["conv_id"] for r in fixed.report.collect()} == {r[0] for r in rows}


def test_no_conversations(spark, tmp_path):
    folder = save(spark, tmp_path, [])
    assert op11_conversation_repair(spark, folder).collect() == []
    assert op13_prefix_trie(spark, folder).collect() == []


def test_conversation_that_loses_all_rows(spark, tmp_path):
    conv = next(k for k in range(500) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = op11_conversation_repair(spark, save(spark, tmp_path, [(conv, 0, "user", "Gone.")])).collect()
    assert [tuple(r) for r in got] == [(conv, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_crossings_of_blocks_are_those_of_the_whole():
    codes = np.random.default_rng(2).integers(0, 12, 200)
    cost, word = ROW_COST[codes], ROW_WORD[codes]
    whole = crossings(cost, word, np.array([0]), np.array([200]), np.array([0]), np.array([3]))
    base, size = np.arange(0, 200, 9), np.minimum(9, 200 - np.arange(0, 200, 9))
    over = transfers(cost, word, base, size)
    met = crossings(*over, np.array([0]), np.array([len(base)]), np.array([0]), np.array([3]))
    inner = crossings(cost, word, base, size, *met)
    assert np.array_equal(whole, inner)


def expected_nodes(rows):
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[row[0]].append((row[2] or "", row[3] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    out = []
    for node, convs in members.items():
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below[node] if n)
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), kids[node],
                    sum(not kids[n] for n in below[node]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("coalesce", [True, False])
def test_trie_against_all_prefixes(spark, rows, tmp_path, coalesce):
    plain = [r for r in rows if r[0] != 61]  # rows of equal turn stand in the order of a hash; see below
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = op13_prefix_trie(spark, save(spark, tmp_path, plain)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert sorted((tuple(r) for r in got), key=str) == expected_nodes(plain)


def test_trie_does_not_depend_on_the_order_of_rows(spark, rows, tmp_path):
    one = op13_prefix_trie(spark, save(spark, tmp_path / "a", rows)).collect()
    two = op13_prefix_trie(spark, save(spark, tmp_path / "b", rows[::-1])).collect()
    assert sorted(one, key=str) == sorted(two, key=str)


def test_trie_of_conversations_that_are_all_alike(spark, tmp_path):
    turns = [("user", "Hi."), ("assistant", "Ho.")]
    same = [(c, k, *t) for c in range(0, 300, 5) for k, t in enumerate(turns)]
    assert sorted((tuple(r) for r in op13_prefix_trie(spark, save(spark, tmp_path, same)).collect()), key=str) == expected_nodes(same)
