"""Benchmark decontamination against all windows, on odd and on invented rows."""

import random
import re

import numpy as np
import pytest

from streetlens.llm import decontamination
from streetlens.llm.decontamination import SuffixArray, contamination, decontaminate, longest_matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(bench, width):
    out = {}
    for item, text in bench:
        w = words(text)
        n = min(len(w), width)
        for k in range(len(w) - n + 1 if n else 0):
            out.setdefault(tuple(w[k : k + n]), set()).add("" if item is None else str(item))
    return out


def expected(docs, bench, width):
    wanted = windows(bench, width)
    sizes = {len(x) for x in wanted}
    rows = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wanted:
                    hit.update(range(k, k + n))
                    items |= wanted[x]
        rows.append((doc, len(w), len(hit), sorted(items)))
    return sorted(rows, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    make = lambda n: " ".join(rng.choice("abc") + rng.choice("xyz,;") + rng.choice(["é", "1", "", "Q"]) for _ in range(n))
    bench = [(k, make(rng.randint(12, 40))) for k in range(12)]
    bench += [(3, make(15)), (90, bench[0][1]), (91, "One, TWO"), (92, "five"), (None, make(14)), (93, None), (94, " .;! "), (95, ""), (96, make(300))]
    docs = [(k, make(rng.randint(0, 80))) for k in range(40)]
    for k in range(40, 80):
        item = bench[rng.randrange(14)][1].split(" ")
        lo = rng.randrange(len(item))
        docs.append((k, make(rng.randint(0, 20)) + "\n" + "  ".join(item[lo : lo + rng.randint(3, 40)]).upper() + " - " + make(rng.randint(0, 30))))
    docs += [(80, None), (81, ""), (82, "one... two?"), (83, "one"), (84, "x five-five"), (41, docs[50][1]), (None, bench[1][1]), (60, docs[60][1]), (85, make(4000))]
    docs += [(100 + k, bench[2][1]) for k in range(30)]  # one passage in many documents
    return docs, bench


def frames(spark, rows):
    docs, bench = rows
    return (
        spark.createDataFrame([(d, t, 7, "mine") for d, t in docs], "doc_id long, text string, n_words int, hits string"),
        spark.createDataFrame(bench, "item_id long, text string"),
    )


@pytest.mark.parametrize("width,block,segment", [(10, 1 << 20, 1 << 20), (10, 60, 64), (4, 200, 1 << 20)])
def test_contamination_against_all_windows(spark, rows, monkeypatch, width, block, segment):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)  # small ones need several passes
    monkeypatch.setattr(decontamination, "SHARD_WORDS", segment)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 50)
    found = contamination(*frames(spark, rows), width)
    assert found.columns == ["doc_id", "text", "n_words", "n_hit", "hits", "items"]
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found.collect()), key=str)
    assert got == expected(*rows, width)


def test_stretches_are_the_hit_words(spark, rows):
    for r in contamination(*frames(spark, rows)).collect():
        wanted, w = windows(rows[1], 10), words(r["text"])
        hit = {p for x in wanted for k in range(len(w)) if tuple(w[k : k + len(x)]) == x for p in range(k, k + len(x))}
        assert {p for h in r["hits"] for p in range(h["lo"], h["lo"] + h["n"])} == hit


def test_affected_documents_go(spark, rows):
    docs, bench = frames(spark, rows)
    stays = decontaminate(docs, bench)
    assert stays.columns == docs.columns
    clean = [(d, t) for (d, t) in rows[0] if not expected([(d, t)], rows[1], 10)[0][2]]
    assert sorted(((r["doc_id"], r["text"], r["n_words"], r["hits"]) for r in stays.collect()), key=str) == sorted(((d, t, 7, "mine") for d, t in clean), key=str)


@pytest.mark.parametrize("segment", [1 << 20, 64])
def test_longest_matches_against_all_places(spark, rows, monkeypatch, segment):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", segment)
    bench = [(i, t) for i, t in rows[1] if i is not None and i != 3]
    want = {}
    for item, text in bench:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            best = None
            for doc, other in rows[0]:
                o = words(other)
                for p in range(len(o) if doc is not None else 0):
                    size = 0
                    while k + size < len(w) and p + size < len(o) and w[k + size] == o[p + size]:
                        size += 1
                    if size >= n and (best is None or (-size, doc, p) < best):
                        best = (-size, doc, p)
            if best:
                want[str(item), k] = (-best[0], best[1], best[2])
    docs, bench = frames(spark, (rows[0], bench))
    got = {(r["item_id"], r["item_word"]): (r["n"], r["doc_id"], r["doc_word"]) for r in longest_matches(docs, bench).collect()}
    assert got == want


def test_empty_tables(spark, rows):
    docs, bench = frames(spark, rows)
    assert contamination(docs.limit(0), bench).collect() == []
    assert {r["n_hit"] for r in contamination(docs, bench.limit(0)).collect()} == {0}
    assert longest_matches(docs, bench.limit(0)).collect() == []


def test_suffixes_are_in_order():
    rng = np.random.default_rng(1)
    names = rng.integers(1, 1 << 63, 4, dtype=np.uint64)
    hashes = names[rng.integers(0, 4, 400)]
    shard = SuffixArray(hashes, np.array([0, 100, 100, 250, 400]), 64)
    suffixes = [tuple(shard.text[p : p + 64]) for p in shard.order]
    assert sorted(shard.order.tolist()) == list(range(404)) and suffixes == sorted(suffixes)
