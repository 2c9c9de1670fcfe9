"""Operators on documents: brute force on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from streetlens.llm import jaccard_join, substring_dedup
from streetlens.llm.jaccard_join import jaccard_components
from streetlens.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, hub long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    make = lambda n: [word() for _ in range(n)]
    passage = make(70)
    rows = []
    for _ in range(30):
        rows.append(make(rng.randint(1, 160)))
    for base in list(rows[:10]):
        for _ in range(3):
            near = list(base)
            for _ in range(max(1, len(near) // 40)):
                near[rng.randrange(len(near))] = word()
            rows.append(near)
    rows += [list(rows[3]), list(rows[3]), make(20) + passage + make(25), make(7) + passage, passage + make(3), passage[5:60], make(6000)]
    rows += [make(30) + passage[10:] + make(40) for _ in range(6)]
    out = [" ".join(r) for r in rows]
    out[4] = out[4].replace(" ", "\n", 2).upper()
    out += [None, "", " \t\n", "one", "ONE", "one two three", "a" * 30000, "x " * 120, "x " * 130]
    ids = list(range(len(out)))
    rng.shuffle(ids)
    return list(zip(ids, out))


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    top = {i: i for i, _ in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(i), root(j)
                top[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets}


def test_jaccard_against_all_pairs(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, texts)).collect()}
    assert got == components(texts)


def test_jaccard_hot_pieces_and_blocks(spark, texts, monkeypatch):
    # small limits send every group through the ways for large ones
    monkeypatch.setattr(jaccard_join, "HOT", 1)
    monkeypatch.setattr(jaccard_join, "SKETCH_BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "SET_BLOCK", 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, texts)).collect()}
    assert got == components(texts)


def test_jaccard_odd_rows(spark):
    rows = [(None, "a b c d e f"), (1, None), (2, ""), (7, "a b c d e f"), (7, "q r s t u v"), (5, "Q r s t u v"), (5, "Q r s t u v")]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None), (1, 0, 1), (2, 0, 2), (7, 2, 5), (7, 2, 5), (5, 2, 5), (5, 2, 5)], key=str)
    assert jaccard_components(frame(spark, [])).collect() == []


def repeats(rows, depth):
    starts = defaultdict(list)
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - depth + 1):
            if i is not None:
                starts[tuple(w[k : k + depth])].append(i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - depth + 1):
            if i is not None and min(starts[tuple(w[k : k + depth])]) < i:
                gone.update(range(k, k + depth))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def kept(spark, rows, depth=50):
    found = remove_repeats(frame(spark, rows), depth)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "hub", "n_words", "n_removed", "kept"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("depth", [50, 12])
def test_repeats_against_all_windows(spark, texts, depth):
    assert kept(spark, texts, depth) == repeats(texts, depth)


def test_repeats_of_large_groups(spark, texts, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", 0)  # every group is split by whole windows
    assert kept(spark, texts) == repeats(texts, 50)


def test_repeats_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(None, long), (3, long), (3, long), (3, "z " + long), (2, None), (9, long.replace(" ", "\t"))]
    assert kept(spark, rows) == repeats(rows, 50)
    assert kept(spark, []) == []


def test_segments_of_giant_texts(monkeypatch, spark, texts):
    monkeypatch.setattr(substring_dedup, "SEGMENT", (1 << 7) - 1)  # texts are longer than a segment
    assert kept(spark, texts) == repeats(texts, 50)


def test_digest_is_of_the_kept_words(spark, tmp_path):
    from streetlens.llm.op1 import op1_substring_dedup

    frame(spark, [(1, "a  b\nc")]).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    row = op1_substring_dedup(spark, str(tmp_path)).first()
    assert row["kept_sha256"] == hashlib.sha256(b"a b c").hexdigest()
