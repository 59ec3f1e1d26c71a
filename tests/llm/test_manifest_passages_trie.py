"""Merkle manifest, substring dedup and conversation trie against plain versions, and on the edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerflow.llm import merkle, ordered, rlz_dedup, zfast_trie
from layerflow.llm.common import written

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# ---------------------------------------------------------------- ordered places

def test_places_and_running_totals_span_tasks(spark):
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.randrange(1 << 40), rng.randrange(100)) for i in range(5000)]
    df = written(spark.createDataFrame(data, "g string, o bigint, x bigint, s bigint").repartition(7), "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(ordered.numbered(df, ["g"], ["o"], "n", sums=("s",), xors=("x",)), "g", "o", "_pos", "_run_s", "_run_x")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, seen = [], {}
    for g, o, x, s in sorted(data, key=lambda r: r[1]):
        n, a, b = seen.get(g, (0, 0, 0))
        want.append((g, o, n, a + s, b ^ x))
        seen[g] = (n + 1, a + s, b ^ x)
    assert got == sorted(want, key=repr)


# ---------------------------------------------------------------- Merkle manifest

def joined(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def piece(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_manifest(records):
    low = lambda t: None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    trees = collections.defaultdict(list)
    for d, s, lang, n, t in records:
        leaf = joined(*map(piece, (d, s, lang, n, t)))
        hit = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        trees[lang].append((d, leaf, joined(*map(piece, (d, s, lang, n, low(t)))) if hit else leaf))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([joined(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    built = {x: levels([r[1] for r in trees[x]]) for x in langs}
    top = levels([built[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for i, (d, leaf, now) in enumerate(trees[lang]):
            siblings = []
            for tree, k in ((built[lang], i), (top, at)):
                for level in tree[:-1]:
                    run, slot = level[k // 8 * 8:k // 8 * 8 + 8], k % 8
                    siblings += run[:slot] + run[slot + 1:]
                    now = joined(*run[:slot], now, *run[slot + 1:])
                    k //= 8
            out.append((d, leaf, built[lang][-1][0], top[-1][0], joined(*siblings), now, now == top[-1][0]))
    return sorted(out, key=repr)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("broadcast_bytes", [8 << 20, 30_000, 0])
def test_manifest(spark, broadcast_bytes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(merkle.manifest(docs, broadcast_bytes)) == brute_manifest([tuple(r) for r in docs.select(*FIELDS).collect()])


def test_manifest_edge_cases(documents, clashing, nothing):
    extra = {"n_chars": F.length("text").cast("bigint")}
    plain = documents.withColumns(extra)
    want = brute_manifest([tuple(r) for r in plain.select(*FIELDS).collect()])
    assert rows(merkle.manifest(plain)) == want == rows(merkle.manifest(clashing.withColumns(extra | {"place": F.lit(1), "tree": F.lit("t")})))
    assert merkle.manifest(nothing.withColumns(extra)).count() == 0
    one = plain.filter("doc_id = 6")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == joined()


def test_manifest_of_many_langs(spark):
    data = [(i, "s", f"l{i % 70}", 1, f"Text {i}") for i in range(200)]
    df = spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    for broadcast_bytes in (8 << 20, 4000):
        assert rows(merkle.manifest(df, broadcast_bytes)) == brute_manifest(data)


# ---------------------------------------------------------------- substring dedup

def brute_passages(pairs, window=50):
    words = [(LAST if d is None else d, d, WORD.findall(t or "")) for d, t in pairs]
    first: dict = {}
    for k, _, w in words:
        for i in range(len(w) - window + 1):
            s = tuple(w[i:i + window])
            first[s] = min(first.get(s, LAST), k)
    out = []
    for k, d, w in words:
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < k for j in range(i, i + window)}
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


PASSAGE = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_passages_of_shared_texts(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefgh") + rng.choice("aeiouy")
    shared = [[word() for _ in range(rng.choice([50, 51, 80, 200]))] for _ in range(5)]
    data = [(None, " ".join(shared[0])), (None, " ".join(shared[0])), (3, None), (4, "")]
    for i in range(120):
        text: list = []
        for _ in range(rng.randrange(4)):
            text += [word() for _ in range(rng.randrange(60))]
            passage = list(rng.choice(shared))
            if rng.random() < 0.4:
                passage[rng.randrange(len(passage))] = "edit"
            text += passage[rng.randrange(8):]
        data.append((i + 10, rng.choice([" ", "\n", "\t "]).join(text)))
    data += [(50, " ".join(shared[1])), (50, " ".join(shared[1]) + " more"), (51, "x " * 400), (52, "y x " * 300 + "x " * 60)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(rlz_dedup.remove_passages(df), *PASSAGE) == brute_passages(data)


def test_passages_when_tables_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr("layerflow.llm.common.BROADCAST_BYTES", 0)
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    docs = written(docs, "docs")
    assert rows(rlz_dedup.remove_passages(docs), *PASSAGE) == brute_passages([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("window,gram", [(6, 3), (9, 9), (5, 1)])
def test_short_windows_over_few_words(spark, window, gram):
    rng = random.Random(window)
    data = [(i // 2, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(rlz_dedup.remove_passages(df, window, gram), *PASSAGE) == brute_passages(data, window)


def test_passages_edge_cases(documents, clashing, nothing):
    want = brute_passages([(r.doc_id, r.text) for r in documents.collect()])
    assert rows(rlz_dedup.remove_passages(documents), *PASSAGE) == want == rows(rlz_dedup.remove_passages(clashing), *PASSAGE)
    assert rlz_dedup.remove_passages(nothing).count() == 0
    kept = {r.doc_id: r for r in rlz_dedup.remove_passages(documents, keep_text=True).collect()}
    assert kept[7].kept_text == "" or kept[7].n_removed == 6000
    assert kept[7].n_factors == 1  # one factor for the whole shared text


def test_anchor_is_the_leftmost_least():
    rng = np.random.default_rng(1)
    for width in (1, 2, 5, 35):
        values = rng.integers(0, 6, 200)
        want = [i + int(np.argmin(values[i:i + width])) for i in range(len(values) - width + 1)]
        assert rlz_dedup.leftmost_least(values, width).tolist() == want


# ---------------------------------------------------------------- conversation trie

def brute_trie(records):
    turns = collections.defaultdict(list)
    for c, t, r, x in records:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).digest(), x or ""))
    said = {c: [(v[2], v[4]) for v in sorted(vs)] for c, vs in turns.items()}
    whole = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = said.get(c - c % 5, [])[:h] + said[c][h:]
    nodes = collections.defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    children = collections.Counter(k[:-1] for k in nodes if k)
    saved, leaves = collections.Counter(), collections.Counter()
    for k, m in nodes.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += children[k] == 0
    ends = lambda k, m: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(whole[c]) == len(k)))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], ends(k, m)) for k, m in nodes.items()), key=repr)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("seed,batches", [(1, (10, 20, 64)), (2, (64,)), (3, (1, 64))])
def test_trie_of_branching_conversations(spark, seed, batches):
    rng = random.Random(seed)
    data = []
    for c in range(90):
        for t in range(rng.choice([1, 2, 3, 9, 17, 33])):
            text = rng.choice(["a", "é", None]) if rng.random() < 0.1 * seed else "same"
            data.append((c, rng.choice([None, t, t]), rng.choice(["u", None]), text))
    df = spark.createDataFrame(data, CONVERSATIONS)
    assert rows(zfast_trie.prefix_trie(df, batches)) == brute_trie(data)


def test_trie_edge_cases(spark):
    names = ["c", "d", "n", "k1", "e", "rep", "bytes", "_pos"]
    data = [(None, 0, "u", "lost"), (1, None, None, None), (1, 0, "u", ""), (5, 0, "u", "hi"), (5, 0, "u", "hi"), (6, 1, "u", "x" * 200_000), (7, 0, "u", "hi"), (8, 3, "u", "own")]
    data += [(10 + 5 * i, t, "u", "copy") for i in range(40) for t in range(3)]
    df = spark.createDataFrame(data, CONVERSATIONS)
    assert rows(zfast_trie.prefix_trie(df)) == brute_trie(data) == rows(zfast_trie.prefix_trie(df.withColumns({c: F.lit("x") for c in names})))
    assert zfast_trie.prefix_trie(df.limit(0)).count() == 0


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", zfast_trie.fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in df.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: (x & -x, x))
