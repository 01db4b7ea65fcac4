"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quayside.llm import spelling

SF = "/root/testdata/sf0.001"
rnd = random.Random(8)
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, shortest=5, least=3, noise=97):
    count = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if noise and h % noise == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= shortest and c >= least}
    holes = {}
    for w in n:  # words with one letter left out or blanked meet
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
        for i in range(len(w) + 1):
            holes.setdefault((w[:i], w[i:]), set()).add(w)
    out = {}
    for w in n:
        keys = [(w[:i], w[i + 1 :]) for i in range(len(w))] + [(w[:i], w[i:]) for i in range(len(w) + 1)]
        near = {v for k in keys for v in holes[k] if edits(v, w)}
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = (best if best and n[best] >= 2 * n[w] else None, len(near))
    rows = set()
    for w, (form, near) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n[w], near, n[form] if form else None))
    return rows


def got(df):
    rows = df.collect()
    assert df.columns == COLUMNS and len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


def test_query_equals_the_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = plain(docs)
    assert any(r[1] for r in expected) and any(r[1] != r[2] for r in expected if r[1])
    assert got(spelling.op12_spelling(spark, SF)) == expected


@pytest.mark.parametrize(("classes", "tile", "others"), [(1, 2048, 16384), (2, 3, 5), (5, 7, 4)])
def test_any_blocks_give_the_same(spark, classes, tile, others):
    stem = ["abcde", "abcdef", "hello", "hallo", "été" * 3, "Ünder", "x" * 5000, "x" * 5001, "x" * 4999 + "y"]
    words = stem + [w[:i] + rnd.choice(["", "a", "é", "÷"]) + w[i + 1 :] for w in stem[:6] for i in range(len(w)) for _ in range(3)]
    texts = [(None, " ".join(rnd.choices(words, k=40))) if k % 7 == 0 else (k % 5, "3".join(rnd.choices(words, k=30))) for k in range(60)]
    docs = [*texts, (1, None), (2, ""), (3, "12 ... 漢字 ab"), (4, "HELLO Hallo hello"), (4, "HELLO Hallo hello"), (None, None)]
    table = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    found = got(spelling.variants(table, shortest=4, least=2, noise=5, classes=classes, tile=tile, others=others))
    assert found == plain(docs, 4, 2, 5)


def test_empty_tables(spark):
    for rows in ([], [(1, None)], [(1, "one two")]):
        assert got(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == set()


def test_one_edit_of_all_pairs():
    words = ["", "a", "b", "ab", "ba", "aab", "aba", "abb", "abab", "abba", "aabb", "babab", "aaaaa", "aaaa", "xaaaa", "aaaax", "aaxaa"]
    raw = [w.encode() for w in words]
    size = np.array([len(w) for w in raw])
    rows = spelling._matrix(np.frombuffer(b"".join(raw), np.uint8), size, int(size.max()) + 1)
    a, b = np.divmod(np.arange(len(words) ** 2), len(words))
    near = spelling.one_edit(rows[a], size[a], rows[b], size[b])
    assert near.tolist() == [edits(words[x], words[y]) for x, y in zip(a, b, strict=True)]


def test_letter_counts_bound_the_edits():
    words = [bytes(rnd.choices(b"abcd", k=rnd.randrange(1, 7))) for _ in range(300)]
    words = sorted(set(words))
    n = np.array([rnd.randrange(1, 9) for _ in words])
    dimension = np.zeros(256, np.int64)
    dimension[[*b"abcd"]] = [0, 1, 2, 3]
    side = np.repeat([0, 1], len(words))
    a, count, b = spelling.near_in_tile(words * 2, np.tile(n, 2), side, dimension, block=17)
    found = {words[x]: (c, words[y % len(words)]) for x, c, y in zip(a.tolist(), count.tolist(), b.tolist(), strict=True)}
    for x, w in enumerate(words):
        near = [v for v in range(len(words)) if edits(words[v], w)]
        assert found.get(w) == ((len(near), words[min(near, key=lambda v: (-n[v], words[v]))]) if near else None), x
