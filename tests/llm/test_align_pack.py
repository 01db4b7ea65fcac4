"""Alignment of two tokenizers and packing into sequences, against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quayside.llm import align, packing

SF = "/root/testdata/sf0.001"
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
rnd = random.Random(21)
LONG = " ".join(rnd.choices([f"w{i}" for i in range(3000)], k=20_000))
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, LONG), (6, LONG), (6, LONG), (7, "été " * 90), (8, "a<|endoftext|>b <0x41> <s>"), (9, "x▁y"),
        (10, "▁"), (11, "a" * 5000), (11, "another text"), (None, "a text without an id"), (None, None), (12, "漢字 😀 mixed\r\nlines \x00")]


def table(spark, rows):
    """doc_id, text and columns whose names the operators use inside."""
    clash = ("key", "chunk", "copies", "length", "offset", "n_a", "q_hash")
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in clash))


def plain_alignment(docs):
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in own]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}
    held, per_doc = Counter(), []
    for d, text in docs:
        ids_a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = sp.encode(text or "")
        raw_a = [bytes(byte[c] for c in t.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            per_doc.append((d, [], [], 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([*map(len, raw_a)]).tolist(), np.cumsum([*map(len, raw_b)]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        links, j = [], 0
        for i, (x, n) in enumerate(zip(ids_a, raw_a, strict=True)):
            lo, hi = ends_a[i] - len(n), ends_a[i]
            while ends_b[j] <= lo:
                j += 1
            k = j
            while k < len(ids_b) and ends_b[k] - len(raw_b[k]) < hi:
                links.append((x, ids_b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for c in common:
            a0, b0 = i, j
            i, j = ends_a.index(c, i) + 1, ends_b.index(c, j) + 1
            groups.append(",".join(map(str, ids_a[a0:i])) + "|" + ",".join(map(str, ids_b[b0:j])))
        held.update(set(links))
        per_doc.append((d, ids_a, ids_b, len(common), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    return [(d, len(a), len(b), g, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), h) for d, a, b, g, links, h in per_doc]


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def got(df):
    return sorted(map(tuple, df.collect()), key=key)


@pytest.mark.parametrize("chunk", [align.CHUNK_BYTES, 3000])
def test_alignment_equals_the_plain_version(spark, chunk):
    found = align.align(table(spark, EDGE), A, B, chunk_bytes=chunk)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(found) == sorted(plain_alignment(EDGE), key=key)


def test_alignment_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(align.op11_alignment(spark, SF)) == sorted(plain_alignment(docs), key=key)
    assert got(align.align(spark.createDataFrame([], "doc_id long, text string"), A, B)) == []
    assert got(align.align(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def check_packing(rows, docs, capacity, end=2):
    t = Tokenizer.from_file(A)
    pieces = defaultdict(list)
    expected = []
    for d, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            expected.append((d, k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected, key=key)
    for r in rows:
        pieces[r.sequence_id].append((r.offset, r.length))
    for members in pieces.values():
        members.sort()
        assert [o for o, _ in members] == np.cumsum([0, *(n for _, n in members[:-1])]).tolist() and sum(n for _, n in members) <= capacity
    total = sum(e[3] for e in expected)
    return len(pieces), -(-total // capacity)


def test_packing_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    df = packing.op13_packing(spark, SF)
    assert df.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    used, least = check_packing(df.collect(), docs, 1024)
    assert used <= 1.03 * least + 1


@pytest.mark.parametrize(("capacity", "open_bins", "again"), [(1024, 2048, 250_000), (7, 1, 3), (64, 3, 5), (1, 2, 100)])
def test_packing_cases(spark, capacity, open_bins, again):
    docs = [e for e in EDGE if e[1] != LONG] + [(20, LONG[:3000])]
    found = packing.pack(table(spark, docs).repartition(3), A, capacity=capacity, open_bins=open_bins, again=again, with_ids=True)
    rows = found.collect()
    check_packing(rows, docs, capacity)
    ids = {(r.sequence_id, r.offset): r.ids for r in rows}
    for r in packing.sequences(found).limit(50).collect():
        if any(k[0] == r.sequence_id for k in ids):
            assert len(r.ids) <= capacity
    assert packing.pack(table(spark, []), A).collect() == []


def test_open_bins_are_best_fit_and_bounded():
    for limit in (1, 2, 5, 1000):
        bins, space, closed = packing.OpenBins(50, limit), {}, set()
        for _ in range(2000):
            n = rnd.randint(1, 50)
            fitting = [f for b, f in space.items() if f >= n]
            before = dict(space)
            b, offset = bins.place(n)
            if fitting:
                assert before[b] == min(fitting) and offset == 50 - before[b]
            else:
                assert b not in before and offset == 0
                if len(before) == limit:  # the fullest closed
                    assert before[bins.closed[0]] == min(before.values())
            space[b] = before.get(b, 50) - n
            for c in bins.closed:
                space.pop(c)
                assert c not in closed
                closed.add(c)
            bins.closed = []
            assert len(space) <= limit and all(space.values())
