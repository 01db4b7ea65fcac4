"""Operators over documents: brute force, and the cases every operator defines."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import decontamination, near_duplicates, repeated_bytes, repeated_words
from tokenizers import Tokenizer

from quayside.llm import bpe, common, debruijn, decontaminate, langid, license, neardup, quality, suffixdedup, tokenfile

SF = "/root/testdata/sf0.001"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")
rnd = random.Random(11)
LONG = " ".join(rnd.choices([f"w{i}" for i in range(3000)], k=40_000))
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, LONG), (6, LONG), (6, LONG), (7, "été " * 90), (8, "été " * 90 + "x"),
    (9, "12 !! 34"), (10, "Released under the MIT License."), (11, "a" * 5000), (11, "other text under a repeated id"), (None, "a text without an id " * 20),
    (12, "漢字 😀 <|endoftext|> mixed\r\nlines"),
]
CLASH = ("uid", "spans", "q_uid", "q_text", "n_words", "anchor", "member", "bucket", "score", "hit", "kept")


def table(spark, rows):
    """doc_id, text and columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *[f"x{i}" for i in range(len(CLASH))], None) for r in rows],
                                 "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASH) + ", n_chars long")


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def got(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=key)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").orderBy("doc_id").collect()]


# -- decontamination --------------------------------------------------------

def test_decontamination_equals_brute_force(spark):
    items = [(1, " ".join(f"w{i}" for i in range(30))), (2, "short item"), (3, None), (4, "..."), (5, LONG[:400]), (5, LONG[:400]), (6, "word")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "n_items", "contaminated"]
    for block in (1 << 24, 60):
        found = decontaminate.hits(table(spark, EDGE), bench, keep=["doc_id"], block_bytes=block)
        assert got(found, *cols) == sorted(((d, n, h, i, c) for d, n, h, i, _, c in decontamination(EDGE, items)), key=key)
    real = documents(spark)
    q = decontaminate.op1_decontamination(spark, SF)
    bench_rows = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got(q, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(decontamination(pairs(real), bench_rows), key=key)


def test_decontamination_longest_matches_and_removal(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "a b " + text + " c"), (2, " ".join(text.split()[5:20])), (3, "nothing here"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, text)], "item_id long, text string")
    best = {(r.item_word): (r.n_words, r.n_places, r.doc_id, r.doc_word) for r in decontaminate.longest_matches(docs, bench).collect()}
    assert best[0] == (40, 1, 1, 2) and best[5] == (35, 1, 1, 7) and best[30] == (10, 1, 1, 32) and 31 not in best
    assert got(decontaminate.remove_contaminated(docs, bench), "doc_id") == [(3,), (4,)]
    empty = bench.limit(0)
    assert decontaminate.remove_contaminated(docs, empty).count() == 4
    assert decontaminate.hits(docs.limit(0), bench).count() == 0 and decontaminate.longest_matches(docs, empty).count() == 0


# -- licenses ----------------------------------------------------------------

def test_license_matches(spark):
    notice = dict(license.TEMPLATES)
    changed = notice["mit-text"].replace("free of charge", "at no cost").replace("without limitation ", "")
    rows = [(1, "x " + notice["mit"] + " y"), (2, "Some header. " + changed + " tail"), (3, notice["gpl-3.0"] * 3), (4, "licensed to nobody"), *EDGE]
    found = license.license_matches(table(spark, rows))
    by = {}
    for r in found.collect():
        by.setdefault(r.doc_id, []).append((r.license, round(r.coverage, 2), r.start_byte, r.end_byte))
    assert by[1] == [("mit", 1.0, 2, 2 + len(notice["mit"]) - 1)]
    assert by[2][0][0] == "mit-text" and 0.9 < by[2][0][1] < 1 and by[2][0][2] == len("Some header. ")
    assert [m[0] for m in by[3]] == ["gpl-3.0"] * 3 and 4 not in by and by[10][0][0] == "mit"
    assert license.license_matches(table(spark, rows), templates=[]).count() == 0
    assert license.license_matches(table(spark, []), templates=[("a", None), ("b", "two words")]).count() == 0


def _scanned(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    by = {}
    for r in license.license_matches(rows, **options).collect():
        by.setdefault(r.doc_id, []).append((r.license, r.coverage, r.start_word, r.end_word))
    return by


def test_licenses_with_a_changed_or_an_inserted_word(spark):
    texts, expected = [], []
    for name, notice in license.TEMPLATES:
        words = re.findall("[a-z0-9]+", notice.lower())
        for i in range(1, len(words) - 1):
            texts += [" ".join(["so", *words[:i], "zzz", *words[i + 1:], "so"]), " ".join(["so", *words[:i], "zzz", *words[i:], "so"])]
            expected += [(name, 1 - 1 / len(words), 1, 1 + len(words)), (name, 1.0, 1, 2 + len(words))]
    texts += ["Released under an MIT License.", "released under the new MIT License", "all of it Released x under y the MIT License"]
    by = _scanned(spark, texts, templates=license.TEMPLATES)
    for i, (name, share, a, b) in enumerate(expected):
        # another template that covers as many words, or a whole shorter one, may stand in the same place
        assert any(n == name and c == pytest.approx(share) and (s, e) == (a, b) for n, c, s, e in _scanned_one(texts[i], name)), texts[i]
        assert by[i], texts[i]
    # the last drifts by more than the band of a template of five words
    assert [by[len(expected) + i][0][:2] for i in range(3)] == [("mit", 0.8), ("mit", 1.0), ("mit", 0.8)]


def _scanned_one(text, name):
    """Matches of one template alone, without Spark."""
    index = license.TemplateIndex([(name, dict(license.TEMPLATES)[name])])
    buf = np.frombuffer(text.encode(), np.uint8)
    starts, ends, first = license.C.word_spans(buf, np.array([0, len(buf)]), license._WORD)
    codes = license.C.word_hashes(buf, starts, ends)
    at, hashed = license.all_fingerprints(codes, first)
    which, template, place = index.hits(hashed)
    return [(name, share, a, b) for share, _, a, b in license.matches_of(codes, index, at[which], template, place, license.BAND, license.COVERAGE)]


def test_license_of_two_words_inside_a_text(spark):
    by = _scanned(spark, ["a text with two words in it", "two", "two words"], templates=[("b", "Two words")])
    assert by == {0: [("b", 1.0, 3, 5)], 2: [("b", 1.0, 0, 2)]}


# -- language ----------------------------------------------------------------

def test_every_language_gets_centroids(spark):
    draw = random.Random(5)
    rows = []
    for n in range(230):
        own = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(draw.choices(own, k=60)), f"l{n:03d}") for i in range(12 if n < 200 else 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learned(docs)
    assert model.langs == sorted(model.langs) and set(model.langs) == {r[2] for r in rows}
    found = langid.predicted(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.99 * len(rows)
    assert sum(r.rejected for r in found) <= 0.01 * len(rows)


def test_language_identification(spark):
    q = langid.op3_language_id(spark, SF)
    rows = q.join(documents(spark).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and all(0 <= r.score <= 1 for r in rows)
    model = langid.learned(documents(spark))
    out = langid.predicted(table(spark, [*EDGE, (20, "qqqq zzzz xxxx " * 60)]), model, keep=["doc_id"])
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score, r.rejected))
    for i in (1, 2, 3, 9):
        assert by[i] == [("und", 0.0, True)]
    assert by[20][0][2] and not by[10][0][2]
    assert langid.predicted(table(spark, EDGE), langid.learned(table(spark, []).withColumnRenamed("kept", "lang")), stay=True).count() == 0
    kept = langid.predicted(table(spark, EDGE), model, stay=True)
    assert kept.columns == table(spark, EDGE).columns


# -- near copies ---------------------------------------------------------------

def test_near_duplicates_equal_brute_force(spark):
    base = [f"w{i}" for i in range(60)]
    family = [(100 + i, " ".join(rnd.choice(base) if rnd.random() < 0.02 * (i % 9) else w for w in base)) for i in range(150)]
    rows = pairs(documents(spark)) + [(10_000 + d, t) for d, t in family]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found.collect()} == near_duplicates(rows)


def test_near_duplicates_defined_cases(spark):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.near_duplicates(table(spark, EDGE)).collect()}
    assert found[1, 0] == (1, True) and found[2, 0] == (2, True) and found[3, 0] == (3, True)
    assert found[6, found_size(found, 5)][0] == 5 and found[8, 2] == (8, True)
    stay = neardup.keep_one(table(spark, EDGE))
    assert stay.columns == table(spark, EDGE).columns
    ids = [r.doc_id for r in stay.collect()]
    assert 6 not in ids and {1, 2, 3, 5, 7, 8, 11} <= set(ids)
    assert neardup.near_duplicates(table(spark, [])).count() == 0


def found_size(found, doc):
    return next(n for d, n in found if d == doc)


def test_sketches_are_filled_and_estimate(spark):
    a = np.sort(np.unique(np.random.default_rng(1).integers(0, 1 << 62, 3000, dtype=np.uint64)))
    b = np.sort(np.concatenate([a[:2700], np.random.default_rng(2).integers(0, 1 << 62, 300, dtype=np.uint64)]))
    one = a[:1]
    s = neardup.sketches(np.concatenate([a, b, one]), np.array([0, len(a), len(a) + len(b), len(a) + len(b) + 1]))
    assert (s != neardup._EMPTY).all()
    share = (s[0] == s[1]).mean()
    assert abs(share - 2700 / 3300) < 0.15


# -- tokens ----------------------------------------------------------------------

def library():
    return Tokenizer.from_file(VOCAB)


def test_bpe_equals_the_library(spark):
    import hashlib

    t = library()
    alphabet = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "a", "é", "'s", "'ll", "1", "²", "!", "<|endoftext|>", "the", "\0", "漢", "😀", "x" * 70]
    rows = EDGE + [(1000 + i, "".join(rnd.choices(alphabet, k=rnd.randint(0, 14)))) for i in range(1500)]
    rows = [(i, t_) for i, (_, t_) in enumerate(rows)]
    out = bpe.encode(table(spark, rows), VOCAB)
    by = {r.doc_id: r for r in bpe.decode_ids(out, VOCAB, out="back").collect()}
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert by[d].ids == ids and by[d].n_tokens == len(ids) and by[d].back == (text or "")
        assert by[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by[d].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(table(spark, []), VOCAB).count() == 0


def test_segment_trees_agree():
    v = bpe.Vocabulary(open(VOCAB, encoding="utf-8").read())
    words = ["".join(rnd.choices("abcdefgh ", k=rnd.randint(2, 64))).encode() for _ in range(300)]
    byte = np.zeros((len(words), 64), np.uint8)
    for i, w in enumerate(words):
        byte[i, : len(w)] = np.frombuffer(w, np.uint8)
    flat, n = bpe.merge_many(v, byte, np.array([len(w) for w in words]))
    for part, w in zip(np.split(flat, np.cumsum(n)[:-1]), words, strict=True):
        assert part.tolist() == bpe.merge_one(v, v.byte_id[np.frombuffer(w, np.uint8)].tolist())


def test_token_file_round_trip_and_random_access(spark, scratch):
    t = library()
    rows = sorted([(d, x) for d, x in EDGE if d is not None and d not in (6, 11)])
    path = f"{scratch}/tokens"
    tokenfile.write_ids(table(spark, rows), VOCAB, path, shard_tokens=5000)
    found = {r.doc_id: r for r in tokenfile.read_ids(spark, path).collect()}
    whole, at = [], 0
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        r = found[d]
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
        whole += ids
    for lo, hi in ((0, 7), (100, 1500), (len(whole) - 5, len(whole) + 9), (3, 3)):
        part = sorted((r.start, r.ids) for r in tokenfile.read_range(spark, path, lo, hi).collect())
        assert [x for _, ids in part for x in ids] == whole[lo:hi]
    tokenfile.write_ids(table(spark, []), VOCAB, f"{path}0")
    assert tokenfile.read_ids(spark, f"{path}0").count() == 0


def test_reading_token_files_shuffles_no_shard(spark, scratch):
    path = f"{scratch}/ids"
    tokenfile.write_ids(table(spark, [(i, f"text {i}") for i in range(20)]), VOCAB, path)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    try:
        for df in (tokenfile.read_ids(spark, path), tokenfile.read_range(spark, path, 0, 30)):
            assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
            assert df.count() > 0
    finally:
        for n in names:
            spark.conf.unset(n)


def test_grammar_round_trip():
    for _ in range(60):
        ids = np.array(rnd.choices(range(rnd.choice([1, 2, 5, 40])), k=rnd.randint(0, 300)), np.int64)
        rules, seq = tokenfile.repair(ids, 50, 2)
        lengths = tokenfile.expansion_lengths(rules, 50)
        assert tokenfile.expand(rules, lengths, seq, 50).tolist() == ids.tolist()
        lo, hi = sorted(rnd.choices(range(len(ids) + 1), k=2))
        assert tokenfile.expand_range(rules, lengths, seq, 50, lo, hi).tolist() == ids[lo:hi].tolist()


# -- repeated passages -------------------------------------------------------------

def synthetic(n=120):
    letters = "a b c d".split()
    base = " ".join(rnd.choices("abcdefghijklmnop", k=120))
    rows = [(i, " ".join(rnd.choices(letters, k=rnd.randint(0, 60)))) for i in range(n)]
    rows += [(1000 + i, base[: rnd.randint(0, 200)] + " " + rnd.choice(letters) + " " + base[rnd.randint(0, 200) :]) for i in range(n // 2)]
    return rows


@pytest.mark.parametrize(("window", "anchor"), [(6, 2), (9, 4)])
def test_word_passages_equal_brute_force(spark, window, anchor):
    rows = synthetic()
    found = debruijn.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), window, anchor=anchor, with_text=False)
    assert got(found) == sorted(repeated_words(rows, window))


def test_word_passages_defined_cases(spark):
    found = debruijn.deduplicated(table(spark, EDGE))
    rows = {(r.doc_id, r.n_words): (r.n_removed, r.kept) for r in found.collect()}
    assert rows[1, 0] == (0, "") and rows[5, 40_000][0] == 0 and rows[6, 40_000] == (40_000, "") and rows[8, 91][0] == 90
    assert rows[None, 100][0] == 0 and found.count() == len(EDGE)
    assert debruijn.deduplicated(table(spark, [])).count() == 0
    q = debruijn.op6_de_bruijn(spark, SF)
    assert got(q) == sorted(repeated_words(pairs(documents(spark)), 50))


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("size", [64, 65, 1024, 4096])
def test_words_on_which_polynomial_hashes_collide(spark, size):
    one, two = thue_morse(size), thue_morse(size, "b", "a")
    heads = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{heads} {one}"), (2, f"{heads} {two}"), (3, f"p q r {one}"), (4, f"p q r {two}"), (5, f"{heads} {one}")]
    table_ = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(debruijn.deduplicated(table_, with_text=False)) == sorted(repeated_words(rows, 50))
    brute = near_duplicates(rows)
    assert got(neardup.near_duplicates(table_).drop("uid")) == sorted((d, n, c, k) for d, (n, c, k) in brute.items())
    assert got(suffixdedup.measured(table_)) == sorted(repeated_bytes(rows, 200))
    buf = np.frombuffer((one + two).encode(), np.uint8)
    for second in (False, True):
        a, b = common.word_hashes(buf, np.array([0, size]), np.array([size, 2 * size]), second)
        assert a != b


def test_prime_hashes_of_ranges():
    codes = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64)
    codes = np.concatenate([codes, codes[40:90], codes[:7]])
    hashed = common.PrimeHash(codes)
    assert hashed.of(np.array([40]), np.array([90])) == hashed.of(np.array([300]), np.array([350]))
    lo = np.repeat(np.arange(len(codes)), 5)
    n = np.tile([1, 2, 3, 10, 50], len(codes))
    some = lo + n <= len(codes)
    lo, hi = lo[some], (lo + n)[some]
    found = {}
    for a, b, h in zip(lo, hi, hashed.of(lo, hi).tolist(), strict=True):
        assert found.setdefault(h, codes[a:b].tobytes()) == codes[a:b].tobytes()
    # Thue-Morse sequences of codes collide modulo 2^64, not here
    seq = np.array([bin(i).count("1") % 2 for i in range(4096)], np.uint64)
    both = np.concatenate([seq, 1 - seq])
    a, b = common.PrimeHash(both).of(np.array([0, 4096]), np.array([4096, 8192]))
    assert a != b


def test_halves_of_a_segment_share_the_bytes_around_their_anchor():
    length, anchor = 20, 4
    for _ in range(300):
        text = "".join(rnd.choices("ab", k=60)).encode()
        off = rnd.randint(0, length - anchor)
        windows = rnd.randint(1, off + 1)
        todo, ends = [(0, off, 0, length - anchor, text[: windows + length - 1])], 0
        while todo:
            first, at, a, b, segment = todo.pop()
            if a == b:
                ends += len(segment) - length + 1
                assert len(segment) == length
                continue
            for start, at2, a2, b2, _key, part in suffixdedup.halves(segment, at, a, b, length):
                assert part == segment[start : start + len(part)] and b2 - a2 < b - a
                for i in range(len(part) - length + 1):  # each window holds its anchor between a2 and b2
                    assert a2 <= at2 - i <= b2
                todo.append((first + start, at2, a2, b2, part))
        assert ends == windows


@pytest.mark.parametrize(("length", "anchor", "hot"), [(12, 4, 2048), (20, 8, 2), (20, 4, 1)])
def test_byte_strings_equal_brute_force(spark, length, anchor, hot):
    rows = synthetic(60)
    found = suffixdedup.measured(spark.createDataFrame(rows, "doc_id long, text string"), length, anchor=anchor, hot=hot, shard_bytes=3000)
    assert got(found) == sorted(repeated_bytes(rows, length))


def test_byte_strings_defined_cases(spark):
    rows = [(d, t) for d, t in EDGE if t != LONG] + [(5, LONG[:3000]), (6, LONG[:3000]), (6, LONG[:3000])]
    assert got(suffixdedup.measured(table(spark, rows))) == sorted(repeated_bytes(rows, 200), key=key)
    assert got(suffixdedup.op7_suffix_array(spark, SF)) == sorted(repeated_bytes(pairs(documents(spark)), 200))
    cut = suffixdedup.without_repeats(table(spark, rows))
    assert cut.columns == table(spark, rows).columns and cut.count() == len(rows)
    texts = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    assert texts[1][0] is None and texts[4][0] == "word" and texts[5] == ("", 0) and texts[12][0].startswith("漢字")
    assert suffixdedup.measured(table(spark, [])).count() == 0


def test_repeated_windows_by_interval_expansion():
    import collections

    for trial in range(40):
        length = rnd.choice([5, 8, 20])
        segs = ["".join(rnd.choices(rnd.choice(["ab", "abc"]), k=rnd.randint(1, 60))).encode() for _ in range(rnd.randint(1, 12))]
        count = np.array([rnd.choice([1, 1, 2]) for _ in segs])
        seen = collections.Counter()
        for s, n in zip(segs, count, strict=True):
            for i in range(len(s) - length + 1):
                seen[s[i : i + length]] += n
        expect = [[seen[s[i : i + length]] > 1 for i in range(max(0, len(s) - length + 1))] for s in segs]
        assert [m.tolist() for m in suffixdedup.repeated_windows(segs, count, length)] == expect, trial


# -- quality ---------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op10_quality(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert quality.quality(table(spark, EDGE), labels).count() == len(EDGE)
    assert quality.quality(table(spark, []), labels).count() == 0
    alone = quality.quality(table(spark, EDGE), labels.limit(0)).collect()
    assert {r.score for r in alone} == {0.5}


def test_trees_learn_and_traverse():
    g = np.random.default_rng(5)
    x = g.random((4000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = quality.fit_trees(x[:3000], y[:3000])
    assert ((trees.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
