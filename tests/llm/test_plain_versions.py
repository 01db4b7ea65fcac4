"""Language identification, quality scores and license matches against plain
versions: dictionaries and loops, no numpy, whole tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quayside.llm import langid, license, quality

SF = "/root/testdata/sf0.001"
EDGE = [None, "", " \n\t ", "123 !!", "x", "Word", "漢字 ひらがな", "ALL UPPER! | $%", "a\r\nb\n\n\nb\nb", "end.", "été ÉTÉ été"]


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


# -- language ---------------------------------------------------------------------

def grams(text, dims):
    shift = 32 - dims.bit_length() + 1
    raw = [b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in (text or "").encode()]
    out = Counter()
    for i in range(len(raw)):
        h = 0
        for k in (1, 2, 3):
            if i + k > len(raw):
                break
            h = (h * 0x01000193 + raw[i + k - 1] + k) % 2**32
            if (raw[i] == 32) if k == 1 else (raw[i] == 32 and raw[i + k - 1] == 32):
                continue
            out[(h * 0x9E3779B1 % 2**32) >> shift] += 1
    return out


def plain_language(model, text):
    count = grams(text, len(model.idf))
    weight = {g: math.log1p(c) * float(model.idf[g]) for g, c in count.items()}
    norm = math.sqrt(sum(w * w for w in weight.values())) or 1
    cosine = [sum(w * float(c[g]) for g, w in weight.items()) / norm for c in model.centres]
    best = max(range(len(cosine)), key=lambda j: (cosine[j], -j))
    if not any(ch.isalpha() for ch in text or ""):
        return "und", 0.0, True, cosine
    score = min(1, max(0, cosine[best]))
    return model.langs[best], score, score < model.bounds[best] * math.sqrt(min(1, len(count) / langid.FULL)), cosine


def test_language_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learned(docs)
    own = [(d, t) for d, t in documents(spark)]
    found = {r.doc_id: r for r in langid.op3_language_id(spark, SF).collect()}
    assert len(found) == len(own)
    for d, t in own:
        lang, score, rejected, cosine = plain_language(model, t)
        r = found[d]
        close = sorted(cosine)[-1] - sorted(cosine)[-2] < 1e-5 if len(cosine) > 1 else False
        assert abs(r.score - score) < 1e-4 and (r.lang_pred == lang or close)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert r.rejected == rejected or abs(score - model.bounds.max()) < 0.3
    raw = [(t or "").encode() for t in EDGE]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    langs, scores, rejected = model.predict(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, lang, score, gone in zip(EDGE, langs, scores, rejected, strict=True):
        expected = plain_language(model, t)
        assert (lang, bool(gone)) == (expected[0], expected[2]) and abs(score - expected[1]) < 1e-4, t


def test_centroids_are_clusters():
    rng = np.random.default_rng(4)
    sizes = [300, 200, 90, 10]
    centres = langid.unit(rng.normal(size=(4, 40)).astype(np.float32))
    rows = langid.unit(np.concatenate([c + 0.05 * rng.normal(size=(n, 40)) for c, n in zip(centres, sizes, strict=True)]).astype(np.float32))
    found = langid.spherical_means(rows, 4, least=0.05)
    own = (rows @ found.T).argmax(axis=1)
    assert len(found) >= 2 and np.bincount(own).min() >= 30
    # the two largest groups have a centroid of their own
    assert len({int((c @ found.T).argmax()) for c in centres[:2]}) == 2
    assert len(langid.spherical_means(rows[:1], 4)) == 1 and len(langid.spherical_means(np.repeat(rows[:1], 9, axis=0), 4)) == 1


def test_every_cluster_of_the_model_holds_its_share(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.learned(docs)
    texts = {}
    for r in docs.where("lang is not null").select("lang", "text").collect():
        texts.setdefault(r.lang, []).append((r.text or "").encode())
    for lang, raw in texts.items():
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        x = langid.weigh(langid.counts(np.frombuffer(b"".join(raw), np.uint8), off), model.idf)
        mine = [j for j, name in enumerate(model.langs) if name == lang]
        size = np.bincount((x @ model.centres[mine].T).argmax(axis=1), minlength=len(mine))
        assert size.min() >= 0.01 * len(raw), (lang, size)


# -- quality ------------------------------------------------------------------------

def plain_statistics(text):
    raw = (text or "").encode()
    share = lambda x, n: x / n if n else 0.0
    one = [bytes([b]) for b in raw]
    kind = lambda pattern: sum(bool(re.match(pattern, c, re.S)) for c in one)
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = [x for x in re.split(rb"[\r\n]", raw) if x]
    seen, at = Counter(words), Counter(lines)
    chars = Counter(raw)
    marks = {"exclamations": b"!", "pipes": b"|", "symbols": b"#$%&*+=<>@^~\\/{}_`", "sentence_marks": b".,;:?", "quotes_brackets": b"\"'()[]"}
    out = {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(words)), "log_lines": math.log1p(len(lines)),
        "word_length": share(sum(map(len, words)), len(words)), "long_words": share(sum(len(w) > 20 for w in words), len(words)),
        "line_length": math.log1p(share(sum(map(len, lines)), len(lines))),
        "upper": share(kind(rb"[A-Z]"), len(raw)), "lower": share(kind(rb"[a-z]"), len(raw)), "digit": share(kind(rb"[0-9]"), len(raw)),
        "space": share(kind(rb"[\x09-\x0D\x20]"), len(raw)), "high_bytes": share(kind(rb"[\x80-\xff]"), len(raw)),
        "other_ascii": share(kind(rb"[\x00-\x08\x0e-\x1f\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"), len(raw)),
        **{name: share(sum(c[0] in m for c in one), len(raw)) for name, m in marks.items()},
        "distinct_words": share(len(seen), len(words)), "commonest_word": share(max(seen.values(), default=0), len(words)),
        "repeated_next": share(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)),
        "distinct_lines": share(len(at), len(lines)), "repeated_lines": share(max(at.values(), default=0), len(lines)),
        "capital_words": share(sum(bool(re.match(rb"[A-Z]", w)) for w in words), len(words)),
        "all_upper_words": share(sum(bool(re.search(rb"[A-Z]", w)) and not re.search(rb"[a-z]", w) for w in words), len(words)),
        "end_marks": share(sum(w[-1:] in b".?!;:," for w in words), len(words)),
        "entropy": -sum(n / len(raw) * math.log2(n / len(raw)) for n in chars.values()) if raw else 0.0,
    }
    return [out[name] for name in quality.FEATURES]


def walk(trees, x):
    total = trees.base
    for t in range(len(trees.feature)):
        node = 0
        while trees.left[t, node] != node:
            node = trees.left[t, node] if np.float32(x[trees.feature[t, node]]) <= trees.threshold[t, node] else trees.right[t, node]
        total += trees.value[t, node]
    return 1 / (1 + math.exp(-total))


def test_quality_query_equals_the_plain_version(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.fitted(quality.described(docs), labels)
    found = {r.doc_id: r for r in quality.op10_quality(spark, SF).collect()}
    own = documents(spark)
    assert len(found) == len(own)
    for d, t in own:
        score = walk(trees, plain_statistics(t))
        r = found[d]
        assert abs(r.score - score) < 1e-6 and r.predicted == int(score >= 0.5) and r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
    raw = [(t or "").encode() for t in EDGE]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), off)
    for t, row in zip(EDGE, got, strict=True):
        assert row.tolist() == pytest.approx(plain_statistics(t), abs=1e-6), t


def test_quality_repeated_null_and_clashing_labels(spark):
    rows = [(i, ("good text of words. " if i % 2 else "$$$ ### junk!!! ") * (1 + i % 7), "x") for i in range(300)]
    rows += [(0, f"copy {k} of id 0", "x") for k in range(40)] + [(None, "no id", "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y string")
    labels = [(i, i % 2, None) for i in range(300)] + [(0, 1, 1), (0, None, 0), (None, 1, 1), (5, 0, 0), (9999, 1, 0)]
    found = quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, features int"))
    out = found.collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out and r.doc_id not in (0, 5, 7)]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)


# -- licenses -------------------------------------------------------------------------

def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def whole_alignment(doc, template):
    """(matched, start, end) of the best local alignment, no band."""
    best, above = (0, 0, 0, 0), {}
    for word in template:
        row = {}
        for d, w in enumerate(doc):
            score, matched, start = above.get(d - 1, (0, 0, d))
            cell = (score + 2, matched + 1, start) if w == word else (score - 1, matched, start)
            for score, matched, start in (above.get(d, (0, 0, d)), row.get(d - 1, (0, 0, d))):
                if score - 1 > cell[0]:
                    cell = (score - 1, matched, start)
            if cell[0] > 0:
                row[d] = cell
                if cell[0] > best[0]:
                    best = (*cell, d + 1)
        above = row
    return best[1:]


def plain_licenses(text):
    doc, found = words_of(text), []
    have = set(doc)
    for name, notice in license.TEMPLATES:
        template = words_of(notice)
        if sum(w in have for w in template) < license.COVERAGE * len(template):
            continue  # no alignment can match so many
        todo = [(0, doc)]
        while todo:
            at, part = todo.pop()
            matched, start, end = whole_alignment(part, template)
            if matched >= license.COVERAGE * len(template):
                found.append((matched, matched / len(template), name, at + start, at + end))
                todo += [(at, part[:start]), (at + end, part[end:])]
    found.sort(key=lambda f: (-f[0], -f[1], f[3], f[2]))
    kept = []
    for _, share, name, a, b in found:
        if all(b <= x or a >= y for _, _, x, y in kept):
            kept.append((name, share, a, b))
    return kept


def test_license_query_equals_a_whole_alignment_of_every_template(spark):
    own = documents(spark)
    notices = dict(license.TEMPLATES)
    expected = sorted((d, *m) for d, t in own for m in plain_licenses(t))
    found = sorted((r.doc_id, r.license, r.coverage, r.start_word, r.end_word) for r in license.op2_license_scan(spark, SF).collect())
    assert found == expected and found
    # notices within other text, changed, parted, and twice
    words = notices["mit-text"].split()
    texts = [f"one two {notices['isc']} three {notices['mit']} four", " ".join(w for i, w in enumerate(words) if i % 9), " ".join(w if i % 11 else f"{w} extra" for i, w in enumerate(words)),
             f"{notices['gpl-2.0']} between {notices['gpl-2.0']}", " ".join(words[: len(words) // 2]), " ".join("ab"[bin(i).count("1") % 2] for i in range(1024))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r.doc_id, r.license, r.coverage, r.start_word, r.end_word) for r in license.license_matches(table).collect())
    assert found == sorted((d, *m) for d, t in enumerate(texts) for m in plain_licenses(t))
