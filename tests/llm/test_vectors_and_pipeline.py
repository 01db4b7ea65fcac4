import numpy as np
import pytest
from brute import decontamination, near_duplicates, repeated_bytes

import corpus_pipeline
from quayside.llm import ann, langid

SF = "/root/testdata/sf0.001"


def test_neighbours_recall_and_scores(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    by = {}
    for r in ann.op8_ann(spark, sf).collect():
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    recall = []
    assert sorted(by) == [i for i in ids.tolist() if i % 20 == 0]
    for q, found in by.items():
        score = (v * v[ids == q][0]).sum(axis=1)
        score[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - score[ids == i][0]) < 1e-12 for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        recall.append(len(best & {f[1] for f in found}) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize(("spread", "longest"), [(0.25, 1), (0.5, 1), (1, 1), (0, 5)])
def test_neighbours_recall_with_varying_norms(spark, spread, longest):
    draw = np.random.default_rng(3)
    v = draw.standard_normal((10_000, 64))
    v *= np.exp(spread * draw.standard_normal((len(v), 1))) / np.sqrt((v * v).sum(axis=1, keepdims=True))
    v[7] *= longest
    asked = np.arange(0, len(v), 125)
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>")
    by = {}
    for r in ann.nearest(df, df.where("vec_id % 125 = 0")).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    score = v[asked] @ v.T
    score[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert all(len(found) == 20 for found in by.values())
    recall = np.mean([len(by[int(q)] & set(b.tolist())) / 20 for q, b in zip(asked, best, strict=True)])
    assert recall >= 0.9, recall


def test_an_id_of_many_vectors_is_one_neighbour(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [1.0, i / 100]) for i in range(30)] + [(i, [0.5, i / 10]) for i in range(2, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [r.vec_id for r in ann.nearest(df, k=3).orderBy("rank").collect()] == [1, 2, 3]


def test_neighbours_defined_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]),
            (7, [float("inf"), 1.0]), (8, [1.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (None, [1.0, 1.0]), (9, [])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")
    found = sorted(tuple(r) for r in ann.nearest(df).collect())
    assert found == [(0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 20, 0.0), (20, 1, 2, 0.5), (20, 2, 0, 0.0), (20, 3, 1, 0.0)]
    assert ann.nearest(df.limit(0)).count() == 0
    many = ann.nearest(df, shard_rows=1, block_rows=1)
    assert sorted(tuple(r) for r in many.collect()) == found


def test_pipeline_equals_brute_force_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = langid.learned(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "bpe":
            assert docs.columns == columns
        out = docs.collect()
        if name == "language_id":
            buf = [t.encode() for t in rows.values()]
            rejected = model.predict(np.frombuffer(b"".join(buf), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in buf])]))[2]
            rows = {d: t for (d, t), gone in zip(rows.items(), rejected.tolist(), strict=True) if not gone}
        elif name == "near_dedup":
            keep = near_duplicates(list(rows.items()), 5)
            rows = {d: t for d, t in rows.items() if keep[d][2]}
        elif name == "suffix_dedup":
            removed = {r[0]: r[2] for r in repeated_bytes(list(rows.items()), 200)}
            for r in out:  # whole characters only, so up to 3 bytes more at each end of a run may stay
                assert 0 <= len(r.text.encode()) - (len(rows[r.doc_id].encode()) - removed[r.doc_id]) <= removed[r.doc_id] // 30
                assert r.n_chars == len(r.text)
            rows = {r.doc_id: r.text for r in out}
        elif name == "decontaminate":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            rows = {r[0]: rows[r[0]] for r in decontamination(list(rows.items()), items) if not r[-1]}
        assert sorted(r.doc_id for r in out) == sorted(rows)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def tables(scratch, spark, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, q_uid string, member int").write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch


def test_pipeline_defined_cases(spark, scratch):
    real = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    docs = [(d, t, lang, "s", len(t or ""), "x", d) for d, t, lang in real]
    first = next(t for d, t, lang in real if lang == "en" and t and len(t) > 2000)
    extra = [(9001, None), (9002, ""), (9003, "12 34 !!"), (9004, first + " with a tail of its own"), (9004, first + " with a tail of its own"), (None, "words without an id " * 3), (None, None),
             (9005, " ".join(first.split()[::-1] * 40))]
    docs += [(d, t, None, None, None, None, None) for d, t in extra]
    sf = tables(scratch, spark, docs, [(1, None), (2, ""), (None, "an item without an id that stands nowhere in these texts at all")])
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    kept = [r.doc_id for r in rows]
    assert out.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert not {9001, 9002, 9003} & set(kept) and 9004 not in kept  # no language; a near copy of a smaller id
    assert 9005 in kept and all(len(r.ids) == r.n_tokens for r in rows)
    one = [r for r in rows if r.doc_id == 9005]
    assert len(one) == 1 and one[0].n_tokens < 200  # nearly all of it repeats


def test_pipeline_of_an_empty_table(spark, scratch):
    assert corpus_pipeline.run(spark, tables(scratch, spark, [], [])).collect() == []
