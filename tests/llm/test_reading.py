import numpy as np
import pytest

from cohortloom.llm.reading import LEAST_WORDS, isotonic, reading_levels, streams, tier_pairs

DOCS = "doc_id long, text string, lang string, reading_level string"
LABELS = "doc_id long, grader_id int, reading_level int"


def test_running_text_only():
    assert streams("EG00\t722\t16.73\t15/179\n" * 50).n_words == 0
    assert streams("MKVLAAGIVG" * 200).n_words == 0
    assert streams("").n_words == 0
    assert streams("<p>You may have some rest.</p>\n" * 10).n_words == 50


def test_short_words_long_words_and_scripts_without_blanks(spark):
    assert streams("Donaudampfschifffahrtsgesellschaftskapitänsmützenband ist lang.\n").n_words == 3
    assert streams("患者应当遵循医生的建议。" * 10).n_words >= 50 and streams("รักษาผู้ป่วย " * 10).n_words >= 40
    texts = ["a " * 39 + "b", "a " * 38 + "b", "患者应当遵循医生的建议。" * 10]
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(texts)], DOCS)
    assert len(texts[0]) == 79
    assert sorted(r.doc_id for r in reading_levels(docs, spark.createDataFrame([(0, 1, 2)], LABELS)).collect()) == [0, 2]


def test_quantiles_of_the_contrasts_against_brute_force():
    from cohortloom.llm.reading import QUANTILES, contrasts

    rng = np.random.default_rng(4)
    logs, docs = rng.normal(-20, 3, (200, 4)), np.sort(rng.choice([0, 1, 3], 200))
    got = contrasts(logs, docs, 4)
    p = np.exp(logs)
    for k in range(3):
        c = np.clip(np.log(p[:, k + 1 :].mean(1)) - np.log(p[:, : k + 1].mean(1)), -6, 6)
        assert np.allclose(got[:, k], [np.quantile(c[docs == i], QUANTILES).mean() if (docs == i).any() else 0 for i in range(4)])
    assert not contrasts(np.zeros((0, 4)), np.zeros(0, int), 2).any()


def test_pairs_of_a_level():
    assert [int(tier_pairs(x).sum()) for x in (1, 2, 3, 4)] == [1, 5, 7, 3]
    assert tier_pairs(None).all()


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        y, w = rng.integers(1, 5, 7).astype(float), rng.random(7) + 0.1
        got = isotonic(np.arange(7), y, w)
        assert (np.diff(got) >= -1e-9).all()
        best = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 7)) for a in range(i + 1)) for i in range(7)]
        assert np.allclose(got, best)


def test_null_short_and_empty(spark):
    text = "You may have some rest at home. The nurse will help you with your pill. " * 6
    rows = [(1, None, None, "x"), (2, "", "en", "x"), (3, "too short", "en", "x"), (4, text, "xx", "x"), (4, text, None, "x"), (5, text * 300, "en", "x")]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(4, 1, 1), (4, 2, 1), (4, 3, 2), (9, 1, None), (3, 1, 7)], LABELS)
    out = reading_levels(docs, labels).collect()
    assert sorted(r.doc_id for r in out) == [4, 4, 5] and {r.reading_level for r in out} == {1}
    assert min(r.n_words for r in out) >= LEAST_WORDS
    assert reading_levels(docs.limit(0), labels).count() == 0
    assert {r.reading_level for r in reading_levels(docs, labels.limit(0)).collect()} == {3}


def test_held_out_accuracy(spark):
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/reading_labels.parquet")
    held = {r.doc_id: r.m for r in labels.groupBy("doc_id").agg({"reading_level": "median"}).withColumnRenamed("median(reading_level)", "m").collect() if r.doc_id % 4 == 1}
    seen = labels.where("doc_id % 4 <> 1")
    texts = {r.doc_id: r.text for r in docs.where("text is not null").collect()}
    known = {texts[r.doc_id] for r in seen.select("doc_id").distinct().collect() if r.doc_id in texts}
    got = {r.doc_id: r.reading_level for r in reading_levels(docs, seen).collect()}
    fresh = [d for d in held if d in got and texts[d] not in known]
    right = sum(got[d] == int(held[d] + 0.5) for d in fresh)
    assert len(fresh) > 100 and right / len(fresh) > 0.88


def test_fitted_on_graded_documents_of_any_length_and_no_others(spark, monkeypatch):
    from cohortloom.llm.reading import Grader

    text = "You may have some rest at home. The nurse will help you with your pill. " * 6
    rows = [(1, text, "en", "x"), (2, text * 60, "en", "x"), (3, "Whereas " + text, "en", "x")]
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 2)], LABELS)
    fitted = []
    fit = Grader.fit
    monkeypatch.setattr(Grader, "fit", lambda self, parts, grades: fitted.append(sorted(grades, key=str)) or fit(self, parts, grades))
    assert len(text) * 60 > 20_000
    assert reading_levels(spark.createDataFrame(rows, DOCS), labels).count() == 3
    assert fitted == [[1.0, 2.0]]


def test_fitted_on_all_graded_documents_however_many(spark, monkeypatch):
    from cohortloom.llm.reading import Grader

    text = "You may have some rest at home. The nurse will help you with your pill. " * 6
    docs = spark.range(4200).selectExpr("id as doc_id", f"concat('{text}', 'Page ', id, ' of the leaflet ends here.') as text", "'en' as lang", "'x' as reading_level")
    labels = spark.range(4200).selectExpr("id as doc_id", "1 as grader_id", "cast(1 + id % 2 as int) as reading_level")
    fitted = []
    fit = Grader.fit
    monkeypatch.setattr(Grader, "fit", lambda self, parts, grades: fitted.append(parts.count() if hasattr(parts, "rdd") else len(parts)) or fit(self, parts, grades))
    assert reading_levels(docs, labels).count() == 4200 and fitted == [4200]


def test_pooling_in_parts_is_exact():
    from cohortloom.llm.reading import MonotoneTier, pooled

    rng = np.random.default_rng(6)
    x = np.round(rng.normal(0, 2, 500), 1)
    y = np.round(rng.random(500) + (x > 0), 3)
    whole = pooled(x, x, y, np.ones(500))
    cells = [pooled(x[at], x[at], y[at], np.ones(at.sum())) for c in np.unique(np.floor(x)) if (at := np.floor(x) == c).any()]
    parts = pooled(*map(np.concatenate, zip(*cells)))
    ux, n = np.unique(x, return_counts=True)
    want = isotonic(ux, np.array([y[x == v].mean() for v in ux]), n.astype(float))
    assert np.allclose(np.interp(ux, *MonotoneTier([whole]).maps[0]), want) and np.allclose(np.interp(ux, *MonotoneTier([parts]).maps[0]), want)
    assert all(len(c) == 0 for c in pooled(*[np.zeros(0)] * 4))
