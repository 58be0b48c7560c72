import numpy as np

from cohortloom.llm.packing import Index, fill_report, fill_windows, packed_windows
from cohortloom.llm.tokens import vocabulary

CAPS = "window_id int, capacity_tokens int"


def check(rows, sizes, caps):
    for w, cap in caps.items():
        mine = [r for r in rows if r.window_id == w]
        load, pieces = {}, {}
        for r in mine:
            assert r.n_tokens == r.token_end - r.token_start
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
            pieces.setdefault(r.doc_id, []).append((r.token_start, r.token_end))
        assert max(load.values()) <= cap
        assert set(pieces) == set(sizes)
        for d, p in pieces.items():
            p.sort()
            assert p[0][0] == 0 and p[-1][1] == sizes[d] and all(a[1] == b[0] for a, b in zip(p, p[1:]))
            assert len(p) == 1 or sizes[d] > cap


def test_every_document_once_never_split_below_capacity(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    v = vocabulary()
    sizes = {r.doc_id: len(v.encode(r.text or "")) for r in docs.collect()}
    caps = {1: 64, 2: 512, 3: 4096}
    out = packed_windows(docs, spark.createDataFrame(list(caps.items()), CAPS))
    rows = out.collect()
    check(rows, sizes, caps)
    report = fill_report(out, spark.createDataFrame(list(caps.items()), CAPS)).collect()
    assert min(r.filled for r in report) > 0.85 and all(0 <= r.retrieved <= 1 for r in report) and max(r.retrieved for r in report) > 0.3


def test_empty_null_repeated_and_clashing(spark):
    rows = [(1, None, "N1", 1), (2, "", None, 1), (3, "word " * 700, "N1", 1), (4, "short text", None, 1), (4, "short text", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, nct_id string, window_id int")
    win = spark.createDataFrame([(1, 100), (1, 100), (2, 0), (None, 5)], CAPS)
    out = packed_windows(docs, win).collect()
    assert {r.window_id for r in out} == {1} and {r.doc_id for r in out} == {1, 2, 3, 4}
    assert sum(r.doc_id == 4 for r in out) == 2
    assert packed_windows(docs.limit(0), win).count() == 0
    assert packed_windows(docs, win.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, "some words", None, 1), (None, None, None, 1)], docs.schema)
    assert packed_windows(nameless, win).count() == 2
    only_empty = packed_windows(docs.where("doc_id < 3"), win).collect()
    assert [(r.doc_id, r.n_tokens) for r in sorted(only_empty, key=lambda r: r.doc_id)] == [(1, 0), (2, 0)]


def _index(texts):
    vocab = {w: i for i, w in enumerate(sorted({w for t in texts for w in t.split()}))}
    terms, tfs = zip(*[np.unique([vocab[w] for w in t.split()], return_counts=True) for t in texts])
    df = np.zeros(len(vocab))
    for t in terms:
        df[t] += 1
    idf = np.log1p((len(texts) - df + 0.5) / (df + 0.5)).astype(np.float32)
    return Index(list(terms), [t.astype(np.int32) for t in tfs], idf, np.mean([len(t.split()) for t in texts])), vocab, idf


def test_scores_are_bm25():
    texts = ["a b b c", "a a d", "e f", "b c e e"]
    index, vocab, idf = _index(texts)
    mean = np.mean([len(t.split()) for t in texts])
    for q, query in enumerate(texts):
        want = []
        for t in texts:
            ws = t.split()
            want.append(sum(idf[vocab[w]] * ws.count(w) * 2.2 / (ws.count(w) + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for w in set(query.split())))
        assert np.allclose(index.scores(q), want, rtol=1e-4)


def test_neighbours_come_first():
    texts = ["asthma inhaler trial", "cancer drug dose", "asthma inhaler visit", "cancer drug level"]
    index, _, _ = _index(texts)
    got = fill_windows([60, 60, 40, 40], index, 100)
    assert sorted(sorted(p[0] for p in w) for w in got) == [[0, 2], [1, 3]]
