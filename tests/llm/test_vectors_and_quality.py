"""Quality rules, whitening and hard negatives against brute force, and defined results for odd rows."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from flowlab.llm import hard_negatives as mining
from flowlab.llm import quality_rules, queries, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute_measures(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {p for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("name", ["op11_quality_rules", "op13_hard_negatives"])
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_against_sql(spark, name, sf):
    df = queries.QUERIES[name](spark, sf)
    assert not differences(connect(sf), queries.ORACLES[name], df, [tuple(r) for r in df.collect()])


def test_measures_of_odd_texts(spark, odd_docs, no_docs):
    again = "a b c d e f g h i a b c d e f g h"
    texts = ["", None, "one", again, " ".join(["x"] * 40), "a b c d e f g h " * 2 + "z\n\nz\n z\nz", "   \x0b\x1f w\x85x", "| a\r\n...\n- b\n- b"]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id bigint, text string, `_words` string")
    for table in (docs, odd_docs):
        want = Counter(brute_measures(r.text) for r in table.collect())
        got = Counter(tuple(r)[1:] for r in quality_rules.measures(table).select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        assert got == want
    judged = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert judged[0].base_failed and not judged[0].kept and judged[0].failed == []
    assert judged[4].base_failed and judged[4].n_repeat_words == 40
    assert quality_rules.judge(no_docs).collect() == []


def test_rules_come_from_a_table(spark, frame_of_rules):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa the of and # lambda mu nu xi omicron pi rho sigma"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    strict = quality_rules.rules_of(frame_of_rules)
    row = quality_rules.judge(docs, strict).first()
    assert row.failed == ["few_symbols", "long_words"] and not row.kept and not row.base_failed
    assert quality_rules.judge(docs).first().kept
    with pytest.raises(ValueError):
        quality_rules.broken(quality_rules.Rule("x", "no_such", "n_words"))


@pytest.fixture
def frame_of_rules(spark):
    return spark.createDataFrame([("few_symbols", "n_symbols", "n_words", None, 2), ("long_words", "word_chars", "n_words", 900, None),
                                  ("open", "n_lines", "n_lines", None, None)], "name string, measure string, per string, least int, most int")


def test_spectrum_updates():
    rng = np.random.default_rng(5)
    cases = [rng.normal(size=(50, 8)), np.repeat(rng.normal(size=(3, 8)), 40, axis=0), rng.normal(size=(300, 2)) @ rng.normal(size=(2, 8)),
             np.eye(8) * 3, np.zeros((4, 8)), np.floor(rng.normal(size=(90, 8)) * 30), rng.normal(size=(9, 1)), np.array([[1e-200] * 8, [1.0] * 8])]
    for rows in cases:
        one, first, second = (whitening.Spectrum.empty(rows.shape[1]) for _ in range(3))
        for r in rows:
            one.add(r)
        first.add_rows(rows[:30])
        second.add_rows(rows[30:])
        first.merge(second)
        want = rows.T @ rows
        for s in (one, first):
            assert np.allclose((s.vectors * s.values) @ s.vectors.T, want, atol=1e-12 * max(1, np.abs(want).max()))
            assert np.allclose(s.vectors.T @ s.vectors, np.eye(len(want)), atol=1e-12)
            assert (np.diff(s.values) >= 0).all()


def test_secular_roots():
    d, z = np.array([0.0, 1.0, 1.5, 4.0]), np.array([1e-5, 2.0, -0.5, 1.0])
    roots, apart = whitening.secular_roots(d, z)
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + np.outer(z, z)), rtol=1e-13)
    assert np.allclose(apart, d[:, None] - roots)


def brute_whitening(vectors: list, k: int):
    x = np.floor(256 * np.array(vectors, float))
    fit = np.unique(x, axis=0)
    values, turn = np.linalg.eigh(np.cov(fit.T, bias=True))
    mean, top = fit.mean(axis=0), np.argsort(-values)[:k]
    return len(fit), ((len(fit) * x - fit.sum(axis=0)) ** 2).sum(axis=1), (x - mean) @ turn[:, top] / np.sqrt(values[top]), values[top] / values.sum()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_whitening_against_numpy(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    n, off, want, shares = brute_whitening([r.embedding for r in table], 4)
    got = queries.op12_whitening(spark, sf).orderBy("vec_id", "component").collect()
    assert len(got) == 4 * len(table) and {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3, 4}
    assert [r.deviation for r in got[::4]] == off.astype(int).tolist()
    values = np.array([r.whitened for r in got]).reshape(-1, 4)
    assert np.allclose(np.abs(values), np.abs(want), atol=1e-8)
    assert np.allclose([r.explained for r in got[:4]], shares, rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0, 0.5], 1, "a"), (1, [1.0, 0.0, 0.5], 1, "a"), (None, [0.0, 1.0, 0.5], None, "b"), (3, None, 1, None),
            (4, [], 1, "c"), (5, [1.0, None, 0.0], 1, "c"), (6, [float("nan"), 1.0, 1.0], 1, "c"), (7, [float("inf"), 1.0, 1.0], 1, "c"),
            (8, [1.0, 2.0], 1, "d"), (9, [-0.0, -1e-9, 3.0], 2, "e"), (10, [2.0, 2.0, 2.0], 2, "f")]
    df = spark.createDataFrame(rows, VECTORS + ", `_x` string").repartition(5)
    model = whitening.fit(df, k=4)
    n, off, want, _ = brute_whitening([r[1] for r in rows if r[1] and len(r[1]) == 3 and all(v is not None and math.isfinite(v) for v in r[1])], 3)
    out = whitening.transform(df, model).collect()
    assert model.n == n == 4 and len(model.values) == 3 and len(out) == 5
    assert sorted(r.deviation for r in out) == sorted(off.astype(int).tolist())
    assert np.allclose(np.sort(np.abs([r.whitened[0] for r in out])), np.sort(np.abs(want[:, 0])))
    flat = whitening.fit(df.filter("vec_id = 1"))  # one distinct vector: nothing varies
    assert len(flat.values) == 0 and whitening.transform(df, flat).collect() == []
    none = whitening.fit(df.filter("vec_id = 3"))
    assert none.n == 0 and whitening.transform(df, none).collect() == []
    huge = spark.createDataFrame([(1, [1e30, 0.0], 1), (2, [-1e30, 1.0], 1), (3, [1.0, 1.0], 1)], VECTORS)
    assert {r.deviation for r in whitening.transform(huge, whitening.fit(huge)).collect()} == {None, 513 ** 2 + 256 ** 2}


def brute_negatives(rows: list, anchors, k: int = 5, percent: int = 80) -> list[tuple]:
    x = {r[0]: [math.floor(256 * float(np.float32(c))) for c in r[1]] for r in rows}
    label = {r[0]: r[2] for r in rows}
    out = []
    for a in filter(anchors, x):
        scores = sorted(((-sum(p * q for p, q in zip(x[a], x[b], strict=True)), b) for b in x if b != a))
        for s, p in [z for z in scores if label[z[1]] == label[a]][:k]:
            good = [(t, b) for t, b in scores if label[b] != label[a] and -percent * s <= -100 * t <= -100 * s]
            out += [(a, p, i, b, -s, -t) for i, (t, b) in enumerate(good[:k], 1)]
    return sorted(out)


def clustered(n: int, size: int, seed: int, scale: float = 1.0) -> list[tuple]:
    """Rows around a few centres, many of them equal, with ties and empty windows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size))
    rows = []
    for i in range(n):
        v = centres[i % 4] if i % 3 == 0 else centres[i % 4] + rng.normal(size=size) * 0.02
        rows.append((i, [float(c) for c in (v * scale).astype(np.float32)], int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("scale", [1.0, 3e5, -2.0])
def test_negatives_against_brute_force(spark, monkeypatch, scale):
    """Small trees, chunks and groups; near anchors, so bounds leave out most pairs; large entries are exact longs."""
    for name, value in (("BLOCK", 8), ("CHUNK", 32), ("ROWS_PER_GROUP", 50), ("LEAST_GROUPS", 3), ("BLOCKS_PER_GROUP", 2)):
        monkeypatch.setattr(mining, name, value)
    rows = clustered(400, 6, 3, scale)
    df = spark.createDataFrame(rows, VECTORS)
    got = sorted(tuple(r) for r in mining.hard_negatives(df, F.col("vec_id") % 5 == 0).collect())
    assert got == brute_negatives(rows, lambda i: i % 5 == 0) and len(got) > 50


def test_bounds_leave_out_far_pairs_only():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(3, 16)) * 200)[np.arange(60) % 3] + rng.integers(0, 3, (60, 16))
    x = x.astype(np.int64)
    tree = mining.spanning_tree(x)
    truth = x @ x.T
    low = np.full((60, 1), int(np.percentile(truth, 97)))
    block = mining.Block(np.arange(60), np.zeros(60), x, *tree, low, np.full((60, 1), -mining.NONE))
    scores, scored = block.scores(x, np.ones((60, 60), bool))
    inside = truth >= low
    assert (scores[inside] == truth[inside]).all() and set(scores[scores > mining.NONE]) <= set(truth.ravel())
    assert scored < 0.75 * 59 * 60
    parent, edge, level = tree
    assert (parent == -1).sum() == 1 and all(level[i] == level[parent[i]] + 1 for i in range(60) if parent[i] >= 0)
    assert np.allclose(edge, [np.linalg.norm(x[i] - x[p]) if p >= 0 else 0 for i, p in enumerate(parent)])


def test_negatives_of_odd_rows(spark):
    rows = clustered(60, 4, 9)
    odd = [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan")] * 4, 1), (103, [1.0] * 4, None), (None, [1.0] * 4, 1),
           (104, [], 1), (105, [1.0, 2.0], 1), (106, [3e38] * 4, 2), (7, [-9.0] * 4, 2), (0, [9.0] * 4, 0), rows[5]]
    smallest = {r[0]: r for r in sorted([*rows, (7, [-9.0] * 4, 2), (0, [9.0] * 4, 0)], key=lambda r: ([math.floor(256 * c) for c in r[1]], r[2]), reverse=True)}
    df = spark.createDataFrame([(*r, "z") for r in rows + odd], VECTORS + ", `id` string")
    got = sorted(tuple(r) for r in mining.hard_negatives(df, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_negatives(list(smallest.values()), lambda i: i % 10 == 0)
    assert mining.hard_negatives(df, F.lit(False)).collect() == []
    assert mining.hard_negatives(df, F.lit(None).cast("boolean")).collect() == []
    assert mining.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
