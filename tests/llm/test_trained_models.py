"""Language identification and toxicity: held-out accuracy, and defined results for odd rows."""

from __future__ import annotations

import numpy as np

from flowlab.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, SF).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_kernel_folds_into_weights():
    """The folded matrix gives what landmark kernels and ridge weights give: the kernel is linear in presence."""
    rows = [np.unique(np.concatenate(langid.grams(t))) for t in ("the thing and that", "der die das und", "and the other", "das ist und")]
    model = langid.fit_kernel_ridge(["de", "en"], rows, ["en", "de", "en", "de"])
    kernel = langid._presence(rows)
    again = kernel @ (model.weights[:, :2] * np.sqrt(3)) + model.bias
    assert np.allclose(again, model.margins(["the thing and that", "der die das und", "and the other", "das ist und"]), atol=1e-3)
    assert (model.margins(["and that", "die und das"]).argmax(axis=1) == [1, 0]).all()


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = langid.fit(odd_docs)
    rows = odd_docs.select("doc_id", "text", langid.predicted(spark, model, odd_docs["text"]).alias("p")).collect()
    for r in rows:
        assert (r.p.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")), r.doc_id
    assert langid.fit(no_docs) is None
    none = odd_docs.select(langid.predicted(spark, None, odd_docs["text"]).alias("p")).collect()
    assert {(r.p.lang_pred, r.p.score) for r in none} == {("und", 0.0)}
    assert no_docs.select(langid.predicted(spark, model, no_docs["text"])).collect() == []


def test_toxicity_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op1_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = ([r.score for r in held if labels[r.doc_id] == y] for y in (1, 0))
    above = np.mean([a > b for a in toxic for b in clean])
    assert above > 0.9


def test_subwords_reach_misspellings():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(words, 30)) for _ in range(400)]
    labels = [int(i % 4 == 0) for i in range(400)]
    texts = [t + " dreadfulness " + t if y else t for t, y in zip(texts, labels, strict=True)]
    model = toxicity.fit_texts(texts, labels, 100, 300)
    plain = " ".join(words)
    assert model.score(f"{plain} dreadfullness {plain}") > 0.5 > model.score(plain)
    assert model.score("") == model.prior == 0.25


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labelled = odd_docs.selectExpr("text", "CASE WHEN doc_id = 4 THEN NULL WHEN doc_id < 4 THEN 1 ELSE 0 END AS toxic")
    model = toxicity.fit(labelled)
    scores = [r.s for r in odd_docs.select(toxicity.score(spark, model, odd_docs["text"]).alias("s")).collect()]
    assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
    nothing = toxicity.fit(no_docs.selectExpr("text", "1 AS toxic"))
    assert nothing.score("anything") < 0.3 and nothing.score("") == 0.0
    assert no_docs.select(toxicity.score(spark, model, no_docs["text"])).collect() == []


def test_many_languages_are_all_learned(spark):
    """Three hundred languages, one of them made of copies and one of a single text."""
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    stems = [["".join(rng.choice(letters, 4)) for _ in range(12)] for _ in range(300)]
    text = lambda i: " ".join(rng.choice(stems[i], 30))
    rows = [(text(i), f"l{i:03d}") for i in range(299) for _ in range(5)] + [(text(299), "l299")] * 400 + [("only one here of its kind", "one")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == [f"l{i:03d}" for i in range(300)] + ["one"]
    held = [(text(i), f"l{i:03d}") for i in range(300)]
    found = [model.languages[j] for j in model.margins([t for t, _ in held]).argmax(axis=1)]
    assert np.mean([f == y for f, (_, y) in zip(found, held, strict=True)]) > 0.95


def test_language_stage_decides_by_score(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(-1, "zqxj kvwz xqk jjqz vvkx", None, None, None), (-2, "12 34 ...", None, None, None),
                                 (-3, "it was the house of the and", None, None, None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(odd), SF).select("doc_id").collect()}
    assert not {-1, -2} & kept and -3 in kept and len(kept) == docs.count() + 1


LABELLED = "doc_id bigint, text string, toxic int"


def planted_texts(n: int, length: int) -> list[tuple]:
    """Every third text holds insults; words are drawn anew for each."""
    rng = np.random.default_rng(8)
    words = [f"{a}{b}" for a in ("lo", "mi", "tar", "ven", "sol") for b in ("ra", "den", "ku", "st", "pel")]
    rows = []
    for i in range(n):
        text = [words[j] for j in rng.integers(0, len(words), length // 5)]
        if i % 3 == 0:
            for at in rng.integers(0, len(text), length // 250):
                text[int(at)] = "stupididiot moron"
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return rows


def test_long_labelled_texts_are_learned_from(spark):
    rows = planted_texts(90, 30_000)
    docs = spark.createDataFrame(rows, LABELLED)
    for model in (toxicity.fit(docs), toxicity.fit_by_key(docs.drop("toxic"), docs.select("doc_id", "toxic"))):
        assert abs(model.prior - 1 / 3) < 1e-9
        right = [(model.score(t) >= 0.3) == bool(y) for _, t, y in planted_texts(120, 30_000)[90:]]
        assert np.mean(right) > 0.9


def test_excerpts(spark):
    step, most = toxicity.WINDOW_CHARS, toxicity.WINDOW_CHARS * toxicity.WINDOWS
    texts = ["", "short", "x" * most, "a" * step + "b" * most + "c" * step]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in frame.select(toxicity.excerpt(frame.text)).collect()]
    assert got[:3] == texts[:3]
    assert got[3].startswith("a" * step + "\n") and got[3].endswith("\n" + "c" * step) and len(got[3]) == most + toxicity.WINDOWS - 1


def test_labels_of_repeated_keys(spark, monkeypatch):
    """A hot id does not multiply, gives a share of its rows only, and a key with both labels is toxic."""
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 30)
    taken = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda texts, labels, p, n: taken.append((texts, labels, p, n)))
    rows = [(7, f"hot text {i}") for i in range(3000)] + [(i, f"text {i}") for i in range(100, 400)] + [(5, "both"), (None, "no key"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(7, 0)] * 50 + [(i, 1) for i in range(100, 400)] + [(5, 0), (5, 1), (6, 1), (None, 1), (8, None)], "doc_id bigint, toxic int")
    toxicity.fit_by_key(docs, labels)
    texts, known, positives, negatives = taken[0]
    assert (positives, negatives) == (301, 3000)
    assert 10 < sum(known) < 60 and 25 < known.count(0) < 130
    assert not {"no key"} & set(texts) and toxicity.fit_by_key(docs.limit(0), labels).score("x") < 1e-9
