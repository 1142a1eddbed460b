"""Near-duplicates, decontamination and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from compare import connect, differences

from flowlab.llm import decontamination, near_dedup, order_minhash, queries, shingles

BLANK = "[^\x20\x09-\x0d]+"


def shingle_words(text, size=5):
    words = re.findall(BLANK, (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_components(docs, percent):
    sets = [(d, shingle_words(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, len(s), least.get(top(i))) for i, (d, s) in enumerate(sets)]


def near_copies(seed=1):
    """Chains and stars of copies that drift, so links are at and around the border."""
    rng = random.Random(seed)
    out, key = [], 100
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 200]))]
        for _ in range(12):
            out.append((key, " ".join(words)))
            key -= rng.choice([-3, 1])
            for _ in range(max(1, len(words) // rng.choice([25, 60, 120]))):
                words[rng.randrange(len(words))] = f"v{rng.randrange(5000)}"
        key += 50
    return list({k: (k, t) for k, t in out}.values())


@pytest.mark.parametrize("percent", [80, 85])
def test_components_are_those_of_all_pairs(spark, percent):
    docs = near_copies()
    rng = random.Random(3)
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    rows = near_dedup.near_duplicates(frame, percent).collect()
    want = sorted(brute_components(docs, percent))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    kept = near_dedup.keep_one(frame, percent)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert kept.columns == frame.columns


def test_near_dedup_of_odd_rows(odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = near_dedup.near_duplicates(odd_docs).collect()
    # Documents without words are their own component.
    want = [(d, n, c if n else d) for d, n, c in brute_components(docs, 85)]
    order = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=order) == sorted(want, key=order)
    kept = near_dedup.keep_one(odd_docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert near_dedup.near_duplicates(no_docs).collect() == []
    assert near_dedup.keep_one(no_docs).collect() == []


def test_keep_one_decides_per_text_not_per_key(spark):
    rng = random.Random(9)
    alone, first, second, third = (" ".join(f"{c}{rng.randrange(900)}" for _ in range(60)) for c in "abcd")
    near = lambda t: t + " end"
    docs = [(1, alone), (1, first), (2, near(first)), (1, second), (1, near(second)), (1, second), (None, third),
            (None, near(third)), (None, third), (4, ""), (4, " "), (4, ""), (5, None), (5, near(first))]
    rows = [(*d, i) for i, d in enumerate(docs)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, at int").repartition(3)
    kept = near_dedup.keep_one(frame).collect()
    assert sorted(r.text for r in kept if r.doc_id == 1 and r.text in (alone, first)) == sorted([alone, first])
    assert [r.text in (second, near(second)) for r in kept if r.doc_id == 1].count(True) == 1
    assert len([r for r in kept if r.doc_id is None]) == 1
    assert sorted(r.text for r in kept if r.doc_id == 4) == ["", " "]
    assert [r.text for r in kept if r.doc_id == 5] == [None]
    assert len(kept) == 7


def test_components_of_a_long_chain(spark):
    n = 40
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a bigint, b bigint").repartition(3)
    assert {(r.node, r.root) for r in near_dedup.components(links).collect()} == {
        *((i, 0) for i in range(n + 1)), (100, 100), (101, 100)}


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(5)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) for n in (600, 200, 200))
    x, y = (near_dedup.signature(np.concatenate([common, s])) for s in (a, b))
    assert abs((x == y).mean() - 0.6) < 0.15


def test_parities_never_differ_in_more_cells_than_the_sets_in_shingles():
    rng = np.random.default_rng(6)
    for same, only_a, only_b in ((0, 1, 0), (50, 0, 0), (200, 40, 40), (5000, 300, 10), (100, 9000, 9000)):
        common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.int64).astype(np.uint64) * np.uint64(2) for n in (same, only_a, only_b))
        x, y = (near_dedup.parities(np.concatenate([common, s])) for s in (a, b))
        cells = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert cells <= only_a + only_b and (cells - only_a - only_b) % 2 == 0
        if only_a + only_b <= 100:
            assert cells >= 0.8 * (only_a + only_b)


@pytest.mark.parametrize("percent", [80, 85])
def test_few_differ_holds_for_every_pair_at_the_similarity(spark, percent):
    docs = near_copies(seed=4)[:60]
    sets = {k: shingles.shingle_set(t) for k, t in docs}
    rows = [(a, len(sets[a]), near_dedup.parities(sets[a]).tolist(), b, len(sets[b]), near_dedup.parities(sets[b]).tolist())
            for a in sets for b in sets if a < b]
    frame = spark.createDataFrame(rows, "a bigint, a_n bigint, a_parities array<bigint>, b bigint, b_n bigint, b_parities array<bigint>")
    may = {(r.a, r.b): r.may for r in frame.select("a", "b", near_dedup._few_differ("a_", "b_", percent).alias("may")).collect()}
    both = {p: len(np.intersect1d(sets[p[0]], sets[p[1]])) for p in may}
    linked = {p for p, c in both.items() if 100 * c >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - c)}
    assert linked and all(may[p] for p in linked) and sum(may.values()) < 1.2 * len(linked) + 5


def test_shingle_sets():
    for text in ("", " \n", "a", "A b", "a  b\tc\x0bd e F g é É", "x " * 50):
        assert len(shingles.shingle_set(text)) == len(shingle_words(text))
    assert (shingles.shingle_set("A b C d E f") == shingles.shingle_set(" a B\nc D e\x0c f ")).all()
    assert len(shingles.shingle_set(None)) == 0
    assert not set(shingles.shingle_set("a b c")) & set(shingles.shingle_set("a b c d"))


@pytest.mark.parametrize("name", ["op3_near_dedup", "op6_decontamination", "op8_chat_format"])
def test_against_check_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert rows and not differences(connect(sf), queries.ORACLES[name], df, rows)


def test_items_in_long_documents(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(f"i{i}w{rng.randrange(900)}" for _ in range(rng.choice([3, 5, 6, 9, 30, 80])))) for i in range(60)]
    items += [(60, None), (61, ""), (62, items[0][1])]
    docs = []
    for d in range(60):
        words = [f"n{rng.randrange(3000)}" for _ in range(rng.choice([0, 50, 700, 5000]))]
        for i in rng.sample(range(60), 3):
            part = items[i][1].split()
            cut = rng.choice([0, 1, 2])  # some lose so much that they no longer count
            at = rng.randrange(len(words) + 1)
            words[at:at] = part[cut:]
        docs.append((d, " ".join(words)))
    docs += [(None, items[3][1]), (70, None), (71, ""), (72, items[0][1].upper())]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    want = []
    for k, t in docs:
        s = shingle_words(t)
        for j, u in items:
            own = shingle_words(u)
            if own and s and 100 * len(own & s) >= 80 * len(own):
                want.append((k, j, len(own), len(own & s)))
    order = lambda x: tuple((v is not None, v or 0) for v in x)
    for block in (8_000_000, 2_000):  # in one block of items and in several
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        got = [tuple(r) for r in decontamination.contained_items(d, i).collect()]
        assert sorted(got, key=order) == sorted(want, key=order) and len(want) > 60
        clean = decontamination.without_leaks(d, i).collect()
        assert sorted((r.doc_id or 0) for r in clean) == sorted((k or 0) for k, _ in docs if k not in {w[0] for w in want})


def test_decontamination_of_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "three four five six seven one two"), (2, "two three four five six seven")],
                                  "item_id bigint, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.contained_items(odd_docs, items).collect()] == [(1, 2)] * 2
    assert decontamination.without_leaks(odd_docs, items).columns == odd_docs.columns
    assert decontamination.without_leaks(odd_docs, items).count() == odd_docs.count() - 2
    assert decontamination.contained_items(no_docs, items).collect() == []
    assert decontamination.without_leaks(odd_docs, items.limit(0)).count() == odd_docs.count()


def test_items_of_few_shingles_are_all_found():
    """In the size class of 512 a bin hides 3 of 100 shingles; 600 items of one shingle, each somewhere in a long document."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    starts = rng.sample(range(19_990), 600)
    items = [(i, " ".join(words[s:s + 5 + i % 4])) for i, s in enumerate(starts)]
    index = decontamination.ItemIndex(items, 5)
    assert set(index.candidates(shingles.shingle_set(" ".join(words)))) == set(range(600))
    assert not len(index.candidates(shingles.shingle_set("of none of these words is a thing said there")))


def edited(text, after):
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def brute_sketch(text, xx):
    """The sketch by plain Python, with Spark's hash as a given function."""
    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,8}", text)
    grams = [tuple(tokens[i:i + 3]) for i in range(max(min(1, len(tokens)), len(tokens) - 2))]
    high = [(xx(g) % (1 << 64)) >> 29 for g in grams]
    seen, ranked = {}, []
    for at, h in enumerate(high):
        occurrence = seen[h] = seen.get(h, -1) + 1
        ranked.append(((h if not occurrence else (xx((h, occurrence)) % (1 << 64)) >> 29), at))
    out = []
    for b in range(64):
        least = sorted(x for x in ranked if x[0] >> 29 == b)[:2]
        if least:
            out.append((b, tuple(h for h, _ in sorted(least, key=lambda x: x[1]))))
    return out


def test_fingerprints(spark, sf):
    rows = {r.doc_id: r for r in queries.op2_order_minhash(spark, sf).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert len(rows) == len(docs)
    by_text = {}
    for (d, t), (_, after) in zip(docs, docs[1:] + docs[:1], strict=True):
        r = rows[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited(t, after).encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert np.mean([r.near_edited for r in rows.values()]) > np.mean([r.near_next for r in rows.values()]) + 0.05


def test_sketch_is_the_one_defined(spark):
    words = "aa bb cc dd ee ff gg averylongword".split()
    rng = random.Random(2)
    texts = ["", "one", "one two", "a a a a a a a", *[" ".join(rng.choice(words) for _ in range(n)) for n in (3, 9, 40, 400)]]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.s for r in order_minhash.with_sketch(frame, "t", "s").collect()}
    needed = {}

    def xx(key):
        return needed[key]

    hashes = {tuple(t[i:i + 3]) for text in texts for t in [re.findall(r"\S{1,8}", text)] for i in range(len(t))}
    pad = [(*k, None, None)[:3] for k in hashes]
    for r in spark.createDataFrame(pad, "a string, b string, c string").selectExpr("a", "b", "c", "xxhash64(a, b, c) AS h").collect():
        needed[tuple(x for x in (r.a, r.b, r.c) if x is not None)] = r.h
    occurrences = [((needed[k] % (1 << 64)) >> 29, n) for k in hashes for n in range(1, 400)]
    for r in spark.createDataFrame(occurrences, "h bigint, n int").selectExpr("h", "n", "xxhash64(h, n) AS x").collect():
        needed[r.h, r.n] = r.x
    want = {t: brute_sketch(t, xx) for t in texts}
    tuples = sorted({k for s in want.values() for _, k in s})
    whole = {tuple(r.k): (r.x % (1 << 64)) >> 32 for r in spark.createDataFrame(
        [(list(k),) for k in tuples], "k array<bigint>").selectExpr("k", "xxhash64(k) AS x").collect()}
    for t in texts:
        assert got[t] == [b << 32 | whole[k] for b, k in want[t]]


def test_sketch_sees_order(spark):
    a = [f"w{i}" for i in range(300)]
    moved = a[150:] + a[:150]
    frame = spark.createDataFrame([(" ".join(a), " ".join(moved), " ".join(a[:280] + ["x"] * 20))], "a string, b string, c string")
    for c in "abc":
        frame = order_minhash.with_sketch(frame, c, f"s{c}")
    from pyspark.sql import functions as F

    far, near, same = frame.select(*[order_minhash.likeness(F.col("sa"), F.col(x)) for x in ("sb", "sc", "sa")]).first()
    assert same == 1 and near > 0.7 > far > 0.2


def test_sketch_stands_an_insertion_in_text_without_blanks(spark):
    rng = random.Random(3)
    from pyspark.sql import functions as F

    for alphabet in ([chr(c) for c in range(0x4E00, 0x5200)], [chr(c) for c in range(0x20000, 0x20400)], "abcdefghij0123456789+/"):
        for n in (100, 3000):
            a = "".join(rng.choice(alphabet) for _ in range(n))
            frame = spark.createDataFrame([(a, a[:5] + alphabet[0] + a[5:], "".join(sorted(a)))], "a string, b string, c string")
            for c in "abc":
                frame = order_minhash.with_sketch(frame, c, f"s{c}")
            near, far = frame.select(*[order_minhash.likeness(F.col("sa"), F.col(x)) for x in ("sb", "sc")]).first()
            assert near > 0.7 and far < 0.3
    # A character off the first plane is one character, at the end of a run too.
    run = "".join(chr(0x20000 + i) for i in range(17))
    got = spark.createDataFrame([(f"ab {run} averylongword",)], "t string").select(order_minhash.tokens(F.col("t"))).first()[0]
    assert got == ["ab", *[run[i:i + 8] for i in range(10)], "averylon", "gword"]


def test_fingerprints_of_odd_rows(odd_docs, no_docs, spark):
    rows = order_minhash.fingerprints_with_next(odd_docs).collect()
    docs = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_docs.collect()))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text) for r in rows) == docs
    nexts = {(r.doc_id, r.text): r.next_text for r in rows}
    assert nexts[None, "une deux trois quatre cinq six"] == "one two three four five six seven"
    assert nexts[8, "<s></s><|endoftext|> [INST] \\</s>"] == "une deux trois quatre cinq six"
    assert order_minhash.fingerprints_with_next(no_docs).collect() == []
    one = order_minhash.fingerprints_with_next(odd_docs.filter("doc_id = 7")).first()
    assert one.next_text == one.text


def test_kept_documents_with_clashing_columns(spark):
    """Columns of any name stay, also those the operator would have chosen."""
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words), (2, words), (3, words + " more"), (4, "other text altogether than those above"), (4, "other text altogether than those above")]
    docs = spark.createDataFrame([(*r, "k", "h", "r", "t") for r in rows],
                                 "doc_id bigint, text string, _kept_key string, `_KEPT_hash` string, _kept_rows string, _root string")
    out = near_dedup.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r._kept_key, r._kept_rows) for r in out.collect()) == [(1, "k", "r"), (4, "k", "r")]
    assert near_dedup.keep_one(docs.limit(0)).collect() == []
