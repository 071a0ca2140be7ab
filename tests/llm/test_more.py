"""Ties, models written out, the tree of the Jaccard join, and sets that share few blocks."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_ops import brute_components, docs

from trivet.llm import langid, pieces, quality, setjoin, warc
from trivet.llm.common import components
from trivet.llm.mixing import mix
from trivet.llm.queries import piece_model


def test_mix_splits_ties(spark):
    """Rows that share an id, or id and text, are taken one by one, so a source still meets its target."""
    rows = [(None if i % 2 else 7, "a b c d e f" if i % 3 else f"a b c d e {i}", "en", "x") for i in range(400)] + [(1000 + i, "w w w", "en", "y") for i in range(100)]
    out = mix(docs(spark, rows)).collect()
    assert len(out) == 500 and Counter((r["doc_id"], r["taken"]) for r in out) == Counter((r["doc_id"], r["taken"]) for r in mix(docs(spark, rows)).collect())
    for s in "xy":
        mine = [r for r in out if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 6 and all(r["taken"] <= 2 * r["size"] for r in mine)


def test_letters_and_languages(spark):
    assert [langid.has_letter(t) for t in ("²", "½ Ⅷ", "12 _", "é", "世", "٣", "²a")] == [False, False, False, True, True, False, True]
    many = [(i, f"text number {i}", f"l{i % 300:03d}", "s") for i in range(600)] + [(9000 + i, "aaa bbb", "l000", "s") for i in range(9)]
    model = langid.train(docs(spark, many), max_langs=5)
    assert len(model.langs) == 5 and "l000" in model.langs


def test_kernel_machine_written_out():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcd e" if i % 2 else "wxyz e") for _ in range(rng.randrange(5, 60))) for i in range(60)]
    langs = ["p" if i % 2 else "q" for i in range(60)]
    new = ["".join(rng.choice("abcwx e") for _ in range(30)) for _ in range(25)]
    m = langid.fit(texts, langs, landmarks=12)
    buf = np.zeros(m.lengths << langid.BITS, bool)

    def grams(t):
        langid.ngram_flags(t, buf, m.lengths)
        return set(np.flatnonzero(buf).tolist())

    def kernel(a, b):
        return np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])

    # Landmarks alternate between the languages, in the order of the texts.
    by = {g: [grams(t) for t, h in zip(texts, langs, strict=True) if h == g] for g in ("p", "q")}
    marks = [by[g][k] for k in range(6) for g in ("p", "q")]
    val, vec = np.linalg.eigh(kernel(marks, marks))
    root = vec / np.sqrt(np.maximum(val, 1e-6 * val.max())) @ vec.T
    phi = kernel([grams(t) for t in texts], marks) @ root
    goal = np.array([[1.0 if g == x else -1.0 for x in ("p", "q")] for g in langs])
    w = np.linalg.solve(phi.T @ phi + 1e-2 * 60 / 100 * np.eye(12), phi.T @ goal)
    s = kernel([grams(t) for t in new], marks) @ root @ w
    e = np.exp(4 * (s - s.max(axis=1, keepdims=True)))
    got, p = m.predict(new)
    assert got == [("p", "q")[k] for k in s.argmax(axis=1)]
    assert np.allclose(p, e.max(axis=1) / e.sum(axis=1), atol=1e-4)


def test_bradley_terry_against_plain_descent():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((80, 4))
    y = (x @ [1.0, -2.0, 0.5, 0.0] + rng.standard_normal(80) > 0).astype(int)
    m = quality.fit(x, y.tolist(), 0.4, pairs=500, ridge=1e-2)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    draw = np.random.default_rng(7)
    d = z[draw.choice(np.flatnonzero(y == 1), 500)] - z[draw.choice(np.flatnonzero(y == 0), 500)]
    w = np.zeros(4)
    for _ in range(20_000):
        w -= 0.2 * (-(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + 1e-2 * w)
    assert np.allclose(m.weight, w, atol=1e-4)
    s = np.sort((z @ w)[np.argsort(z @ w)])
    assert s[0] < m.cut < s[-1]


def test_quality_reads_one_row_an_id(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    text = lambda i: " ".join([f"plain words {i}" if i % 2 else "SPAM!! NOW!!"] * 10)
    once = docs(spark, [(i, text(i), "en", "s") for i in range(60)])
    a, b = quality.train(once, labels), quality.train(once.unionByName(once).unionByName(once), labels)
    assert np.array_equal(a.weight, b.weight) and a.cut == b.cut


def test_quality_learns_from_every_label(spark):
    """More than 2,000 labels of a class and a text of more than 200,000 characters all count."""
    rows = [(i, f"plain words number {i} flow on" if i % 2 else f"SPAM!! {i} NOW", "en", "s") for i in range(7_000)] + [(7_001, "LONG 42 " * 30_000, "en", "s")]
    table = docs(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, *_ in rows], "doc_id long, quality int, toxic int")
    m = quality.train(table, labels)
    learned = {r["doc_id"] for r in table.where(~langid.held_out(F.col("doc_id"), 3, 1)).collect()}
    x = np.array([quality.features(t) for i, t, *_ in rows if i in learned])
    y = [i % 2 for i, *_ in rows if i in learned]
    assert min(Counter(y).values()) > 2_000 and 7_001 in learned
    assert np.allclose(m.mean, x.mean(axis=0), atol=1e-8) and np.allclose(m.scale, np.maximum(x.std(axis=0), 1e-6), atol=1e-6)


def test_quality_meets_all_pairs(spark):
    """Sums over cells of scores give the machine of all pairs written out, in whatever order rows come."""
    rng = np.random.default_rng(9)
    d = len(quality.FEATURES)
    x = rng.standard_normal((330, d)) * rng.uniform(0.01, 3, d)
    y = (x / x.std(axis=0) @ rng.standard_normal(d) + 2 * rng.standard_normal(330) > -3).astype(int)
    x[0, 3] = 400
    rows = spark.createDataFrame(list(zip(y.tolist(), x.tolist(), strict=True)), "q int, x array<double>")
    want = quality.fit(x, y.tolist(), 0.2)
    a, b = quality.fit_rows(rows.repartition(7), 0.2), quality.fit_rows(rows.coalesce(1).orderBy(F.col("x")[0]), 0.2)
    assert np.allclose(a.weight, want.weight, atol=1e-6) and a.cut == pytest.approx(want.cut, abs=1e-6) and a.width == pytest.approx(want.width, abs=1e-6)
    assert np.array_equal(a.weight, b.weight) and (a.cut, a.width) == (b.cut, b.width)
    tied = spark.createDataFrame([(0, 1.0), (1, 2.0), (1, 2.0), (0, 2.0), (1, 5.0), (0, 1e9)], "q int, s double")
    assert [quality._threshold(tied, p, np.array([3.0, 3.0])) for p in (0.1, 0.5, 0.69, 0.9)] == [3.5, 3.5, (5 + 1e9) / 2, (5 + 1e9) / 2]
    assert quality._threshold(tied.where("s = 2"), 0.5, np.array([1.0, 2.0])) == 2


def test_warc_ties(spark):
    page = [(6, "u", "same"), (6, "u", "same"), (6, "u", "same"), (8, "u", "same"), (None, "v", "lone"), (None, "v", "lone"), (9, "w", "x")]
    pages = spark.createDataFrame(page, "page_id long, url string, html string")
    out = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, warc.write_archives(pages)).collect())
    assert out == Counter({(6, "response", None): 1, (6, "revisit", 6): 2, (8, "revisit", 6): 1, (None, "response", None): 1, (None, "revisit", None): 1, (9, "response", None): 1})


def test_pieces_fall_back_and_forget():
    codec = pieces.PieceCodec(piece_model(), memo=2_000)
    texts = [f"some words {k} {'x' * 90}{k}\nand a line" for k in range(40)]
    want = [codec.by_library(t) for t in texts]
    assert [list(codec.run([t]))[0] for t in texts] == want and not any(len(s) > 64 for s in codec.memo) and codec.kept < 6_000
    same = codec._same
    codec.memo.clear()
    codec._same = lambda order, ids, size: "▁words" not in order and same(order, ids, size)
    assert list(codec.run(texts)) == want and codec.odd == {"▁words"}


def test_components_in_rounds_as_in_one_task(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(70)]
    e = spark.createDataFrame(edges, "a long, b long")
    assert sorted(map(tuple, components(e).collect())) == sorted(map(tuple, components(e, local_links=0).collect()))




@pytest.mark.parametrize("num", [80, 85])
def test_tree_of_several_leaves(spark, monkeypatch, num):
    """Crowded buckets of near copies that often do not link, in leaves of eight, against brute force."""
    monkeypatch.setattr(setjoin, "LEAF", 8)
    monkeypatch.setattr(setjoin, "NEAR", 3)
    rng = random.Random(num)
    rows = []
    for g, n in enumerate((40, 120, 14)):
        base = [f"g{g}w{i}" for i in range(n)]
        for i in range(60):
            t = list(base)
            for j in range(rng.choice([0, 2, 6, n // 12, n // 7])):
                t[rng.randrange(n)] = f"e{g}-{i}-{j}"
            rows.append((len(rows), " ".join(t[: n - rng.choice([0, 0, n // 9])]), "en", "s"))
    got = {r["doc_id"]: r["component_id"] for r in setjoin.jaccard_components(docs(spark, rows), 1, num, 100).collect()}
    want = brute_components([set(t.split()) for _, t, *_ in rows], num, 100)
    assert [got[i] for i in range(len(rows))] == want
    assert len(set(want)) > 10 and max(Counter(want).values()) > 10


def test_boxes_prune(spark):
    """Leaves of other groups are skipped by their boxes; no pair that brute force finds is lost."""
    rng = np.random.default_rng(1)
    points, sets = [], []
    for g in range(12):
        base = rng.integers(0, 2**63, 90).astype(np.uint64)
        for i in range(10):
            h = np.unique(np.concatenate([base[rng.permutation(90)[: 90 - rng.integers(0, 9)]], rng.integers(0, 2**63, rng.integers(0, 9)).astype(np.uint64)]))
            f = setjoin.fine_counts(h)
            tile = setjoin._folded(np.frombuffer(f, np.uint8), 8).astype(">u4").tobytes()
            points.append((1, len(sets), len(sets), len(h), bytearray(f), bytearray(tile)))
            sets.append(set(h.tolist()))
    df = spark.createDataFrame(points, "cluster long, cid long, component long, n long, fine binary, tile binary")
    counted = []
    got = {tuple(r) for r in setjoin._tree_pairs(df, 85, 100, False, leaf=5, counted=counted).collect()}
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert want <= got and want and counted[2] < counted[1] <= counted[0]


def test_few_filled_blocks_lose_no_link(spark):
    """Sets that fill few of their blocks, in crowded buckets: links are those of brute force."""
    rng = random.Random(2)
    shared = [f"s{i}" for i in range(14)]
    rows = [(1, " ".join(shared), "en", "s"), (2, " ".join([*shared, "more"]), "en", "s")]
    for i in range(200):
        rows.append((10 + i, " ".join(rng.sample(shared, rng.randrange(4, 12)) + [f"own{i}-{k}" for k in range(rng.randrange(1, 16))]), "en", "s"))
    for words, num in ((1, 80), (1, 85)):
        got = {r["doc_id"]: r["component_id"] for r in setjoin.jaccard_components(docs(spark, rows), words, num, 100).collect()}
        want = brute_components([set(t.split()) for _, t, *_ in rows], num, 100)
        assert [got[i] for i, *_ in rows] == [rows[k][0] for k in want]
    assert got[2] == 1


def test_keys_are_shared_as_often_as_said():
    """Thousands of linked pairs, small and at the bounds of size classes, by the kinds of key."""
    rng = np.random.default_rng(8)
    tried = 0
    for num in (80, 85):
        for _ in range(4000):
            n = int(rng.integers(3, 90))
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            if rng.random() < 0.4:  # crowded into a part of the range
                a >>= np.uint64(int(rng.integers(1, 5)))
            b = np.concatenate([a[int(rng.integers(0, n // 6 + 1)) :], rng.integers(0, 2**64, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both < num * (len(a) + len(b) - both) or both == max(len(a), len(b)):
                continue
            tried += 1
            (ka, na), (kb, nb) = setjoin._keys(a, num, 100), setjoin._keys(b, num, 100)
            common = np.intersect1d(ka, kb)
            kinds = Counter((common & 3).tolist())
            assert len(common)
            for k, need in ((ka, na), (kb, nb)):
                # A set drops a kind only if too few of its keys meet; one kind that the pair shares must stay.
                assert any(kinds[t] >= need[(k & 3) == t].max(initial=0) for t in kinds)
                lone = kinds.get(2, 0)
                assert lone or all(kinds[t] >= need[(k & 3) == t].max(initial=0) for t in kinds if t < 2)
    assert tried > 2000
