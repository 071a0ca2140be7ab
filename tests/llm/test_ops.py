"""Operators of llm on hard rows and against brute force: nulls, empty and long texts, ties, repeats, extra columns."""

import base64
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trivet.llm import capfilters, langid, pieces, quality, setjoin, warc
from trivet.llm.common import components
from trivet.llm.linededup import dedup_lines
from trivet.llm.linerules import line_rules
from trivet.llm.mixing import mix
from trivet.llm.queries import piece_model
from trivet.llm.urlfilter import filter_urls, intervals

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, size string, row string, `n` int, _t int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """Rows (doc_id, text, lang, source) with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, g, s, len(t or ""), 1, "x", "y", 2, 3) for i, t, g, s in rows], DOCS)


@pytest.fixture(scope="module")
def hard(spark):
    long = "word " * 60_000 + "end"
    rows = [
        (1, "The quick brown fox jumps over the lazy dog tonight\nA second line here", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "   \n\t ", "en", "b"), (None, "orphan text of no id at all", "de", "b"),
        (5, long, "en", "c"), (6, "twin text here\nwith a line", "en", "c"), (6, "twin text here\nwith a line", "en", "c"), (7, "twin text here\nwith a line", "fr", None), (8, "12345 !!! ???", None, "é"),
        (9, "ﬀ 世界 \x00 😀 ▁ tail  ", "fr", "Z"),
    ]
    return docs(spark, rows)


def empty(df):
    return df.limit(0)


def test_mix(spark, hard):
    out = mix(hard).collect()
    assert len(out) == 11 and sorted(map(repr, out)) == sorted(map(repr, mix(hard).collect()))
    by = {}
    for r in out:
        assert r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], [r["source_size"], 0, r["target"]])[1] += r["size"]
    assert all(a == b for a, b, _ in by.values())
    total = sum(a for a, _, _ in by.values())
    assert sum(t for _, _, t in by.values()) == pytest.approx(1.5 * total) and all(t <= 2 * a + 1e-9 for a, _, t in by.values())
    assert mix(empty(hard)).count() == 0
    many = docs(spark, [(i, "w " * (1 + i % 7), "en", f"s{i % 5 if i % 3 else 0}") for i in range(3000)])
    got = {r["source"]: (r["taken"], r["target"]) for r in mix(many).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(abs(a - b) <= 8 for a, b in got.values())


def test_language(spark, hard):
    out = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(hard).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (8, "und")} <= out
    assert langid.identify(empty(hard)).count() == 0
    nothing = langid.identify(hard.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and {r["score"] for r in nothing} == {0.0}
    # The scores are those of the kernel machine written out.
    texts, langs = ["aab ab", "abba ba", "xyz zyx", "zzx yx"], ["a", "a", "x", "x"]
    m = langid.fit(texts, langs)
    flags = [set() for _ in texts]
    buf = np.zeros(m.lengths << langid.BITS, bool)
    for s, t in zip(flags, texts, strict=True):
        langid.ngram_flags(t, buf, m.lengths)
        s.update(np.flatnonzero(buf).tolist())
    k = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in flags] for a in flags])
    assert np.allclose(k, k.T) and m.predict(texts)[0] == langs
    n = {len(t) - i for t in ("aab ab",) for i in range(3)}
    assert len(flags[0]) <= sum(n)


def test_pieces(spark, hard):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in pieces.encode_pieces(hard, piece_model()).collect()}
    for r in hard.collect():
        ids = lib.encode(r["text"] or "", add_bos=True, add_eos=True)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert (r["doc_id"], sha, hashlib.sha256(lib.decode(ids).encode()).hexdigest(), len(ids)) in rows
    assert pieces.encode_pieces(empty(hard), piece_model()).count() == 0
    codec = pieces.PieceCodec(piece_model())
    rng = random.Random(2)
    letters = [*"abcdeéß \n\t\r▁世的😀\x00{};", "  ", "the ", "", "<s>"]
    for _ in range(60):
        some = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 4, 40, 120]))) for _ in range(8)]
        for t, (ids, text) in zip(some, codec.run(some), strict=True):
            theirs = lib.encode(t, add_bos=True, add_eos=True)
            assert np.frombuffer(ids, "<u4").tolist() == theirs and text == lib.decode(theirs)
    word = "internationalisation" * 5
    assert codec._merge_one("▁" + word) == lib.encode(word)


def test_urls(spark):
    d = lambda n: f"date'2024-01-{n:02d}'"
    e = spark.sql(f"""select * from values ('x.com','spam','add',{d(5)}),('x.com','spam','add',{d(6)}),('x.com','spam','remove',{d(10)}),('x.com','spam','add',{d(20)}),
      ('x.com','spam','remove',{d(20)}),('x.com/a','ads','add',{d(1)}),('y.org',null,'add',{d(1)}),(null,'z','add',{d(1)}),('q.com','z','remove',{d(1)}) as t(key,category,op,day)""")
    assert sorted(map(str, [(r["key"], r["start"].day, r["stop"] and r["stop"].day) for r in intervals(e).collect()])) == sorted(
        map(str, [("x.com", 5, 10), ("x.com", 20, None), ("x.com/a", 1, None), ("y.org", 1, None)])
    )
    c = spark.sql(f"""select * from values (1,'http://x.com/',{d(4)}),(2,'http://X.com./a/b?q',{d(5)}),(3,'https://u:p@sub.x.com:80/',{d(9)}),(4,'http://x.com/z',{d(10)}),(5,'http://x.com',{d(20)}),
      (6,null,{d(5)}),(7,'no url',{d(5)}),(8,'http://x.com/',null),(9,'http://y.org#x',{d(2)}),(9,'http://y.org#x',{d(2)}) as t(page_id,url,fetch_day)""").withColumn("key", F.lit("clash"))
    out = {r["page_id"]: (r["n_active"], r["categories"], r["blocked"]) for r in filter_urls(c, e).collect()}
    assert out == {1: (0, "", False), 2: (2, "ads,spam", True), 3: (1, "spam", True), 4: (0, "", False), 5: (1, "spam", True), 6: (0, "", False), 7: (0, "", False), 8: (0, "", False), 9: (1, "unknown", True)}
    assert filter_urls(c, e).count() == 10 and filter_urls(c.limit(0), e).count() == 0 and filter_urls(c, e.limit(0)).where("blocked").count() == 0


def test_line_dedup(spark, hard):
    out = dedup_lines(hard, carry=("lang",)).collect()
    assert len(out) == 11 and [r["text"] for r in out if r["doc_id"] == 2] == [None]
    assert {r["text"] for r in out if r["doc_id"] == 6} == {"twin text here\nwith a line"}
    assert dedup_lines(empty(hard)).count() == 0
    rng = random.Random(1)
    line = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(6)) + str(rng.random())
    shared = [line() for _ in range(12)]
    rows = [(i, "\n".join([*[line() for _ in range(rng.randrange(4))], *shared, *[line() for _ in range(3)]]), "en", "s") for i in range(300)]
    got = {r["doc_id"]: r for r in dedup_lines(docs(spark, rows)).collect()}
    # Boundaries behind the second shared line depend on shared lines alone: chunks between them go everywhere but once.
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in shared]
    ends = [i for i in range(1, 12) if ((h[i - 1] % 2**31) * 1_000_003 + h[i]) % 2**31 % 2 == 0]
    inner = sum(b - a for a, b in zip(ends, ends[1:]) if b - a >= 2)
    assert got[0]["n_removed"] == 0 and inner > 0 and min(r["n_removed"] for i, r in got.items() if i) >= inner
    for i, text, _, _ in rows:  # only shared lines go, the rest keeps its order
        own = [x for x in text.split("\n") if x not in shared]
        assert [x for x in got[i]["text"].split("\n") if x not in shared] == own


def base_rules(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for i, g in enumerate(grams):
        seen.setdefault(g, []).append(i)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    covered = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_line_rules(spark, hard):
    rng = random.Random(4)
    rows = [(100 + i, "\n".join(" ".join(rng.choice(["a", "b", "c|", "#d"]) for _ in range(rng.randrange(12))) for _ in range(6)), "en", "r") for i in range(40)]
    rows += [(200 + i, "Common Line 1 of the host\n" + " ".join(f"w{rng.random()}" for _ in range(2 if i == 0 else 40)) + "\ncommon  line 2 of the host", "en", "h") for i in range(60)]
    every = hard.unionByName(docs(spark, rows))
    out = line_rules(every).collect()
    want = {}
    for r in every.collect():
        want.setdefault(r["doc_id"], base_rules(r["text"]))
    assert len(out) == 111
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want[r["doc_id"]]
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert not kept[200] and all(kept[200 + i] for i in range(1, 60))
    assert line_rules(empty(hard)).count() == 0


def test_quality(spark, hard):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(None, 1, 0), (900, None, 0)], "doc_id long, quality int, toxic int")
    rows = [(i, " ".join(f"plain words flow on {random.Random(i).random()}" if i % 2 else "SPAM!! BUY!! NOW!!" for _ in range(20)), "en", "s") for i in range(400)]
    out = quality.classify(docs(spark, rows).unionByName(hard), labels).collect()
    assert len(out) == 411 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    test = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 10]
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in test) / len(test) > 0.95
    assert quality.classify(empty(hard), labels).count() == 0 and quality.classify(hard, labels.limit(0)).count() == 11


def test_warc(spark):
    page = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, None), (4, "http://c\r\nX: y", ""), (None, "http://d/", "lone"), (5, "u", "é" * 100_000), (6, "u", "same"), (6, "u", "same"), (7, "u", "other\r\n\r\nbody")]
    pages = spark.createDataFrame(page, "page_id long, url string, html string").withColumn("d", F.lit("clash"))
    out = warc.read_archives(spark, warc.write_archives(pages)).collect()
    assert len(out) == 9
    for r in out:
        p = next(((h or "").encode() for i, _, h in page if i == r["page_id"]), b"")
        same = [i for i, _, h in page if (h or "").encode() == p and i is not None]
        assert r["payload_bytes"] == len(p) and r["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
        first = min(same) if same else None
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == first else ("revisit", first))
        assert bytes(r["payload"]) == (p if r["record_type"] == "response" else b"")
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0
    raw = warc.train_dictionary([f"<html><p>page {i} of the site</p></html>".encode() * 20 for i in range(200)], 2000)
    assert raw and warc.dictionary_frame(raw)[:4] == b"\x5d\x2a\x4d\x18"


def test_cap_filters(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 32))
    x[:60] = x[0] + 0.2 * rng.standard_normal((60, 32))
    x[60:70] = x[60]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 32, 0), (503, [float("nan")] * 32, 0), (504, [None] * 32, 0), (505, [1.0, 2.0], 0), (None, x[60].tolist(), 0), (70, x[70].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = capfilters.cap_links(df, block=16).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    extra = np.zeros(400, int)
    extra[60:70] = 1
    extra[70] = 1
    links = near.sum(1) - 1 + extra
    by = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows) and all(by[i]["n_links"] == links[i] for i in range(400))
    assert all((by[i]["n_links"], by[i]["component_id"], by[i]["kept"]) == (0, i, True) for i in range(500, 506))
    assert by[None]["component_id"] == 60 and by[65]["component_id"] == 60 and not by[65]["kept"]
    assert capfilters.cap_links(df.limit(0)).count() == 0


def brute_components(sets, num, den):
    par = list(range(len(sets)))

    def root(i):
        while par[i] != i:
            i = par[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                par[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("words,num", [(4, 85), (5, 80)])
def test_jaccard(spark, hard, words, num):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(200)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(rng.choice([0, 1, 3, 5, 7])):
            t[rng.randrange(200)] = rng.choice(vocab)
        rows.append((1000 + i, " ".join(t) if i % 2 else " ".join(t).upper(), "en", "s"))
    rows += [(2000 + i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 4, 5, 30]))), "en", "s") for i in range(80)]
    every = hard.unionByName(docs(spark, rows))
    out = setjoin.jaccard_components(every, words, num, 100).collect()
    plain = sorted({(r["doc_id"], r["text"]) for r in every.collect() if r["doc_id"] is not None}, key=lambda x: x[0])

    def shingle(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = WORD.findall(w)
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())

    sets = [shingle(t) for _, t in plain]
    comp = brute_components(sets, num, 100)
    want = {d: (len(s), plain[c][0]) for (d, _), s, c in zip(plain, sets, comp, strict=True)}
    assert len(out) == len(rows) + 11
    for r in out:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert sum(r["kept"] for r in out if r["doc_id"] == 6) == 1
    assert setjoin.jaccard_components(empty(hard)).count() == 0


def test_sub_vectors_share_a_block():
    rng = np.random.default_rng(2)
    for n in (8, 20, 60, 300, 2000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            drop = rng.integers(0, int(0.15 * n / 1.85 * 2) + 1)
            b = np.unique(np.concatenate([a[: len(a) - drop // 2], rng.integers(0, 2**63, drop - drop // 2).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                assert set(setjoin.sub_vectors(a, 85, 100).tolist()) & set(setjoin.sub_vectors(b, 85, 100).tolist())
                assert setjoin.overlap_bound(setjoin.fine_counts(a), setjoin.fine_counts(b)) >= both


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (5, 5), (None, 4)], "a long, b long")
    assert {r["id"]: r["component"] for r in components(e).collect()} == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20}
