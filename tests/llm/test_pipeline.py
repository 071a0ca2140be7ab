"""The pipeline against plain Python, stage by stage in one program."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import sentencepiece
from test_ops import WORD, brute_components, docs

import corpus_pipeline
from trivet.llm import langid
from trivet.llm.queries import piece_model


def plain_runs(rows):
    """The lines that stay of each row (id, text), in order of ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        a, gone = t.split("\n"), set()
        for k in range(len(a) - 1):
            if (a[k], a[k + 1]) in seen:
                gone |= {k, k + 1}
            seen.add((a[k], a[k + 1]))
        run, drop = [], set()
        for k in range(len(a) + 1):
            if k in gone:
                run.append(k)
            else:
                drop |= set(run) if any(WORD.search(a[j]) for j in run) else set()
                run = []
        out[i] = [x for k, x in enumerate(a) if k not in drop]
    return out


def plain_lines(rows):
    """The text of each row without the passages of lines that stand earlier; rows that lose all words go."""
    kept = plain_runs([r[:2] for r in rows])
    return [(i, "\n".join(kept[i]), g, s) for i, t, g, s in sorted(rows) if len(kept[i]) == len(t.split("\n")) or WORD.search("\n".join(kept[i]))]


def plain_mix(rows):
    size = {i: len(WORD.findall(t)) for i, t, *_ in rows}
    total = Counter()
    for i, _, _, s in rows:
        total[s] += size[i]
    names = sorted(total)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_ = {}, 1.5 * sum(total.values())
    left = set(names)
    while left:
        level = open_ / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 2 * total[s]}
        for s in over or left:
            target[s] = 2 * total[s] if over else level * weight[s]
            open_ -= target[s] if over else 0
        left = left - over if over else set()
    copies = {}
    for s in names:
        mine = sorted((int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i) for i, _, _, x in rows if x == s)
        full = int(target[s] // total[s])
        rest, more = target[s] - full * total[s], True
        for _, i in mine:
            take = more and rest > 0 and (size[i] <= rest or size[i] <= 2 * rest)
            more = more and size[i] <= rest
            rest -= size[i] if take else 0
            copies[i] = full + bool(take)
    return [i for i, *_ in rows for _ in range(copies[i])]


def test_pipeline(spark, tmp_path):
    rng = random.Random(3)
    words = {g: ["".join(rng.choice(a) for _ in range(rng.randrange(2, 7))) for _ in range(300)] for g, a in (("en", "abcdet"), ("fr", "éèlou"))}
    line = lambda g: " ".join(rng.choice(words[g]) for _ in range(8))
    shared = [line("en") for _ in range(8)]
    rows = []
    for i in range(120):
        g = "en" if i % 3 else "fr"
        own = [line(g) for _ in range(6)]
        if i % 10 == 1:
            own = own[:2] + shared + own[2:]
        if i % 10 == 5:  # a near copy of the row before, its lines joined otherwise
            w = rows[-1][1].split()
            w[3] = "edit"
            own = [" ".join(w)]
        rows.append((i, "\n".join(own), g, f"s{i % 4}"))
    rows += [(500, "123 ...", "en", "s0"), (501, None, "en", "s1"), (502, rows[7][1], "en", "s2")]
    docs(spark, rows).select(*corpus_pipeline.COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    model = langid.train(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    found = dict(zip([r[0] for r in rows], zip(*model.predict([r[1] for r in rows]), strict=True), strict=True))
    kept = [r for r in rows if found[r[0]][0] != "und" and found[r[0]][1] >= corpus_pipeline.MIN_SCORE]
    assert {r[0] for r in rows} - {r[0] for r in kept} == {500, 501}
    kept = plain_lines(kept)

    def shingle(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}

    comp = brute_components([shingle(t) for _, t, *_ in kept], 80, 100)
    kept = [r for k, r in enumerate(kept) if comp[k] == k]
    assert len(kept) < 120
    lib = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    sha = {i: hashlib.sha256(np.array(lib.encode(t, add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest() for i, t, *_ in kept}
    assert got == Counter((i, sha[i]) for i in plain_mix(kept))
