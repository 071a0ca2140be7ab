"""Repeated passages go whole, against plain Python."""

import random

from test_ops import WORD, docs
from test_pipeline import plain_runs

import corpus_pipeline
from trivet.llm.linededup import dedup_runs


def test_repeated_passages_go_whole(spark):
    rng = random.Random(6)
    line = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(6)) + str(rng.random())
    shared = [line() for _ in range(7)]
    rows = []
    for i in range(60):
        body = [line() for _ in range(rng.randrange(1, 7))]
        if i % 3 == 1:
            n = rng.randrange(2, 8)
            body[1:1] = shared[:n]
        if i % 5 == 2:
            body += ["", "", *shared[2:4], ""]
        rows.append((i, "\n".join(body)))
    rows += [(100 + i, t) for i, t in rows[:20]] + [(200, "one\ntwo"), (201, "one\ntwo"), (202, "one"), (203, "\n\n"), (204, "\n\n")]
    got = {r["doc_id"]: r for r in dedup_runs(docs(spark, [(i, t, "en", "s") for i, t in rows] + [(300, None, "en", "s"), (201, "one\ntwo", "en", "s")]), carry=("lang",)).collect()}
    want = plain_runs(rows)
    for i, t in rows:
        assert (got[i]["text"], got[i]["n_removed"]) == ("\n".join(want[i]), len(t.split("\n")) - len(want[i]))
    for i, t in rows[:20]:  # a copy keeps no word, unless it is a single line
        assert "\n" not in t or not WORD.search(got[100 + i]["text"])
    assert got[201]["text"] == "" and got[203]["text"] == "\n\n" and got[300]["text"] is None
    assert dedup_runs(docs(spark, []).limit(0)).count() == 0


def test_pipeline_drops_copies_whole(spark):
    rng = random.Random(8)
    texts = ["\n".join(f"line {rng.random()} of the text" for _ in range(6)) for _ in range(40)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(100 + i, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(200 + i, f"alone {rng.random()}\n{t}\nalone {rng.random()}", "en", "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs(spark, rows), "").collect()}
    assert set(got) == {*range(40), *range(200, 240)}
    assert all(got[i] == t for i, t in enumerate(texts)) and all(len(got[200 + i].split("\n")) == 2 for i in range(40))
