from __future__ import annotations

import random

from tests.llm import cases
from tidemark.llm import line_dedup as L


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[at + 1 :] == b[at + 1 :] or a[at:] == b[at + 1 :] or a[at + 1 :] == b[at:]


def brute(texts, least=L.MIN_CHARS, exact=1):
    before, out = [], {}
    for i in sorted(texts):
        gone = []
        for at, line in enumerate((texts[i] or "").split("\n")):
            line = line.strip(" \t\r")
            if len(line) >= exact:
                near = [x for x in before if len(x) >= least] if len(line) >= least else ()
                if line in before or any(one_edit(line, x) for x in near):
                    gone.append(at)
                before.append(line)
        out[i] = gone
    return out


def corpus(rng):
    bases = ["".join(rng.choices("abé ", k=rng.randrange(8, 60))).strip() for _ in range(12)] + ["aaaaaaaaaaaa", "abababababab"]
    texts = {}
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(bases))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(line))
                line[at : at + rng.randrange(2)] = rng.choice(["", "x", "é"])
            lines.append("".join(line) + rng.choice(["", " ", "\r"]))
        texts[i] = "\n".join(lines)
    return texts


def test_equals_brute_force(spark):
    for seed in (1, 2):
        texts = corpus(random.Random(seed))
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
        expected = brute(texts)
        got = {r.doc_id: r.removed for r in L.digest(docs).collect()}
        assert got == {i: ",".join(map(str, x)) for i, x in expected.items()}
        for r in L.dedup(docs).collect():
            left = [x for at, x in enumerate(texts[r.doc_id].split("\n")) if at not in expected[r.doc_id]]
            assert r.text == "\n".join(left) and r.n_removed == len(expected[r.doc_id])


def test_one_long_line_and_its_near_copy(spark):
    line = "".join(random.Random(1).choices("abcdef ", k=60_000)).strip()
    texts = {1: line, 2: line[:20_000] + "x" + line[20_000:], 3: line[:-1], 4: line[:5] + "yy" + line[7:]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in L.digest(docs).collect()} == {1: 0, 2: 1, 3: 1, 4: 0}


def test_odd_rows(spark):
    docs = cases.documents(spark)
    rows = L.digest(docs).collect()
    assert len(rows) == docs.count()
    got = cases.by_id(L.digest(docs))
    assert (got[0].n_lines, got[1].n_lines, got[7].n_removed, got[8].n_removed) == (0, 0, 0, 1)
    assert got[None].n_removed == 0
    cleaned = L.dedup(docs)
    assert cleaned.columns == [*docs.columns, "n_removed"]
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[0] is None and texts[1] == "" and texts[8] == "" and texts[5] == cases.LONG
    assert texts[None] == "a text without an id"
    assert L.digest(cases.empty(spark)).count() == 0 and L.dedup(cases.empty(spark)).count() == 0


def test_a_hot_line_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(L, "HOT_TIMES", 5)
    texts = {i: f"the same line everywhere\nan own line number {i * i} {i}" for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.removed for r in L.digest(docs).collect()} == {i: "0" if i else "" for i in texts}


def test_short_lines_go_as_equal_lines_only(spark):
    texts = {1: "menu\n\na line of many letters\nmenus", 2: "menu \n\na line of many letter\nmenu", 3: "x\nmenus\n\nx", 4: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.removed) for r in L.digest(docs).collect()}
    assert got == {1: (3, ""), 2: (3, "0,2,3"), 3: (3, "1,3"), 4: (0, "")}
    cleaned = {r.doc_id: r.text for r in L.dedup(docs).collect()}
    assert cleaned == {1: texts[1], 2: "", 3: "x\n", 4: None}
    longer = {r.doc_id: r.removed for r in L.digest(docs, exact_chars=10).collect()}
    assert longer == {1: "", 2: "2", 3: "", 4: ""}
