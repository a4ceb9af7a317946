from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from tests.llm import cases
from tidemark.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, seen, dup = Counter(windows), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def verdicts(rows, limit, least, left):
    norm = lambda t: [" ".join(WORD.findall(x.translate({c: c + 32 for c in range(65, 91)}))) for x in (t or "").split("\n")]
    holders = defaultdict(set)
    for _, host, text in rows:
        for line in norm(text):
            holders[host, line].add(tuple(" ".join(norm(text)).split()))
    out = {}
    for i, host, text in rows:
        n, _, _, _, repeated = counts(text)
        failed = n < 20 or 100 * repeated > 30 * n
        sizes = [(len(x.split()), len(holders[host, x]) > limit and len(x.split()) >= least) for x in norm(text)]
        rest = sum(s for s, taken in sizes if not taken)
        out[i] = (failed, not failed and rest >= left * n, n - rest)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.choices(["a", "Bb", "c#", "é|", "dd"], k=rng.randrange(12))) for _ in range(25)]
    rows = [(i, rng.choice(["x", "y", None]), "\n".join(rng.choices(lines, k=rng.randrange(9)) + [f"own line {i} " * rng.randrange(3)])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    expected = verdicts(rows, 6, 3, 0.5)
    got = Q.judge(df, max_documents=6, min_line_words=3).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id][2]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(text)
        assert (r.base_failed, r.kept, r.n_common_words) == expected[r.doc_id]
    assert len({r.kept for r in got if not r.base_failed}) == 2


def test_odd_rows(spark):
    docs = cases.documents(spark)
    rows = Q.judge(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    assert Q.judge(cases.empty(spark)).count() == 0


def test_short_lines_of_a_host_are_taken_away(spark):
    own = [" ".join(f"w{i}_{j}" for j in range(11)) for i in range(12)]
    menu = "".join(f"Menu {c}\n" for c in "abcdefgh")
    rows = [(i, "x", menu + own[i]) for i in range(12)] + [(12, "y", menu + own[0])]
    expected = verdicts(rows, 10, 1, 0.5)
    got = {r.doc_id: (r.base_failed, r.kept, r.n_common_words) for r in Q.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert got == expected
    assert got[0] == (False, False, 16) and got[12] == (False, True, 0)
