"""Periodic runs against a direct scan of all periods, and grammar LCE against word by word comparison."""

import hashlib
import random
import re
import zlib

import numpy as np

from asterism.llm import periodic
from tests.llm.conftest import documents


def scan(words):
    """Runs ``(start, length, period)`` by start, then period: all stretches of every period, smallest period first."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


def sequences(seed, count, longest):
    r = random.Random(seed)
    for _ in range(count):
        k, n = r.choice([1, 2, 3, 5, 50]), r.randrange(longest)
        words = [r.randrange(k) for _ in range(n)]
        if n > 3 and r.random() < 0.6:
            a = r.randrange(n)
            p = 1 + r.randrange(max(1, (n - a) // 2))
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            if r.random() < 0.4:
                words[r.randrange(n)] = 99
        yield words


def test_runs_equal_a_scan():
    for words in sequences(1, 1500, 90):
        assert [tuple(r) for r in periodic.runs(np.array(words, np.int64)).tolist()] == scan(words)


def test_runs_in_small_blocks_of_places(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 16)
    for words in sequences(2, 200, 60):
        assert [tuple(r) for r in periodic.runs(np.array(words, np.int64)).tolist()] == scan(words)
    words = np.arange(5000) % 1700  # beyond the grids that are kept
    assert periodic.runs(words).tolist() == [[0, 5000, 1700]]


def test_grammar_answers_extensions():
    r = random.Random(3)
    for words in sequences(3, 150, 160):
        n = len(words)
        if n < 2:
            continue
        i, j = np.triu_indices(n, 1)
        after, before = periodic.Grammar(np.array(words, np.int64)).lce(i, j)
        for at in r.sample(range(len(i)), min(30, len(i))):
            x, y, e, b = i[at], j[at], 0, 0
            while y + e < n and words[x + e] == words[y + e]:
                e += 1
            while x - b > 0 and words[x - 1 - b] == words[y - 1 - b]:
                b += 1
            assert (after[at], before[at]) == (e, b)


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    runs = scan([numbers[w] for w in words])
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], sha(lines),
            sha(" ".join(w for k, w in enumerate(words) if k not in dropped)))


def query(docs):
    found = periodic.summary(periodic.find_runs(periodic.with_repeats(docs)))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_whole_table(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    short = [r for r in rows if len((r[1] or "").split()) <= 3000]  # the scan is quadratic
    assert len(short) > 0.95 * len(rows)
    want = {r[0]: r for r in (expected(*r) for r in short)}
    got = {r[0]: r for r in query(docs)}
    assert len(got) == len(rows) and {k: got[k] for k in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 10


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    quick = [r for r in rows if r[0] not in (13, 14)]
    got = query(edge_docs)
    assert len(got) == len(rows)
    assert [r for r in got if r[0] not in (13, 14)] == sorted((expected(*r) for r in quick), key=str)
    long = {r[0]: r for r in got}[13]
    assert long[1:6] == (1, 0, 48_000, 4, 12_000_000)
    assert query(no_docs) == []
    one = spark.createDataFrame([(5, "go " * 5000)], "doc_id long, text string")
    assert periodic.find_runs(one).collect()[0].asDict(True) == {
        "doc_id": 5, "runs": [{"start": 0, "length": 5000, "period": 1}], "collapsed": "go"}
