"""Near-duplicates by tensored banding against all pairs of shingle sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from asterism.llm import minhash
from tests.llm.conftest import documents


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(len(words), 3)
    return frozenset(tuple(words[k:k + n]) for k in range(len(words) - n + 1)) if n else frozenset()


def linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 85 * (len(a) + len(b) - both)


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text)."""
    classes = defaultdict(list)
    for k, (_, text) in enumerate(rows):
        classes[shingles(text) or k].append(k)
    sets = [s for s in classes if not isinstance(s, int)]
    root = {s: s for s in sets}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    index = defaultdict(list)
    for a in sets:
        for b in {b for t in a for b in index[t]}:
            if linked(a, b):
                root[find(a)] = find(b)
        for t in a:
            index[t].append(a)
    least, out = {}, []
    for s in sets:
        ids = [rows[k][0] for k in classes[s] if rows[k][0] is not None]
        if ids:
            least[find(s)] = min(ids + [least[find(s)]] if find(s) in least else ids)
    for doc_id, text in rows:
        s = shingles(text)
        comp = least.get(find(s)) if s else doc_id
        out.append((doc_id, len(s), comp, comp is not None and doc_id == comp))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert result(minhash.near_duplicates(docs)) == want
    assert sum(c != d for d, _, c, _ in want) > 20  # the table does hold near copies


def family(seed, copies, edits, length=80):
    """A text and copies with up to ``edits`` words changed, so that similarities lie on both sides of the threshold."""
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(copies):
        words = list(base)
        for k in r.sample(range(length), r.randrange(edits + 1)):
            words[k] = f"x{r.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_families_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)
    monkeypatch.setattr(minhash, "PAIRS_A_COPY", block)
    texts = family(1, 60, 4) + family(2, 40, 8) + family(3, 30, 2) + ["one two", "ONE two", "one", "", None]
    rows = list(enumerate(texts, 100))
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(minhash.near_duplicates(docs)) == brute(rows)


def test_chain_links_through_members_that_the_first_does_not_match(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[8 * k:8 * k + 200])) for k in range(20)]  # neighbours share 190 of 206 shingles
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in minhash.near_duplicates(docs).collect()} == {0}


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert result(minhash.near_duplicates(edge_docs)) == brute(rows)
    assert minhash.near_duplicates(no_docs).collect() == []
    twice = spark.createDataFrame([(7, "a b c d e"), (7, "f g h i j"), (None, "f g h i j"), (9, "F g h i j"), (None, "k l m n")],
                                  "doc_id long, text string")
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(twice).collect()) == [
        ("7", "7", True), ("7", "7", True), ("9", "7", False), ("None", "7", False), ("None", "None", False)]


def test_tables_are_pairs_of_bands():
    rng = np.random.default_rng(3)
    shared, hits = rng.integers(1 << 62, size=400, dtype=np.uint64), 0
    sig = minhash.signatures([np.concatenate([shared, rng.integers(1 << 62, size=35, dtype=np.uint64)]) for _ in range(200)])
    bands = minhash._bands(sig)
    assert bands.shape == (200, 2 * minhash.BANDS)
    same = bands[:-1] == bands[1:]  # similarity 400 / 470
    hits = (same[:, :minhash.BANDS].any(axis=1) & same[:, minhash.BANDS:].any(axis=1)).mean()
    assert hits > 0.99
    agree = (sig[:-1] == sig[1:]).mean()  # a minhash agrees as often as the sets are similar
    assert abs(agree - 400 / 470) < 0.02


def test_words_are_cut_as_the_contract_says():
    seen = minhash.WordHashes()
    for text in ("a\x0bb c\xa0d e", "É é  x", "A B\tc\nd", " lone ", "two words", "a b a b a b"):
        assert len(minhash.shingle_set(text, seen)) == len(shingles(text))
    assert (minhash.shingle_set("A b C d", seen) == minhash.shingle_set("a  B\tc D ", seen)).all()
