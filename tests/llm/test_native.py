"""The operators without Python on the main path, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from asterism.llm import decontam, dedup, pii, secret_scan, sharding
from asterism.llm.common import join_groups, spool
from asterism.llm.spans import AFTER, BEFORE, find_spans
from tests.conftest import plan
from tests.llm.conftest import documents

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


# --- pii ---

PII_BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn_ok(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_base(text, kinds):
    found = [(m.start(), k, m.end(), kind) for k, (kind, (p, ok)) in enumerate(kinds.items())
             for m in re.finditer(p, text or "") if ok(m[0])]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def check_base(df, summary, kinds):
    want = Counter()
    for doc_id, text in pairs(df):
        spans = brute_base(text, kinds)
        n = Counter(s.split(":")[0] for s in spans)
        want[(doc_id, *(n[k] for k in kinds), hashlib.sha256(",".join(spans).encode()).hexdigest())] += 1
    got = Counter((r["doc_id"], *(r[f"n_{k}"] for k in kinds), r["base_sha256"]) for r in summary.collect())
    assert got == want


@pytest.mark.parametrize("which", ["edge", "real"])
def test_pii_base_spans_equal_brute_force(spark, edge_docs, which):
    # the long run of one letter is quadratic for the plain pattern of this test, not for the operator
    df = edge_docs.where("doc_id is null or doc_id <> 15") if which == "edge" else documents(spark)
    check_base(df, pii.summary(pii.find_pii(df)), PII_BASE)


def test_pii_method_spans_and_scores(edge_docs):
    rows = {r["doc_id"]: r for r in pii.summary(pii.find_pii(edge_docs)).collect()}
    kinds = [s.split(":")[0] for s in rows[10]["spans"].split(",")]
    assert kinds == ["iban", "ssn"]  # the second number is no valid one
    assert rows[10]["scores"].split(",") == ["100", "60"]
    assert rows[15]["spans"] == "" and rows[1]["spans"] == ""


def test_ssn_needs_context(spark):
    df = spark.createDataFrame([(1, "order 123-45-6789"), (2, "SSN 123-45-6789"), (3, "GB82WEST12345698765433")],
                               "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in pii.summary(pii.find_pii(df)).collect()} == {1: "", 2: "ssn:4:15", 3: ""}


def test_context_is_the_text_around_and_whole_words(spark):
    rng = random.Random(4)
    pattern = "[0-9]{5,}"
    texts = ["".join(rng.choice(["12345", " ", "é", "a b", "1234567", "x" * 30]) for _ in range(60)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = df.select("doc_id", find_spans(F.col("text"), pattern, context=True).alias("s")).collect()
    for i, spans in got:
        want = [(m.start(), m.end(), m[0], texts[i][max(0, m.start() - BEFORE):m.start()], texts[i][m.end():m.end() + AFTER])
                for m in re.finditer(pattern, texts[i])]
        assert [tuple(s) for s in spans] == want
    rows = ["ssn 123-45-6789, 223-45-6789", "ssns: 123-45-6789", "xssn 123-45-6789", "shipping 10.0.0.1", "ip 10.0.0.1, 10.0.0.2",
            "hotel +49 30 1234567", "123-45-6789 is my SSN", "discard 4111 1111 1111 1111"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: (r["spans"].count(":") // 2, r["scores"]) for r in pii.summary(pii.find_pii(df)).collect()}
    assert found == {0: (2, "60,60"), 1: (1, "60"), 2: (0, ""), 3: (1, "50"), 4: (2, "70,70"), 5: (1, "60"), 6: (1, "60"), 7: (1, "80")}


def test_many_spans_in_one_text(spark):
    text = "é ".join(f"u{i}@mail.example.com" for i in range(5000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    check_base(df, pii.summary(pii.find_pii(df)), PII_BASE)


# --- secrets ---

SECRET_BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: len(re.search(r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", m)[1]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m) >= 24),
}


@pytest.mark.parametrize("which", ["edge", "real"])
def test_secret_base_spans_equal_brute_force(spark, edge_docs, which):
    df = edge_docs if which == "edge" else documents(spark)
    check_base(df, secret_scan.summary(secret_scan.find_secrets(df)), SECRET_BASE)


def battery(hit, symbols):
    """The same tests in plain Python, with the exact normal tail."""
    import math

    v = [symbols.index(c) for c in hit]
    n, size = len(v), len(symbols)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = size / n * sum(k * k for k in Counter(v).values()) - n
    p = [tail((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (1 - 1 / n)))]
    high = [x >= size / 2 for x in v]
    mean = 2 * sum(high) * (n - sum(high)) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    p.append(2 * tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0)
    m = sum(v) / n
    r = sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / sum((a - m) ** 2 for a in v)
    p.append(2 * tail(abs((r + 1 / n) * math.sqrt(n))))
    h = -sum(math.log(max(q, 1e-30)) for q in p)
    return min(1.0, math.exp(-h) * (1 + h + h * h / 2))


def test_randomness_battery(spark):
    rng = random.Random(5)
    b62 = secret_scan.ENCODINGS["base62"][0]
    hits = ["".join(rng.choices(b62, k=k)) for k in (24, 40, 64)] + ["Aa1" * 10, "".join(rng.choices("0123456789abcdef", k=40))]
    df = spark.createDataFrame([(i, h) for i, h in enumerate([*hits, "onlylettersandnothingelse", "123456789012345678901"])],
                               "doc_id long, hit string")
    got = {r["doc_id"]: r["p"] for r in df.select("doc_id", secret_scan.randomness(F.col("hit")).alias("p")).collect()}
    for i, h in enumerate(hits):
        symbols = "0123456789abcdef" if i == 4 else b62
        assert got[i] == pytest.approx(battery(h, symbols), rel=1e-3, abs=1e-6)
    assert got[5] is None and got[6] is None


def test_random_strings_stay_and_patterned_ones_go(spark):
    rng = random.Random(1)
    b62 = secret_scan.ENCODINGS["base62"][0]
    rows = [(i, "key " + "".join(rng.choices(b62, k=40)) + " end") for i in range(200)]
    rows += [(1000 + i, "see " + "Ab1" * 14 + " end") for i in range(200)]
    found = secret_scan.summary(secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")))
    n = {r["doc_id"]: r["n_random"] for r in found.collect()}
    lost = 200 - sum(n[i] for i in range(200))
    assert sum(v for i, v in n.items() if i >= 1000) == 0
    assert lost / (200 + lost) <= 0.03  # of all dismissed, at a rate of 0.01 and some chance


LOWER36, UPPER36 = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WORDY = ["the-state-of-the-art-in-information-retrieval", "some_rather_long_function_name_in_the_code",
         "internationalization-of-the-interface", "documents/archive/reports/annual/summary",
         "sectionandsubsectionheadings", "THE_MAXIMUM_NUMBER_OF_RETRIES_ALLOWED"]


def tokens(seed, count=60):
    """Tokens of the shapes that the encodings with both cases and a digit leave out; prefix, token."""
    import uuid

    rng = random.Random(seed)
    draw = lambda symbols, k: "".join(rng.choices(symbols, k=k))
    uuid4 = lambda: str(uuid.UUID(int=rng.getrandbits(128), version=4))
    return [t for _ in range(count) for t in [
        ("", draw(LOWER36, 32)), ("", draw(UPPER36, 32)), ("", uuid4()), ("", uuid4().upper()),
        ("", draw(LOWER36[:26], 32)), ("", draw(UPPER36[:26], 32)), ("", draw(LOWER36[:26] + UPPER36[:26], 32)),
        ("", "key-" + draw(LOWER36, 32)), ("https://example.org/documents/archive/reports/annual/", draw(LOWER36, 32)),
        ("https://example.org/documents/archive/the-annual-", uuid4())]]


def test_tokens_of_one_case_uuids_and_path_parts_stay_and_words_go(spark):
    planted = tokens(3)
    rows = [(i, f"see {a}{t} end") for i, (a, t) in enumerate(planted)]
    rows += [(10_000 + i, f"see {w} end") for i in range(100) for w in WORDY]
    found = secret_scan.summary(secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")))
    got = defaultdict(list)
    for r in found.select("doc_id", "spans").collect():
        got[r["doc_id"]] += [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("random:")]
    assert not any(v for i, v in got.items() if i >= 10_000)
    lost = [t for i, (a, t) in enumerate(planted)
            if not any(s <= 4 + len(a) + (4 if t.startswith("key-") else 0) and e == 4 + len(a + t) for s, e in got[i])]
    assert len(lost) <= 0.03 * len(planted), lost
    # the words of the path before a token are mostly no part of its span
    paths = [i for i, (a, _) in enumerate(planted) if a]
    assert sum(all(s == 4 + len(planted[i][0]) for s, _ in got[i]) for i in paths) >= 0.7 * len(paths)


def test_long_runs_are_tested_in_linear_time(spark):
    run = "".join(random.Random(4).choices(LOWER36 + UPPER36, k=100_000))
    p = spark.createDataFrame([(run,), ("a" * 200_000,)], "hit string").select(
        secret_scan.run_randomness(F.col("hit")).alias("p")).collect()
    assert p[0]["p"] == pytest.approx(battery(run, secret_scan.ENCODINGS["base62"][0]), rel=1e-3, abs=1e-6)
    assert p[1]["p"] < 1e-30


# --- exact dedup ---

@pytest.mark.parametrize("n", [2_000, 60_000])
def test_rows_hashed_in_full_keep_their_share_as_groups_grow(spark, n):
    """Every tenth row has a copy; the others, of the same lengths, stay out of the full read at either size."""
    text = F.format_string("%08d some words", F.when(F.col("id") % 10 == 9, F.col("id") - 1).otherwise(F.col("id")))
    got = dedup.exact_dedup(spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")))
    copies, hashed = got.agg(F.count_if(F.col("group_size") > 1), F.count("text_sha256")).first()
    assert copies == n / 5
    assert copies <= hashed <= copies + 0.12 * (n - copies)


def test_the_filter_lets_all_surviving_groups_through_when_it_is_full(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MAX_FILTER_ROWS", 1)
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.format_string("%05d", F.floor(F.col("id") / 2)).alias("text"))
    assert dedup.exact_dedup(docs).where("group_size = 2").count() == 4_000


def brute_dedup(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(UP)].append(doc_id)
    out = Counter()
    for doc_id, text in rows:
        norm = (text or "").translate(UP)
        keep = max((i for i in groups[norm] if i is not None), default=None)
        out[(doc_id, keep, len(groups[norm]), doc_id == keep, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("which", ["edge", "real"])
def test_exact_dedup_equals_brute_force(spark, edge_docs, which):
    df = edge_docs if which == "edge" else documents(spark)
    want = brute_dedup(pairs(df))
    assert Counter(map(tuple, dedup.exact_dedup(df, hash_all=True).collect())) == want
    lean = dedup.exact_dedup(df).collect()
    assert Counter(tuple(r)[:4] for r in lean) == Counter(k[:4] for k in want.elements())
    assert any(r["text_sha256"] is None for r in lean)  # unique texts are not read in full
    assert all(r["text_sha256"] for r in lean if r["group_size"] > 1)


def test_prefix_twins_are_told_apart(spark):
    rows = [(1, "x" * 500 + "a"), (2, "x" * 500 + "b"), (3, "x" * 500 + "A")]
    got = dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"]) for r in got} == {(1, 3, 2), (2, 2, 1), (3, 3, 2)}


def test_one_row_of_each_text_stays(spark, edge_docs, no_docs):
    """Repeated rows, ids shared by different texts, and rows without an id, one of which holds a third of all rows."""
    rows = [(1, "a", 0), (2, "A", 1), (1, "b", 2), (3, "c", 3), (3, "c", 3), (None, "c", 4), (4, "d", 5), (4, "D", 5),
            (5, None, 6), (6, "", 7), *[(None, "x", 8)] * 20, (None, "X", 8), (None, None, 9), *((i, f"t{i}", i) for i in range(10, 45))]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_sha256 int").repartition(5)
    kept = dedup.keep_one_of_each(df)
    got = Counter((r["doc_id"], (r["text"] or "").lower()) for r in kept.collect())
    assert kept.columns == df.columns
    assert got == Counter([(2, "a"), (1, "b"), (3, "c"), (4, "d"), (6, ""), (None, "x"), *((i, f"t{i}") for i in range(10, 45))])
    norm = lambda d: Counter((t or "").translate(UP) for _, t in pairs(d))
    assert norm(dedup.keep_one_of_each(edge_docs)) == Counter(set(norm(edge_docs)))
    assert dedup.keep_one_of_each(no_docs).count() == 0
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan(kept))


def test_hot_group_is_spread(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") < 20_000, "hot").otherwise(F.col("id").cast("string")).alias("key"), "id")
    groups = spool(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "test-groups")
    out = join_groups(rows.repartition(16), groups, "key", "n")
    assert out.count() == 30_000 and out.where("key = 'hot' and n = 20000").count() == 20_000
    sizes = out.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 2_000  # broadcast to where the rows are


# --- sharding ---

def test_sharding_invariants(spark, edge_docs):
    tree = sharding.layout(24)
    for df in (documents(spark, "/root/testdata/sf0.01"), edge_docs):
        got = sharding.shard_documents(df, tree, sharding.grow(tree, 24)).collect()
        assert len(got) == df.count()
        by = defaultdict(list)
        for r in got:
            by[r["shard"]].append(r["slot"])
            assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs(edge_docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want


def test_sharding_weights_and_growth(spark):
    keys = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    tree = [[[(0, 1.0), (1, 3.0)]], [[(2, 2.0)], [(3, 2.0)]]]
    heavier = [[[(0, 1.0), (1, 3.0)]], [[(2, 2.0)], [(3, 4.0)]]]
    got = keys.select(sharding.choose(F.col("k"), tree).alias("a"), sharding.choose(F.col("k"), heavier).alias("b")).collect()
    n = Counter(r["a"] for r in got)
    assert all(abs(n[s] / 40_000 - w / 8) < 0.01 for s, w in {0: 1, 1: 3, 2: 2, 3: 2}.items())
    # only subtrees whose weight changed gain rows: region 1 gains, and within it rack 1 does
    assert all(r["b"] in (2, 3) for r in got if r["a"] in (0, 1) and r["b"] != r["a"])
    assert all(r["b"] == 3 for r in got if r["a"] in (2, 3) and r["b"] != r["a"])


# --- decontamination ---

def brute_shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_contaminated(docs, items):
    out = set()
    for item_id, item in items:
        q = brute_shingles(item)
        for doc_id, text in docs:
            common = len(q & brute_shingles(text))
            if q and common / len(q) >= 0.8 and doc_id is not None and item_id is not None:
                out.add((doc_id, item_id, common, len(q)))
    return out


def test_decontamination_equals_brute_force(spark):
    docs, items = documents(spark), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = decontam.contaminated(docs, items).collect()
    want = brute_contaminated(pairs(docs), [tuple(r) for r in items.select("item_id", "text").collect()])
    assert {tuple(r)[:4] for r in got} == want and len(got) == len(want) and want


def test_decontamination_edges(spark, edge_docs):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    words = item.split()
    items = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (None, item), (4, "One"), (5, "the quick brown fox jumps"), (5, "nothing like it at all now")],
        "item_id long, text string")
    partly = " ".join(["pad"] * 3000 + words[:13] + ["other"] * 3000)  # 9 of 11 shingles
    less = " ".join(["pad"] * 30 + words[:12])  # 8 of 11
    docs = edge_docs.select("doc_id", "text", "common", "hash", "item_id").unionByName(spark.createDataFrame(
        [(100, partly), (101, less), (102, f"A {item.upper()}!")], "doc_id long, text string"), allowMissingColumns=True)
    got = {(r["doc_id"], r["item_id"], r["common"], r["item_shingles"]) for r in decontam.contaminated(docs, items).collect()}
    assert {g for g in got if g[0] >= 100} == {(100, 1, 9, 11), (102, 1, 11, 11)}
    assert {(g[0], g[1]) for g in got if g[0] < 100} == {(4, 4), (5, 4), (40, 4), (16, 5), (17, 5)}
    kept = {r["doc_id"] for r in decontam.decontaminate(docs, items).select("doc_id").collect()}
    assert not kept & {4, 5, 40, 16, 17, 100, 102} and {101, None, 1, 13} <= kept


def test_rows_are_decontaminated_one_by_one(spark, no_docs):
    """Ids that repeat or are missing: the row that holds an item goes, the others stay."""
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item), (1, "clean"), (None, f"so {item} on"), (None, "clean"), (None, None), (2, "x"), (2, "x"), (3, item), (3, item)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, row_id int")
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert Counter(pairs(kept)) == Counter([(1, "clean"), (None, "clean"), (None, None), (2, "x"), (2, "x")])
    assert decontam.decontaminate(docs, items.where("false")).count() == len(rows)
    assert decontam.decontaminate(no_docs, items).count() == 0


@pytest.mark.parametrize("make", [
    lambda d: pii.summary(pii.find_pii(d)), lambda d: dedup.exact_dedup(d),
    lambda d: secret_scan.summary(secret_scan.find_secrets(d)), lambda d: sharding.shard_documents(d, sharding.layout(24)),
    lambda d: decontam.contaminated(d, d.select(F.col("doc_id").alias("item_id"), "text"))])
def test_empty_tables_and_native_plans(no_docs, make):
    out = make(no_docs)
    assert out.count() == 0
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan(out))
