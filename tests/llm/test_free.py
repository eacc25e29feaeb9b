"""The operators with Python in tasks, against brute force, round trips and held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from asterism.llm import chat, langid, packing, queries, simhash, urls
from tests.llm.conftest import documents

VOCABULARY = str(queries.VOCABULARY)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- language identification ---

def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert len(got) == docs.count() and {r["doc_id"] for r in got if r["held_out"]} == {
        i for i, _ in pairs(docs) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark, edge_docs, no_docs):
    docs = documents(spark).select("doc_id", "text", "lang")
    model = langid.train(docs)
    got = {r["doc_id"]: r["p"] for r in edge_docs.withColumn("p", langid.predict(edge_docs, model)).collect()}
    for i in (1, 2, 3, 18, 20):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0
    assert all(got[i]["lang_pred"] in model.langs for i in (4, 5, 13, 15, 21))
    assert langid.identify_languages(no_docs).count() == 0
    kept = langid.keep_identified(docs.withColumn("langid", F.lit("mine")))  # a column of the result's name passes through
    assert {r["langid"] for r in kept.select("langid").collect()} == {"mine"}
    only_unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify_languages(only_unlabelled).collect()} == {"und"}


def test_stage_drops_only_texts_without_letters(spark):
    texts = ["Сегодня утром мы пошли на рынок за хлебом", "今日は天気がいいので散歩に行きました", "Hôm nay trời đẹp quá", None, "", "12 + 34 = 46!"]
    rows = [(10_000_000 + i, t, None) for i, t in enumerate(texts)]
    clean = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = [10_000_000, 10_000_001, 10_000_002]
    learned = documents(spark).select("doc_id", "text", "lang").unionByName(clean)
    kept = [r["doc_id"] for r in langid.keep_identified(learned).where("doc_id >= 10000000").collect()]
    assert sorted(kept) == want
    assert sorted(r["doc_id"] for r in langid.keep_identified(clean).collect()) == want  # no language to learn


def test_labels_and_sources_are_not_inputs(spark):
    docs = documents(spark)
    model = langid.train(docs)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("s"))
    a, b = (sorted((r["doc_id"], r["p"]) for r in d.withColumn("p", langid.predict(d, model)).collect()) for d in (docs, other))
    assert a == b


def ppm_bits(text, trees, order):
    """Bits of a text by PPM with exclusion, straight from counts by context."""
    data, bits = langid.PAD + text, 0.0
    for i in range(len(langid.PAD), len(data)):
        context, out, p = data[i - order:i], set(), 1.0
        while context not in trees["kept"] and context:
            context = context[1:]
        while True:
            seen = {s: n for s, n in trees["counts"].get(context, {}).items() if s not in out}
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                p *= seen[data[i]] / (n + d)
                break
            if n:
                p *= d / (n + d)
                out |= set(seen)
            if not context:
                p /= 256 - len(out)
                break
            context = context[1:]
        bits -= np.log2(p)
    return bits


def test_code_lengths_equal_plain_ppm():
    texts = {"a": [b"the cat sat on the mat. " * 8, b"a hat is that"], "b": ["là où été élève ".encode() * 10]}
    counts = {lang: defaultdict(Counter) for lang in texts}
    support, grams = Counter(), Counter()
    for lang, samples in texts.items():
        for text in samples:
            data = langid.PAD + text
            for i in range(3, len(data)):
                for k in range(4):
                    counts[lang][data[i - k:i]][data[i]] += 1
                    support[data[i - k:i]] += 1
                grams[lang, int.from_bytes(data[i - 3:i + 1], "big")] += 1
    kept = {c for c, n in support.items() if n >= langid.MIN_SUPPORT}
    langs = sorted(texts)
    model = langid.build(langs, np.array([langs.index(x) for x, _ in grams]), np.array([g for _, g in grams]),
                         np.array(list(grams.values()), float))
    probe = [b"the hat sat", "été zzz".encode(), b"", b"\x00\xff q"]
    got = model.bits(probe)
    for i, text in enumerate(probe):
        for j, lang in enumerate(langs):
            assert got[i, j] == pytest.approx(ppm_bits(text, {"counts": counts[lang], "kept": kept}, 3), rel=1e-5)


def test_long_texts_are_scored_in_blocks(monkeypatch, spark):
    model = langid.train(documents(spark))
    texts = [t.encode() for _, t in pairs(documents(spark))][:40] + [b""]
    whole = model.bits(texts)
    monkeypatch.setattr(langid, "BLOCK", 500)
    assert np.allclose(whole, model.bits(texts))


# --- packing ---

def brute_pieces(rows):
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    out = Counter()
    for doc_id, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        start, piece = 0, 0
        while start < len(ids):
            size = (len(ids) % 2048 or 2048) if piece == 0 else 2048
            out[(doc_id, piece, start, size, zlib.crc32(np.array(ids[start:start + size], "<u4").tobytes()))] += 1
            start, piece = start + size, piece + 1
    return out


def test_letters_and_numbers_are_those_of_the_tokenizer():
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    encode = packing.Encoder(VOCABULARY)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    # the pieces around a letter, a number and a suffix depend on what each character is taken for
    for i in range(0, len(every), 50_000):
        text = "\n".join(f"a{c}1{c}'s" for c in every[i:i + 50_000])
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def check_packing(got, capacity=2048):
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


@pytest.mark.parametrize("which", ["edge", "real"])
def test_packing_equals_tokenizer_and_is_tight(spark, edge_docs, which):
    df = edge_docs if which == "edge" else documents(spark)
    got = packing.pack(df, VOCABULARY).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute_pieces(pairs(df))
    lengths = Counter(r["length"] for r in got)
    assert check_packing(got) <= packing.lower_bound(lengths) * 1.01 + 1


def test_tokens_of_odd_characters():
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(3)
    odd = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0    　​﻿aAé日本ß'٣½_-.🙂́"
    texts = ["".join(rng.choices(odd, k=30)) for _ in range(500)] + ["it's we'll  x  ", "a<|endoftext|>b", "<|endoftext|>"]
    encode = packing.Encoder(VOCABULARY)
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_with_ids(spark, edge_docs):
    got = packing.pack(edge_docs, VOCABULARY, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)


def test_genetic_search():
    rng = random.Random(7)
    lengths = dict(Counter(rng.choice([rng.randint(1, 100), rng.randint(30, 60)]) for _ in range(3000)))
    start = packing.best_fit({}, lengths, 100)
    best = packing.evolve([start], lengths, 1, 100)[0]

    def content(bins):
        out = Counter()
        for b, n in bins.items():
            assert packing.used(b) <= 100 and n > 0
            for size, k in b:
                out[size] += k * n
        return dict(out)

    assert content(start) == content(best) == lengths
    assert packing.lower_bound(lengths, 100) <= packing.cost(best, 100)[0] <= packing.cost(start, 100)[0]
    child = packing.crossover(best, packing.mutate(start, rng, 100), lengths, rng, 100)
    assert content(child) == lengths


def test_best_fit_equals_one_by_one():
    rng = random.Random(11)
    items = Counter(rng.randint(1, 50) for _ in range(400))
    rooms = []
    for size in sorted(items.elements(), reverse=True):
        fits = [r for r in rooms if r >= size]
        rooms.remove(r := min(fits)) if fits else (r := 60)
        rooms.append(r - size)
    got = packing.best_fit({}, dict(items), 60)
    assert Counter(60 - packing.used(b) for b, n in got.items() for _ in range(n)) == Counter(rooms)


def test_islands_search_on_spark(spark):
    lengths = {7: 100, 6: 100, 5: 100, 4: 60, 3: 10}  # best fit alone leaves room
    best = packing.search(spark, lengths, 16)
    assert packing.lower_bound(lengths, 16) <= packing.cost(best, 16)[0] <= packing.cost(packing.best_fit({}, lengths, 16), 16)[0]
    assert packing._read(packing._write(best)) == best


@pytest.mark.parametrize("bins,capacity,copies", [(20, 100, 1), (60, 1000, 1), (200, 2048, 1), (20, 100, 50)])
def test_search_beats_best_fit_on_triplets(bins, capacity, copies):
    """Full bins cut in three, which best fit can't put together again."""
    rng, lengths = random.Random(3), Counter()
    for _ in range(bins):
        a = rng.randint(capacity // 4, capacity // 2 - 1)
        b = rng.randint((capacity - a) // 2 - 5, (capacity - a) // 2)
        for x in (a, b, capacity - a - b):
            lengths[x] += copies
    start = packing.best_fit({}, dict(lengths), capacity)
    best = packing.evolve([start], dict(lengths), 1, capacity)[0]
    assert bins * copies == packing.lower_bound(lengths, capacity) <= packing.cost(best, capacity)[0] < packing.cost(start, capacity)[0]


# --- simhash ---

def brute_fp(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """{node: smallest node reachable} over items (key, fingerprint)."""
    left, out = dict(fps), {}
    for key in sorted(left):
        if key not in out:
            stack = [key]
            while stack:
                k = stack.pop()
                out[k] = key
                stack += [j for j in left if j not in out and (left[j] ^ left[k]).bit_count() <= 4 and not out.setdefault(j, key) is None]
    return out


def test_simhash_equals_brute_force(spark):
    docs = documents(spark)
    fps = {i: brute_fp(t) for i, t in pairs(docs)}
    got = {r["doc_id"]: (r["fp"] & (1 << 64) - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    parts = brute_components(fps)
    assert got == {i: (fps[i], parts[i]) for i in fps} and len(set(parts.values())) < len(parts)


def test_simhash_edges(spark, edge_docs, no_docs):
    small = edge_docs.where("doc_id is null or doc_id not in (13, 14, 15)")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(small).collect()}
    assert {got[i]["component_id"] for i in (1, 2, 3)} == {1} and got[2]["fp"] == 0
    assert {got[i]["component_id"] for i in (4, 5, 40)} == {4} and got[17]["component_id"] == 16
    assert simhash.near_duplicates(small).count() == small.count()
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.fingerprint("word " * 200_000) == brute_fp("word " * 10)


def test_one_row_of_each_component_stays(spark, no_docs):
    """Repeated rows, ids shared by texts that are far apart, and rows without an id."""
    a, x, p, k, z = ("a b c d e f", "x y z w v u", "p q r s t u v", "k l m n o", "g h i j k l m n")
    rows = [(1, a), (1, x), (2, x), (None, x), (None, p), (None, p.upper()), (3, k), (3, k), (4, None), (5, " "), (6, z), (7, z)]
    docs = spark.createDataFrame([(*r, "") for r in rows], "doc_id long, text string, fp string").repartition(3)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (1, x), (None, p), (3, k), (4, None), (6, z)]
    assert Counter((i, t and t.lower()) for i, t in pairs(kept)) == Counter(want)
    named = docs.where("doc_id in (2, 4, 5, 6, 7)")
    assert sorted(i for i, _ in pairs(simhash.keep_one_of_each(named))) == [2, 4, 6]
    assert simhash.keep_one_of_each(no_docs).count() == 0


def test_covering_masks_find_every_pair_within_the_radius():
    masks, rng = simhash.covering_masks(), random.Random(2)
    assert len(masks) == 31
    for _ in range(5000):
        diff = sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4)))
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("max_bucket", [512, 3])
def test_links_of_crowded_buckets(spark, max_bucket):
    """Clusters far larger than a bucket may be, in one and in several batches."""
    rng = random.Random(4)
    fps = set()
    for _ in range(3):
        center = rng.getrandbits(64)
        fps |= {center ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for _ in range(60)}
        chain = center
        for _ in range(40):  # a long chain of short steps
            chain ^= sum(1 << i for i in rng.sample(range(64), 3))
            fps.add(chain)
    fps |= {rng.getrandbits(64) for _ in range(50)}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    got = simhash.components(simhash.links(df, max_bucket=max_bucket)).collect()
    root = {r["node"] & (1 << 64) - 1: r["root"] for r in got}
    want = brute_components({f: f for f in fps})
    for a in fps:
        for b in fps:
            assert (root.get(a, a) == root.get(b, b)) == (want[a] == want[b])


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(500)] + [(5000, 5000)]
    got = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {r["node"]: r["root"] for r in got}
    assert len({root[i] for i in range(301)}) == 1 and len({root[2000 + i] for i in range(500)} | {root[1000]}) == 1
    assert len(set(root.values())) == 3


# --- chat ---

def test_chat_folds_events(spark):
    log = [
        (1, 0, 0, "message", "user", "hi"), (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", "assistant", "Hel"),
        (1, 1, 3, "delta", "assistant", "lo"), (1, 0, 4, "edit", "user", "hello"), (1, 1, 5, "regenerate", "assistant", None),
        (1, 1, 6, "delta", "assistant", "He"), (1, 1, 7, "delta", "assistant", "y"), (2, 9, 1, "delta", "user", "late start"),
        (2, 4, 0, None, None, None), (None, 1, 1, "message", "user", "no id"), (3, 1, None, "message", "user", "a"),
        (3, 1, None, "message", "user", "a")]
    events = spark.createDataFrame(log, "conv_id long, msg long, seq long, kind string, role string, text string")
    got = sorted((tuple(r) for r in chat.fold_events(events).collect()), key=str)
    assert got == sorted([(1, 0, 0, "user", "hello"), (1, 1, 1, "assistant", "Hey"), (2, 9, 1, "user", "late start"),
                          (2, 4, 0, "", ""), (None, 1, 1, "user", "no id"), (3, 1, None, "user", "a"), (3, 1, None, "user", "a")], key=str)
    pieces = chat.format_conversations(events)
    assert {r["conv_id"]: r["n_turns"] for r in chat.read_back(pieces).collect()} == {1: 2, 2: 2, 3: 2, None: 1}
    assert chat.format_conversations(events.where("false")).count() == 0


def test_chat_escapes_reversibly(spark):
    parts = ["</s>", "[INST]", "[/INST]", "<s>[INST:", "\\", "<", "[", "<\\", "\\\\<", "x", "é\n", "<<SYS>>"]
    rng = random.Random(6)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(400)]
    messages = spark.createDataFrame([(1, i, i, rng.choice(["user", "assistant"]), t) for i, t in enumerate(texts)], chat.MESSAGES)
    for r in chat.render(messages).collect():
        role, text = chat.parse_piece(r["formatted"])
        body = r["formatted"].removeprefix(chat.OPEN).removesuffix(chat.CLOSE).split(chat.CLOSE_ROLE, 1)[1]
        assert text == texts[r["msg"]] and not any(c in body for c in ("</s>", "[INST", "[/INST]", "<s>"))
        if role == "assistant":
            assert r["formatted"][r["loss_start"]:r["loss_end"]] == body
        else:
            assert r["loss_start"] is None


def test_chat_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", queries.PROBE_TEXT), (-7, 1, "assistant", queries.PROBE_TEXT)]
    by = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        by[conv].append((role, text or ""))
    want = {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest()) for c, t in by.items()}
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_sha256"]) for r in queries.op7_chat(spark, d).collect()}
    assert got == want


def test_log_of_turns_ends_in_the_turns(spark):
    rows = [(1, 0, "user", "hé"), (1, 1, "assistant", "abc"), (1, 1, "assistant", "abc"), (1, 1, "assistant", "abb"), (2, None, None, None),
            (2, -1, "assistant", ""), (2, 1 << 62, "user", "x"), (None, 3, "tool", "</s>"), (3, 0, "assistant", "é[" * 50_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    log = chat.log_of_turns(turns)
    kinds = Counter(r["kind"] for r in log.collect())
    assert kinds == {"message": 9, "delta": 3 * 5 + 4, "regenerate": 5, "edit": 4}
    got = sorted(((r["conv_id"], r["role"], r["text"]) for r in chat.fold_events(log).collect()), key=str)
    assert got == sorted(((c, r or "", t or "") for c, _, r, t in rows), key=str)
    whole = {r["conv_id"]: r["turns_sha256"] for r in chat.read_back(chat.format_conversations(log)).collect()}
    sha = lambda *turns: hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert whole[1] == sha(("user", "hé"), ("assistant", "abb"), ("assistant", "abc"), ("assistant", "abc"))
    assert whole[2] == sha(("", ""), ("assistant", ""), ("user", "x"))
    assert chat.log_of_turns(turns.where("false")).count() == 0


# --- urls ---

def test_globs_equal_regular_expressions():
    rng = random.Random(8)
    alphabet = "ab/."
    patterns = ["".join(rng.choices(["a", "b", "/", ".", "*", "**"], k=rng.randint(1, 9))) for _ in range(60)] + ["", "*", "**"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 10))).encode() for _ in range(1500)]
    automaton = urls.GlobAutomaton(patterns)
    assert automaton.words > 1
    got = automaton.match(texts)
    for j, p in enumerate(patterns):
        parts = re.split(r"(\*+)", p)
        rx = re.compile("".join(".*" if x.startswith("**") else "[^/]*" if x == "*" else re.escape(x) for x in parts), re.S)
        assert [bool(rx.fullmatch(t.decode())) for t in texts] == got[:, j].tolist(), p


def test_url_edges(spark):
    rows = ["https://A.Example.COM/en/x?q#f", "http://com", "http://com/", "http://xcom/", "ftp://www.example.com/en/1", None, "",
            "no scheme com/en/", "http://a.net/es/x", "http://a.net/esx", "http://net/fr/", "http://evil.org/x.com/en/",
            "http://spam-farm.org/y", "http://user@com:80/en/", "http://a.com/" + "z" * 30_000, "http://exämple.com/en/é",
            "x\ny://b.com/a\nb?c", "http://a.com/EN/://b.net/es/", "http://b.net/es/"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*rows, rows[0]])], "page_id long, url string, rule string")
    got = {r["page_id"]: tuple(r)[1:5] for r in urls.judge_urls(df).collect()}
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", "block") == got[len(rows)]
    assert got[1] == ("com", "", None, "allow") and got[2] == ("com", "/", "com/", "allow") and got[3][2] is None
    assert got[4][2:] == ("www.example.com/en/", "allow") and got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8][2:] == ("net/es/", "block") and got[9][2] is None and got[10][2:] == ("net/fr/", "block")
    assert got[11][2] is None and got[12][2:] == (None, "block") and got[13][2] is None
    assert got[14][2] == "com/" and got[15][2] == "com/" and got[16][:3] == ("b.com", "/a\nb", "com/") and got[17][2] == "com/"
    assert urls.judge_urls(df.where("false")).count() == 0


def test_canonical_forms():
    forms = {"HTTP://User:pw@WWW.Example.COM.:80/%7Ea/./b/../%2e%2E/c%2fd?q=1#f": "www.example.com/c%2Fd", "https://a.org": "a.org/",
             "https://a.org:8443/x/..": "a.org:8443/", "http://[::1]:80/a/.": "[::1]/a/", "http://u@[::1]:81": "[::1]:81/",
             "http://a.org/%zz%4/%": "a.org/%zz%4/%", "http://É.org/%C3%a9//x": "É.org/%C3%A9//x", "ftp://a.b:21/../../x": "a.b/x",
             "http://a.org/%2541": "a.org/%2541", "://x/y": "x/y", "no scheme/../x": "", "": "", None: "",
             "https://a.org:/x": "a.org/x", "http://a.org?x=/../": "a.org/", "http://a.org/" + "b/../" * 20_000: "a.org/"}
    assert {u: urls.canonical(u) for u in forms} == forms
    again = [f for f in forms.values() if f]
    assert [urls.canonical("gopher://" + f) for f in again] == again


def test_globs_judge_the_canonical_form(spark):
    rows = [("http://x.org/a/../%61ds/1", "block"), ("http://x.org/a%2Fads/1", "allow"), ("http://SPAM.example.:80/", "block"),
            ("http://spam@x.org/", "allow"), ("http://x.org/wp-login.php?x#y", "block"), ("http://x.org/ads/../y", "allow"),
            ("http://x.org/a/setup.%65xe", "block"), ("http://x.net/es/../ads/", "block"), ("http://x.com/ads/", "allow")]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge_urls(df).collect()}
    assert [got[i][1] for i in range(len(rows))] == [v for _, v in rows]
    assert got[7][0] == "net/es/" and got[8][0] == "com/"  # rules read the path as it stands
    assert urls.UrlJudge(urls.RULES, urls.GLOBS).automaton.words > 4


def test_the_longest_rule_wins_and_ties_go_to_the_first():
    rules = [urls.Rule("allow", "b.com", "/x/"), urls.Rule("block", "com", "/x/yy/"), urls.Rule("allow", "com", "/"),
             urls.Rule("block", "a.b.com", "/")]
    judged = urls.UrlJudge(rules, []).judge(["a.b.com/x/yy/z", "b.com/x/yy/", "c.com/q", "a.b.com/x/"])
    assert judged.rule.tolist() == ["com/x/yy/", "com/x/yy/", "com/", "b.com/x/"]
    assert judged.verdict.tolist() == ["block", "block", "allow", "allow"]


# --- the pipeline ---

def test_pipeline_equals_its_parts(spark):
    d = "/root/testdata/sf0.001"
    docs = documents(spark)
    model = langid.train(docs)
    told = docs.withColumn("p", langid.predict(docs, model)).where("p.lang_pred <> 'und' and p.bits_per_byte < 8")
    rows = dict(pairs(told))
    groups = defaultdict(list)
    for i, t in rows.items():
        groups[t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))].append(i)
    rows = {max(g): rows[max(g)] for g in groups.values()}
    parts = brute_components({i: brute_fp(t) for i, t in rows.items()})
    rows = {i: rows[i] for i in set(parts.values())}
    from tests.llm.test_native import brute_contaminated
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {x[0] for x in brute_contaminated(rows.items(), items)}
    rows = {i: t for i, t in rows.items() if i not in leaks}
    got = corpus_pipeline.run(spark, d).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == brute_pieces(rows.items())
    check_packing(got)


def test_pipeline_stages_keep_columns(spark, edge_docs, no_docs):
    d = "/root/testdata/sf0.001"
    for docs in (edge_docs.where("doc_id is null or doc_id not in (13, 14, 15)"), no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, d).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, d).count() == 0
