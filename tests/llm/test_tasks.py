"""Operators that work in Arrow batches, against brute force and the sentencepiece library, and their edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from oddrows.llm import components, decontaminate, language, minhash, pieces, suffixes, urls, words

SCHEMA = "doc_id long, text string, row string, node string, carried int, lang string"


def docs_of(spark, rows, langs=None):
    return spark.createDataFrame([(i, t, "r", "n", 1, langs[k] if langs else None) for k, (i, t) in enumerate(rows)], SCHEMA)


# --- words

def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["The cat", None, "", "the CAT", "  x\ty\x0bz ", "é" * 700_000 + " end", "the ca t"]
    for letters in (False, True):
        hashes, at = words.word_hashes(pa.array(texts), letters)
        own = [hashes[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
        assert [len(o) for o in own] == [2, 0, 0, 2, 3, 2, 3]
        assert own[0] == own[3] and len({h for o in own for h in o}) == 9
    sliced = pa.array(texts).slice(3, 2)
    assert len(words.word_hashes(sliced)[0]) == 5


# --- near-duplicates

def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def roots(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                u, v = sorted((find(i), find(j)))
                parent[v] = u
    return {i: find(i) for i, _ in rows}


def near_rows(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 40, 150]))] for _ in range(25)]
    out = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(spark, shingle, percent):
    rows = near_rows(shingle)
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "W " * 50_000)]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs_of(spark, rows), shingle=shingle, percent=percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == roots(rows, shingle, percent)
    assert all(got[i].n_shingles == len(shingles(t, shingle)) for i, t in rows)
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


@pytest.mark.parametrize("block", [minhash.BLOCK_MEMBERS, 3])
def test_near_duplicates_without_leader_rounds(spark, block):
    rows = near_rows(9, 80)
    found = minhash.near_duplicates(docs_of(spark, rows), shingle=3, percent=85, leader_rounds=0, block_members=block)
    assert {r.doc_id: r.component_id for r in found.collect()} == roots(rows, 3, 85)


def test_near_copies_below_the_threshold_make_no_rows(spark, monkeypatch):
    """All pairs of a family pass the bounds on signatures and hardly any the threshold: what leaves the blocks stays below the members."""
    rng = random.Random(3)
    base = [f"b{k}" for k in range(400)]
    rows = []
    for k in range(300):
        w = list(base)
        for at in rng.sample(range(2, 398, 3), 8 if k % 10 else 4):
            w[at] = f"x{k}_{at}"
        rows.append((k, " ".join(w)))
    counted, across = [], minhash._across
    monkeypatch.setattr(minhash, "_across", lambda *a: counted.append(across(*a)) or counted[-1])
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, rows), shingle=3, percent=85).collect()}
    assert got == roots(rows, 3, 85)
    assert len(counted.pop().collect()) < 300 and len({got[k] for k in got}) > 100


def test_sets_that_share_half_a_digest_stay_apart(spark):
    rows = spark.createDataFrame([(1, 7, 5), (2, 7, 5), (3, 7, 6), (4, 7, 9), (5, 8, 5), (6, None, None)], "doc_id long, node long, check long")
    named = {r.doc_id: r.node for r in minhash._told_apart(rows).collect()}
    assert named[1] == named[2] == 7 and named[5] == 8 and named[6] is None
    assert len({named[k] for k in (1, 3, 4, 5)}) == 4


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, "A b c d"), (None, None), (9, "x y z")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.op3(docs_of(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, 2, False), (3, 2, False), (3, 2, False), (2, 2, True), (None, None, True), (9, 9, True)], key=repr)
    assert minhash.op3(docs_of(spark, rows).limit(0)).count() == 0


def test_pigeonhole():
    for percent in (80, 85):
        radius = minhash.radius_for(percent)
        masks = minhash.chunk_masks(radius)
        rng = random.Random(1)
        for _ in range(300):
            wrong = set(rng.sample(range(minhash.SLOTS), radius))
            assert any(not wrong & set(m) for m in masks)


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(100, 50), (60, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**{k: 0 for k in range(31)}, 50: 50, 60: 50, 100: 50}


# --- decontamination

def brute_leaks(docs, items, percent=80):
    cut = lambda t: [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", (t or "").encode())]
    grams = lambda w, k: collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for d, t in docs:
        w = cut(t)
        for i, s in items:
            v = cut(s)
            k = min(5, len(v))
            for at in range(len(w) - len(v) + 1 if v else 0):
                a, b = grams(w[at:at + len(v)], k), grams(v, k)
                common = sum((a & b).values())
                if 100 * common >= percent * (sum(a.values()) + sum(b.values()) - common):
                    out.add((d, i))
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(60)] + ["é", "and"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 18, 40, 60])))) for i in range(30)]
    items += [(90, None), (91, ""), (92, items[4][1]), (None, "only here once x y z")]
    docs = []
    for d in range(80):
        parts = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items[:30])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            at = rng.randint(0, len(parts))
            parts[at:at] = [p.upper() + rng.choice(["", ",", "!!"]) for p in passage]
        docs.append((d, " ".join(parts)))
    docs += [(300, None), (301, "..."), (301, "..."), (302, "ONLY here, once x-y z!" + " tail" * 30_000)]
    benchmark = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, start string")
    for block in (decontaminate.BLOCK_WORDS, 100):
        found = decontaminate.leaks(docs_of(spark, docs), benchmark, block_words=block)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == brute_leaks(docs, items), block
    assert decontaminate.op2(docs_of(spark, docs), benchmark).count() == len(docs)
    assert decontaminate.op2(docs_of(spark, docs), benchmark.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.op2(docs_of(spark, docs).limit(0), benchmark).count() == 0


def test_leaks_in_short_documents(spark):
    """A document that is an item with words left out has no window of the item's size."""
    item = [f"q{k}" for k in range(40)]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(reversed(item))), (3, "a b c d e")], "item_id long, text string")
    rows = [(1, " ".join(item[:-1])), (2, " ".join(item[:20] + item[21:])), (3, " ".join(item[:33])), (4, " ".join(item[:32])),
            (5, " ".join(item[:3])), (6, "a b c d"), (7, "")]
    found = {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 6)) for r in decontaminate.leaks(docs_of(spark, rows), benchmark).collect()}
    # 2: four of its 35 shingles are new, 31 / 40 is below the threshold
    assert found == {(1, 1): (0, 39, round(35 / 36, 6)), (3, 1): (0, 33, round(29 / 36, 6))}


def test_leaks_with_unicode_words(spark):
    items = [(1, "請問，以下哪一個城市是日本的首都？東京、大阪還是京都。"), (2, "“What is the capital—the seat of government—of France?”"), (3, "ประเทศไทยมีเมืองหลวงชื่อว่าอะไร")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "前文很長的一段話" + items[0][1] + "後文"), (2, "He asked: what is the capital - the seat of government - of France? Paris…"),
            (3, "คำถาม" + items[2][1] + "ครับ"), (4, "請問這裡有沒有別的東西可以看"), (5, "請問 以下哪一個城市是日本的首都 東京 大阪還是京都")]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs_of(spark, rows), benchmark).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (5, 1)}


# --- urls

def test_cascade_is_exact_in_shards(spark):
    rows = spark.range(3000).selectExpr("id", "concat('h', id % 900) AS host", "id % 7 AS listed_")
    listed = spark.createDataFrame([(f"h{k}",) for k in range(0, 900, 13)] + [("not in the corpus",)], "host string")
    for shard in (urls.SHARD_KEYS, 20):
        got = urls.listed_rows(rows, "host", listed, shard_keys=shard).collect()
        assert len(got) == 3000 and all(r.listed == (int(r.host[1:]) % 13 == 0) for r in got)
    none = urls.listed_rows(rows, "host", listed.limit(0)).collect()
    assert not any(r.listed for r in none)


def test_hashes_of_a_key_are_independent(spark):
    """The second hash is no function of the first one, which it is if Spark chains it onto that."""
    key = urls.F.col("id").cast("string")
    rows = spark.range(20_000).select(*urls._hashes(key), urls.F.xxhash64(key, urls.F.lit(1)).alias("chained")).collect()
    assert all(r["chained"] != r["_b"] for r in rows)
    assert len({r["_b"] for r in rows}) == 20_000


def test_url_edges(spark):
    pages = spark.createDataFrame(
        [(1, None, 0), (2, "no scheme", 0), (3, "HTTP://WWW.Example.COM/en/x?y#z", 0), (4, "http://a.net/es/", 0), (5, "http://a.net/de/", 0),
         (5, "http://a.net/de/", 0), (6, "http://example.com/en/", 0), (7, "http://com", 0), (8, "http://xcom/", 0), (9, "//http://b.org", 0)],
        "page_id long, url string, listed int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.op7(pages).collect()}
    assert got == {
        1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        4: ("a.net", "/es/", "net/es/", "block"), 5: ("a.net", "/de/", None, "block"), 6: ("example.com", "/en/", "example.com/en/", "block"),
        7: ("com", "", None, "allow"), 8: ("xcom", "/", None, "allow"), 9: ("b.org", "", None, "allow")}
    assert urls.op7(pages.limit(0)).count() == 0


# --- repeated bytes

def test_suffix_array():
    rng = random.Random(1)
    for _ in range(400):
        x = np.array([rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 50))] + [0])
        assert suffixes.suffix_array(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def brute_spans(rows, length):
    seen, out = set(), {}
    for key in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (key[1] or "").encode()
        covered = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if data[s:s + length] in seen:
                covered[s:s + length] = b"\1" * length
            seen.add(data[s:s + length])
        out[key[0]] = bytes(c for c, gone in zip(data, covered) if not gone)
    return out


@pytest.mark.parametrize("group", [suffixes.GROUP_CONTEXTS, 3])
def test_repeats_against_brute_force(spark, group):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abé \n") for _ in range(rng.randint(10, 60))) for _ in range(12)]
    rows = []
    for k in range(90):
        rows.append((k if k else None, "".join(rng.choice([rng.choice(passages), "".join(rng.choice("abcd") for _ in range(15))])
                                               for _ in range(rng.randint(0, 9)))))
    rows += [(200, rows[5][1]), (201, None), (202, ""), (203, "a" * 3000), (204, "ab" * 1000), (205, "a" * 3000), (206, "short"),
             (207, "short"), (208, passages[0] * 40), (30, rows[30][1])]
    for length, gram in ((20, 12), (100, 64)):
        out = suffixes.remove_repeats(docs_of(spark, rows), length=length, gram=gram, group_contexts=group).collect()
        assert len(out) == len(rows)
        assert {r.doc_id: bytes(r.kept) for r in out} == brute_spans(rows, length), length
        for r in out:
            assert r.n_bytes - sum(s.stop - s.start for s in r.spans) == len(r.kept)


def test_repeats_with_shared_ids_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 512)
    rng = random.Random(8)
    long = "".join(rng.choice("abcdef") for _ in range(5000))
    rows = [(1, long), (1, "x" + long[1000:2000]), (2, long[4000:] + long[:100])]
    out = {bytes(r.kept) for r in suffixes.remove_repeats(docs_of(spark, rows)).collect()}
    assert len(out) == 3 and sum(map(len, out)) < 5000 + 200
    assert suffixes.op8(docs_of(spark, rows).limit(0)).count() == 0


# --- pieces

def test_pieces_against_the_library(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(6)
    rows = [(k, "".join(rng.choice("ab  \n\t▁éß日本😀.,'\r12(){}theing") for _ in range(rng.randint(0, 80)))) for k in range(400)]
    rows += [(900, None), (901, ""), (902, " "), (903, "  \n "), (904, "▁"), (905, "word " * 40_000), (906, "\x00<s></s>"), (None, "x"), (1, "y"), (1, "y")]
    for cache in (pieces.CACHE_SIZE, 30):
        vars(__import__("sys")).pop("_oddrows_parts", None)
        out = pieces.encode_texts(docs_of(spark, rows), path, cache_size=cache, batch_chars=500).collect()
        ids = [library.encode(t or "", add_eos=True) for _, t in rows]
        assert sorted((repr(r.doc_id), list(r.ids), r.decoded) for r in out) == sorted(
            (repr(k), i, library.decode(i)) for (k, _), i in zip(rows, ids))
    got = {r.doc_id: r for r in pieces.op9(docs_of(spark, rows[:5])).collect()}
    for (k, _), i in zip(rows[:5], ids):
        assert got[k].n_tokens == len(i) and got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest()
    assert pieces.op9(docs_of(spark, rows).limit(0)).count() == 0


# --- language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = language.op10(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_edges(spark):
    rows = [(k, "the cat sat on the mat and the hat " * 3) for k in range(20)] + [(k, "der hund lag auf der matte und dem hut") for k in range(20, 40)]
    langs = ["en"] * 20 + ["de"] * 20
    rows += [(50, None), (51, ""), (52, "123 ... !"), (53, "the mat"), (54, "日本 语"), (None, "der hut"), (53, "the mat"), (55, "the " * 100_000)]
    langs += ["fr", None, "en", None, None, None, None, None]
    got = {r.doc_id: r for r in language.op10(docs_of(spark, rows, langs)).collect()}
    assert [got[k].lang_pred for k in (50, 51, 52, 53, None, 55)] == ["und", "und", "und", "en", "de", "en"]
    assert got[54].lang_pred in ("en", "de") and got[54].rejected and not got[53].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language.op10(docs_of(spark, rows)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.op10(docs_of(spark, rows, langs).limit(0)).count() == 0
