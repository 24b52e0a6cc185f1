"""Fill-in-middle, repeated passages and lexical search against brute force, and odd input."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farescope.llm import common, fill_middle, lexical_search, queries, substring_dedup

DOCS = "doc_id bigint, text string"
CLASHES = ("n", "form", "output", "row", "cut", "shard", "score", "rank", "bag", "members", "n_words", "prefix_chars")
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def crowded(df):
    """With columns named like those that the operators make."""
    return df.withColumns({c: F.lit(c) for c in CLASHES})


def test_words_that_sums_cannot_tell_apart():
    a = "a"
    for _ in range(10):
        a += a.translate({97: 98, 98: 97})
    texts = pa.array([" ".join([a, a.translate({97: 98, 98: 97}), a[:64], a[:65], "x" * 8, "x" * 9, "x\x00", "x"])])
    hasher = common.WordHasher(common.space_words(), fold=False)
    ((_, data, offsets),) = common.text_blocks(texts)
    starts, ends, _ = hasher.words(data, offsets)
    assert len(set(hasher.hashes(data, starts, ends).tolist())) == 8


# 11: fill in the middle


def fim_brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n = len(tokens)
    if not text or any(m in text for m in fill_middle.MARKS) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def fim_rows(docs):
    made = fill_middle.fill_in_middle(docs)
    back = fill_middle.restored(F.col("output"), F.col("form")).alias("back")
    return sorted(map(tuple, made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()), key=str)


def test_fill_in_middle_matches_brute_force(spark):
    rng = random.Random(7)
    parts = ["".join(rng.choices("ab é€ \n\t\x00 x", k=rng.randint(0, 300))) for _ in range(20)]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 9)))) for i in range(300)]
    rows += [(400 + i, t) for i in range(12) for t in (None, "", " ", "a", " a\n", "x<P>", "<", "<S", "x" * 50_000, " " * 40_000, "é" * 20_000 + " b")]
    rows += [(None, "null id with words"), (None, "null id with words"), (7, rows[7][1])]
    docs = crowded(spark.createDataFrame(rows, DOCS))
    assert fim_rows(docs) == sorted((fim_brute(*r) for r in rows), key=str)
    assert set(CLASHES) <= set(fill_middle.fill_in_middle(docs).columns)
    assert fim_rows(docs.where("false")) == []


def test_shared_chunks_are_counted_once():
    rng = random.Random(8)
    passage = " ".join(f"w{rng.random()}" for _ in range(2000))
    texts = [f"start {i} {passage} end {i}" for i in range(20)]
    asked, summaries = [], fill_middle.ChunkSummaries()
    plain = summaries.summarise
    summaries.summarise = lambda chunks: asked.extend(chunks) or plain(chunks)
    draws = np.arange(20) * 7919
    n, before, between = fill_middle.cut_places(pa.array(texts), draws, draws * 3, np.ones(20, bool), summaries)
    assert n.tolist() == [len(TOKEN.findall(t)) for t in texts]
    assert sum(map(len, asked)) < 0.25 * sum(map(len, texts))
    small = fill_middle.ChunkSummaries(limit=2000)
    again = fill_middle.cut_places(pa.array(texts), draws, draws * 3, np.ones(20, bool), small)
    assert all((a == b).all() for a, b in zip(again, (n, before, between), strict=True))
    assert sum(map(len, {**small.known, **small.older})) < 2 * sum(map(len, set(asked)))


def test_chunks_follow_content():
    rng = np.random.default_rng(3)
    body = rng.integers(97, 123, 60_000).astype(np.uint8)

    def chunks(data):
        heads = fill_middle.chunk_starts(data, np.array([0, len(data)]))
        return {data[i:j].tobytes() for i, j in zip(heads, np.append(heads[1:], len(data)), strict=True)}

    a, b = chunks(body), chunks(np.concatenate([body[:31], body]))
    assert len(a) > 20 and len(a & b) >= len(a) - 2
    flat = np.full(100_000, 97, np.uint8)
    assert max(map(len, chunks(flat))) <= fill_middle.LONGEST_CHUNK


# 12: repeated passages


def last(doc_id):
    return doc_id is None, doc_id or 0


def repeats_brute(rows, window):
    words, first, out = [WORD.findall(t or "") for _, t in rows], {}, []
    for (doc_id, _), w in zip(rows, words, strict=True):
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, doc_id), doc_id, key=last)
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if last(first[tuple(w[p : p + window])]) < last(doc_id):
                gone.update(range(p, p + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [50, 7, 2, 1])
def test_repeats_match_brute_force(spark, window):
    """Small shards and buckets, so that passages lie across both."""
    rng = random.Random(window)
    parts = [[rng.choice(["a", "bb", "é", "\x00", f"long-word-{i}"]) for i in range(rng.randint(1, 3 * window))] for _ in range(12)]
    texts = ["\n ".join(" ".join(rng.choice(parts)) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    rows = [(rng.choice([None, *range(90)]), rng.choice([*texts, None, "", " \t"])) for _ in range(120)]
    docs = crowded(spark.createDataFrame(rows, DOCS))
    got = substring_dedup.remove_repeats(docs, window, shard_bytes=2000, bucket_windows=300).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got), key=str) == repeats_brute(rows, window)
    assert all(sum(x["n_words"] for x in r["removed"]) == r["n_removed"] for r in got) and any(r["n_removed"] for r in got)
    assert substring_dedup.remove_repeats(docs.where("false"), window).count() == 0


def test_repeats_are_maximal(spark):
    long = " ".join(f"w{i}" for i in range(120))
    rows = [(1, f"x {long} y"), (2, f"p q {long}"), (3, " ".join(f"w{i}" for i in range(20, 69))), (4, " ".join(f"w{i}" for i in range(20, 70)))]
    got = {r["doc_id"]: (r["n_removed"], [tuple(x) for x in r["removed"]], r["kept_text"]) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1][0] == 0 and got[2] == (120, [(2, 120)], "p q") and got[3][0] == 0 and got[4] == (50, [(0, 50)], "")


def test_shards_stay_where_they_are(spark):
    """Replies are dealt to the stored shards; the shards themselves aren't shuffled, and no pair is joined."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = substring_dedup.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") >= 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    below = [line for line in plan.split("\n") if "packed" in line and "Exchange" in line]
    assert not below


# 13: search


def search_brute(docs, items, top):
    low = {i: i + 32 for i in range(65, 91)}
    bags = [(d, Counter(TERM.findall((t or "").translate(low)))) for d, t in docs]
    n_docs, length = sum(bool(c) for _, c in bags), sum(sum(c.values()) for _, c in bags)
    df, asked, out = Counter(t for _, c in bags for t in c), {}, []
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(low)))
    for i, terms in asked.items():
        found = []
        for d, c in bags:
            if c:
                m = 100 - 90 + (90 * sum(c.values()) * n_docs) // length
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t])
                if s > 0:
                    found.append((-s, last(d), d))
        out += [(i, r, d, -s) for r, (s, _, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def test_search_matches_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "B", "é", "word%d", "Long-Term", "x" * 30, "X" * 30 + "y", "tHe", "1", "2a", " ", "longer" * 20]

    def text():
        return " ".join(rng.choice(words).replace("%d", str(rng.randint(0, 9))) for _ in range(rng.randint(0, 12)))

    some = [text() for _ in range(40)] + [None, "", "a " * 3000]
    docs = [(rng.choice([None, *range(300)]), rng.choice(some)) for _ in range(400)]
    items = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([text(), text(), None, ""])) for _ in range(12)]
    d, i = crowded(spark.createDataFrame(docs, DOCS)), crowded(spark.createDataFrame(items, "item_id bigint, text string"))
    monkeypatch.setattr(lexical_search, "STEP", 50)
    for top, chars in ((10, 1 << 20), (3, 40)):
        got = sorted(map(tuple, lexical_search.search(d, i, top, chars).collect()), key=str)
        assert got == search_brute(docs, items, top)
    assert lexical_search.search(d.where("false"), i).count() == 0
    assert lexical_search.search(d, i.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(d, i.where("false")).count() == 0


def test_classes_are_scored_once(spark, monkeypatch):
    """Five hundred copies of one document are one class with as many members as can be ranked."""
    docs = spark.createDataFrame([(i, "x y z") for i in range(500, 0, -1)] + [(0, "x q")], DOCS)
    items = spark.createDataFrame([(1, "y x"), (2, "q")], "item_id int, text string")
    found = lexical_search.search(docs, items, 4)
    assert found.schema["item_id"].dataType.simpleString() == "int"
    assert [tuple(r)[:3] for r in found.orderBy("item_id", "rank").collect()][:4] == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 4)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before and after the shuffle


def test_bags_are_canonical():
    for counts in ([1, 2], [300, 1], [70_000, 5], []):
        terms = np.arange(len(counts)) * 70_000
        bag = lexical_search.pack_bag(terms, np.array(counts, np.int64))
        a, b = lexical_search.unpack_bag(bag)
        assert a.tolist() == terms.tolist() and b.tolist() == counts


def test_new_queries_cover_their_tables(spark):
    sf = "/root/testdata/sf0.001"
    ids = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    for query in (queries.op11_fill_middle, queries.op12_substring_dedup):
        assert {r["doc_id"] for r in query(spark, sf).select("doc_id").collect()} == ids
