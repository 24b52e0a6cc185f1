"""The training-data operators: SQL twins, brute force, round trips, and odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from farescope.llm import (
    chat_format,
    common,
    components,
    decontam,
    exact_dedup,
    html_extract,
    mixing,
    ngram_join,
    quality,
    queries,
    secret_scan,
    token_output,
    url_filter,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i}" for i in range(3000))
# Nulls, empty and blank texts, a long one, ties and repeated rows.
ODD = [
    (1, "a b c", "en", "s", 5),
    (1, "a b c", "en", "s", 5),
    (2, "a  b c", "en", None, 6),
    (3, None, None, "s", None),
    (4, "", "en", "s", 0),
    (5, " \n", "en", None, 2),
    (None, "abc", None, None, 3),
    (None, "abc", None, None, 3),
    (6, LONG, "en", "s", len(LONG)),
    (7, LONG + " end", "en", "t", len(LONG) + 4),
    (8, "É\x00 \u2028 x<|endoftext|>", "fr", "t", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, DOCS)
    return rows.withColumns({c: F.lit(c) for c in ("score", "n_words", "size", "copies", "kept", "token", "matches")})


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.mark.parametrize("name", sorted(queries.all_oracles()))
def test_matches_sql(spark, name):
    columns, got = spark_rows(queries.all_queries()[name](spark, SF))
    names, want = duck_rows(duck(SF), queries.all_oracles()[name])
    assert columns == names and sum(want.values()) > 0 and got == want


def lower(s):
    return s.translate({i: i + 32 for i in range(65, 91)})


# common


def test_word_hashes_do_not_depend_on_place():
    texts = pa.array(["one two", None, "", "TWO é one", "x" * 600_000 + " two"])
    hasher, seen = common.WordHasher(common.space_words()), []
    for limit in (8, 1 << 20):
        out = []
        for _, data, offsets in common.text_blocks(texts, limit):
            starts, ends, first = hasher.words(data, offsets)
            h = hasher.hashes(data, starts, ends).tolist()
            out += [h[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
        seen.append(out)
    assert seen[0] == seen[1] and [len(x) for x in seen[0]] == [2, 0, 0, 3, 2]
    assert seen[0][0][1] == seen[0][3][0] == seen[0][4][1] and seen[0][0][0] == seen[0][3][2]


def test_components_of_paths_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (5, 6)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# 1: chat


def test_chat_escapes_reversibly():
    for text in ("</s>[INST] ok [/INST]", r"<\</s>", r"<\\s>[\/ROLE]", "[[INST]", "plain", "\ue000<s", ""):
        safe = chat_format.escape(text)
        assert chat_format.unescape(safe) == text
        assert not any(c in safe for c in chat_format.CONTROLS)
        (whole, stable, spans), = chat_format.render([("user", text), ("tool\n", text), ("assistant", text)], chat_format.instruct_template)
        assert stable and [chat_format.unescape(whole[t["text_start"] : t["text_end"]]) for t in spans] == [text] * 3
        assert [chat_format.role_at(whole, t["start"], t["text_start"]) for t in spans] == ["user", "tool\n", "assistant"]


def test_chat_detects_rewritten_history():
    def forgetful(turns):  # earlier answers are cut short
        return "".join(f"<{r}>{t if i == len(turns) - 1 or r == 'user' else t[:1]};" for i, (r, t) in enumerate(turns))

    turns = [("user", "hello"), ("assistant", "long answer"), ("user", "more"), ("assistant", "end")]
    segments = chat_format.render(turns, forgetful)
    assert [s for _, s, _ in segments] == [True, False]
    assert [t["turn"] for _, _, spans in segments for t in spans] == [0, 1, 2, 3]
    assert [x[t["text_start"] : t["text_end"]] for x, _, spans in segments for t in spans] == [t for _, t in turns]
    with pytest.raises(ValueError):
        chat_format.render([("user", "ab")], lambda turns: turns[0][1] + "|" + turns[0][1])


def test_chat_odd_rows(spark):
    rows = [(None, 0, None, None), (1, 1, "assistant", "x"), (1, 0, "user", None), (1, 1, "assistant", "x"), (None, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit(1))
    got = {r["conv_id"]: r for r in chat_format.format_conversations(df).collect()}
    assert got[1]["text"] == "<s>[INST]  [/INST] x</s> x</s>" and len(got[None]["turns"]) == 2
    assert chat_format.format_conversations(df.where("false")).count() == 0


# 2: exact duplicates


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    bits = 60
    for n, crowded in ((500, 1), (3000, 1 << 38), (0, 1)):  # the second with long runs
        prints = rng.integers(0, (1 << bits) // crowded, n, dtype=np.uint64)
        drawn = rng.choice(prints, 4000) if n else prints
        parts = [np.unique(x, return_counts=True) for x in np.array_split(drawn, 7)]
        filters = [exact_dedup.QuotientFilter.of(p, c, bits) for p, c in parts]
        filters = [exact_dedup.QuotientFilter.unpacked(dict(zip(("places", "lengths", "remainders", "counts"), f.packed(), strict=True))) for f in filters]
        whole = exact_dedup.QuotientFilter.merged(filters)
        again = exact_dedup.QuotientFilter.merged([exact_dedup.QuotientFilter.merged(filters[:3]), *filters[3:]])
        want = np.unique(drawn, return_counts=True)
        for f in (whole, again):
            got = f.entries(bits)
            assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and len(got[0]) == len(want[0])
            assert f.lengths.sum() == len(want[0]) and f.remainders.max(initial=0) < 1 << bits - exact_dedup.PLACE_BITS


def test_a_filter_counts_all(spark):
    rng = random.Random(6)
    prints = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)] + [0, -1]
    rows = [rng.choice(prints) for _ in range(2000)]
    df = spark.createDataFrame([(p,) for p in rows], "fingerprint bigint").repartition(5)
    got = dict(map(tuple, exact_dedup.filter_counts(exact_dedup.counting_filter(df)).collect()))
    assert got == {p: rows.count(p) for p in set(rows)}
    more = dict(map(tuple, exact_dedup.filter_counts(exact_dedup.counting_filter(df), 9).collect()))
    assert more == {p: n for p, n in got.items() if n >= 9}
    assert exact_dedup.counting_filter(df.where("false")).count() == 0


def test_exact_duplicates_odd(spark, odd, none):
    got = exact_dedup.exact_duplicates(odd).collect()
    groups = sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["kept"]) for r in got)
    assert groups == [
        (-1, 2, 5, False), (-1, 2, 5, False), (1, 2, 5, False), (1, 2, 5, False), (2, 2, 5, True),
        (3, 5, 3, False), (4, 5, 3, False), (5, 5, 3, True), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True),
    ]
    assert exact_dedup.exact_duplicates(none).count() == 0
    twins = odd.where("doc_id = 1")
    assert sorted(r["kept"] for r in exact_dedup.exact_duplicates(twins).collect()) == [False, True]


# 3: urls


def test_urls_odd(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?q#f", "://", "http://example.com", "x://org/fr/", "http://b.org/de?a=://c/d"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    outcomes = spark.createDataFrame([("b.org", 1)] * 40 + [("c.org", None), (None, 1)], "host string, bad int")
    got = {r["page_id"]: r for r in url_filter.judge(pages, outcomes, queries.RULES).collect()}
    assert [got[i]["host"] for i in range(8)] == ["", "", "", "a.example.net", "", "example.com", "org", "b.org"]
    assert [got[i]["path"] for i in range(8)] == ["", "", "", "/en/x", "", "", "/fr/", "/de"]
    assert [got[i]["rule"] for i in range(8)] == [None] * 3 + ["example.net/en/", None, None, "org/fr/", None]
    assert [got[i]["verdict"] for i in range(8)] == ["allow"] * 7 + ["block"]
    assert url_filter.judge(pages.where("false"), outcomes, []).count() == 0


def test_names_under_a_suffix_of_two_labels_are_apart(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "c.org.uk", "x.notco.uk", "www.example.com", "com", ""]
    rows = spark.createDataFrame([(h, None) for h in hosts], "host string, bad int")
    got = {r["host"]: (r["domain"], r["suffix"]) for r in url_filter.reputations(rows, url_filter.SUFFIXES).collect()}
    assert got == {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
        "c.org.uk": ("c.org.uk", "org.uk"), "x.notco.uk": ("notco.uk", "uk"), "www.example.com": ("example.com", "com"),
        "com": ("com", "com"), "": ("", ""),
    }


def test_reputation_shrinks(spark):
    rows = [("a.x.com", b) for b in [1] * 30 + [0] * 2] + [("b.x.com", 1)] + [("c.y.com", 0)] * 50 + [("d.y.com", 1)]
    got = {r["host"]: r for r in url_filter.reputations(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["b.x.com"]["rate"] > got["d.y.com"]["rate"] and got["a.x.com"]["bound"] > 0.5 > got["c.y.com"]["bound"]
    assert got["a.x.com"]["domain"] == "x.com" and got["a.x.com"]["suffix"] == "com"


# 4: secrets


def plain_spans(text):
    found = []
    for m in re.finditer(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_match_brute_force(spark, odd, none):
    rng = random.Random(3)
    parts = ["token=", "Api_Key: '", "AKIA", "deadbeef" * 3, "é", " ", "\n", "password", "=", "ABCDEFGH12345678", "ſecret = abcdefghijklmnop", "secret=token=", "x1Y2"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for df in (docs, spark.read.parquet(f"{SF}/documents.parquet")):
        want = {r["doc_id"]: plain_spans(r["text"] or "") for r in df.collect()}
        for r in secret_scan.scan(df).collect():
            base = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in want[r["doc_id"]]]
            assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
            assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == base
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in want[r["doc_id"]]) for i in range(3))
    assert secret_scan.scan(odd).count() == len(ODD) and secret_scan.scan(none).count() == 0


@pytest.mark.parametrize("length", [24, 32, 40, 48, 64])
def test_random_keys_are_found_and_plain_words_are_not(spark, length):
    """Two thousand keys in plain sentences, no decoys among them; and as many plain tokens of their length."""
    rng = random.Random(length)
    plain = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()]
    words = [w.strip(".,").capitalize() for t in plain for w in t.split() if w.strip(".,").isascii() and w.strip(".,").isalpha()]
    rows = []
    for i in range(2000):
        key = "".join(rng.choices(secret_scan.ALPHABETS["base64"][:62], k=length))
        at = rng.randrange(len(words) - 60)
        natural = ("".join(words[at : at + 40]) + "x" * length)[: length - 3] + str(rng.randint(100, 999))
        rows.append((i, f"{plain[i % 300][:200]} so {key} and {natural} it is"))
    docs = spark.createDataFrame(rows, DOCS.split(", lang")[0])
    hit = false = 0
    for r in secret_scan.scan(docs).collect():
        text = rows[r["doc_id"]][1]
        spans = [text[int(s) : int(e)] for k, s, e in (x.split(":") for x in r["spans"].split(",") if x) if k == "random"]
        hit += any(text.split(" so ")[-1].startswith(s) for s in spans)
        false += sum(not text.split(" so ")[-1].startswith(s) for s in spans)
    assert false <= 0.06 * (hit + false)  # 0.05 is aimed at
    assert hit > (0.9 if length > 24 else 0.5) * 2000  # half the tokens of 24 characters are plain ones much like keys


def test_random_tokens_stand_alone(spark):
    """Keys as the only long tokens are found at every length."""
    rng = random.Random(9)
    for length in (24, 64):
        keys = ["".join(rng.choices(secret_scan.ALPHABETS["base64"][:62], k=length)) for _ in range(2000)]
        docs = spark.createDataFrame([(i, f"some words before {k} and after it") for i, k in enumerate(keys)], "doc_id bigint, text string")
        assert sum("random" in r["spans"] for r in secret_scan.scan(docs).collect()) > 0.9 * 2000


def test_randomness_of_random_tokens_is_even():
    x = np.random.default_rng(4).integers(0, 64, (4000, 40))
    p = secret_scan.randomness(x, 64)
    assert 0.85 < (p >= 0.1).mean() <= 0.92 and p.min() >= 0 and p.max() <= 1
    assert secret_scan.randomness(np.zeros((1, 30), int), 64)[0] < 1e-6
    for kind in secret_scan.ENCODINGS:  # an empty corpus, and one of a single word
        for pairs in ({}, {64 * 65 + 30: 5, 30 * 65 + 31: 5, 31 * 65 + 64: 5}):
            made = secret_scan.decoys(pairs, 20, kind, n=50)
            assert made.shape == (50, 20) and made.min() >= 0 and made.max() < len(secret_scan.ALPHABETS[kind])


# 5: pages


def page(body, article="article"):
    return (
        '<html><head><title>T</title><script>var t="</p>";</script><style>p{}</style></head><body><nav><a href="/">menu</a></nav>'
        f'<div class="ad-12">buy</div><{article}>{body}</{article.split()[0]}><div class="reader-comments"><p>{"I say so. " * 30}</p></div>'
        '<aside>side</aside><form><p>mail me</p></form><div id="cookie-notice">cookies</div><footer>&copy; host</footer></body></html>'
    )


def test_extracts_the_article(spark):
    body = "<h1>A &amp; B</h1><p>One <b>two</b>\n three&#33;<br>four<p>fi<i>ve</i> &lt;six&gt;<ul><li>seven<li>eight</ul>"
    want = "A & B One two three! four five <six> seven eight"
    for article in ("article", "main", 'div class="post-77"'):
        html = page(body, article)
        path = html_extract.best_path(html)[0]
        assert html_extract.text_at(html, path) == want, article
    rows = [(1, "http://a.org/1", page(body)), (2, "http://a.org/2", page(body)), (3, "http://a.org/3", "<p>bare"), (4, None, None), (5, "http://a.org", "")]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, rows[0]]], "page_id bigint, url string, html string, path string")
    got = sorted(tuple(r)[:4] for r in html_extract.extract(df).select("page_id", "text", "n_chars").collect())
    assert got == [(1, want, len(want))] * 2 + [(2, want, len(want)), (3, "bare", 4), (4, "", 0), (5, "", 0)]
    assert html_extract.extract(df.where("false")).count() == 0


LONG_P = "<p>" + "A paragraph that goes on for a while, to weigh something in all. " * 5 + "</p>"
LONG_TEXT = LONG_P[3:-4].strip()


@pytest.mark.parametrize(
    ("html", "path", "want"),
    [
        ("<html><p>one<p>two</html>", None, "one two"),
        ("no tag &amp; all", None, "no tag & all"),
        (f'<body><nav>m</nav><div class="overflow-hidden">{LONG_P}</div><div class="ad">b</div></body>', None, LONG_TEXT),
        (f'<body><div class="social-post">{LONG_P}</div></body>', None, LONG_TEXT),
        (f'<body><form id="all"><div>{LONG_P}</div></form></body>', None, LONG_TEXT),
        (
            f'<article><header><h1>T</h1></header><p class="notice">N</p><div class="post-search-warning">W</div>{LONG_P}</article>',
            None,
            f"T N W {LONG_TEXT}",
        ),
        (f'<div class="post"><form>f</form></div><article>{LONG_P}</article>', ">body>div.post", LONG_TEXT),
        (f'<div class="intro">{LONG_P}</div><div class="rest">{LONG_P}</div>', None, f"{LONG_TEXT} {LONG_TEXT}"),
        (f"<article>{LONG_P}</article><article><h2><a>A teaser with a title</a></h2><p>short</p></article>", None, LONG_TEXT),
        (f'<article>{LONG_P}</article><div class="reader-comments">{LONG_P * 4}</div>', None, LONG_TEXT),
        (f'<header>site</header><div id="c">{LONG_P}</div><div class="notice">n</div><footer>f</footer>', None, LONG_TEXT),
    ],
)
def test_odd_pages_keep_their_text(html, path, want):
    assert html_extract.text_at(html, path) == want


def test_no_page_comes_out_empty(spark):
    """Without an article or body, or with a doubtful class in their place, as against a plain reading."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.blocks = 0, [""]

        def handle_starttag(self, tag, attrs):
            self.inside += tag == "article"
            if tag in ("p", "br", "h1", "li", "ul", "div"):
                self.blocks.append("")

        def handle_endtag(self, tag):
            self.inside -= tag == "article"
            if tag in ("p", "h1", "li", "ul", "div"):
                self.blocks.append("")

        def handle_data(self, data):
            if self.inside:
                self.blocks[-1] += data

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        plain = Plain()
        plain.feed(r["html"])
        want = " ".join(" ".join(b.split()) for b in plain.blocks if b.strip())
        assert html_extract.text_at(r["html"], None) == want
        bare = re.sub(r"</?(?:body|article)>", "", r["html"])
        assert want in html_extract.text_at(bare, None)
        doubtful = r["html"].replace("<article>", '<div class="overflow-hidden">').replace("</article>", "</div>")
        assert html_extract.text_at(doubtful, None) == want


# 6: quality


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) > 0.95 * len(rows)
    assert min(r["score"] for r in rows) >= 0 and max(r["score"] for r in rows) <= 1


def test_quality_odd(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (6, None)], "doc_id bigint, label int")
    model = quality.fit(odd, labels)
    got = quality.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got) and got[0].asDict()["n_words"] == "n_words"
    assert quality.accepted(odd, model, 0.0).columns == odd.columns and quality.score(none, model).count() == 0
    empty = quality.fit(none, labels.where("false"))
    assert quality.score(odd, empty, ["doc_id"]).count() == len(ODD)


def test_pooled_is_monotone():
    rng = np.random.default_rng(2)
    n = rng.integers(1, 50, 100).astype(float)
    out = quality.pooled(n, n * rng.random(100))
    assert (np.diff(out) >= 0).all() and len(out) == 100


# 7: mixing


def test_mix_odd(spark, odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(total)
    again = mixing.mix(odd.repartition(5, "text"))
    assert sorted(map(str, again.collect())) == sorted(map(str, got)) and mixing.mix(none).count() == 0
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r["copies"] for r in got)


def test_targets_stop_at_the_limit(spark):
    rows = [("a", 10), ("b", 100), (None, 1000), ("c", 0)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint")).collect()}
    assert got["a"] == 30 and got["b"] == 300 and got["c"] == 0 and got[None] == pytest.approx(780)


# 8: tokens


def test_tokens_round_trip(spark, odd, none, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    plain = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(10 + i, t, None, None, 0) for i, t in enumerate(["a b\nc, d.\n\ne", "x!. y", " lead", "tail ", "it's  two\ttabs", "a\u00a0b é!?", "1,000.5 (x)"])], DOCS)
    for k, df in enumerate((odd.select(*extra.columns).unionByName(extra), spark.read.parquet(f"{SF}/documents.parquet"))):
        token_output.write_tokens(df, str(tmp_path / str(k)), path)
        got = token_output.read_tokens(spark, str(tmp_path / str(k)), ids=True).orderBy("start").collect()
        at = 0
        want = sorted([r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or ""] for r in df.collect())
        ids = sorted([i, *plain.encode(t, add_special_tokens=False).ids, 0] for i, t in want)
        assert sorted([r["doc_id"] if r["doc_id"] is not None else -1, *r["ids"]] for r in got) == ids
        assert [r["doc_id"] or -1 for r in got] == sorted(i or -1 for i, _ in want)
        for r in got:
            assert r["start"] == at and r["n_tokens"] == len(r["ids"])
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["n_tokens"]
    one = token_output.read_tokens(spark, str(tmp_path / "1"), doc_ids=[want[3][0]], ids=True).collect()
    assert [r["ids"][:-1] for r in one] == [plain.encode(want[3][1], add_special_tokens=False).ids]
    token_output.write_tokens(none, str(tmp_path / "none"), path)
    assert token_output.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_encoder_forgets_without_harm():
    path = public_tokenizers.path(queries.TOKENIZER)
    small = token_output.Encoder(path, remembered=40)
    texts = [f"Word{i}, word{i % 7}.\nLine{i}!! {i} $$$" for i in range(200)]
    assert [x for t in texts for x in small.encode(pa.array([t]))] == small._pack(texts)
    assert len(small.places.keys) < 80


def test_encoder_matches_the_plain_one():
    path = public_tokenizers.path(queries.TOKENIZER)
    enc = token_output.Encoder(path)
    rng = random.Random(17)
    parts = ["word", "Word", "1", "23", ",", ".", "..", "'s", "'", "\u201cq\u201d", "\u2026", "é", "日本", "€", "<|endoftext|>", "-", "\x00", "a.b", "\u00a0", "\u2009", "\u3000", "\x85", "longer-than-eight"]
    glue = [" ", "\n", "", "  ", "\n\n", "\t", " \n", "\r\n"]
    texts = ["".join(rng.choice(parts) + rng.choice(glue if rng.random() < 0.2 else glue[:3]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n", "a", " a", "a ", None, "x" * 100_000]
    assert enc.pieces and enc.encode(pa.array(texts)) == enc._pack([t or "" for t in texts])
    assert len(enc.places.keys) > 50


def test_places_of_keys():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)
    keys[:9000] = np.arange(9000)  # all for one slot and the ones behind it
    keys = np.unique(keys)
    places = token_output.Places(keys[:100])
    for i in range(100, len(keys), 7000):
        places.add(keys[i : i + 7000])
    assert (places.find(keys) == np.arange(len(keys))).all()
    assert (places.find(rng.integers(1 << 63, 1 << 64, 1000, dtype=np.uint64)) == -1).all()


# 9: near duplicates


def near_brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                root[top(i)] = top(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[top(i)] = min(doc_id, lowest.get(top(i), doc_id))
    return sorted(((d, len(s), lowest.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("short", [ngram_join.SHORT_LIST, 2])
def test_near_duplicates_match_brute_force(spark, monkeypatch, short):
    """Groups around the threshold, so that long lists hold linked and unlinked sets."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    rng = random.Random(11)
    rows = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(60)] = f"r{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(200, "a b"), (201, "A  b"), (202, "a b c"), (203, ""), (204, None), (None, rows[0][1]), (None, "z y"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"n": F.lit(1), "token": F.lit("t")})
    got = sorted(map(tuple, ngram_join.similar_components(docs).collect()), key=str)
    assert got == near_brute(rows)
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    want = {c for _, n, c in got if n and c is not None}
    assert sorted(r["doc_id"] for r in kept.where("text <> '' and doc_id is not null").collect()) == sorted(want)


def test_near_duplicates_odd(odd, none):
    got = sorted(((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in ngram_join.similar_components(odd).collect()))
    assert got == sorted([(1, 1, 1)] * 2 + [(2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (-1, 1, -1), (-1, 1, -1), (6, 2996, 6), (7, 2997, 6), (8, 1, 8)])
    assert ngram_join.similar_components(none).count() == 0 and ngram_join.representatives(none).count() == 0


# 10: benchmark text


def test_decontamination_odd(spark, odd, none):
    items = [("b", "w5 W6-w7 w8"), ("a", " ".join(f"w{i}" for i in range(100, 120))), (None, None), ("c", ""), ("d", "abc"), ("d", "abc")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for chars in (decontam.BENCHMARK_CHARS, 30):
        got = {(r["doc_id"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.contamination(odd, bench, benchmark_chars=chars).collect()}
        assert got == {(1, 0, 0, False), (2, 0, 0, False), (3, 0, 0, False), (4, 0, 0, False), (5, 0, 0, False), (None, 1, 1, True), (6, 24, 2, False), (7, 24, 2, False), (8, 0, 0, False)}
        kept = decontam.remove_contaminated(odd, bench, benchmark_chars=chars)
        assert kept.columns == odd.columns and kept.count() == len(ODD) - 2
    longest = decontam.contamination(odd.where("doc_id = 6"), bench).first()["matches"]
    assert sorted((m["item_id"], m["doc_start"], m["n_words"]) for m in longest) == [("a", 100, 20), ("b", 5, 4)]
    assert decontam.contamination(none, bench).count() == 0
    assert decontam.contamination(odd, bench.where("false")).where("n_hit > 0").count() == 0


# rows that share an id, or have none


def test_rows_are_told_apart_by_themselves(spark):
    rows = [(1, "one text of some words here"), (1, "another one, quite unlike it"), (2, "one text of some words here"), (None, "one text of some words here")]
    rows += [(None, "a text that nothing else is like"), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(c) for c in ("row", "row_", "__key", "first")})
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([rows[0], rows[1], rows[4], rows[5], rows[6], rows[7]], key=str)


def test_reserved_names_of_a_caller_come_back(spark):
    names = ("__n", "__row", "__n_words", "number", "size", "copies", "row", "rest", "none", "order", "source_", "c0")
    docs = spark.createDataFrame([(i, "a b c " * (i + 1), "s") for i in range(5)], "doc_id bigint, text string, source string")
    docs = docs.withColumns({c: F.lit(c.upper()) for c in names})
    bench = spark.createDataFrame([("x", "c a b " * 3)], "item_id string, text string")
    for out in (mixing.mixed_documents(docs), decontam.remove_contaminated(docs, bench), decontam.remove_contaminated(docs, bench, benchmark_chars=1)):
        assert out.columns == docs.columns and out.count() > 0
        assert all(r[c] == c.upper() for r in out.collect() for c in names)


def thue_morse(n):
    s = "a"
    for _ in range(n):
        s += s.translate({97: 98, 98: 97})
    return s


def test_words_that_a_sum_would_take_for_equal(spark):
    one = thue_morse(10)
    other = one.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, f"x {one} y {one} z {one} q"), (2, f"x {other} y {other} z {other} q")], "doc_id bigint, text string")
    assert {r["component_id"] for r in ngram_join.similar_components(docs).collect()} == {1, 2}
    bench = spark.createDataFrame([("i", f"x {one} y")], "item_id string, text string")
    assert {r["doc_id"]: r["contaminated"] for r in decontam.contamination(docs, bench).collect()} == {1: True, 2: False}


# pipeline


def test_pipeline_on_odd_tables(spark, odd, none, tmp_path):
    import corpus_pipeline

    for n, docs in enumerate((odd, none)):
        folder = str(tmp_path / str(n))
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([("i", "abc"), (None, None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
        step = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = common.stored(stage(spark, step, folder))
            assert out.count() <= 3 * step.count()
            if name != "tokens":
                assert out.columns == docs.columns
                step = out
        assert out.count() == step.count()
        assert corpus_pipeline.run(spark, folder).columns == out.columns


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench, labels = spark.read.parquet(f"{SF}/benchmark.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = common.stored(stage(spark, docs, SF))
        before = {r["doc_id"]: r for r in docs.collect()}
        after = out.collect()
        if name == "quality":
            bad = {r["doc_id"] for r in labels.where("quality = 0").collect()}
            ids = {r["doc_id"] for r in after}
            assert ids < set(before) and len(bad & ids) <= 1 and len(set(before) - ids) < 0.3 * len(before)
        elif name == "near_duplicates":
            want = {c for _, _, c in near_brute([(r["doc_id"], r["text"]) for r in before.values()])}
            assert {r["doc_id"] for r in after} == want and len(after) == len(want)
        elif name == "decontamination":
            clean = decontam.contamination(docs, bench, ["doc_id"]).where("not contaminated")
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in clean.collect()}
        elif name == "mixing":
            want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
            assert {i: sum(r["doc_id"] == i for r in after) for i in want} == want and sum(want.values()) == len(after)
        if name != "tokens":
            assert out.columns == docs.columns and all(r == before[r["doc_id"]] for r in after)
            docs = out
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in docs.collect())
