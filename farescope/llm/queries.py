"""The operators over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farescope.session import shared_dir

from . import (
    chat_format,
    decontam,
    exact_dedup,
    fill_middle,
    html_extract,
    lexical_search,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    substring_dedup,
    token_output,
    url_filter,
)

PROBE = "</s>[INST] ok [/INST]"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> "F.Column":
    """Every fifth document, by its id; labels are learnt from the others."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def quality_labels(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def _digests(batches):
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["segment"] or not r["stable"]:
                raise ValueError("the template has rewritten a conversation")
            text, said, loss = r["text"], hashlib.sha256(), []
            for t in r["turns"]:
                own = chat_format.unescape(text[t["text_start"] : t["text_end"]])
                role = chat_format.role_at(text, t["start"], t["text_start"])
                said.update(f"{role}\n{own}\n".encode())
                if t["loss"]:
                    loss.append(own)
            learnt = "".join(loss)
            rows.append((r["conv_id"], len(r["turns"]), said.hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], own.schema)
    return chat_format.format_conversations(own.unionByName(probe)).mapInArrow(
        _digests,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document that its path names by number."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.try_to_number(F.nullif(F.regexp_extract(url_filter.path_of(F.col("url")), r"/([0-9]{1,18})(?:/|\.html)?$", 1), F.lit("")), F.lit("9" * 18))
    named = pages.select(url_filter.host_of(F.col("url")).alias("host"), number.cast("bigint").alias("doc_id"))
    outcomes = named.join(labels.where("quality is not null"), "doc_id").select("host", (1 - F.col("quality")).alias("bad"))
    return url_filter.judge(pages, outcomes, RULES, url_filter.SUFFIXES).select("page_id", "host", "path", "rule", "verdict")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality_labels(table(spark, sf_dir, "labels")))
    return quality.score(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_output.read_tokens(spark, path)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.drop("matches")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def all_queries():
    own = (
        op1_chat_format, op2_exact_dedup, op3_url_filter, op4_secret_scan, op5_html_extract,
        op6_quality, op7_mixing, op8_token_output, op9_ngram_join, op10_decontam,
        op11_fill_middle, op12_substring_dedup, op13_lexical_search,
    )
    return {f.__name__: f for f in own}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL_OP1 = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
), written AS (
  SELECT *,
    length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\])', '\1\\\2\3', 'g')) AS text_chars,
    length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\])', '\1\\\2\3', 'g')) AS role_chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(text_chars + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 20 + role_chars END))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""

SQL_OP2 = r"""
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM plain WINDOW best AS (PARTITION BY norm ORDER BY length(raw) DESC, doc_id NULLS LAST)
"""

_WEIGHT = """
  SELECT {parent}, least(greatest(coalesce(1 / round(CASE WHEN below > 0 AND above > 0 THEN above / below END, 9) - 1, 200.0), 1.0), 200.0) AS weight
  FROM (
    SELECT {parent}, squares - pages * p * p - p * (1 - p) * (m - 1) AS above,
      p * (1 - p) * (pages - n_squares / pages - (m - 1)) AS below
    FROM (
      SELECT {parent}, count(*) AS m, sum(n)::DOUBLE AS pages, sum(bad) / sum(n) AS p,
        sum(bad * bad / n) AS squares, sum(n * n)::DOUBLE AS n_squares
      FROM {child} WHERE n > 0 GROUP BY {parent}
    )
  )
"""

_TWO = "|".join(s.replace(".", r"\.") for s in url_filter.SUFFIXES)

SQL_OP3 = rf"""
WITH url AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), outcome AS (
  SELECT host, 1 - quality AS bad FROM url
  JOIN labels ON doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:/|\.html)?$', 1) AS BIGINT)
  WHERE quality IS NOT NULL
), hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
    CASE WHEN regexp_matches(host, '(^|\.)({_TWO})$') THEN regexp_extract(host, '([^.]+\.)?({_TWO})$', 0)
      ELSE regexp_extract(host, '([^.]*\.)?[^.]*$', 0) END AS domain,
    CASE WHEN regexp_matches(host, '(^|\.)({_TWO})$') THEN regexp_extract(host, '({_TWO})$', 0)
      ELSE regexp_extract(host, '[^.]*$', 0) END AS suffix
  FROM (SELECT host, bad FROM outcome UNION ALL SELECT host, NULL FROM url) GROUP BY host
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
tops AS (SELECT suffix, (sum(bad) + 1) / (sum(n) + 2) AS prior FROM domains GROUP BY suffix),
top_weight AS ({_WEIGHT.format(parent="suffix", child="domains")}),
domain_weight AS ({_WEIGHT.format(parent="domain", child="hosts")}),
domain_rate AS (
  SELECT domain, (coalesce(weight, 200) * prior + bad) / (coalesce(weight, 200) + n) AS prior
  FROM domains JOIN tops USING (suffix) LEFT JOIN top_weight USING (suffix)
), rated AS (
  SELECT host, coalesce(weight, 200) + n AS total, (coalesce(weight, 200) * prior + bad) / (coalesce(weight, 200) + n) AS rate
  FROM hosts JOIN domain_rate USING (domain) LEFT JOIN domain_weight USING (domain)
), judged AS (
  SELECT page_id, host, path, greatest(rate - 1.64 * sqrt(rate * (1 - rate) / (total + 1)), 0) > 0.5 AS bad,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM url JOIN rated USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

SQL_OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size, 3.0 * sum(size)::DOUBLE AS cap,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit
  FROM sources WINDOW rank AS (ORDER BY cap / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= unit * weight THEN cap
    ELSE weight * max(CASE WHEN cap > unit * weight THEN unit END) OVER () END AS target
  FROM ranked
), placed AS (
  SELECT sized.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio,
    row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id NULLS FIRST) AS place,
    ('0x' || substr(md5('mix-1:' || coalesce(sized.source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
), tried AS (
  SELECT *, start + k / 32.0::DOUBLE - floor(start + k / 32.0::DOUBLE) AS u FROM placed, range(32) AS r(k)
), misses AS (
  SELECT source, k, u, abs(sum(size * least(ceil(ratio), floor(u + ratio * place) - floor(u + ratio * (place - 1)))) - any_value(target)) AS miss
  FROM tried GROUP BY source, k, u
), best AS (SELECT source, u FROM misses QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, k) = 1)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
  (size * least(ceil(ratio), floor(u + ratio * place) - floor(u + ratio * (place - 1))))::BIGINT AS taken
FROM placed JOIN best ON placed.source IS NOT DISTINCT FROM best.source
"""

SQL_OP9 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, least(doc_id, coalesce(min(b), doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON doc_id = a GROUP BY doc_id
"""

SQL_OP10 = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, w, least(13, len(w)) AS l FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
  ) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - l + 2)) AS p FROM items)
), places AS (
  SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM docs, (SELECT DISTINCT l FROM items) WHERE len(w) >= l)
), hits AS (SELECT doc_id, p, l, item_id FROM places JOIN windows USING (l, win)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + l)) AS q FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL_OP11 = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents
), placed AS (
  SELECT doc_id, text, w, len(w)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50
      THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT doc_id, text, n, form, array_to_string(w[1:least(a, b)], '') AS p, array_to_string(w[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(w[greatest(a, b) + 1:n], '') AS s
  FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""

SQL_OP12 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, row_number() OVER () AS r FROM documents
), windows AS (
  SELECT r, doc_id, p, md5_number(array_to_string(w[p:p + 49], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50)
), first AS (SELECT h, min(doc_id) AS d FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT r, unnest(range(p, p + 50)) AS q FROM windows JOIN first USING (h) WHERE d < coalesce(doc_id, 9223372036854775807)
), kept AS (
  SELECT r, array_to_string(list(x ORDER BY q), ' ') AS text FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM words)
  ANTI JOIN gone USING (r, q) GROUP BY r
), removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (r) LEFT JOIN removed USING (r)
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL_OP13 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS length FROM docs WHERE len(w) > 0),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tf, size GROUP BY t
), asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
measured AS (SELECT r, doc_id, 100 - 90 + ((90 * len(w)::BIGINT * docs) // length) AS m FROM docs, size WHERE len(w) > 0),
scored AS (
  SELECT item_id, doc_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (t) JOIN weights USING (t) JOIN measured USING (r) GROUP BY item_id, doc_id, r
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_chat_format": SQL_OP1,
        "op2_exact_dedup": SQL_OP2,
        "op3_url_filter": SQL_OP3,
        "op7_mixing": SQL_OP7,
        "op9_ngram_join": SQL_OP9,
        "op10_decontam": SQL_OP10,
        "op11_fill_middle": SQL_OP11,
        "op12_substring_dedup": SQL_OP12,
        "op13_lexical_search": SQL_OP13,
    }
