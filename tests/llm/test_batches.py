"""What bounds the memory of a Python worker."""

import pyarrow as pa

from farescope.llm import common, ngram_join

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_tokens_are_counted_in_bounded_parts(spark):
    texts = [" ".join(f"w{i * j % 97}" for j in range(60)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])

    def counted(batches, at_once):
        found, sizes = {}, []
        for out in ngram_join._token_counts(5, 4, at_once)(iter(batches)):
            parts = [ngram_join._unpack(x.as_py()) for x in out.column("packed")]
            sizes.append(sum(int(n.sum()) for _, n in parts))
            for token, n in parts:
                for t, m in zip(token.tolist(), n.tolist(), strict=True):
                    found[t] = found.get(t, 0) + m
        return found, sizes

    whole, one = counted([batch], 1 << 30)
    parted, many = counted([batch], 200)
    merged, again = counted([batch.slice(i, 1) for i in range(40)], 1 << 30)
    assert whole == parted == merged and len(one) == len(again) == 1
    assert len(many) > 1 and max(many) < 200 + 60


def test_stages_take_texts_in_small_batches(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"one two three four five {i}", "en", "web", 20) for i in range(5)], "doc_id bigint, text string, lang string, source string, n_chars int")
    before = spark.conf.get(BATCH_ROWS)
    try:
        spark.conf.set(BATCH_ROWS, 10_000)
        assert corpus_pipeline.near_duplicate_stage(spark, docs, "").count() == 5
        assert int(spark.conf.get(BATCH_ROWS)) == common.BATCH_ROWS
        common.small_batches(spark, 7)
        common.small_batches(spark)
        assert int(spark.conf.get(BATCH_ROWS)) == 7
    finally:
        spark.conf.set(BATCH_ROWS, before)
