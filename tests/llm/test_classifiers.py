import os
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from gaugeline.llm import langid, quality, queries
from gaugeline.llm.common import bounded_sample, discard, materialize, scratch_root

SF = "/root/testdata/sf0.01"


def test_held_out_rule(spark):
    df = queries.op1_quality(spark, SF).select("doc_id", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in df)


def test_quality_on_held_out_rows(spark):
    scored = queries.op1_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_quality_scores_equal_plain_calls(spark):
    """The sizes of whole texts, piece by piece, by a compressor made anew for each piece."""
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("quality", "label"), "doc_id"))
    texts = ["", "a", "plain words of a text " * 300, "### *** " * 40, "grüße und mehr " * 100]
    params = zstandard.ZstdCompressionParameters.from_level(quality.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(raw, d):
        return sum(len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), compression_params=params).compress(raw[i : i + quality.PIECE])) for i in range(0, len(raw), quality.PIECE))

    want = []
    for t in texts:
        raw = t.encode()
        x = (size(raw, model.bad) - size(raw, model.good)) / len(raw) if raw else 0.0
        want.append(1 / (1 + np.exp(-(model.slope * x + model.shift))))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r.score for r in quality.score_quality(df, model).orderBy("i").collect()]
    assert np.allclose(got, want, atol=1e-9)


def test_samples_do_not_depend_on_the_order(spark):
    """Copies with different labels: the same row is taken however the rows are dealt, and copies don't thin the sample."""
    rows = [(7, i) for i in range(900)] + [(k, i % 3) for i in range(6) for k in range(100, 140)]
    seen = set()
    for step, n in ((1, 1), (-1, 3), (-1, 8)):
        df = spark.createDataFrame(rows[::step], "k int, y int").repartition(n).select(F.xxhash64("k").alias("h"), "k", "y")
        seen.add(tuple(map(tuple, bounded_sample(df, "h", 15).select("k", "y").collect())))
    assert len(seen) == 1 and len(*seen) == 15 and all(y == 0 for _, y in [*seen][0])


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Session:
        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

        class conf:
            get = staticmethod(lambda key, default: None)

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(Session)
    Session.sparkContext.master = "local[2]"
    assert scratch_root(Session).startswith("file:///")
    table = materialize(spark.range(3), "x")
    discard(table)
    assert not os.path.exists(table.scratch_path.removeprefix("file://"))


def test_quality_of_odd_rows(spark):
    rows = [(1, "good prose of words and more words here. " * 30, 1), (2, "### *** %%% " * 50, 0), (3, None, 1), (4, "", 0), (5, "x" * 300_000, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").withColumnRenamed("doc_id", "score")
    model = quality.fit(df)
    out = quality.score_quality(df, model).collect()
    assert len(out) == 15 and all(0 <= r.score <= 1 for r in out)
    assert quality.score_quality(df.limit(0), model).count() == 0
    nothing = quality.fit(df.limit(0))
    assert all(r.score == 0.5 for r in quality.score_quality(df, nothing).collect())


def test_language_on_held_out_rows(spark):
    told = queries.op4_language(spark, SF)
    rows = told.filter("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97


def test_language_of_odd_rows(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("", "de"), ("123 !?", "en"), ("wort " * 50_000, None)] * 2
    df = spark.createDataFrame(rows, "text string, lang_pred string")
    model = langid.fit(df, lang="lang_pred")
    out = langid.identify(df, model).collect()
    assert [r.lang_pred for r in out if not r.text or r.text == "123 !?"] == ["und"] * 6
    assert {r.lang_pred for r in out} <= {"en", "de", "und"} and all(0 <= r.score <= 1 for r in out)
    assert langid.identify(df.limit(0), model).count() == 0
    assert {r.lang_pred for r in langid.identify(df, langid.fit(df.limit(0), lang="lang_pred")).collect()} == {"und"}


def test_pair_tables_equal_the_convolution():
    rng = np.random.default_rng(0)
    model = langid.train([bytes(rng.integers(32, 127, 256).tolist()) for _ in range(40)], ["a", "b"] * 20, epochs=1)
    text = bytes(rng.integers(32, 127, 700).tolist()).decode()
    codes = np.pad(langid.CLASSES[np.frombuffer(text.encode().ljust(768, b"\xff"), np.uint8)], (0, 4))
    pooled = []
    for w in langid.WIDTHS:
        conv = sum(model.tables[w][k][codes[k : k + 768]] for k in range(w))
        pooled.append(conv.reshape(3, 256, -1).max(axis=1))
    p = langid.softmax(np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense + model.out)
    assert model.windows(codes[:768], model.pairs()) == pytest.approx(p, abs=1e-5)
    assert model.predict([text, "", text])[0] == pytest.approx(model.predict([text])[0])
