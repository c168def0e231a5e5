import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gaugeline.llm import langid, pii, queries
from gaugeline.llm.common import held_out, materialize
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixture", "packing"]
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
    rows = {n: {r.doc_id: r for r in d.collect()} for n, d in seen.items() if n != "packing"}
    kept, unique, clean = rows["language"], rows["near_duplicates"], rows["personal_data"]
    prose = [r for r in rows[""].values() if r.text and len(r.text) > 200 and r.lang]
    assert sum(r.doc_id in kept for r in prose) > 0.97 * len(prose)
    assert set(unique) <= set(kept) and set(clean) == set(unique)
    assert max(Counter(r.text for r in unique.values() if r.text.strip()).values()) == 1
    assert not any(pii.base_spans(r.text) for r in clean.values())
    assert all(r.n_chars == len(r.text) for r in clean.values() if r.text != unique[r.doc_id].text)
    copies = Counter(r.doc_id for r in seen["mixture"].collect())
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    # packing brings every copy back
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in seen["packing"].collect():
        pieces.setdefault((r.doc_id, r.start), []).append(np.frombuffer(r.ids, "<u4").tolist())
    for doc, n in copies.items():
        want = [*own.encode(clean[doc].text, add_special_tokens=False).ids, 1]
        for at in range(0, len(want), 2048):
            assert pieces.pop((doc, at)) == [want[at : at + 2048]] * n
    assert not pieces


def test_odd_documents(spark):
    long = "der schnelle braune Fuchs springt über den faulen Hund " * 2000
    rows = [(1, "the quick brown fox jumps over the lazy dog " * 5, "en", "a", 225), (2, long, "de", None, None), (3, None, None, None, None), (4, "", "en", "a", 0), (None, "the quick brown fox jumps over the lazy dog " * 5, "en", "b", 1), (1, "123 456", "en", "a", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.limit(0)):
        out = given
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, out, SF), f"odd-{name}")
        assert out.count() == 0 or {r.doc_id for r in out.select("doc_id").collect()} <= {1, 2}


def plain_pipeline(spark, docs):
    """(doc_id, start, length, crc32 of ids, tokens) of every piece, stage by stage in plain Python and one SQL text."""
    rows = [r.asDict() for r in docs.collect()]
    model = langid.fit(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    p = model.predict([r["text"] or "" for r in rows])
    rows = [r for r, q in zip(rows, p, strict=True) if re.search(r"[^\W\d_]", r["text"] or "") and q.max() >= corpus_pipeline.LEAST_LANGUAGE_SCORE]

    def bag(text):
        w = re.findall(r"[^\x09-\x0d\x1c-\x20]+", text.lower())
        return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))

    bags, part = [bag(r["text"]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if part[i] != part[j] and (a & b).total() >= 0.8 * (a | b).total():
                part = [part[j] if x == part[i] else x for x in part]
    least = {}
    for r, k in zip(rows, part, strict=True):
        least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    rows = [r for r, k in zip(rows, part, strict=True) if r["doc_id"] == least[k]]
    tagger = pii.fit()
    for r in rows:
        own = pii.all_spans(tagger, [r["text"]])[0][1]
        r["text"] = pii.replaced(r["text"], [{"kind": k, "start": a, "end": b} for k, a, b in own])
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?)", [[r["doc_id"], r["text"], r["source"]] for r in rows])
    copies = {d: round(taken / size) for d, size, taken in duck.sql(f"SELECT doc_id, size, taken FROM ({queries.ORACLE_SQL['op3_mix_sources']})").fetchall()}
    own, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for r in rows:
        ids = np.array([*own.encode(r["text"], add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            cut = ids[at : at + 2048]
            out[r["doc_id"], at, len(cut), zlib.crc32(cut.tobytes()), len(ids)] += copies[r["doc_id"]]
    return +out


def test_run_equals_a_plain_version(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    found = Counter((r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)), r.doc_tokens) for r in out)
    assert found == plain_pipeline(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_columns_that_clash(spark):
    names = ["told_lang", "told_score", "near_class", "spans", "base_spans", "row", "uid", "found", "a.b", "h", "copies"]
    rows = [(i, text, "en", "a", len(text), *map(str, range(len(names)))) for i, text in enumerate(["the quick brown fox jumps over the lazy dog " * 5, "mail to a@b.com about the river and the mills of the town " * 4])]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *names])
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, out, SF), f"clash-{name}")
        assert out.columns == docs.columns
    got = {tuple(r)[5:] for r in out.collect()}
    assert got == {tuple(map(str, range(len(names))))}
    assert corpus_pipeline.packed(spark, out, SF).count() == out.count()
