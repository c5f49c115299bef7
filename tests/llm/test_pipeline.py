"""The pipeline's stages against brute force, each on its own input."""

import hashlib

import corpus_pipeline
import public_tokenizers as P
import tiktoken
from test_qgram_decontam import plain
from test_signature_join import brute

from ledgerlens.llm import qgram_decontam, toxicity_chain
from ledgerlens.llm.common import load_ranks, stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "byte_bpe"]
    tables = [docs]
    for _, step in corpus_pipeline.STAGES:
        tables.append(stage(step(spark, tables[-1], SF)))
    assert all(t.columns == columns for t in tables[:-1])
    rows = [t.collect() for t in tables]

    chain = toxicity_chain.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rejected = {r.doc_id for r in toxicity_chain.score(docs, chain).filter("rejected").collect()}
    assert {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]} == rejected

    # Each set's group keeps its smallest id; documents without words all stay.
    pairs = [(r.doc_id, r.text) for r in rows[1]]
    assert {r.doc_id for r in rows[2]} == {c for _, n, c in brute(pairs) if n} | {i for i, n, _ in brute(pairs) if not n}

    normal = qgram_decontam.Normal()
    items = [qgram_decontam.strip(normal.form(r.text)[0]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = set()
    for r in rows[2]:
        form = normal.form(r.text)[0].tobytes()
        if any(i.tobytes() in form for i in items):
            dirty.add(r.doc_id)
    gone = {r.doc_id for r in rows[2]} - {r.doc_id for r in rows[3]}
    assert dirty <= gone
    for r in rows[2]:
        if r.doc_id in gone - dirty:  # only an edited copy
            form = normal.form(r.text)[0].tolist()
            assert any(plain(i.tolist(), form) <= len(i) // 10 for i in items)

    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = {(r.doc_id, hashlib.sha256(",".join(map(str, tik.encode_ordinary(r.text))).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in rows[3]}
    assert {(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in rows[4]} == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, rows[4]))
