"""The pipeline's stages against brute-force versions, and the guard in the entry module."""

import hashlib
import os
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as cp
from graticule.llm import op3_mixture, op4_pii, op5_simhash, op8_quality, op9_packing, queries
from graticule.llm.encoding import Encoder
from graticule.session import cut_lineage


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stage = dict(cp.STAGES)
    assert list(stage) == ["quality_rules", "near_dedup", "personal_data", "mix_sources", "pack_sequences"]
    source = {r["doc_id"]: r.asDict() for r in docs.collect()}

    rules = op8_quality.Rules()
    good = {i for i, r in source.items() if rules.measure(r["text"])[-1]}
    a = cut_lineage(stage["quality_rules"](spark, docs, sf_dir))
    assert a.columns == docs.columns and {r["doc_id"] for r in a.collect()} == good and 0 < len(good) < len(source)

    fps = {i: op5_simhash.simhash(source[i]["text"]) for i in good}
    group = {i: i for i in good}
    changed = True
    while changed:
        changed = False
        for i in good:
            least = min(group[j] for j in good if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 3)
            if least < group[i]:
                group[i], changed = least, True
    b = cut_lineage(stage["near_dedup"](spark, a, sf_dir))
    assert b.columns == docs.columns and sorted(r["doc_id"] for r in b.collect()) == sorted(set(group.values()))

    c = cut_lineage(stage["personal_data"](spark, b, sf_dir))
    for r in c.collect():
        text = source[r["doc_id"]]["text"]
        assert r["text"] == op4_pii.redact(text, op4_pii.find_spans(text)) and r["n_chars"] == len(r["text"])

    d = cut_lineage(stage["mix_sources"](spark, c, sf_dir))
    passes = {r["doc_id"]: r["passes"] for r in op3_mixture.mixed_documents(c).collect() if r["passes"]}
    assert d.columns == docs.columns and Counter(r["doc_id"] for r in d.collect()) == Counter(passes)

    e = stage["pack_sequences"](spark, d, sf_dir)
    enc = Encoder(queries.vocabulary(queries.WORD_BPE), False)
    assert sum(r["length"] for r in e.collect()) == sum(len(enc.whole(r["text"])) // 4 + 1 for r in d.collect())
    assert max(r["offset"] + r["length"] for r in e.collect()) <= op9_packing.CAPACITY

    digest = lambda df: hashlib.sha256(repr(sorted(tuple(r)[:5] for r in df.collect())).encode()).hexdigest()
    assert digest(cp.run(spark, sf_dir)) == digest(e)


def test_queries_are_registered():
    names = entry.queries()
    assert [n for n in names if n.startswith("op")] == list(queries.QUERIES) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))


def test_empty_and_odd_documents_pass_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(20).union(docs.limit(20)).selectExpr("doc_id", "if(doc_id % 3 = 0, null, text) AS text", "lang", "null AS source", "n_chars")
    for frame in (docs.limit(0), odd):
        for _, stage in cp.STAGES[:-1]:
            frame = cut_lineage(stage(spark, frame, sf_dir))
        cp.STAGES[-1][1](spark, frame, sf_dir).collect()


def test_no_vocabulary_in_the_repository():
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert not [f for _, _, files in os.walk(here) for f in files if f.endswith((".tiktoken", ".model"))]
