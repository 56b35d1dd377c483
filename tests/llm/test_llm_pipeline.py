"""The pipeline, stage by stage, against brute force on the smallest tables."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
import xxhash
from test_llm_mixing import flattened
from test_llm_ring import walk
from test_llm_simhash import groups, plain_fingerprint
from test_llm_winnow import judged

import corpus_pipeline
from tidemark.llm import mixing, toxicity

SF_DIR = "/root/testdata/sf0.001"


def plain_mix(rows):
    sources = flattened((r.source, len(r.text.split())) for r in rows)
    axes = [{mixing.OTHER: 0.0, **a} for a in (sources, mixing.LANGUAGES, mixing.TOPICS)]

    def topic(text):
        checks = {"table": " | " in text, "shouting": "!! " in text, "markup": any(x * 3 in text for x in "#$%&*"), "license": "licen" in text.lower()}
        return next((name for name, held in checks.items() if held), "prose")

    tokens, where = np.zeros([len(a) for a in axes]), {}
    for r in rows:
        values = (r.source, r.lang, topic(r.text))
        where[r.doc_id] = tuple(list(a).index(v if v in a else mixing.OTHER) for a, v in zip(axes, values))
        tokens[where[r.doc_id]] += len(r.text.split())
    wanted = mixing.rake(tokens, [np.array(list(a.values())) for a in axes], mixing.BUDGET * tokens.sum())

    def chance(r):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", mixing.SEED), 42)
        seed = xxhash.xxh64_intdigest(struct.pack("<q", r.doc_id), seed)
        return (xxhash.xxh64_intdigest(r.text.encode(), seed) % (1 << 53)) / (1 << 53)

    return [r for r in rows if chance(r) < (wanted[where[r.doc_id]] / tokens[where[r.doc_id]] if tokens[where[r.doc_id]] else 1)]


def test_run_against_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit_on(docs, labels)
    evidence = toxicity._Evidence(model.weights)
    rows = sorted(docs.collect())
    rows = [r for r in rows if toxicity.score_text(r.text.encode(), evidence, model.bias)[0] < toxicity.THRESHOLD]
    top = groups([plain_fingerprint(r.text) for r in rows], 4)
    first = {}
    for r in rows:
        first.setdefault(top[plain_fingerprint(r.text)], r)
    rows = sorted(first.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = [r for r in rows if not judged(r.text, items)[4]]
    rows = plain_mix(rows)
    wanted = walk([(r.doc_id, zlib.crc32(r.text.encode()), len(r.text.encode()) + 8) for r in rows], 24, 64)
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {(r.doc_id, r.text_crc32, r.size): [(r.shard, r.slot)] for r in got} == wanted and len(got) == len(rows) < docs.count()


@pytest.mark.parametrize("kind", ["edge_documents", "no_documents"])
def test_stages_on_edge_cases(spark, kind, request):
    docs = request.getfixturevalue(kind)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        rows = out.collect()
        assert len(rows) <= docs.count(), name
        if (name, stage) != corpus_pipeline.STAGES[-1]:
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        else:
            assert len(rows) == docs.count()
