"""The corpus pipeline stage by stage, and the registration of the operators."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from paymart.llm import line_crf, minhash, packing, secrets
from paymart.llm.common import staged, table


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_small), name))
    return out


def test_stages_in_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_redaction", "pack_sequences"]
    assert all(d.columns == stages[0].columns for d in stages[:4])


def test_each_stage_does_what_its_operator_says(spark, sf_small, stages):
    docs, good, single, clean, packed = stages
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    judged = line_crf.quality(docs, table(spark, sf_small, "labels"))
    assert ids(good) == ids(judged.where("kept")) and 0 < good.count() < docs.count()
    assert ids(single) == ids(minhash.near_duplicates(good).where("kept")) and single.count() < good.count()
    assert ids(clean) == ids(single)
    before, after = ({r.doc_id: r for r in d.collect()} for d in (single, clean))
    for i, r in before.items():
        spans = secrets.scan_secrets(single.where(single.doc_id == i)).first().spans if "token" in r.text else []
        assert (after[i].text != r.text) == bool(spans) and after[i].n_chars == len(after[i].text)
    assert not any(re.search(r'token = "[0-9a-f]{32}', r.text) for r in after.values())
    pieces = packing.pack(clean)
    assert pieces.agg({"length": "sum"}).first()[0] == packed.agg({"length": "sum"}).first()[0]
    assert {r.doc_id for r in packed.collect()} == set(after)


def test_run_equals_its_stages(spark, sf_small, stages):
    rows = corpus_pipeline.run(spark, sf_small).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    whole = lambda rows: Counter((r.doc_id, r.doc_tokens) for r in rows)
    assert sum(r.length for r in rows) == sum(r.length for r in stages[-1].collect())
    assert set(whole(rows)) == set(whole(stages[-1].collect())) and len({key(r) for r in rows}) == len(rows)


def test_one_query_an_operator():
    names = [q for q in queries() if re.match(r"op\d+_", q)]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in names) == list(range(1, 14))
    assert "pipeline" in queries() and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in oracle_sql()
