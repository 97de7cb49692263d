"""Every stage of the pipeline against brute force on what its predecessor kept."""

import os

import pytest

import corpus_pipeline
from tessera.llm import decontaminate, secrets, simhash, toxicity
from tessera.llm.common import table
from tessera.session import tables_written
from tests.llm.frames import awkward, frame
from tests.llm.test_groups import plain_components, plain_fingerprint
from tests.llm.test_text_operators import plain_contamination, plain_spans

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_dedup", "decontamination", "secret_scan", "best_fit_packing"]
    assert all(s.columns == stages[0].columns for s in stages)


def test_toxic_documents_went(spark, stages):
    rated, name = toxicity.rate(stages[0], table(spark, SF, "labels"))
    want = {r.doc_id for r in rated.where(~toxicity.toxic(name)).select("doc_id").collect()}
    assert set(rows(stages[1])) == want


def test_one_of_each_group_stayed(stages):
    before = sorted(rows(stages[1]).values(), key=lambda r: r.doc_id)
    label = plain_components([r.doc_id for r in before], [plain_fingerprint(r.text) for r in before])
    assert set(rows(stages[2])) == set(label) and len(set(label)) < len(before)


def test_contaminated_documents_went(spark, stages):
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    want = set()
    for r in rows(stages[2]).values():
        n, hit, _ = plain_contamination(r.text, items)
        if not (hit and decontaminate.SHARE * hit >= n):
            want.add(r.doc_id)
    assert set(rows(stages[3])) == want


def test_no_secret_is_left_and_no_document_lost(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    for doc, r in after.items():
        found = plain_spans(before[doc].text)
        assert (r.text == before[doc].text) == (not found)
        assert not plain_spans(r.text) and r.n_chars == len(r.text)
        assert (secrets.REDACTED in r.text) == bool(found)


def test_packing_holds_every_document(spark, stages):
    packed = corpus_pipeline.STAGES[-1][1](spark, stages[4], SF).collect()
    assert {r.doc_id for r in packed} == set(rows(stages[4]))
    room = {}
    for r in packed:
        room[r.sequence_id] = room.get(r.sequence_id, 0) + r.length
    assert max(room.values()) <= 1024


def test_awkward_documents_pass_through(spark):
    docs = frame(spark, [*awkward(), *awkward()], extra=True)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns, name
        assert made.count() == (len(docs.collect()) if name != "simhash_dedup" else simhash.keep_one(docs).count())
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_run_keeps_one_table_per_step(spark, stages, monkeypatch):
    """What a stage has read is removed once it is written; the rows are those of the stages in turn."""
    left, pack = [], corpus_pipeline.STAGES[-1]

    def last(*args):
        left.append(tables_written(spark) - before)
        return pack[1](*args)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[:-1], (pack[0], last)])
    before = tables_written(spark)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert left == [1]
    assert {r.doc_id for r in packed} == set(rows(stages[4]))
