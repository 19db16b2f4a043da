"""The pipeline's stages on documents that have everything they must bear, and on none."""

import pytest
from fixtures import SCHEMA, frame, odd_rows

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
FILTERS = corpus_pipeline.STAGES[:3]


def plain(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


@pytest.mark.parametrize("name, stage", FILTERS, ids=[name for name, _ in FILTERS])
def test_filters_return_rows_as_they_were(spark, name, stage):
    docs = frame(spark, odd_rows())
    kept = stage(spark, docs, FOLDER)
    assert kept.dtypes == docs.dtypes
    before, after = plain(docs.collect()), plain(kept.collect())
    left = list(before)
    for row in after:
        left.remove(row)  # none is new, none more often than before
    if name == "near_duplicates":
        assert len(left) == 1 and "One two" in left[0]  # the row that is there twice
    else:
        assert left == []


def test_redacting_keeps_all_rows(spark):
    docs = frame(spark, odd_rows() + [(60, "write to jane.doe@example.org now"), (60, "write to jane.doe@example.org now")])
    found = corpus_pipeline.redact(spark, docs, FOLDER).collect()
    before = docs.collect()
    assert len(found) == len(before)
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in before)
    assert sum(r["text"] is None for r in found) == sum(r["text"] is None for r in before)
    changed = [r for r in found if r["doc_id"] == 60]
    assert len(changed) == 2 and all("jane" not in r["text"] and r["n_chars"] == len(r["text"]) for r in changed)
    assert plain(r for r in found if r["doc_id"] != 60) == plain(r for r in before if r["doc_id"] != 60)


def test_packing_places_every_document(spark):
    docs = frame(spark, odd_rows())
    pieces = corpus_pipeline.pack(spark, docs, FOLDER).collect()
    assert sorted(str(r["doc_id"]) for r in pieces if r["piece"] == 0) == sorted(str(i) for i, _ in odd_rows())
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[name for name, _ in corpus_pipeline.STAGES])
def test_no_documents(spark, name, stage):
    empty = spark.createDataFrame([], SCHEMA)
    found = stage(spark, empty, FOLDER)
    assert found.collect() == []
    if name != "packing":
        assert found.dtypes == empty.dtypes
