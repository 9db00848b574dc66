"""The near-duplicate stage finds links that lie outside the first block of every group."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import bagminhash
from tests.llm.test_bagminhash_blocks import family, table


def test_the_pipeline_stage_drops_what_only_a_later_block_links(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", 1)
    kept = corpus_pipeline.near_duplicates(spark, table(spark, family(3)), "unused").collect()
    assert sorted(r["doc_id"] for r in kept) == list(range(1, 41)) + [100]
