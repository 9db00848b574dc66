"""A host's template goes whatever the number of the host's other pages."""

from __future__ import annotations

import pytest

from strata.llm import templates

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
@pytest.mark.parametrize("others", [0, 400])
def test_a_template_goes_from_a_small_and_a_large_host(spark, others, broadcast_rows):
    rows = [(i, f"http://h.example/{i}", f"<body><div>section menu</div><p>text {i}") for i in range(5)]
    rows += [(10 + i, f"http://h.example/four/{i}", f"<body><div>on four pages</div><p>four {i}") for i in range(4)]
    rows += [(100 + i, f"http://h.example/o/{i}", f"<body><p>other {i}") for i in range(others)]
    got = {r["page_id"]: r["text"] for r in templates.extract(spark.createDataFrame(rows, SCHEMA), broadcast_rows=broadcast_rows).collect()}
    assert [got[i] for i in range(5)] == [f"text {i}" for i in range(5)]
    assert [got[10 + i] for i in range(4)] == [f"on four pages\n\nfour {i}" for i in range(4)]
    assert all(got[100 + i] == f"other {i}" for i in range(others))
