"""Each stage of the pipeline on its own input, against brute force or its own rules, and the whole run."""

from __future__ import annotations

import importlib.util
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm import bagminhash, decontam, line_dedup
from tests.conftest import SF_SMALL

NAMES = ["quality", "lines", "near_duplicates", "decontamination", "mixing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, as lists of rows."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF_SMALL)
        after.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def rows(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select("doc_id", "text").collect())


def test_stages_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    columns = spark.read.parquet(f"{SF_SMALL}/documents.parquet").columns
    assert all(stages[name][1].columns == columns for name in NAMES[:-1])
    assert set(columns) < set(stages["mixing"][1].columns)
    for name in ("lines", "decontamination"):
        assert all(r["n_chars"] == len(r["text"]) for r in stages[name][1].collect())


def test_quality_rejects_labelled_bad_and_keeps_labelled_good_documents(spark, stages):
    before, after = stages["quality"]
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {d for d, _ in rows(after)}
    assert set(rows(after)) <= set(rows(before))
    good = [d for d, _ in rows(before) if labels.get(d) == (1, 0)]
    bad = [d for d, _ in rows(before) if labels.get(d, (1, 0))[0] == 0]
    assert sum(d in kept for d in good) > 0.95 * len(good)
    assert sum(d in kept for d in bad) < 0.2 * len(bad)


def test_lines_found_in_ten_documents_stay_once(stages):
    before, after = stages["lines"]
    documents, seen = Counter(), set()
    for _, text in rows(before):
        documents.update({k for k in line_dedup.line_keys(text.encode()) if k})
    expected = []
    for doc_id, text in rows(before):
        lines = []
        for line, key in zip(text.split("\n"), line_dedup.line_keys(text.encode()), strict=True):
            if documents[key] < 10 or key not in seen:
                lines.append(line)
            if documents[key] >= 10:
                seen.add(key)
        expected.append((doc_id, "\n".join(lines)))
    assert rows(after) == sorted(expected)


def test_one_document_of_each_near_duplicate_class_stays(stages):
    spec = importlib.util.spec_from_file_location("near", f"{__file__.rpartition('/')[0]}/test_bagminhash.py")
    near = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(near)
    before, after = stages["near_duplicates"]
    classes = near.brute(rows(before))
    assert rows(after) == [r for r in rows(before) if classes[r[0]] == r[0]]
    assert bagminhash.keep_one_per_class(after).count() == after.count()


def test_decontamination_cuts_items_and_leaves_other_documents_alone(spark, stages):
    before, after = stages["decontamination"]
    items = [(str(r["item_id"]), decontam.words(r["text"].encode())) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    automaton = decontam.SuffixAutomaton(10).build(items)
    kept = dict(rows(after))
    for doc_id, text in rows(before):
        runs, _ = automaton.scan(decontam.words(text.encode()))
        words = len(decontam.words(text.encode()))
        covered = sum(e - s for s, e in runs)
        if covered > 0.5 * words:
            assert doc_id not in kept
        else:
            assert kept[doc_id] == (decontam.cut_runs(text, runs) if runs else text)


def test_mixing_emits_whole_copies(stages):
    before, after = stages["mixing"]
    copies = Counter(d for d, _ in rows(after))
    expected = {r["doc_id"]: r["copies"] for r in after.collect()}
    assert copies == expected and max(copies.values()) <= 3
    assert set(rows(after)) <= set(rows(before))
    numbers = Counter((r["doc_id"], r["copy"]) for r in after.collect())
    assert set(numbers.values()) == {1}


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages["mixing"][1].select(got.columns).collect()))


def test_stages_take_nulls_repeats_and_empty_tables(spark, tmp_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, copy long, starts string, weight double"
    odd = [(1, None, None, None, None, 1, "x", 0.0), (2, "", "en", "a", 0, 1, "x", 0.0), (None, "no id at all here", "en", "a", 17, 1, "x", 0.0)]
    odd += [(3, "word " * 60_000, "en", "b", 300_000, 1, "x", 0.0)] + [(4, "said twice", "en", "b", 10, 1, "x", 0.0)] * 2
    for n, table in enumerate((odd, [])):
        folder = f"{tmp_dir}/{n}"
        spark.createDataFrame(table, schema).write.parquet(f"{folder}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(100 * (1 - n)).write.parquet(f"{folder}/{name}.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert {"doc_id", "text", "copies", "copy"} <= set(got.columns)
        ids = {r["doc_id"] for r in got.collect()}
        assert ids <= {1, 2, 3, 4, None} and (n == 0 or not ids)
