"""The pipeline's stages, each on what the one before kept."""

import collections

import public_tokenizers
import pytest

import corpus_pipeline
from eventloom.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    from eventloom.llm.common import stored

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], "/root/testdata/sf0.001")))
    return out


def test_stages_return_documents(kept):
    assert all(d.columns == COLUMNS for d in kept[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "mixing", "packing"]


def test_clean_documents_stay(kept):
    before, after = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in kept[:2])
    assert len(before - after) <= 1


def test_copies_go(kept):
    rows = kept[1].collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        first.setdefault(" ".join(r["text"].split()).lower(), r["doc_id"])
    left = {r["doc_id"] for r in kept[2].collect()}
    assert left <= set(first.values()) and len(left) > 0.9 * len(first)


def test_repeated_passages_go(kept):
    seen, found = {}, 0
    for r in sorted(kept[3].collect(), key=lambda r: r["doc_id"]):
        words = r["text"].split()
        for i in range(len(words) - 60):
            found += seen.setdefault(tuple(words[i : i + 60]), r["doc_id"]) != r["doc_id"]
    assert found == 0


def test_mix_and_packing(kept):
    copies = collections.Counter(r["doc_id"] for r in kept[4].select("doc_id").collect())
    assert max(copies.values()) <= 2 and set(copies) <= {r["doc_id"] for r in kept[3].collect()}
    packed = collections.Counter(r["doc_id"] for r in kept[5].filter("start = 0").collect())
    assert packed == copies
    lengths = collections.Counter()
    for r in kept[5].collect():
        lengths[r["sequence_id"]] += r["length"]
    assert max(lengths.values()) <= 4096


def test_run_is_the_stages_and_leaves_no_tables_of_theirs(spark, kept):
    from pathlib import Path

    from eventloom.llm import common

    place = Path(common.shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in place.glob("table-*")}
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = lambda d: sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in d.collect())
    assert rows(found) == rows(kept[5])
    # what is left: the results of four stages and the tables that the last one still reads
    assert len({p.name for p in place.glob("table-*")} - before) <= 4 + 2


def test_empty_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_queries_are_registered(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert public_tokenizers.path("word_bpe_49k.json")
