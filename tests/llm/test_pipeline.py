"""The pipeline's stages, each against a brute-force version of its own input."""

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weekloom.llm import queries
from weekloom.session import stored

from .test_operators import AWKWARD, FOLDER, SCHEMA, brute_containment, brute_fingerprint, brute_groups, brute_removal

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark):
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(queries.vocabulary_file("word_bpe_49k.json"))
    docs = queries.table(spark, FOLDER, "documents")
    extra = [(10**6 + i, t, "en", "x", 0) for i, t in enumerate([None, "", "12 34", docs.first()["text"]])]
    docs = stored(docs.unionByName(spark.createDataFrame(extra, SCHEMA)), "docs")
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "substrings", "benchmark", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = stored(stage(spark, docs, FOLDER), name)
        after = rows_of(docs)
        if name != "tokens":
            assert docs.columns == COLUMNS
        if name == "language":
            assert set(after) == {d for d, r in before.items() if r["text"] and any(map(str.isalpha, r["text"]))}
        elif name == "near_duplicates":
            groups = brute_groups({d: brute_fingerprint(r["text"]) for d, r in before.items()})
            assert set(after) == set(groups.values()) and 10**6 + 3 not in after
        elif name == "substrings":
            want = brute_removal([(d, r["text"]) for d, r in before.items()], 20)
            assert set(after) == set(before) and any(n for _, n, _ in want.values())
            for d, r in after.items():
                assert r["text"] == (want[d][2] if want[d][1] else before[d]["text"])
                assert r["n_chars"] == (len(r["text"]) if want[d][1] else before[d]["n_chars"])
        elif name == "benchmark":
            dirty = {d for d, *_ in brute_containment([(d, r["text"]) for d, r in before.items()], items)}
            assert set(after) == set(before) - dirty
        if name in ("language", "near_duplicates", "benchmark"):
            assert all(after[d] == before[d] for d in after)
    for d, r in after.items():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert set(after) == {r["doc_id"] for r in queries.QUERIES["pipeline"](spark, FOLDER).collect()}


def test_language_stage_keeps_texts_when_nothing_can_be_learned(spark):
    docs = spark.createDataFrame([(d, t, None, s, n) for d, t, _, s, n in AWKWARD], SCHEMA)
    kept = corpus_pipeline.language(spark, docs, FOLDER)
    want = [str(r[0]) for r in AWKWARD if r[1] and any(map(str.isalpha, r[1]))]
    assert kept.columns == COLUMNS and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(want)


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_stages_of_awkward_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
    letters = {r[0]: r[1] for r in rows if r[1] and any(map(str.isalpha, r[1]))}
    groups = brute_groups({d: brute_fingerprint(t) for d, t in letters.items() if d is not None})
    want = {*groups.values(), *(d for d in letters if d is None)}
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in docs.collect())
