"""The pipeline's stages on one small corpus, each on what the one before kept, and the registered queries."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import mixing
from corpusloom.llm.queries import ORACLE, QUERIES
from corpusloom.session import land
from tests.llm.test_data_operators import poisson_copies
from tests.llm.test_text_operators import brute_components
from tests.oracle import connect, difference

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_plain_loops(name, before, after):
    """What a stage has to keep of the rows before it, where loops can say it."""
    if name.startswith("MinHash"):
        root = brute_components([(r.doc_id, r.text) for r in before], 5)
        assert sorted(r.doc_id for r in after) == sorted({i for i in root if root[i] == i})
    if name.startswith("mixing"):
        volumes = Counter()
        for r in before:
            volumes[r.source] += len(r.text.encode())
        wanted = sum(volumes.values()) / len(volumes)
        copies = {r.doc_id: poisson_copies(wanted / volumes[r.source], f"{mixing.SEED}:{r.doc_id}") for r in before}
        assert Counter(r.doc_id for r in after) == Counter({i: n for i, n in copies.items() if n})
    if name.startswith("token"):
        encoder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        encoder.encode_special_tokens = True
        ids = [(r.doc_id, [*encoder.encode(r.text, add_special_tokens=False).ids, 0]) for r in before]
        want = sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
        assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in after) == want


def test_stages_take_effect(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    counts, kept = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, kept, sf_small)
        assert kept.columns == COLUMNS, name
        path = corpus_pipeline.scratch_dir(spark, "stage")
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        counts.append(kept.count())
        by_plain_loops(name, before.collect(), kept.collect())
        if name.startswith("MinHash"):
            assert kept.select("doc_id").distinct().count() == counts[-1]
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_small).collect()
    by_plain_loops("token", kept.collect(), last)
    assert len(last) == counts[-1] and sorted(r.doc_id for r in last) == sorted(r.doc_id for r in kept.collect())
    ordered = sorted(last, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_small).collect()} == {r.doc_id for r in last}


def test_stages_take_awkward_rows(spark, sf_small):
    """NULLs everywhere, empty and very long texts, repeated rows, a clashing column, and no rows at all."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "some words without an id stand here", "en", None, 1)]
    rows += [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n", None, "a", 3), (4, long, "en", "b", 5), (5, long, "en", "b", 5), (6, "few words", "de", "c", 9)]
    rows += [rows[-1], rows[-1]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _copies string"
    for table in ([(*r, "x") for r in rows], []):
        kept = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, sf_small)
            assert kept.columns == [c.split()[0] for c in schema.split(", ")], name
            kept = land(kept, "awkward")
        last = corpus_pipeline.STAGES[-1][1](spark, kept, sf_small).collect()
        assert len(last) == kept.count()
        assert not (table and {r.doc_id for r in last} >= {4, 5})


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs_and_equals_its_sql(spark, sf_small, name):
    rows = QUERIES[name](spark, sf_small).toPandas()
    assert len(rows)
    if name in ORACLE:
        assert difference(rows, connect(sf_small).sql(ORACLE[name]).df()) is None
