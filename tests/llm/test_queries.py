"""Queries against their SQL, the pipeline against plain versions of its stages, and the import guard."""

import subprocess
import sys

import numpy as np
import pytest
from compare import connect, difference, duck_result, plan_of, spark_result
from test_decontaminate import plain as plain_decontaminate
from test_lines import plain as plain_lines
from test_simhash import plain_components, plain_print

from tidemark.llm import packing
from tidemark.llm.queries import tokenizer_path  # noqa: F401  (registers the queries)
from tidemark.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = spark_result(df)
    if name in ORACLES:
        assert difference(got, duck_result(connect(sf_dir), ORACLES[name])) is None
    else:
        assert got[1]


def test_pipeline_equals_plain_stages(spark, sf_dir):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    kept = [(r.doc_id, r.text) for r in stages["language_id"](spark, docs, sf_dir).collect()]
    assert len(kept) >= 0.99 * docs.count()
    kept = [(d, t) for d, t, _, _ in plain_lines(kept)]
    groups = plain_components([d for d, _ in kept], [plain_print(t) for _, t in kept])
    kept = [(d, t) for (d, t), g in zip(kept, groups, strict=True) if d == g]
    clean = {r[0] for r in plain_decontaminate(kept, items) if not r[5]}
    kept = [(d, t) for d, t in kept if d in clean]
    out = corpus_pipeline.run(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.tokenizer_path(packing.TOKENIZER))
    lengths = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths
    assert len({r.sequence_id for r in out}) <= packing.lower_bound(np.array([r.length for r in out]), packing.SEQUENCE) + 1


def test_stages_keep_the_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, empty, sf_dir).count() == 0


def test_the_rest_does_not_need_this_package():
    code = "import sys; sys.modules['tidemark.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], check=True)
