"""The pipeline against its stages done by hand, one after the other."""

import corpus_pipeline
from tokenizers import Tokenizer

from strataflow.llm.queries import QUERIES, tokenizer_path
from test_decontaminate import _brute as leaked
from test_setjoin import _brute as alike

SF = "/root/testdata/sf0.01"


def test_stages_are_named_and_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert first.schema == docs.schema


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rejected = {r.doc_id for r in QUERIES["op7_weak_label_quality"](spark, SF).where("rejected").collect()}
    docs = {i: t for i, t in docs.items() if i not in rejected}
    docs = {i: docs[i] for i, _, c in alike(list(docs.items()), 5, 80, 100) if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {i: t for i, t in docs.items() if not leaked(t, items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(docs)
    library = Tokenizer.from_file(tokenizer_path())
    marked = 0
    for i, r in got.items():
        expected = library.decode(library.encode(docs[i], add_special_tokens=False).ids, skip_special_tokens=False)
        if "secret</w>" in r.decoded and r.decoded != expected:
            marked += 1
            continue
        assert r.decoded == expected
    assert 0 < marked < len(got) / 4


def test_cases(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "this plain sentence holds eight ordinary words inside", "en", "a", 1), (2, "this plain sentence holds eight ordinary words inside", "en", "a", 1), (3, "this plain sentence holds eight ordinary words inside", None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for limit, expected in ((len(rows), [0, 1, 2]), (0, [])):
        docs = df.limit(limit)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert sorted(r.doc_id or 0 for r in docs.collect()) == expected


def test_stages_hold_arrow_batches_small_and_keep_smaller_ones(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.createDataFrame([(1, "a b c", "en", "web")], "doc_id long, text string, lang string, source string")
    before = spark.conf.get(name)
    try:
        for given, then in (("10000", "1000"), ("0", "1000"), ("1500", "1000"), ("300", "300")):
            spark.conf.set(name, given)
            corpus_pipeline.secret_scans(spark, docs, "")
            assert spark.conf.get(name) == then
    finally:
        spark.conf.set(name, before)
