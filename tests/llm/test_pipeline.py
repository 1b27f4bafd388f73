"""The pipeline's rows against a plain run of the same stages."""

import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from llm import brute
from tokenizers import Tokenizer

from vocalis.llm import catalog
from vocalis.llm.oracle import ORACLE


def _sql(name, documents, benchmark):
    duck = duckdb.connect()
    duck.register("documents", documents)
    duck.register("benchmark", benchmark)
    return duck.execute(ORACLE[name]).df()


def test_pipeline_rows(spark, sf_dir, documents):
    docs, benchmark = documents.toPandas(), spark.read.parquet(f"{sf_dir}/benchmark.parquet").toPandas()
    kept = _sql("op7_quality_rules", docs, benchmark).set_index("doc_id").kept
    docs = docs[docs.doc_id.map(kept)]
    lowest = {d: c for d, (_, c) in brute.groups(list(zip(docs.doc_id, docs.text))).items()}
    docs = docs[docs.doc_id.map(lowest) == docs.doc_id]
    bad = _sql("op2_benchmark_decontamination", docs, benchmark).set_index("doc_id").contaminated
    docs = docs[~docs.doc_id.map(bad)]
    mix = _sql("op8_source_mix", docs, benchmark).set_index("doc_id")
    tokenizer, expected, start = Tokenizer.from_file(public_tokenizers.path(catalog.WRITTEN_WITH)), [], 0
    for key, text in sorted(zip(docs.doc_id, docs.text)):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for _ in range(int(mix.taken[key] // mix["size"][key])):
            expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(expected)


def test_stages_keep_the_columns(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns, name
