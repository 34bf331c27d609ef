"""The corpus pipeline: its stages against their own rules, on the smallest tables."""

import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from statmart.llm.shared import stored, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, docs, SF), name)
        assert kept.columns == columns
        assert kept.count() <= docs.count()
        assert kept.join(docs, "doc_id", "left_anti").isEmpty()
        docs = kept
    out = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()}
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(rows) == len(out) > 0
    for r in rows:
        want = library.encode(r.text, add_special_tokens=False).ids
        assert bytes(out[r.doc_id]["ids"]) == b"".join(i.to_bytes(4, "little") for i in want)


def test_stages_keep_odd_rows(spark):
    """Nulls, empty texts, repeated rows and columns named like an operator's outputs."""
    docs = table(spark, SF, "documents")
    names = ["score", "predicted", "spans", "n_shingles", "component_id", "kept", "n_bytes", "n_removed", "contaminated", "items"]
    odd = spark.createDataFrame(
        [(None, None), (None, "of a null id"), (900_001, None), (900_002, ""), (900_003, "one"), (900_003, "one"), (900_004, " \n ")], "doc_id long, text string"
    )
    odd = odd.select("doc_id", "text", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns if c not in ("doc_id", "text")])
    rows = docs.select(*odd.columns).unionByName(odd).withColumns({n: F.lit(f"own {n}") for n in names}).repartition(3)
    key = lambda r: (str(r.doc_id), str(r.text))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stored(stage(spark, rows, SF), name)
        assert kept.columns == rows.columns, name
        left = [r for r in kept.collect() if r.doc_id is None or r.doc_id > 900_000]
        assert sorted(map(key, left)) == sorted(key(r) for r in odd.collect()), name
        assert all(r[n] == f"own {n}" for r in left for n in names), name
        assert stage(spark, rows.limit(0), SF).count() == 0, name
        rows = kept
    assert corpus_pipeline.STAGES[-1][1](spark, rows.limit(0), SF).count() == 0
