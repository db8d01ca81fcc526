import numpy as np
from brute import near, repeated
from conftest import SF001
from pyspark.sql import functions as F

import corpus_pipeline
from songemo.llm import mixing
from songemo.llm.base import stored, table, vocabulary


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_equal_brute_force(spark):
    from tokenizers import Tokenizer
    docs = table(spark, SF001, "documents")
    inputs, names = [docs], [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeats", "mixing", "bpe"]
    for _, f in corpus_pipeline.STAGES:
        inputs.append(f(spark, inputs[-1], SF001).persist())
    for x in inputs[1:-1]:
        assert x.columns == docs.columns and x.dtypes == docs.dtypes
    a, b, c, d, e = map(rows, inputs[1:])
    assert 0 < len(a) <= docs.count()
    comp, _ = near([(i, r.text) for i, r in a.items()], 5, 80)
    assert set(b) == {i for i, k in comp.items() if i == k} and len(b) < len(a)
    want = {i: bytes(x for x, f in zip(data, flag) if not f).decode("utf-8", "ignore")
            for i, (data, flag) in zip(b, repeated([r.text for r in b.values()], 200))}
    assert {i: r.text for i, r in c.items()} == want and all(r.n_chars == len(r.text) for r in c.values())
    assert {i: tuple(r) for i, r in d.items()} == {i: tuple(r) for i, r in c.items()}
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    t.no_padding()
    t.no_truncation()
    assert {i: np.frombuffer(r.token_ids, "<u4").tolist() for i, r in e.items()} == {
        i: t.encode(r.text, add_special_tokens=False).ids for i, r in d.items()}
    whole = rows(corpus_pipeline.run(spark, SF001))
    assert {i: tuple(r) for i, r in whole.items()} == {i: tuple(r) for i, r in e.items()}
    for x in inputs[1:]:
        x.unpersist()


def test_odd_rows_pass_the_stages(spark, make_docs):
    texts = [(None, "no id at all"), (None, None), (1, ""), (2, None), (3, "same row"), (3, "same row"), (4, "é" * 400),
             (5, "x" + "é" * 400), (6, "A b c d e f g h")]
    docs = make_docs(texts).unionByName(make_docs([(6, "A b c d e f g h")], source=None)).withColumn("extra", F.lit(1))
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF001)
        assert out.columns == docs.columns
        kept = sorted(str(r.doc_id) for r in out.collect())
        if name == "near_duplicates":
            assert kept == sorted(str(x) for x in (None, None, 1, 2, 3, 4, 5, 6))
        else:
            assert len(kept) == 10
        assert f(spark, docs.limit(0), SF001).count() == 0


def test_result_holds_the_mixture(spark, make_docs, tmp_path, monkeypatch):
    """Sorting run()'s rows by position gives the schedule, also where several files of uneven size are reread."""
    docs = make_docs([(i, f"w{i} " * (1 + i % 97 + i // 8)) for i in range(600)])
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 420, "a").when(F.col("doc_id") < 560, "b"))
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    docs = table(spark, str(tmp_path), "documents")
    want = [r.doc_id for r in mixing.schedule(docs).orderBy("slot", "place").collect()]
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    files = []
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: files.append(stored(df, name)) or files[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
        flat = corpus_pipeline.encode(spark, mixing.mixed(docs), "").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files[0].inputFiles()) > 1
    for rows_ in got, flat:
        assert sorted(r.position for r in rows_) == list(range(600))
        assert [r.doc_id for r in sorted(rows_, key=lambda r: r.position)] == want


def test_clashing_columns_pass_the_stages(spark, make_docs):
    """Names that the operators use inside are kept as they are."""
    names = ["toxicity", "toxic_predicted", "mix_slot", "mix_place", "_id", "_node", "_spans", "_s_id", "position", "_file", "_at", "key", "rep"]
    docs = make_docs([(1, "a b c d e f"), (1, "g h i j k l"), (2, "a b c d e f"), (3, None)], extra=names)
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    for name, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF001)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept = out.collect()
        assert all(r[c] == f"{c}{r.doc_id}" for r in kept for c in names) and len(kept) >= 3
    out = corpus_pipeline.encode(spark, docs, SF001).collect()
    assert len(out) == 4 and sorted(r.position for r in out) == [0, 1, 2, 3]
