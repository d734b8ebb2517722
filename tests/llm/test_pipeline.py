import sentencepiece
import public_tokenizers

import __spark_entry__ as E
import corpus_pipeline
from strata.llm import mixing, quality_crf, secret_scan
from test_forest_dedup import brute as brute_groups
from test_secret_scan import brute as brute_spans

LIB = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_stages_follow_the_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "secret redaction", "source mixing", "piece encoding"]
    assert E.queries()["pipeline"] is corpus_pipeline.run


def redacted(text):
    spans = sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in brute_spans(text)))
    out, at = "", 0
    for s, e in spans:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_run_matches_a_brute_force_version(spark, docs, texts, tmp_path):
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    field = quality_crf.DEFAULT_WEIGHTS, quality_crf.DEFAULT_TRANSITIONS
    good = [(i, t) for i, t in enumerate(texts) if quality_crf.judge_text(t, *field)[6]]
    assert 20 < len(good) < len(texts)
    lead = {i for i, (_, root) in brute_groups(good).items() if i == root}
    assert len(lead) < len(good)
    clean = {i: redacted(t) for i, t in good if i in lead}
    assert all(not secret_scan.scan_secrets(spark.createDataFrame(list(clean.items()), "doc_id long, text string")).where("n_random > 0").count() for _ in (1,))
    rows = spark.createDataFrame([(r["doc_id"], clean[r["doc_id"]], r["lang"], r["source"]) for r in docs.collect() if r["doc_id"] in clean],
                                 "doc_id long, text string, lang string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.choose(rows, mixing.MixConfig(budget_share=1.0)).collect()}
    want = sorted((i, tuple(LIB.encode(clean[i]))) for i, n in copies.items() for _ in range(n))
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want


def test_stages_keep_the_columns_and_bear_odd_tables(spark, odd_docs, no_docs, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for table in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            if name != "piece encoding":
                assert out.columns == table.columns
            assert out.count() <= 2 * table.count()
