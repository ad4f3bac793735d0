"""The pipeline against a brute-force version, and what each stage keeps."""

import re

import public_tokenizers

import corpus_pipeline
from stratamart.llm import bitplanes, mixing, quality_rules, templates
from stratamart.llm.common import table
from stratamart.llm.word_ids import WordIds

from .test_similar import brute_force

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_their_decisions_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "source_mix", "token_ids"]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen, FOLDER)
        if name != "token_ids":
            assert out.columns == docs.columns
        ids = sorted(r["doc_id"] for r in out.collect())
        if name == "quality_rules":
            assert ids == sorted(r["doc_id"] for r in quality_rules.op3(seen).filter("kept").collect())
        elif name == "near_duplicates":
            assert ids == brute_force({r["doc_id"]: r["text"] for r in seen.collect()})
        elif name == "decontamination":
            leaked = {r["doc_id"] for r in templates.op2(seen, table(spark, FOLDER, "benchmark")).collect()}
            assert ids == sorted({r["doc_id"] for r in seen.collect()} - leaked)
        elif name == "source_mix":
            taken = {r["doc_id"]: r["taken"] for r in mixing.op10(seen).collect()}
            words = {}
            for r in out.collect():
                words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
            assert words == {k: v for k, v in taken.items() if v}
        else:
            tokenizer = WordIds(public_tokenizers.path(bitplanes.VOCABULARY)).tokenizer
            want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in seen.collect())
            assert sorted((r["doc_id"], r["n_tokens"]) for r in out.collect()) == want
        seen = spark.createDataFrame(out.collect(), out.schema)


def test_run_gives_the_rows_of_the_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    rows.sort(key=lambda r: r["start"])
    assert rows and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    again = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_empty_documents_pass_through(spark, tmp_path):
    for name in ("documents", "benchmark"):
        table(spark, FOLDER, name).filter("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
