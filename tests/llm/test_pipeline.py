from __future__ import annotations

import corpus_pipeline
import llm_helpers as H
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, pii_tagger, queries


def test_stages_do_what_they_say(spark, tmp_path):
    item = H.prose(900, 40)
    clean = [(k, H.prose(k, 60)) for k in range(10, 40)]
    rows = clean + [
        (1, "too short"), (2, "a b c d e " * 30), (3, None), (50, clean[0][1]), (51, clean[0][1] + " more"), (60, f"{H.prose(60, 30)} {item}"),
        (70, f"{H.prose(70, 30)} abc.12@mail1.example.com {H.prose(71, 9)}"), (70, f"{H.prose(70, 30)} abc.12@mail1.example.com {H.prose(71, 9)}"),
    ]
    H.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {k for k, _ in clean} | {70}
    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    assert all(got[k].ids == library.encode(t, add_special_tokens=False).ids for k, t in clean)
    redacted = pii_tagger.redacted(rows[-1][1], pii_tagger.pattern_spans(rows[-1][1]))
    assert "<EMAIL>" in redacted and got[70].ids == library.encode(redacted, add_special_tokens=False).ids
    assert bpe.encoded is not None and [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "bpe"]


def test_runs_twice_in_one_session_and_on_empty_tables(spark, tmp_path):
    rows = [(k, H.prose(k, 40)) for k in range(20)] + [(30, None)]
    H.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    first, second = (sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) for _ in range(2))
    assert first == second and [k for k, _ in first] == list(range(20))
    empty = tmp_path / "empty"
    H.documents(spark, []).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(empty / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in queries.queries()) == list(range(1, 14))
