"""The pipeline on a small folder, stage by stage against plain Python."""

import public_tokenizers
import sentencepiece

import corpus_pipeline

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, kept string, carried int, row long"
PROSE = ("the quick brown fox jumps over a lazy dog while seven tall sailors count the slow grey waves that roll into the old "
         "harbour before dawn and nobody on the quay says a single word about the storm")
OTHER = ("several engineers measured the pressure inside the long copper pipe and wrote every figure into a small blue book which the "
         "youngest of them carried home through heavy rain without losing one page")
ITEM = "which river crosses the border twice and still reaches the same northern sea after eleven hundred miles of empty plain"


def folder_of(spark, folder, rows):
    spark.createDataFrame([(i, "s", "en", len(t) if t is not None else None, t, "k", 1, 2) for i, t in rows], SCHEMA).write.parquet(
        folder + "/documents.parquet")
    spark.createDataFrame([(0, ITEM), (1, None)], "item_id long, text string").write.parquet(folder + "/benchmark.parquet")


def test_stages(spark, folder):
    three = "alpha line of the passage\nbeta line of the passage\ngamma line of the passage"
    rows = [(5, PROSE), (3, PROSE), (4, PROSE + " today"), (8, OTHER + "\n" + three), (9, three + "\n" + PROSE[::-1]), (10, OTHER + " " + ITEM.upper() + "!"),
            (11, "too short"), (12, None), (12, None), (13, ""), (None, OTHER[::-1]), (14, "word " * 5000)]
    folder_of(spark, folder, rows)
    docs = spark.read.parquet(folder + "/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder))
        steps.append({r["doc_id"]: r for r in docs.collect()})
        if name != "sentencepiece":
            assert docs.columns == ["doc_id", "source", "lang", "n_chars", "text", "kept", "carried", "row"]
            assert all(r["n_chars"] == len(r["text"]) and (r["kept"], r["carried"], r["row"]) == ("k", 1, 2) for r in steps[-1].values())
    quality, lines, near, clean, coded = steps
    assert set(quality) == {3, 4, 5, 8, 9, 10, None} and quality[8]["text"] == OTHER + "\n" + three
    assert set(lines) == set(quality) and lines[9]["text"] == PROSE[::-1] and lines[8]["text"] == OTHER + "\n" + three
    assert set(near) == {3, 8, 9, 10, None}
    assert set(clean) == {3, 8, 9, None}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {k: list(r["ids"]) for k, r in coded.items()} == {k: library.encode(r["text"], add_eos=True) for k, r in clean.items()}


def test_run_on_an_empty_table(spark, folder):
    folder_of(spark, folder, [])
    assert corpus_pipeline.run(spark, folder).count() == 0
