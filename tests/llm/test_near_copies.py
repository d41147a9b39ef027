"""One document of each class stays, whatever the ids."""

import corpus_pipeline


def test_ids_that_repeat_or_are_null(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (1, text("c") + " more"), (2, text("d")), (2, text("e")), (3, text("f")), (3, text("f")), (4, text("f")), (5, ""), (5, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, df, "").collect()
    assert df.columns == list(kept[0].asDict())
    want = [rows[k] for k in (0, 1, 3, 4, 5, 6, 9, 10)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)
