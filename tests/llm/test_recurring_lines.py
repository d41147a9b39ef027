"""Recurring lines go, however short they are and however much is copied or shared."""

import pytest

import corpus_pipeline
from lumenreel.llm import line_templates


def word(i, salt):
    return "".join(chr(97 + (i // 26**k + salt) % 26) for k in range(4))


def cleaned(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = ({r["doc_id"]: r["kept"] for r in line_templates.drop_recurring(df, broadcast=n, **more).collect()} for n in (1 << 20, -1))
    assert a == b
    return a


def test_short_lines(spark):
    rows = [(i, f"Les.\n{i}\nown {word(i, 1)} words {word(i, 2)} here\nAll rights reserved.") for i in range(30)]
    assert cleaned(spark, rows) == {i: f"{i}\nown {word(i, 1)} words {word(i, 2)} here" for i in range(30)}


def test_a_line_of_a_text_copied_often(spark):
    line = "this line stands in many other texts too"
    rows = [(i, f"own {word(i, 1)} words {word(i, 2)}\n{line}") for i in range(20)] + [(1000 + i, f"the copied text begins so\n{line}") for i in range(600)]
    kept = cleaned(spark, rows)
    assert all(line not in t for t in kept.values()) and kept[1000] == "the copied text begins so"


def test_a_block_of_shared_lines(spark):
    """Of a third of each text; where it is nearly all of them, they are near copies."""
    block = "\n".join(f"shared line {word(k, 3)} of the block" for k in range(20))
    own = lambda i: "\n".join(" ".join(word(i * 50 + k * 5 + z, z) for z in range(5)) for k in range(6))
    rows = [(i, f"{own(i)}\n{block[: block.index(word(10, 3))]}") for i in range(100)]
    kept = cleaned(spark, rows)
    assert all("of the block" not in t and t.startswith(own(i)) for i, t in kept.items())
    rows = [(i, f"own {word(i, 1)} words {word(i, 2)}\n{block}") for i in range(100)]
    assert cleaned(spark, rows) == dict(rows)


@pytest.mark.parametrize("lines, copies", [(9, 12), (31, 12), (9, 400)])
def test_near_copies_are_not_erased(spark, lines, copies):
    """Copies that differ in a word each keep all their lines, next to pages that share a footer."""
    body = ["".join(f"{word(40 * k + z, 2)} " for z in range(12)).strip() for k in range(lines)]
    rows = []
    for i in range(copies):
        mine = list(body)
        ws = mine[i % lines].split(" ")
        ws[i % 12] = f"other{word(i, 5)}"
        mine[i % lines] = " ".join(ws)
        rows.append((i, "\n".join([*mine, "all rights reserved by the owner of this page"])))
    pages = [(1000 + i, " ".join(word(90 * i + z, 3) for z in range(40)) + "\nall rights reserved by the owner of this page") for i in range(30)]
    kept = cleaned(spark, rows + pages)
    footer = "\nall rights reserved by the owner of this page"
    assert all(kept[i] == t.removesuffix(footer) for i, t in rows + pages)


def test_fields_anywhere(spark):
    """Two fields apart, one at the very start, and one alone."""
    body = lambda i, s: "\n".join(" ".join(word(3000 * s + 60 * i + 20 * k + z, s + z) for z in range(14)) for k in range(3))
    kinds = ["Posted by {} in the daily news on {} by our desk", "{} wrote this post in the daily news section of today", "Posted by {} in the local section of the news"]
    rows = [(100 * s + i, body(i, s) + "\n" + k.format(f"a{word(i, 7)}", f"b{word(3 * i, 9)}")) for s, k in enumerate(kinds) for i in range(60)]
    kept = cleaned(spark, rows)
    assert all(kept[100 * s + i] == body(i, s) for s in range(3) for i in range(60))


def test_the_pipeline_keeps_one_of_near_copies(spark):
    """Line dedup leaves a family of near copies its lines, near-dedup then keeps one of them."""
    body = ["".join(f"{word(40 * k + z, 2)} " for z in range(12)).strip() for k in range(9)]
    rows = []
    for i in range(12):
        mine = list(body)
        mine[i % 9] = mine[i % 9].replace(mine[i % 9].split(" ")[3], f"other{word(i, 5)}")
        rows.append((i, "\n".join(mine), "en", "s", None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.drop_lines(spark, df, ""), "").collect()
    assert [(r["doc_id"], r["text"]) for r in kept] == [(0, rows[0][1])]
