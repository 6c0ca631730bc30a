import hashlib
import re

from tests.llm.build import docs, rows

from orgtrail.llm import line_dedup

STAMP = "Page 12 of 30 seen by user7 at noon"


def test_templates_with_variable_fields_are_dropped_everywhere(spark):
    texts = [f"own line number{i} alpha{i}\nPage {i} of {i + 5} seen by user{i} at noon\nmore of {chr(97 + i)}" for i in range(4)]
    found = {r.doc_id: r for r in line_dedup.drop_recurring_lines(docs(spark, texts, extra="'x' as leaf")).collect()}
    for i, text in enumerate(texts):
        assert found[i].n_lines == 3
        assert "Page" not in found[i].text and f"more of {chr(97 + i)}" in found[i].text
        assert found[i].leaf == "x"
    assert {r.n_dropped for r in found.values()} == {2}  # its numbered first line is a template, too


def test_a_line_repeated_in_two_documents_only_stays(spark):
    texts = [f"a b c d e f\nlonely {w} words here stay" for w in ("one", "two")] + ["z y"] * 2
    found = line_dedup.line_report(docs(spark, texts))
    assert rows(found, "n_dropped") == [(0,)] * 4


def test_lines_of_another_kind_in_the_leaf_stay(spark):
    same = [f"w x y z one two three four five six {i}" for i in range(6)]
    other = ["w x y z uno dos tres cuatro cinco seis 7"]
    kept = rows(line_dedup.line_report(docs(spark, same + other)), "doc_id", "n_dropped")
    assert kept == [(i, 1) for i in range(6)] + [(6, 0)]


def test_hashes_nulls_empty_blank_and_no_rows(spark):
    texts = [None, "", "\n \n", "kept line of text", "kept line of text"]
    found = {r.doc_id: r for r in line_dedup.line_report(docs(spark, texts)).collect()}
    assert (found[0].n_lines, found[0].n_dropped, found[0].kept_chars, found[0].kept_sha256) == (0, 0, 0, None)
    for i in (1, 2, 3, 4):
        assert found[i].kept_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()
        assert found[i].n_dropped == 0
    frame = spark.createDataFrame([(None, STAMP), (1, STAMP), (1, STAMP), (2, None)], "doc_id long, text string")
    assert rows(line_dedup.line_report(frame), "n_dropped") == [(0,)] * 4  # two documents, one of them null
    assert line_dedup.line_report(frame.filter("false")).count() == 0


def test_long_text_with_many_lines(spark):
    texts = ["\n".join(f"line {'abcdefgh'[i % 8]} of many {i % 50} words" for i in range(3000))] * 3
    found = line_dedup.line_report(docs(spark, texts)).collect()
    assert all(r.n_lines == 3000 and r.n_dropped == 3000 for r in found)


def test_unlike_lines_with_the_same_first_words_stay(spark):
    unlike = [
        "En and the the in and the heer.",
        "En and the the for thor erlyonan was.",
        "En and the the of as ndst the.",
    ]
    numbers = [f"{i} {i + 7} {i * 3} {i * 5}" for i in range(3)]
    near = [f"En and the the in {w} a long line with a name" for w in ("red", "blue", "green")]
    report = line_dedup.line_report(docs(spark, unlike + numbers + near))
    assert rows(report, "doc_id", "n_dropped") == [(i, int(i > 5)) for i in range(9)]


def test_every_recurring_line_of_a_leaf_goes_not_only_the_commonest(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEEDS", 1)
    licence = ["this file is under the one licence and no other"] * 9
    footer = ["this file is under a second thing of another kind"] * 4
    third = [f"this file is under ten more words {w} they say" for w in ("uno", "dos", "tres")]
    lone = ["this file is under what stands here but once alone"]
    report = line_dedup.line_report(docs(spark, licence + footer + third + lone))
    assert rows(report, "doc_id", "n_dropped") == sorted(((i, int(i < 16)) for i in range(17)), key=repr)


def test_long_lines_go_from_two_documents_on(spark):
    passage = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    near = ["x " * 8 + passage + f" end{w}" for w in ("a", "b")]
    fifty = " ".join(["y"] + passage.split()[:49])
    texts = ["own\n" + passage, "other\n" + passage, *near, fifty, fifty, passage.replace("w", "v")]
    report = line_dedup.line_report(docs(spark, texts))
    assert rows(report, "doc_id", "n_dropped") == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 0), (5, 0), (6, 0)]


def test_tokens_and_forms_are_those_of_plain_python(spark):
    lines = ["a b", " a\t\tb1 ", "a\x0b \x0cc9d\r", "1", "<*> x<*> <*>y <*> 2", "é9 ü\u00a03 \u0663 z", "x  y   7z 8 9 q5", "-1- a1b2 c", "\u2028 4"]
    frame = spark.createDataFrame([(line,) for line in lines], "line string")
    spaced = line_dedup._spaced(line_dedup.F.col("line"))
    general = line_dedup._generalised(spaced)
    variable = line_dedup.F.regexp_count(general, line_dedup.F.lit(line_dedup.IS_VARIABLE))
    for r in frame.select("line", spaced.alias("spaced"), general.alias("general"), variable.alias("variable")).collect():
        tokens = re.findall(r"[^\x20\x09-\x0D]+", r.line)
        wanted = ["<*>" if re.search(r"[0-9]", t) else t for t in tokens]
        assert (r.spaced, r.general, r.variable) == (" ".join(tokens), " ".join(wanted), wanted.count("<*>"))


def test_lines_are_not_taken_apart_token_by_token(spark, capsys):
    """Arrays of tokens, worked on by functions of a token, took most of the time over long lines."""
    line_dedup.parsed_lines(docs(spark, ["a b c1"])).explain(True)
    plan = capsys.readouterr().out
    assert "regexp_count" not in plan and "regexp_extract" not in plan and "lambda" not in plan


def test_lines_of_other_leaves_are_cut_before_the_shuffle(spark):
    lines = line_dedup.parsed_lines(docs(spark, [f"one two three four {i}\nsame line in all of them" for i in range(9)]))
    often = line_dedup.rest(lines.filter("line like 'same%'").select("leaf").distinct(), "leaves")
    likely = line_dedup._likely(lines, often)
    assert rows(likely, "doc_id", "line") == [(i, "same line in all of them") for i in range(9)]
    joins = [x for x in likely._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    # The exact join is the upper one; below the bitmap's it would shuffle every line.
    assert len(joins) == 2 and "_chunk" not in joins[0] and "LeftSemi" in joins[1]


def test_blanks_and_variables_as_the_patterns_have_them(spark):
    texts = ["a\tb  c", "\x0b \x0c", " x", "p\rq", "d\u00a0e f", "k"]
    found = line_dedup.parsed_lines(docs(spark, texts))
    assert rows(found, "doc_id", "n") == [(0, 3), (2, 1), (3, 2), (4, 2), (5, 1)]
    general = spark.createDataFrame([("a <*> <*> b",), ("x<*> <*>y",), ("a b",), ("<*>",)], "t string")
    counted = general.select("t", line_dedup._variables(general["t"]).alias("n"))
    assert rows(counted, "t", "n") == [("<*>", 1), ("a <*> <*> b", 2), ("a b", 0), ("x<*> <*>y", 0)]
