import hashlib
import time

from pyspark.sql import functions as F

from panelspark.llm import chat, line_dedup
from panelspark.llm import queries
from tests.llm import edge

SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(FOLD)


def brute_common(rows, least):
    found = {}
    for n, (i, t, *_) in enumerate(rows):
        for x in (t or "").split("\n"):
            if key(x):
                found.setdefault(key(x), set()).add(i if i is not None else f"row{n}")
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(found.get(key(x), ())) < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_common_lines_against_brute_force(spark):
    for least in (2, 3, 10):
        got = line_dedup.drop_common_lines(edge.docs(spark), least).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=str) == brute_common(edge.ROWS, least)


def test_rows_without_id_are_documents(spark):
    rows = [(None, "\n".join(["same"] * 10)), (1, "same")] + [(None, "often\noften")] * 3 + [(None, "often")] * 2 + [(5, "often")] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (2, 3, 6, 7, 10):
        got = line_dedup.drop_common_lines(df, least).collect()
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=str) == brute_common(rows, least)


def test_first_lines(spark):
    rows = [(2, "b\na"), (1, "a\nA \nb\n\nc"), (3, "c\n\nd\nd")]
    got = {r.doc_id: r.text for r in line_dedup.keep_first_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "a\nb\n\nc", 2: "", 3: "\nd"}


def test_bitmap_round_trip(spark):
    text = "\n".join(["x", "dup", "dup", "y", "dup", "z", "dup"])
    df = spark.createDataFrame([(1, text), (2, "dup"), (3, "dup")], "doc_id long, text string")
    maps = line_dedup.line_keep_bitmaps(df, min_docs=3)
    turns = {r._doc: r.turns for r in maps.withColumn("turns", line_dedup.turns_of(F.col("bitmap"))).collect()}
    assert turns == {1: [1, 3, 4, 5, 6, 7], 2: [0, 1], 3: [0, 1]}
    assert {r.doc_id: r.text for r in line_dedup.apply_bitmaps(df, maps).collect()} == {1: "x\ny\nz", 2: "", 3: ""}


def test_many_turns_in_a_long_document(spark):
    rows = [(i, "\n".join(x for n in range(30_000) for x in (f"own {i} {n}", f"shared {n}"))) for i in range(2)]
    got = line_dedup.drop_common_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert all(r.n_dropped == 30_000 and r.text == "\n".join(f"own {r.doc_id} {n}" for n in range(30_000)) for r in got)


def test_empty_tables_and_hot_line(spark):
    assert line_dedup.drop_common_lines(edge.empty(spark), 10).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot line\nown "), F.col("id").cast("string")).alias("text"))
    got = line_dedup.drop_common_lines(hot, 10)
    assert got.filter("n_dropped = 1 AND text LIKE 'own %'").count() == 3000


ROLES = [
    (1, 0, "user", "Hi ### User: there"),
    (1, 1, "assistant", "a\\</turn>\\\\### Assistant: b\n</turn>\n"),
    (1, 2, "user", None),
    (2, 0, "assistant", "first"),
    (3, 0, "system", "s"),
    (3, 1, "user", "#### User: #"),
    (3, 1, "user", "#### User: #"),
    (4, None, None, None),
    (None, 0, "User", "capital\nrole"),
    (None, 1, "a\n%:\n%0A", "odd role </turn"),
    (5, 0, "user", "x" * 200_000 + "</turn>"),
    (5, 1, "assistant", "\\" * 7 + "</turn>" + "\\"),
]


def test_chat_round_trip(spark):
    df = spark.createDataFrame(ROLES, "conv_id long, turn long, role string, text string").withColumns({"segments": F.lit(1), "_conv": F.lit(2), "raw": F.lit(3)})
    got = chat.format_chat(df).select("conv_id", "valid", "error_turn", "segments", "formatted", chat.read_chat(F.col("formatted")).alias("turns")).collect()
    want = {}
    for c, n, r, t in sorted(ROLES, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        want.setdefault(c, []).append((r if r is not None else "null", t or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == want
    assert all("".join(s.text for s in r.segments) == r.formatted for r in got)
    by = {r.conv_id: r for r in got}
    assert by[1].valid and by[5].valid and not by[2].valid and by[2].error_turn == 0 and by[3].error_turn == 2
    for c, turns in want.items():
        loss = spark.createDataFrame([("".join(s.text for s in by[c].segments if s.loss),)], "x string").select(chat.unescaped(F.col("x"), chat.Template()).alias("x")).first().x
        assert loss == "".join(t for r, t in turns if r == "assistant")


def test_runs_of_marks_take_linear_time(spark):
    texts = ["\\" * 100_000, "\\" * 100_001 + "</turn>", ("\\" * 1000 + "### User:") * 100, "\\### User:\\\\</turn>\\"]
    df = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    began = time.time()
    got = {r.conv_id: r.t[0].text for r in chat.format_chat(df).select("conv_id", chat.read_chat(F.col("formatted")).alias("t")).collect()}
    assert got == dict(enumerate(texts)) and time.time() - began < 20


def test_chat_empty(spark):
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_no_python_in_native_plans(spark):
    plans = [
        line_dedup.drop_common_lines(edge.docs(spark), 10)._jdf.queryExecution().executedPlan().toString(),
        chat.format_chat(spark.createDataFrame(ROLES, "conv_id long, turn long, role string, text string"))._jdf.queryExecution().executedPlan().toString(),
    ]
    assert not any(w in p for p in plans for w in ("Python", "Pandas", "Arrow"))


def test_digest_of_kept_lines(spark):
    got = line_dedup.drop_common_lines(edge.docs(spark, clash=False), 10).select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h")).filter("doc_id = 8").first().h
    assert got == hashlib.sha256(edge.ROWS[7][1].encode()).hexdigest()


def test_the_machine_is_in_the_query_s_plan(spark, sf):
    plan = queries.op3_chat_format(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "refused" in plan and "answered" in plan
    got = queries.op3_chat_format(spark, sf)
    assert {"valid", "error_turn"} <= set(got.columns) and got.filter("valid = (error_turn IS NOT NULL)").count() == 0
