"""Columns of the input that bear an operator's own names change nothing."""

from contentflow.llm import decontamination, line_dedup, mixing

DOCS = "doc_id long, text string, source string, n_chars long"


def rows():
    out = [(i, f"line one {i}\nshared line of some length\n" + " ".join(f"w{i}x{k}" for k in range(20)), "ab"[i % 2], 5) for i in range(12)]
    return out + [(None, None, None, None), (3, "shared line of some length", "a", 1)]


def test_line_dedup(spark):
    plain = spark.createDataFrame(rows(), DOCS)
    odd = plain.selectExpr("*", "7 as _row", "'g' as _gone", "1 as row", "2 as node", "3 as line")
    assert sorted(map(str, line_dedup.line_report(odd).collect())) == sorted(map(str, line_dedup.line_report(plain).collect()))
    assert line_dedup.line_report(odd).agg({"n_dropped": "sum"}).first()[0] > 0
    got = line_dedup.without_repeated_lines(odd)
    assert got.dtypes == odd.dtypes and {(r["_row"], r["_gone"]) for r in got.collect()} == {(7, "g")}
    want = line_dedup.without_repeated_lines(plain)
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, want.select("doc_id", "text").collect()))


def test_mixing(spark):
    plain = spark.createDataFrame(rows(), DOCS)
    odd = plain.selectExpr("*", "1 as taken", "2 as _taken", "'h' as _h", "4 as _size", "5 as _src", "6 as _n", "7 as _part", "8 as size", "9 as h")
    got = mixing.mix_documents(odd)
    assert got.columns == odd.columns and got.dtypes == odd.dtypes
    assert {tuple(r)[4:] for r in got.collect()} == {(1, 2, "h", 4, 5, 6, 7, 8, 9)}
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, mixing.mix_documents(plain).collect()))


def test_decontamination(spark):
    items = spark.createDataFrame([(1, rows()[4][1])], "item_id long, text string")
    odd = spark.createDataFrame(rows(), DOCS).selectExpr("*", "7 as _row", "8 as row", "9 as item")
    got = decontamination.without_contaminated(odd, items.selectExpr("*", "1 as item", "2 as n"))
    assert got.columns == odd.columns and {(r["_row"], r["row"], r["item"]) for r in got.collect()} == {(7, 8, 9)}
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for i, r in enumerate(rows()) if i != 4)
