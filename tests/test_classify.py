from pyspark.sql import functions as F

from statuta.operators import classify as cl

N = "\xa0"


def one(spark, style, text):
    r = spark.createDataFrame([(style, text)], "s STRING, t STRING").select(cl.classified(F.col("s"), F.col("t")).alias("c")).select("c.*").first()
    return tuple(r)


def test_styled(spark):
    assert one(spark, "ActHead 2", f"Part{N}1-1—Introduction") == ("part", "1-1", "Introduction", "")
    assert one(spark, "ActHead 4", f"Division{N}1") == ("dvs", "1", "", "")
    assert one(spark, "ActHead 5", "2A  Objects of this Act") == ("section", "2A", "Objects of this Act", "")
    assert one(spark, "Body Text", "(1) The court\nmay") == ("subsec", "1", "", "The court\nmay")
    assert one(spark, "List Paragraph", "(ii) x") == ("subpara", "ii", "", "x")
    assert one(spark, "List Paragraph", "(b) x") == ("para", "b", "", "x")
    assert one(spark, "List Paragraph", "(AA) x") == ("level4", "AA", "", "x")
    assert one(spark, "subsection", "(a) x") == ("para", "a", "", "x")
    assert one(spark, "Normal", f"Note{N}1: x")[0] == "note"
    assert one(spark, "Penalty", "x") == ("penalty", "", "", "x")
    assert one(spark, None, None) == ("skip", "", "", "")
    assert one(spark, "Normal", " 　 ")[0] == "skip"
    assert one(spark, "ActHead 1", "Part 1—no break space") == ("body", "", "", "Part 1—no break space")


def legacy(spark, rows):
    df = spark.createDataFrame([(i, "A", 0, i, s, t, b) for i, (t, b, s) in enumerate(rows)], "para_id BIGINT, act_id STRING, volume_index INT, ord BIGINT, raw_style STRING, text STRING, all_bold BOOLEAN")
    return [(r.ord, r.element_type, r.number, r.heading, r.text) for r in cl.classify_legacy(df).orderBy("ord", "part_no").collect()]


def test_legacy_shapes(spark):
    got = legacy(spark, [("Short title.", True, ""), ("1.\tThis Act may be cited.", False, ""), ("1. (1) Fused", False, ""), ("PART 2—REST", False, ""), ("5  Scope", False, "heading 5,s"), ("No. 7 of 1976", True, ""), ("", False, "")])
    assert got == [(1, "section", "1", "Short title.", ""), (1, "body", "", "", "This Act may be cited."), (2, "section", "1", "", ""), (2, "subsec", "1", "", "Fused"), (3, "part", "2", "REST", ""), (4, "section", "5", "Scope", ""), (5, "body", "", "", "No. 7 of 1976"), (6, "skip", "", "", "")]


def test_bold_numbered_runs_alternate(spark):
    """A consumed row can't itself be a donor: in a run every second row is."""
    rows = [(f"{i}. text", True, "") for i in range(1, 6)] + [("6. end", False, "")]
    want, i = [], 0
    while i < len(rows):
        if rows[i][1] and i + 1 < len(rows):
            want += [(i + 1, "section"), (i + 1, "body")]
            i += 2
        else:
            want.append((i, "body"))
            i += 1
    assert [(o, t) for o, t, *_ in legacy(spark, rows)] == want
