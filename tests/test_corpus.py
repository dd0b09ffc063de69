from pyspark.sql import functions as F

from statuta.operators import corpus as c
from statuta.operators import quality as q


def test_identifiers(spark):
    df = spark.createDataFrame([("Privacy Act 1988", "C1988A119"), ("No year", "F2011L310"), (None, None)], "name STRING, title_id STRING")
    got = df.select(c.safe_name(F.col("name")), c.year_from_name(F.col("name")), c.number_from_title_id(F.col("title_id"))).collect()
    assert [tuple(r) for r in got] == [("privacy-act-1988", 1988, 119), ("no-year", None, 310), (None, None, None)]


def test_site_paths_golden(spark):
    """The digests of two published paths."""
    rows = [("T2", "Second Act 1994", 1994, 57), ("T1", "First Act 1994", 1994, 57), ("T3", "Third", 1995, 1)]
    got = {r.title_id: r.site_path for r in c.site_paths(spark.createDataFrame(rows, "title_id STRING, name STRING, year INT, number INT")).collect()}
    import hashlib

    digest = lambda n: hashlib.blake2b(n.encode(), digest_size=4).hexdigest()
    assert got == {"T2": f"/akn/au/act/1994/57-t2-{digest('second-act-1994')}/", "T1": f"/akn/au/act/1994/57-t1-{digest('first-act-1994')}/", "T3": "/akn/au/act/1995/1/"}


def test_alias_precedence(spark):
    e = spark.createDataFrame([(1, "T1", "Act A 2000", ["Act B 2000", "Old"], "/1"), (2, "T2", "Act B 2000", None, "/2"), (3, "T3", None, ["Old"], "/3")], "entry_id BIGINT, title_id STRING, name STRING, aliases ARRAY<STRING>, frbr_uri STRING")
    assert {r.name: r.frbr_uri for r in c.citation_index(e).collect()} == {"Act A 2000": "/1", "Act B 2000": "/2", "Old": "/1"}


def test_merge(spark):
    e = spark.createDataFrame([(1, "T", "Old Act", "old-act", "xml/old.xml", ["Older"]), (2, "T", "New Act", "new-act", "xml/new.xml", []), (3, "U", "P", "p", "", None), (4, "U", "Q", "q", "", None)], "entry_id BIGINT, title_id STRING, name STRING, slug STRING, xml_path STRING, aliases ARRAY<STRING>")
    merged, orphans = c.merge_titles(e, spark.createDataFrame([("T", "New Act"), ("U", "R")], "title_id STRING, name STRING"))
    assert {(r.entry_id, tuple(r.aliases), r.conflict) for r in merged.collect()} == {(2, ("Old Act", "Older"), False), (3, (), True), (4, (), True)}
    assert [(r.entry_id, r.report_glob, r.docx_globs[0]) for r in orphans.collect()] == [(1, "reports/old-act-v[0-9]*.json", "docx/old-act-c[0-9]*-vol*.docx")]


def test_new_titles(spark):
    n = lambda *x: spark.createDataFrame([(v,) for v in x], "name STRING")
    assert [r.name for r in c.new_titles(n("Privacy Act", "New Act 2026", "GST Act", "Repeal Act"), n("Privacy Act", "GST Act"), n()).collect()] == ["New Act 2026"]


def test_globs(spark):
    f = lambda *x: spark.createDataFrame([(v,) for v in x], "path STRING")
    got = c.orphan_files(f("xml/a.xml", "xml/b.xml", ".cache/x", "README.md", "docx/q.docx"), f("xml/a.xml"), [".cache/*", "docx/*"], ["README.md"])
    assert [r.path for r in got.collect()] == ["xml/b.xml"]


def test_stride_sample(spark):
    names = [f"{chr(65 + i % 7)}ct {i:03} 19{i % 100:02}" for i in range(57)]
    df = spark.createDataFrame([(n, "s") for n in names], "name STRING, era STRING")
    want = [sorted(names)[int(i * (57 / 5))] for i in range(5)]
    assert sorted(r.name for r in q.stride_sample(df, "era", "name", 5).collect()) == want
    assert q.stride_sample(df.limit(3), "era", "name", 5).count() == 3


def test_log_failures(spark):
    lines = ["[fetch ] Act One", q.SKIP_LINE, "noise", q.SKIP_LINE, "[fetch ] Act Two", "ok"]
    df = spark.createDataFrame([("l", i, x) for i, x in enumerate(lines)], "log_id STRING, line_no INT, line STRING")
    assert [r.name for r in q.log_failures(df).collect()] == ["Act One"]


def test_upsert(spark):
    s = "slug STRING, title_id STRING, name STRING, aliases ARRAY<STRING>"
    old = spark.createDataFrame([("a", "T1", "A", ["x"]), ("b", "T2", "B", None), ("c", "T3", "C", ["y"])], s)
    new = spark.createDataFrame([("a2", "T1", "A2", []), ("b", "T2", "B", ["z"])], s)
    assert {(r.slug, tuple(r.aliases)) for r in c.upsert(old, new).collect()} == {("a2", ("A", "x")), ("b", ("z",)), ("c", ("y",))}


def test_upsert_folds(spark):
    import random

    rnd = random.Random(1)
    s = "slug STRING, title_id STRING, name STRING, aliases ARRAY<STRING>, n BIGINT"
    row = lambda i, slug: (slug, f"T{rnd.randrange(5)}", f"N{i}", rnd.choice([None, [], [f"x{i}", "N3"]]), i)
    for _ in range(4):
        old, new = [row(100 + i, f"s{i}") for i in range(6)], [row(i, f"s{rnd.randrange(7)}") for i in range(14)]
        index = {r[0]: (r[1], r[2], set(r[3] or [])) for r in old}
        for slug, title, name, aliases, _n in new:
            gone = [k for k, v in index.items() if v[0] == title and k != slug]
            names = set(aliases or []).union(*[{index[k][1], *index[k][2]} for k in gone]) - {name}
            index = {k: v for k, v in index.items() if k not in gone} | {slug: (title, name, names)}
        got = {r.slug: (r.title_id, r.name, set(r.aliases)) for r in c.upsert(spark.createDataFrame(old, s), spark.createDataFrame(rnd.sample(new, len(new)), s), "n").collect()}
        assert got == index


def test_orphan_files_are_those_of_merged_entries(spark, tmp_path):
    from statuta.plans import legislative

    e = [(1, "T", "Old Act", "old", "xml/old.xml", []), (2, "T", "New Act", "new", "xml/new.xml", []), (3, "U", "P", "p", "xml/p.xml", []), (5, None, "Q", "q", "xml/q.xml", [])]
    spark.createDataFrame(e, "entry_id BIGINT, title_id STRING, name STRING, slug STRING, xml_path STRING, aliases ARRAY<STRING>").write.parquet(f"{tmp_path}/corpus_index.parquet")
    spark.createDataFrame([("T", "New Act"), ("U", "P")], "title_id STRING, name STRING").write.parquet(f"{tmp_path}/acts.parquet")
    assert [r.path for r in legislative.orphan_files(spark, str(tmp_path)).collect()] == ["xml/old.xml"]
