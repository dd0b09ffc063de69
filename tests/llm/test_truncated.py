import random

import pytest

tr = pytest.importorskip("statuta.llm.truncated")
SCHEMA = "doc_id BIGINT, text STRING, source STRING, n_chars BIGINT, open BOOLEAN, word STRING"
NOUNS = "claim notice levy register account boundary security direction holding statement".split()
VERBS = "lodge record withhold publish determine disclose certify transfer".split()


def corpus(n=400, seed=5):
    rnd = random.Random(seed)
    rows, cut = [], set()
    for i in range(n):
        text = " ".join(f"The {rnd.choice(['Minister', 'Registrar'])} must {rnd.choice(VERBS)} the approved {rnd.choice(NOUNS)} within {rnd.randrange(10, 99)} days." for _ in range(rnd.randrange(4, 9)))
        end = rnd.random()
        if end < 0.25:
            text = text[: rnd.randrange(80, len(text) - 60)]
            while text.rstrip()[-1] == ".":
                text = text[:-1]
            text += rnd.choice(["", "", "…", "</p>", "\n"])
            cut.add(i)
        elif end < 0.4:
            text += rnd.choice(["\nEnd of Part IV", "\n* * *", "\n[Schedule 3 repealed]"])
        rows.append((i, text, rnd.choice(["feed", "scan", None]), None, None, "clash"))
    return rows, cut


def test_finds_cut_texts(spark):
    rows, cut = corpus()
    rows += [(9001, None, "feed", None, None, ""), (9002, " \n", "feed", 3, None, ""), (9003, "", None, None, None, ""), (9004, "Word. " * 20000 + "It ends.", "feed", None, None, ""), (9005, "bad �", "scan", None, None, "")]
    told = tr.judged(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r.cut for r in told.collect()}
    assert not {9001, 9002, 9003} & got.keys() and not got[9004] and got[9005]
    flagged = {i for i, c in got.items() if c and i < 9000}
    assert len(flagged & cut) / len(cut) >= 0.95 and len(flagged - cut) <= 2
    share = {r.source: (r.n_texts, r.n_cut) for r in tr.cut_share(told).collect()}
    assert sum(n for n, _ in share.values()) == len(got) and sum(c for _, c in share.values()) == sum(got.values())


def test_empty(spark):
    assert tr.judged(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stripped():
    assert tr.stripped("abc…</p>\n") == ("abc", False, True)
    assert tr.stripped("abc� ") == ("abc", True, False)
    assert tr.stripped(" " * 1000)[0] == ""
    assert tr.stripped("ab." + " <br/>" * 5000) == ("ab.", False, False)
    assert tr.stripped("a" + " " * 200_000 + "b…..") == ("a" + " " * 200_000 + "b…..", False, False)
    assert tr.stripped("a....") == ("a.", False, True) and tr.stripped("a > b>")[0] == "a > b>" and tr.stripped("a <b c=1></p >")[0] == "a"


def test_trie_has_no_longest_word(spark):
    long = "ab" * 40_000
    words = spark.createDataFrame([(long, 50), ("parliament", 90), ("par", 40), ("sch", 1), ("schedule", 60), ("x", 3)], "word STRING, n_docs BIGINT")
    asked = spark.createDataFrame([(w,) for w in (long[:39_999], long, "parlia", "par", "parliament", "sch", "zz", "x")], "word STRING")
    assert {r.word for r in tr.fragments(asked, words).collect()} == {long[:39_999], "parlia", "sch"}
    nodes = {(a, b) for w in ("abc", "abd") for _, a, b in zip(*(x.tolist() for x in tr._beginnings([w], True)), strict=True)}
    assert len(nodes) == 2 and tr._beginnings([], True)[0].size == 0


def test_words_beyond_what_is_appended(spark):
    rows = [(i, "The Registrar must keep the register." + " <br/>" * 200, None, None, None, "") for i in range(3)] + [(7, "The Reg", None, None, None, "")]
    got = tr._scan(spark.createDataFrame(rows, SCHEMA)).where("what = 'word'").groupBy("word").sum("n_docs").collect()
    assert {r[0]: r[1] for r in got} == {"The": 4, "Registrar": 3, "must": 3, "keep": 3, "the": 3}  # the last words are left out, br is appended


def test_contexts_tell_line_ends(spark):
    np = pytest.importorskip("numpy")
    h = np.array([tr.Signs()[t] for t in "a b . c d a b".split()], np.uint64)
    c = tr.contexts(h, np.array([0, 5]), np.array([0, 0]))
    assert c[0][0] == c[0][5] and c[1][1] == c[1][6] and c[4][1] == c[4][6] != c[4][4] and len({int(x) for x in c[4]}) == 5
    assert [int(x) for x in tr.contexts(np.repeat(h[:1], 20), np.array([0]), np.array([0]))[4][8:]] == [0] * 12
