"""Texts cut off by a field limit or in transfer."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.skew import SALT, hot_keys, salt_few, salt_many
from statuta.llm.encode import _slices
from statuta.session import scratch

#: A word keeps its own sign in contexts if it stands in at least this share of the texts and is one of the COMMON_WORDS that
#: stand in most; other words go by their shape. COMMON_WORDS bounds what is broadcast, 8 bytes a word.
COMMON_SHARE, COMMON_WORDS = 0.01, 50_000
#: Order of the contexts that begin with their unit, in tokens, as 4 is the longest of those that don't.
PATH = 8
#: How far a length must stand out from its neighbours (this many lengths to either side) to be a limit of its source, in deviations.
NEIGHBOURS, DEVIATIONS, LEAST_AT_LIMIT = 25, 6.0, 5
#: A text counts as cut if of all that goes so far a smaller share ends there; less is demanded with other evidence.
CHANCE, CHANCE_IF_MORE_STATED, CHANCE_AT_LIMIT = 0.1, 0.3, 0.95
#: A word is known unless words that begin with it stand in this many times as many texts.
OUTNUMBERED = 20
#: The contexts, from the widest to the narrowest.
CTX = ["ctx1", "ctx2", "ctx4", "ctxs", "ctxp"]
ROWS_PER_TASK = 200_000
#: Entries that a worker holds before it folds or hands them on; bounds its memory, not the result.
HELD = 2_000_000

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_|\t| {2,}")
#: What is appended after a cut, or merely closes a text, beside white space, three dots and tags: ellipses, quotation marks, broken characters.
_CLOSING = frozenset("…\ufffd\x22”»“'’")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_END_SIGNS = frozenset(".!?。！？｡؟।։۔")
_MASK, _MUL, _POW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3), np.uint64(0xD6E8FEB86659FD93)
_KIND, _DIGITS, _UPPER, _LOWER, _SIGN = np.uint64(15), 1, 2, 3, 4

TELLS = "doc_id BIGINT, source STRING, text_hash BIGINT, n_chars BIGINT, length INT, octets INT, open BOOLEAN, broken BOOLEAN, dots BOOLEAN, last_word STRING"
#: tokens: signs of all tokens; starts: where lines begin in them; before: column marks in the line before each; ended: whether
#: the last line has tokens; tail, tail_before: the last line without what was appended, and the column marks before it.
SCANNED = f"what STRING, {TELLS}, tokens BINARY, starts BINARY, before BINARY, ended BOOLEAN, tail BINARY, tail_before INT, word STRING, n_docs BIGINT"
CONTEXTS = "ctx BIGINT, ends BIGINT, goes_on BIGINT"
PLACES = "doc_id BIGINT, text_hash BIGINT, " + ", ".join(f"{c} BIGINT" for c in CTX)


def _hash(token: str) -> int:
    return int.from_bytes(hashlib.blake2b(token.encode("utf-8", "replace"), digest_size=8).digest(), "little")


class Signs(dict):
    """The sign of a token: a hash whose four lowest bits tell what kind it is. A number goes by its length."""

    def __missing__(self, token: str) -> int:
        if token[0].isdigit():
            h = _hash(f"d{len(token)}") & ~15 | _DIGITS
        elif token[0].isalpha():
            h = _hash(token) & ~15 | (_UPPER if token[0].isupper() else _LOWER)
        else:
            h = _hash("  " if token[0] == " " else token) & ~15 | _SIGN
        if len(self) > 500_000:
            self.clear()
        self[token] = h
        return h


_SHAPES = np.array([0, 0, _hash("W") & ~15 | _UPPER, _hash("w") & ~15 | _LOWER], np.uint64)
_PIPE, _BREAKS = np.uint64(_hash("|") & ~15 | _SIGN), np.array([_hash(c) & ~15 | _SIGN for c in sorted(_END_SIGNS)], np.uint64)


def shaped(signs: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Signs with words that aren't common (a sorted array) replaced by their shape."""
    kind = signs & _KIND
    word = (kind == _UPPER) | (kind == _LOWER)
    at = np.searchsorted(common, signs)
    known = common[np.minimum(at, len(common) - 1)] == signs if len(common) else np.zeros(len(signs), bool)
    return np.where(word & ~known, _SHAPES[np.minimum(kind, np.uint64(3)).astype(np.int64)], signs)


def contexts(h: np.ndarray, starts: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
    """Of each token its contexts as hashes, in the order of CTX.

    The last token, the last 2, the last 4; the whole unit so far with its first
    two words and the kinds of signs after them; the whole unit so far (both 0
    beyond PATH tokens). starts: where lines begin; a unit begins with its line
    or after an end sign. The number of column marks in the line so far, and in
    the line before (given for each line), belong to every context, so that rows
    of one table aren't taken for rows of another, nor for prose.
    """
    n = len(h)
    begins = np.zeros(n, bool)
    begins[starts] = True
    where = np.arange(n)
    line = np.cumsum(begins) - 1
    marks = (h == _PIPE).cumsum()
    pipes = np.minimum(marks - np.concatenate([[0], marks])[starts][line], 7)
    at_break = np.isin(h, _BREAKS)
    unit = begins.copy()
    unit[1:] |= at_break[:-1] & ~at_break[1:]
    origin = np.maximum.accumulate(np.where(unit, where, 0))
    since = where - origin
    in_line = where - starts[line]
    out = []
    with np.errstate(over="ignore"):
        seed = (pipes + 8 * np.minimum(before, 7)[line] + 1).astype(np.uint64) * _MASK
        for k in (1, 2, 4):
            c = seed + np.uint64(k)
            for back in range(k - 1, -1, -1):
                shifted = np.concatenate([np.zeros(min(back, n), np.uint64), h[: n - back]])
                c = (c ^ np.where(in_line >= back, shifted, np.uint64(7))) * _MUL
                c ^= c >> np.uint64(29)
            out.append(c)
        power = np.concatenate([np.multiply.accumulate(np.full(PATH, _POW, np.uint64)), [np.uint64(0)]])[np.minimum(since, PATH)]
        root = (np.where(begins, np.uint64(11), np.uint64(13)) * _MASK + seed)[origin]
        for coarse in (True, False):
            sums = np.cumsum((np.where(since >= 2, h & _KIND, h) if coarse else h) * power)
            c = (sums - np.concatenate([[np.uint64(0)], sums])[origin] + root + (since.astype(np.uint64) << np.uint64(1)) + np.uint64(coarse)) * _MUL
            out.append(np.where(since < PATH, c ^ (c >> np.uint64(31)), np.uint64(0)))
    return [x.view(np.int64) for x in out]


def stripped(text: str) -> tuple[str, bool, bool]:
    """(text without what was appended, whether a broken character was among it, whether an ellipsis was). Read from the end, each sign once."""
    end = len(text)
    while end:
        c = text[end - 1]
        if c in _CLOSING or c.isspace():
            end -= 1
        elif c == "." and text.endswith("...", 0, end):
            end -= 3
        elif c == ">" and (at := text.rfind("<", 0, end)) >= 0 and (m := _TAG.match(text, at, end)) and m.end() == end:
            end = at
        else:
            break
    tail = text[end:]
    return text[:end], "\ufffd" in tail, "…" in tail or "..." in tail


def _scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: rows 'doc' with what a text tells of itself and its tokens, and rows 'word' with the words of the
    vocabulary, counted in part. A text's last word is no word of it, since it may be a fragment, nor are words of what was
    appended."""
    names = [f.split()[0] for f in SCANNED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), *[pa.binary()] * 3, pa.bool_(), pa.binary(), pa.int32(), pa.string(), pa.int64()]

    def counted(words: Counter[str]) -> Iterator[pa.RecordBatch]:
        kept = [(w, n) for w, n in words.items() if w[0].isalpha()]
        for i in range(0, len(kept), 20_000):
            part = kept[i : i + 20_000]
            cols = [pa.nulls(len(part), k) for k in kinds]
            cols[0], cols[-2], cols[-1] = pa.array(["word"] * len(part)), pa.array([w for w, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, words = Signs(), Counter()
        sign, tokens_of = signs.__getitem__, _TOKEN.findall
        for whole in batches:
            for b in _slices(whole, 4, 2_000_000):
                rows: list[tuple] = []
                for text in b.column(4).to_pylist():
                    core, broken, dots = stripped(text)
                    lines, flat, starts, before = text.split("\n"), [], [], []
                    home, at, tail, tail_before = core.count("\n"), 0, (0, 0), 0
                    seen: set[str] = set()
                    final = None
                    for i, part in enumerate(lines):
                        got = tokens_of(part)
                        if i <= home:
                            n_got = len(got)
                            if i == home:
                                n_got -= len(tokens_of(part[len(core) - at :]))
                                tail, tail_before = (len(flat), len(flat) + n_got), lines[i - 1].count("|") if i else 0
                            seen.update(got[:n_got])
                            final = next((w for w in reversed(got[:n_got]) if w[0].isalpha()), final)
                        at += len(part) + 1
                        if got:
                            starts.append(len(flat))
                            before.append(lines[i - 1].count("|") if i else 0)
                            flat += map(sign, got)
                    ended = bool(starts) and bool(got)
                    if final is not None and (core.count(final) < 2 or sum(w == final for w in tokens_of(core)) < 2):
                        seen.discard(final)
                    words.update(seen)
                    is_open = tail[1] > tail[0] and core[-1] not in _END_SIGNS
                    word = re.search(r"[^\W\d_]+\Z", core[core.rfind("\n") + 1 :]) if is_open else None
                    all_ = np.array(flat, np.uint64)
                    rows.append((len(text), len(text.encode("utf-8", "replace")), is_open, broken, dots, word[0] if word else None, all_.tobytes(), np.array(starts, np.int32).tobytes(), np.array(before, np.int32).tobytes(), ended, all_[slice(*tail)].tobytes(), tail_before))
                made = list(zip(*rows, strict=True)) or [[]] * 12
                yield pa.RecordBatch.from_arrays([pa.array(["doc"] * b.num_rows), *b.columns[:4], *[pa.array(list(c), k) for c, k in zip(made, kinds[5:17], strict=True)], pa.nulls(b.num_rows, pa.string()), pa.nulls(b.num_rows, pa.int64())], names)
                if len(words) > HELD:
                    yield from counted(words)
                    words.clear()
        yield from counted(words)

    return docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), "n_chars", "text").mapInArrow(run, SCANNED)


def _trained(scanned: DataFrame, common: Broadcast) -> DataFrame:
    """ctx, ends, goes_on: how often a line ends and how often it goes on after a context. Lines before the last are whole."""

    def folded(pending: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(pending).group_by("ctx", use_threads=False).aggregate([("ends", "sum"), ("goes_on", "sum")])
        return t.select(["ctx", "ends_sum", "goes_on_sum"]).rename_columns(["ctx", "ends", "goes_on"])

    def counted(docs: list[tuple]) -> Iterator[pa.Table]:
        sizes = np.array([len(d[0]) for d in docs])
        h = shaped(np.concatenate([d[0] for d in docs]), common.value)
        starts = np.concatenate([d[1] + at for d, at in zip(docs, np.cumsum(sizes) - sizes, strict=True)])
        ends = np.zeros(len(h), bool)
        ends[np.append(starts[1:], len(h)) - 1] = True
        known = np.ones(len(h), bool)
        known[(np.cumsum(sizes) - 1)[[d[3] for d in docs]]] = False  # how the last line ends is the question
        for c in contexts(h, starts, np.concatenate([d[2] for d in docs])):
            use = known & (c != 0)
            for ended in (True, False):
                keys, n = np.unique(c[use & (ends == ended)], return_counts=True)
                none = np.zeros(len(keys), np.int64)
                yield pa.table({"ctx": keys, "ends": n if ended else none, "goes_on": none if ended else n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []
        docs: list[tuple] = []
        held = 0

        def take() -> None:
            pending.extend(counted(docs))
            docs.clear()
            if sum(t.num_rows for t in pending) > HELD:
                pending[:] = [folded(pending)]

        for b in batches:
            for tokens, starts, before, ended in zip(b.column(0), b.column(1), b.column(2), b.column(3).to_pylist(), strict=True):
                h = np.frombuffer(tokens.as_buffer(), np.uint64)
                if len(h):
                    docs.append((h, np.frombuffer(starts.as_buffer(), np.int32).astype(np.int64), np.frombuffer(before.as_buffer(), np.int32), ended))
                    held += len(h)
                if held > HELD // 4:
                    take()
                    held = 0
            if docs:
                take()
                held = 0
            if pending and sum(t.num_rows for t in pending) > 2 * HELD:  # still that many after folding: hand them on
                yield from folded(pending).to_batches(50_000)
                pending.clear()
        if pending:
            yield from folded(pending).to_batches(50_000)

    return scanned.select("tokens", "starts", "before", "ended").mapInArrow(run, CONTEXTS).groupBy("ctx").agg(F.sum("ends").alias("ends"), F.sum("goes_on").alias("goes_on"))


def _places(opened: DataFrame, common: Broadcast) -> DataFrame:
    """doc_id, text_hash and the contexts in which each open text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, 2):
                tails = [np.frombuffer(t.as_buffer(), np.uint64) for t in b.column(2)]
                sizes = np.array([len(t) for t in tails], np.int64)
                ends = np.cumsum(sizes)
                if not len(ends):
                    continue
                made = contexts(shaped(np.concatenate(tails), common.value), ends - sizes, b.column(3).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c[ends - 1], pa.int64()) for c in made]], [f.split()[0] for f in PLACES.split(", ")])

    return opened.select("doc_id", "text_hash", "tail", "tail_before").mapInArrow(run, PLACES)


def _chance(places: DataFrame, trained: DataFrame) -> DataFrame:
    """doc_id with chance: how likely a text ends after the contexts it ends in, longer contexts first, shorter ones behind them.

    Contexts in which very many texts end are spread over several tasks.
    """
    each = places.select("doc_id", "text_hash", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).alias("ctx")) for k, c in enumerate(CTX)])).alias("x")).select("doc_id", "text_hash", "x.*").where("ctx <> 0")
    # Other texts that end there too; each distinct text has one say, and none for itself.
    here = each.select("text_hash", "ctx").distinct().groupBy("ctx").agg((F.count(F.lit(1)) - 1).alias("others"))
    counts = here.join(trained, "ctx", "left").select("ctx", (F.col("others") + F.coalesce("ends", F.lit(0))).alias("e"), F.coalesce("goes_on", F.lit(0)).alias("g"))
    hot = hot_keys(each, ["ctx"], ROWS_PER_TASK)
    met = salt_many(each, hot, ["ctx"], ["doc_id"]).join(salt_few(counts, hot, ["ctx"]), ["ctx", SALT])
    got = met.groupBy("doc_id").agg(*[F.max(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(len(CTX)) for c in ("e", "g")])

    def step(k: int, behind: Column) -> Column:
        e, g = F.coalesce(f"e{k}", F.lit(0)), F.coalesce(f"g{k}", F.lit(0))
        return (e + 2 * behind) / (e + g + 2)

    chance = F.lit(0.05)
    for k in range(len(CTX)):
        chance = step(k, chance)
    return got.select("doc_id", chance.alias("chance"))


def _limits(features: DataFrame) -> DataFrame:
    """source, unit, size: lengths in characters or octets at which far more texts of a source end than at those around."""
    sizes = features.select("source", "text_hash", F.explode(F.array(F.struct(F.lit("c").alias("unit"), F.col("length").alias("size")), F.struct(F.lit("o").alias("unit"), F.col("octets").alias("size")))).alias("s"))
    n = sizes.select("source", "text_hash", "s.*").distinct().groupBy("source", "unit", "size").agg(F.count(F.lit(1)).alias("n"))
    around = W.partitionBy("source", "unit").orderBy("size").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    mean = (F.sum("n").over(around) - F.col("n")) / (2 * NEIGHBOURS)
    return n.withColumn("m", mean).where((F.col("n") >= LEAST_AT_LIMIT) & (F.col("n") > F.col("m") + DEVIATIONS * F.sqrt(F.col("m") + 0.25))).select("source", "unit", "size")


def _beginnings(words: list[str], proper: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which word, and two hashes) of every proper beginning of each word, or of each word itself. A hash grows letter by letter,
    so a word of any length costs its letters once."""
    sizes = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    nth = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
    hashes = []
    with np.errstate(over="ignore"):
        for base in (_POW, _MASK):
            powers = np.multiply.accumulate(np.full(int(sizes.max(initial=0)) + 1, base, np.uint64))
            sums = np.cumsum((codes + np.uint64(1)) * powers[nth])
            so_far = sums - np.concatenate([[np.uint64(0)], sums])[np.repeat(ends - sizes, sizes)]
            h = (so_far + nth.astype(np.uint64)) * _MUL
            hashes.append((h ^ (h >> np.uint64(32))).view(np.int64))
    keep = nth + 1 < sizes[word] if proper else nth + 1 == sizes[word]
    return word[keep], hashes[0][keep], hashes[1][keep]


def _nodes(words: DataFrame, proper: bool) -> DataFrame:
    """words (word first, then at most one number) with the trie nodes of their proper beginnings, or of themselves: a, b and the
    other columns; the word itself only where it is the node."""
    kept = [c for c in words.columns if c != "word" or not proper]
    kinds = dict(words.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in _slices(whole, 0, 500_000):
                at, one, two = _beginnings(b.column(0).to_pylist(), proper)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), *[b.column(b.schema.names.index(c)).take(pa.array(at)) for c in kept]], ["a", "b", *kept])

    return words.mapInArrow(run, "a BIGINT, b BIGINT" + "".join(f", {c} {kinds[c]}" for c in kept))


def trie(words: DataFrame) -> DataFrame:
    """a, b, n_below: every proper beginning of a word, as two hashes, with the most texts that one word below it stands in: the inner
    nodes of the vocabulary's trie as a table."""
    return _nodes(words, True).groupBy("a", "b").agg(F.max("n_docs").alias("n_below"))


def fragments(last: DataFrame, words: DataFrame) -> DataFrame:
    """word: which of the given words are proper beginnings of known words and themselves unknown, or next to them all but unknown (OUTNUMBERED)."""
    met = _nodes(last.select("word").distinct(), False).join(trie(words), ["a", "b"]).join(words, "word", "left")
    return met.where(F.coalesce("n_docs", F.lit(0)) * OUTNUMBERED <= F.col("n_below")).select("word")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, source, cut, reason of each text that isn't null or blank.

    A text is looked at without what was appended to it (white space, closing
    tags, ellipses, quotation marks, broken characters). If it then ends in an
    end sign, it is whole. Otherwise it is cut if
    - 'fragment', by the trie of words: its last word is a proper beginning of
      known words and itself unknown, or next to them all but unknown
      (OUTNUMBERED);
    - 'broken': a broken character stands at its end;
    - 'limit', by length: its length, in characters or octets, is a limit of its
      source (unless texts nearly always end after such words);
    - 'open': a cut between words leaves no fragment, so the same is asked of
      token sequences: texts and lines hardly ever end after such tokens (in
      less than CHANCE of the cases; CHANCE_IF_MORE_STATED where n_chars says
      that there was more, or an ellipsis was put behind). Headings, table rows,
      entries, sign-offs and references are known from where whole lines and
      other texts end.

    Counts and statistics are over all texts; copies of a text speak once where
    texts are compared. Texts are cut into tokens once. Broadcast: signs of at
    most COMMON_WORDS words. A null source is a source of its own. Texts and
    words are read whole, however long.
    """
    spark = docs.sparkSession
    at = scratch(spark, "scanned")
    _scan(docs.select("doc_id", "text", "source", "n_chars").where(F.col("text").rlike(r"(?U)\S"))).write.partitionBy("what").parquet(at)
    both = spark.read.schema(SCANNED).option("basePath", at).parquet(at)
    scanned = both.where("what = 'doc'")
    at = scratch(spark, "words")
    both.where("what = 'word'").groupBy("word").agg(F.sum("n_docs").alias("n_docs")).write.parquet(at)
    words = spark.read.schema("word STRING, n_docs BIGINT").parquet(at)
    many = words.where(F.col("n_docs") >= COMMON_SHARE * scanned.count()).orderBy(F.desc("n_docs"), "word").limit(COMMON_WORDS)
    signs = Signs()
    common = spark.sparkContext.broadcast(np.array(sorted(signs[r[0]] for r in many.select("word").toLocalIterator()), np.uint64))
    told = scanned.select(*[f.split()[0] for f in TELLS.split(", ")])
    at = scratch(spark, "places")
    _places(scanned.where("open"), common).write.parquet(at)
    chance = _chance(spark.read.schema(PLACES).parquet(at), _trained(scanned, common))
    last = told.where("last_word IS NOT NULL").select("doc_id", F.col("last_word").alias("word"))
    hot = hot_keys(last, ["word"], ROWS_PER_TASK)
    broken_off = salt_many(last, hot, ["word"], ["doc_id"]).join(salt_few(fragments(last, words), hot, ["word"]), ["word", SALT]).select("doc_id")
    none = F.lit(None).cast("double").alias("chance")
    evidence = (
        chance.select("doc_id", "chance", F.lit("").alias("what")).unionByName(broken_off.select("doc_id", none, F.lit("fragment").alias("what"))).unionByName(_at_limit(told, _limits(told)).select("doc_id", none, F.lit("limit").alias("what")))
        .groupBy("doc_id").agg(F.max("chance").alias("chance"), F.bool_or(F.col("what") == "fragment").alias("fragment"), F.bool_or(F.col("what") == "limit").alias("at_limit"))
    )
    asked = F.when(F.col("dots") | (F.coalesce("n_chars", F.lit(0)) > F.col("length")), CHANCE_IF_MORE_STATED).otherwise(CHANCE)
    reason = (
        F.when(F.col("broken"), "broken").when(~F.col("open"), None).when(F.col("fragment"), "fragment").when(F.col("at_limit") & (F.coalesce("chance", F.lit(0.0)) < CHANCE_AT_LIMIT), "limit")
        .when(F.coalesce("chance", F.lit(0.0)) < asked, "open")
    )
    return told.join(evidence, "doc_id", "left").select("doc_id", "source", reason.isNotNull().alias("cut"), reason.alias("reason"))


def _at_limit(told: DataFrame, limits: DataFrame) -> DataFrame:
    both = [told.select("doc_id", "source", F.lit(u).alias("unit"), F.col(c).alias("size")) for u, c in (("c", "length"), ("o", "octets"))]
    sized = both[0].unionByName(both[1])
    met = (sized["source"].eqNullSafe(limits["source"])) & (sized["unit"] == limits["unit"]) & (sized["size"] == limits["size"])
    return sized.join(limits, met, "left_semi").select("doc_id").distinct().withColumn("at_limit", F.lit(True))


def cut_share(told: DataFrame) -> DataFrame:
    """source, n_texts, n_cut, share_cut."""
    cut = F.count_if("cut")
    return told.groupBy("source").agg(F.count(F.lit(1)).alias("n_texts"), cut.alias("n_cut"), F.round(cut / F.count(F.lit(1)), 6).alias("share_cut"))
