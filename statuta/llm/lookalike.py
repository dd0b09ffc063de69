"""One form for text that reads the same but is written with different characters."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.skew import SALT, hot_keys, salt_few, salt_many
from statuta.session import scratch, settled

# Latin letters and the letters of other scripts that are drawn alike, Latin first.
LOOKALIKES = """
aаɑ cсϲ dԁ eе gɡց hһհ iіι jјϳ lӏ nո oоοօ pр qԛ sѕ uս vѵν wԝ xх yуү
AАΑᎪ BВΒᏴ CСϹᏟ DᎠ EЕΕᎬ FϜ GᏀԌ HНΗᎻ IІΙӀ JЈᎫͿ KКΚᏦ LᏞ MМΜᎷϺ NΝ OОΟՕ PРΡᏢ QԚ SЅՏᏚ TТΤᎢ UՍ VѴᏙ WԜᎳ XХΧ YҮΥ ZΖᏃ
""".split()
# Hyphens drawn alike, beside the width forms that decompose to the plain one.
HYPHENS = "‐‑"
# Invisible signs beside the format characters (general category Cf).
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ" + "".join(map(chr, range(0xFE00, 0xFE10)))
# Format characters that are drawn, and so stay.
DRAWN = {*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x0890, 0x0891, 0x08E2, 0x110BD, 0x110CD}

_TO_LATIN = {other: group[0] for group in LOOKALIKES for other in group[1:]}
_GROUP = {c: group for group in LOOKALIKES for c in group}
#: Decompositions that a reader can't see: width, no-break forms, ligatures and letter signs made of several letters.
_UNSEEN = {"<wide>", "<narrow>", "<small>", "<noBreak>", "<vertical>"}
#: Rules by which a token is suspect, the preferred first, and how its repaired form is known: it stands in the corpus, or two spellings share it.
MIXED, TOWARDS_TEXT, FOREIGN = 0, 1, 2
STANDS, SHARED = 0, 1
ROWS_PER_TASK = 200_000
#: A token is a run of letters and marks.
_TOKEN = re.compile(r"(?:[^\W\d_]|[̀-ͯ])+")
TOKEN_SQL = r"[\p{L}\p{M}]+"


@lru_cache(maxsize=1 << 16)
def _plain(c: str) -> str:
    """One character in its plain form; '' for an invisible one."""
    kind, code = unicodedata.category(c), ord(c)
    if c in "\n  \x85\x0b\x0c":
        return "\n"
    if kind == "Zs" or c == "\t":
        return " "
    if kind == "Cf" and code not in DRAWN or kind == "Cc" or c in INVISIBLE or 0xE0100 <= code <= 0xE01EF:
        return ""
    if c in HYPHENS:
        return "-"
    tag, *parts = unicodedata.decomposition(c).split() or [""]
    if tag in _UNSEEN or tag == "<compat>" and (kind in ("Lu", "Ll", "Lt", "Nl") and len(parts) > 1 or kind == "Nl" or c == "\xb5"):
        return "".join(_plain(chr(int(p, 16))) for p in parts)
    return c


@lru_cache(maxsize=1 << 16)
def script(c: str) -> str:
    """The script of a letter, from its name; '' for marks."""
    if unicodedata.combining(c):
        return ""
    name = unicodedata.name(c, "").split(" ")[0]
    return {"FULLWIDTH": "LATIN", "HALFWIDTH": "KATAKANA", "MODIFIER": "", "COMBINING": ""}.get(name, name)


def unify(text: str) -> str:
    """Width, invisible signs, kinds of blank and hyphen, and encoding in one form; case, accents, digits and dashes stay.

    Line ends become line feeds, other white space a blank each; runs aren't
    shortened, since a reader sees them.
    """
    return unicodedata.normalize("NFC", "".join(map(_plain, text.replace("\r\n", "\n").replace("\r", "\n"))))


def _scripts(text: str) -> Counter[str]:
    """How many letters there are of each script."""
    return Counter(s for c in text if (s := script(c)))


def _dominant(counts: Counter[str]) -> str:
    """The script with most letters, '' for none or a tie."""
    top = counts.most_common(2)
    return top[0][0] if len(top) == 1 or top and top[0][1] > top[1][1] else ""


def _into(token: str, target: str) -> str | None:
    """The token with every letter outside the target script replaced by its look-alike there; None if one has none."""
    out = []
    for c in unicodedata.normalize("NFD", token):
        s = script(c)
        if s and s != target:
            like = next((g for g in _GROUP.get(c, "") if script(g) == target), None)
            if like is None:
                return None
            c = like
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def suspects(text: str) -> tuple[list[tuple[str, str, int]], list[str]]:
    """(tokens that may be repaired, their repaired form, by which rule; all other tokens) of a unified text.

    A token with letters of several scripts is suspect towards its dominant
    script (MIXED) and, where that is another, towards that of the rest of the
    text (TOWARDS_TEXT), since a word may have most of its letters replaced. So
    is a token wholly of another script than the rest of its text if each of its
    letters has a look-alike there (FOREIGN): it mixes scripts with its
    neighbours. Only the first is the method as named; repairs_by_rule tells
    what each adds.
    """
    found: set[tuple[str, str, int]] = set()
    clean: set[str] = set()
    tokens = Counter(_TOKEN.findall(text))
    whole = None
    for token, times in tokens.items():
        if token.isascii():
            clean.add(token)
            continue
        scripts = _scripts(token)
        own, mixed = _dominant(scripts), len(scripts) > 1
        whole = _scripts(text) if whole is None else whole
        around = _dominant(whole - Counter({k: n * times for k, n in scripts.items()}))
        targets = dict.fromkeys([own, around] if mixed else [around] if own and own != around else [])
        forms = [(f, FOREIGN if not mixed else MIXED if t == own else TOWARDS_TEXT) for t in targets if t and (f := _into(token, t)) is not None and f != token]
        if forms:
            found.update((token, f, n) for f, n in forms)
        elif not mixed:
            clean.add(token)
    return sorted(found), sorted(clean)


def repair(text: str, replacements: dict[str, str]) -> str:
    """The text with the given tokens replaced."""
    return _TOKEN.sub(lambda m: replacements.get(m[0], m[0]), text)


def needs_care(c: Column) -> Column:
    """Whether unify could change the value: any sign beyond ASCII, or a control character. A test within the JVM."""
    return (F.octet_length(c) != F.char_length(c)) | c.rlike(r"[\x00-\x09\x0b-\x1f\x7f]")


UNIFIED = "field_name STRING, para_id BIGINT, raw_hash BIGINT, form STRING, fixes ARRAY<STRUCT<token: STRING, fixed: STRING, pref: INT>>, tokens ARRAY<STRING>"
_FIXES = pa.list_(pa.struct([("token", pa.string()), ("fixed", pa.string()), ("pref", pa.int32())]))


def _unified(values: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms, fixes, tokens = [], [], []
            for t in b.column(3).to_pylist():
                forms.append(u := unify(t))
                f, clean = suspects(u)
                fixes.append([{"token": a, "fixed": z, "pref": n} for a, z, n in f])
                tokens.append(clean)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(forms, pa.string()), pa.array(fixes, _FIXES), pa.array(tokens, pa.list_(pa.string()))], ["field_name", "para_id", "raw_hash", "form", "fixes", "tokens"])

    return values.select("field_name", "para_id", "raw_hash", "value").mapInArrow(run, UNIFIED)


def _repaired(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [repair(t, {x["token"]: x["fixed"] for x in good}) if good else t for t, good in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(forms, pa.string())], ["field_name", "para_id", "raw_hash", "form"])

    return rows.select("field_name", "para_id", "raw_hash", "form", "good").mapInArrow(run, "field_name STRING, para_id BIGINT, raw_hash BIGINT, form STRING")


def field_values(paragraphs: DataFrame) -> DataFrame:
    """field_name, para_id, value: texts, and span texts joined in order. Null and blank values are left out; repeated rows stay."""
    texts = paragraphs.select(F.lit("text").alias("field_name"), "para_id", F.col("text").alias("value"))
    joined = F.array_join(F.transform("spans", lambda s: s["text"]), "")
    spans = paragraphs.where("size(spans) > 0").select(F.lit("spans").alias("field_name"), "para_id", joined.alias("value"))
    return texts.unionByName(spans).where(F.col("value").rlike(r"(?U)\S"))


def _read(paragraphs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plain values, unified other values with their suspect tokens, repairs: token, fixed, kind, pref)."""
    spark = paragraphs.sparkSession
    values = field_values(paragraphs.select("para_id", "text", "spans"))
    plain = values.where(~needs_care(F.col("value"))).withColumnRenamed("value", "form")
    care = values.where(needs_care(F.col("value"))).withColumn("raw_hash", F.xxhash64("value"))
    at = scratch(spark, "unified")
    _unified(care).write.parquet(at)
    unified = spark.read.schema(UNIFIED).parquet(at)
    pairs = unified.select(F.explode("fixes").alias("f")).select("f.*").groupBy("token", "fixed").agg(F.min("pref").alias("pref"))
    wanted = pairs.groupBy("fixed").agg(F.count(F.lit(1)).alias("n"))
    words = (
        plain.select(F.explode(F.regexp_extract_all("form", F.lit(TOKEN_SQL), 0)).alias("fixed"))
        .unionByName(unified.select(F.explode("tokens").alias("fixed")))
        .distinct()
    )
    stands = words.join(wanted.select("fixed"), "fixed", "left_semi").select("fixed", F.lit(STANDS).alias("kind"))
    attested = stands.unionByName(wanted.where("n > 1").select("fixed", F.lit(SHARED).alias("kind")))
    good = pairs.join(attested, "fixed").groupBy("token").agg(F.min(F.struct("kind", "pref", "fixed")).alias("g")).select("token", "g.fixed", "g.kind", "g.pref")
    return plain, unified, good


def _met(unified: DataFrame, good: DataFrame) -> DataFrame:
    """field_name, para_id, raw_hash and the repair of each suspect token that has one; tokens of very many values are spread over several tasks."""
    asked = unified.select("field_name", "para_id", "raw_hash", F.explode(F.array_distinct(F.transform("fixes", lambda x: x["token"]))).alias("token"))
    hot = hot_keys(asked, ["token"], ROWS_PER_TASK)
    return salt_many(asked, hot, ["token"], ["para_id"]).join(salt_few(good, hot, ["token"]), ["token", SALT]).drop(SALT)


def one_form(paragraphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(plain, cared): values that are in the one form as they stand (field_name, para_id, form), and the others brought
    into it (field_name, para_id, raw_hash, form).

    Plain ASCII never leaves the JVM. The rest is unified in Python and written
    once; of its suspect tokens those are repaired whose repaired form stands in
    the corpus vocabulary, that is as an unmixed token anywhere in the corpus, or
    else as the common reading of two different mixed spellings (then the clean
    word needn't stand anywhere). The vocabulary meets the suspects in a join whose
    side of suspects Spark broadcasts only if it measures it as small; nothing
    comes to the driver. A paragraph without suspects isn't shuffled.
    """
    plain, unified, good = _read(paragraphs)
    fixes = _met(unified, good).groupBy("field_name", "para_id", "raw_hash").agg(F.collect_list(F.struct("token", "fixed")).alias("good"))
    clean = unified.where("size(fixes) = 0").select("field_name", "para_id", "raw_hash", "form")
    mended = _repaired(unified.where("size(fixes) > 0").join(fixes, ["field_name", "para_id", "raw_hash"], "left"))
    return plain, clean.unionByName(mended)


def repairs_by_rule(paragraphs: DataFrame) -> DataFrame:
    """rule, n_tokens, n_values: how many different tokens, and in how many values, each rule repairs.

    'mixed' is the named method: a token of several scripts, towards its own
    dominant one, whose result stands in the corpus. 'towards the text' and
    'foreign' take the script of the rest of the text, 'shared reading' has its
    result from another mixed spelling.
    """
    # A row delivered twice asks twice, which the counts of different tokens and values don't mind.
    _, unified, good = _read(paragraphs)
    rule = F.when(F.col("kind") == SHARED, "shared reading").when(F.col("pref") == MIXED, "mixed").when(F.col("pref") == TOWARDS_TEXT, "towards the text").otherwise("foreign")
    return _met(unified, good).groupBy(rule.alias("rule")).agg(F.countDistinct("token").alias("n_tokens"), F.countDistinct("field_name", "para_id").alias("n_values"))


def normalised(paragraphs: DataFrame) -> DataFrame:
    """field_name, para_id, form: every text and every joined span text in the one form.

    Null and blank values give no row; a row delivered twice comes twice. Very
    long texts are handled whole. An empty table gives an empty result.
    """
    plain, cared = one_form(paragraphs)
    return plain.unionByName(cared.select("field_name", "para_id", "form"))


def _members(paragraphs: DataFrame) -> DataFrame:
    """field_name, key, raw, para_id of values in classes that have more than one spelling."""
    plain, cared = one_form(paragraphs)
    spark = paragraphs.sparkSession
    key = F.struct(F.xxhash64("form"), F.xxhash64("form", F.lit("second")))
    at = scratch(spark, "keys")
    cared.select("field_name", key.alias("key"), F.col("raw_hash").alias("raw"), "para_id").write.parquet(at)
    odd = spark.read.parquet(at)
    even = plain.select("field_name", key.alias("key"), F.xxhash64("form").alias("raw"), "para_id").join(odd.select("field_name", "key").distinct(), ["field_name", "key"], "left_semi")
    rows = odd.unionByName(even).distinct()
    several = rows.groupBy("field_name", "key").agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where("a <> b").select("field_name", "key")
    return rows.join(several, ["field_name", "key"], "left_semi")


def alike_classes(paragraphs: DataFrame) -> DataFrame:
    """field_name, para_id, class_id, n_spellings: the paragraphs whose value is spelt in more than one way, by what it reads as.

    class_id is the least para_id of the class. One row per paragraph and
    field, so copies of one spelling never multiply.
    """
    rows = _members(paragraphs)
    spellings = rows.select("field_name", "key", "raw").distinct().groupBy("field_name", "key").agg(F.count(F.lit(1)).alias("n_spellings"))
    firsts = rows.groupBy("field_name", "key").agg(F.min("para_id").alias("class_id"))
    return rows.join(firsts.join(spellings, ["field_name", "key"]), ["field_name", "key"]).select("field_name", "para_id", "class_id", "n_spellings")


def alike_pairs(paragraphs: DataFrame) -> DataFrame:
    """field_name, para_id_a, para_id_b (a < b): paragraphs whose values read the same and aren't the same string.

    Copies of one string aren't paired with each other. Values meet by two
    64-bit hashes of their form, after classes of a single spelling are gone. A
    very large class is shared by several tasks.
    """
    rows = settled(_members(paragraphs).select("field_name", "key.*", "raw", "para_id").toDF("field_name", "k1", "k2", "raw", "para_id"), "members")
    keys = ["field_name", "k1", "k2"]
    hot = hot_keys(rows, keys, ROWS_PER_TASK // 20)
    a, b = salt_many(rows, hot, keys, ["para_id"]).alias("a"), salt_few(rows, hot, keys).alias("b")
    met = F.expr(" AND ".join(f"a.{k} = b.{k}" for k in [*keys, SALT]) + " AND a.raw <> b.raw AND a.para_id < b.para_id")
    return a.join(b, met).select("a.field_name", F.col("a.para_id").alias("para_id_a"), F.col("b.para_id").alias("para_id_b"))
