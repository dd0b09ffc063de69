"""Encoding of a corpus with a public byte-level BPE, merged by recursive queries inside each partition."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

#: Where the vocabulary file lies; a parameter of every operator here, never copied.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The pattern that cuts text into words before any merge, as the tokenizer publishes it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Steps that one recursive query may take before its unfinished words go into the next; bounds its memory, not the result.
STEPS = 48
#: Words whose ids a worker keeps; beyond it the store begins anew, which costs time only.
KEPT_WORDS = 1_000_000
#: Letters that one recursive query takes at a time (a longer word alone); bounds its memory, not the result.
LETTERS = 1_000_000


def _byte_of_sign() -> dict[str, int]:
    """The published signs for bytes: printable ones stand for themselves, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id of each byte, merge table of left id, right id, merged id, whether two bytes ever stand together in a token)."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, signs = model["vocab"], _byte_of_sign()
    byte_ids = np.zeros(256, np.int32)
    for sign, b in signs.items():
        byte_ids[b] = vocab[sign]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int32)
    if not (np.diff(merges[:, 2]) > 0).all() or (merges[:, :2].max(axis=1) >= merges[:, 2]).any():
        raise ValueError("the merged ids of this vocabulary don't follow the order of its merges")
    together = np.zeros((256, 256), bool)
    for a, b in pairs:
        together[signs[a[-1]], signs[b[0]]] = True
    return byte_ids, merges, together


#: One step for all words that aren't finished: every row meets the merge of itself and its right neighbour; of each word
#: the pair of least rank is contracted, leftmost first. Further places of the same pair that don't overlap go in the same
#: step: a merge made of them has a greater id, so no other pair can come between. In a run of overlapping places the odd
#: ones are contracted. A word without any pair leaves the recursion, and its last state stands.
_MERGE = f"""
WITH RECURSIVE state(wid, pos, tok, step) AS (
  SELECT wid, pos, tok, 0 FROM words
  UNION ALL
  SELECT wid, pos, CASE WHEN takes THEN best ELSE tok END, step + 1
  FROM (
    SELECT *, coalesce(lag(takes) OVER (PARTITION BY wid ORDER BY pos), false) AS taken
    FROM (
      SELECT *, hit AND (count(*) FILTER (hit) OVER (PARTITION BY wid, run ORDER BY pos)) % 2 = 1 AS takes
      FROM (
        SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY wid ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run
        FROM (
          SELECT *, coalesce(merged = best, false) AS hit
          FROM (
            SELECT p.wid, p.pos, p.tok, p.step, m.merged, min(m.merged) OVER (PARTITION BY p.wid) AS best
            FROM (SELECT wid, pos, tok, step, lead(tok) OVER (PARTITION BY wid ORDER BY pos) AS right_tok FROM state WHERE step < {STEPS}) p
            LEFT JOIN merges m ON m.l = p.tok AND m.r = p.right_tok)
          WHERE best IS NOT NULL))))
  WHERE NOT taken
)
SELECT wid, pos, tok, step FROM (SELECT *, max(step) OVER (PARTITION BY wid) AS last FROM state) WHERE step = last
"""
#: Ids of words: the tokens of their pieces in order.
_DECODE = "INSERT INTO known SELECT {base} + word, list(tok ORDER BY pos)::INTEGER[] FROM done JOIN pieces USING (wid) GROUP BY word"
#: Ids of texts: those of their words in order.
_TEXTS = "SELECT t.doc, coalesce(x.ids, []) AS ids FROM texts t LEFT JOIN (SELECT doc, flatten(list(ids ORDER BY nth)) AS ids FROM said JOIN known USING (wid) GROUP BY doc) x USING (doc) ORDER BY t.doc"
_COUNTS = "SELECT t.doc, coalesce(x.n, 0)::INTEGER AS n FROM texts t LEFT JOIN (SELECT doc, sum(len(ids)) AS n FROM said JOIN known USING (wid) GROUP BY doc) x USING (doc) ORDER BY t.doc"


class Encoder:
    """Token ids by recursive queries and ordered aggregates; one per worker. Nothing is written outside its memory."""

    def __init__(self, byte_ids: np.ndarray, merges: np.ndarray, together: np.ndarray):
        import duckdb
        import regex

        self.byte_ids, self.together = byte_ids, together
        self.words = regex.compile(PATTERN).findall
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "700MB", "temp_directory": ""})
        self.con.register("merges_in", pa.table({"l": merges[:, 0], "r": merges[:, 1], "merged": merges[:, 2]}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.con.execute("CREATE OR REPLACE TABLE known (wid INTEGER, ids INTEGER[])")

    def learn(self, new: list[str]) -> None:
        """Adds the ids of words not met before, a bounded number of letters at a time (a single longer word whole)."""
        part: list[str] = []
        size = 0
        for w in new:
            if part and size + len(w) > LETTERS:
                self._learn(part)
                part, size = [], 0
            part.append(w)
            size += len(w)
        if part:
            self._learn(part)

    def _learn(self, new: list[str]) -> None:
        raw = [w.encode("utf-8", "replace") for w in new]
        size = np.array([len(b) for b in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        word = np.repeat(np.arange(len(raw), dtype=np.int64), size)
        # A place where no token has these two bytes side by side can't be merged over: a piece ends there.
        cut = np.ones(len(data), bool)
        cut[1:] = (word[1:] != word[:-1]) | ~self.together[data[:-1], data[1:]]
        piece = np.cumsum(cut) - 1
        base = len(self.known)
        self.con.register("pieces", pa.table({"wid": piece[cut], "word": word[cut]}))
        self.con.execute("CREATE OR REPLACE TABLE done (wid BIGINT, pos BIGINT, tok INTEGER)")
        self.con.register("words", pa.table({"wid": piece, "pos": np.arange(len(data), dtype=np.int64), "tok": self.byte_ids[data]}))
        left = len(data)
        while left:
            self.con.execute(f"CREATE OR REPLACE TABLE state_now AS {_MERGE}")
            self.con.execute(f"INSERT INTO done SELECT wid, pos, tok FROM state_now WHERE step < {STEPS}")
            t = self.con.sql(f"SELECT wid, pos, tok FROM state_now WHERE step >= {STEPS}").to_arrow_table()
            self.con.register("words", t)
            left = t.num_rows
        self.con.execute(_DECODE.format(base=base))
        self.known.update((w, base + i) for i, w in enumerate(new))

    def _said(self, texts: list[str | None]) -> None:
        if len(self.known) > KEPT_WORDS:
            self.forget()
        split = [self.words(t) if t else [] for t in texts]
        new = {w for ws in split for w in ws} - self.known.keys()
        if new:
            self.learn(sorted(new))
        sizes = np.array([len(ws) for ws in split], np.int64)
        wid = np.fromiter(map(self.known.__getitem__, (w for ws in split for w in ws)), np.int32, int(sizes.sum()))
        self.con.register("said", pa.table({"doc": np.repeat(np.arange(len(texts), dtype=np.int32), sizes), "nth": np.arange(len(wid), dtype=np.int32), "wid": wid}))
        self.con.register("texts", pa.table({"doc": np.arange(len(texts), dtype=np.int32)}))

    def encode(self, texts: list[str | None]) -> pa.Array:
        """The list of ids of each text; none for an empty or null text."""
        self._said(texts)
        ids = self.con.sql(_TEXTS).to_arrow_table().column("ids").combine_chunks()
        return (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).cast(pa.list_(pa.int32()))

    def count(self, texts: list[str | None]) -> pa.Array:
        """The number of ids of each text."""
        self._said(texts)
        n = self.con.sql(_COUNTS).to_arrow_table().column("n").combine_chunks()
        return n.combine_chunks() if isinstance(n, pa.ChunkedArray) else n


_WORKER: dict[str, Encoder] = {}


def _encoder(path: str, vocabulary: Broadcast) -> Encoder:
    if path not in _WORKER:
        _WORKER[path] = Encoder(*vocabulary.value)
    return _WORKER[path]


def _slices(batch: pa.RecordBatch, column: int, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded text size, so that memory doesn't follow the length of texts (a single long one stays whole)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def token_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """id_col and ids ARRAY<INT>: the token ids of each text, without special tokens.

    An empty or null text has an empty list. Strings of special tokens inside a
    text are ordinary text. Every input row gives one row, so repeated rows stay
    repeated; other columns are left out. No shuffle: each partition cuts its
    texts into words, merges every distinct word once by a recursive query over
    (word, position, token) rows and the merge table, and aggregates the ids of
    words and then of texts in order. Broadcast: the merge table of the public vocabulary (50,000 rows).
    """
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, vocabulary)
        for whole in batches:
            for b in _slices(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), enc.encode(b.column(1).to_pylist())], [id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids ARRAY<INT>")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = TOKENIZER) -> DataFrame:
    """id_col and n_tokens INT, by the same encoding; 0 for an empty or null text."""
    spark: SparkSession = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, vocabulary)
        for whole in batches:
            for b in _slices(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), enc.count(b.column(1).to_pylist())], [id_col, "n_tokens"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens INT")
