"""Byte-level BPE by recursive SQL: DuckDB runs inside each Spark task, next to its partition.

Encoding. A text is cut by the vocabulary's pattern; each different match is encoded once per worker.
A match that is a token is that token. The others become a table of token positions, first one row
per byte. One recursive query joins neighbouring positions with the merge table, finds each
word's least rank and contracts the pairs of that rank, until no word has a pair left.

Two facts make a step do more than one contraction, with the ids of the plain rule:

* A token is only ever made from one pair, the one that merging its own bytes by lower ranks ends
  in. The merge table holds these pairs alone, so a merge never makes a pair of the same or a
  lower rank, and all pairs of the least rank may go in one step. Where pairs of a rank overlap (its
  two halves are alike) every second one of a run goes, from the left.
* Where no token holds two bytes side by side, no merge crosses them. A word is cut there, and its
  parts contract side by side.

A query runs ``STEPS`` steps and hands its positions to the next one, so memory doesn't grow with
the number of steps. One word without any such cut takes as many steps as it uses ranks, each
over all its positions.

Decoding joins the positions of a text with the vocabulary and aggregates the bytes in order.

Defined results: null and empty texts have no ids; ids that the vocabulary lacks have no bytes. Other
columns are passed on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from batchlake.llm.arrow import ragged, ship, steps, sums, text_bytes
from batchlake.llm.tokens import Encoder, _Store

#: Steps of one recursive query; bytes of new words, and ids of texts, that one query takes.
STEPS, WORD_BYTES, DECODED = 24, 1 << 18, 1 << 18
#: Memory of a worker's database. It has no folder to spill to.
MEMORY = "400MB"

#: Positions with the rank of the pair they begin, doubled, plus 1 if the halves of the pair are alike.
#: ``word`` numbers the parts that contract on their own; each ends in a position of id -1, so that no
#: pair reaches beyond it. Positions of parts that have no pair left come out with step -1. A mark is a
#: position's id, doubled, plus 1 if it begins a contraction.
_CONTRACT = """
WITH RECURSIVE steps(word, step, pos, id, rank) AS (
  SELECT word, 0, pos, id, rank
  FROM (SELECT *, lead(id) OVER (ORDER BY pos) AS next FROM positions) AS p
  LEFT JOIN merges ON pair = p.id::BIGINT * 4294967296 + p.next
  UNION ALL (
    WITH least AS (
      SELECT word, min(rank) AS low FROM steps WHERE step BETWEEN 0 AND {steps} - 1 GROUP BY word
    ), paired AS (
      SELECT s.*, low, rank IS NOT DISTINCT FROM low AS hit
      FROM steps AS s JOIN least USING (word) WHERE step >= 0
    ), marked AS (
      SELECT word, step, pos, CASE WHEN hit THEN low | 1 ELSE id * 2 END AS mark
      FROM paired WHERE low & 1 = 0
      UNION ALL
      SELECT word, step, pos, CASE WHEN hit AND (nth - coalesce(
        max(CASE WHEN NOT hit THEN nth END) OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1
        THEN low ELSE id * 2 END
      FROM (
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY pos) AS nth
        FROM paired WHERE low & 1 = 1
      )
    ), around AS (
      SELECT *, lag(mark) OVER w AS before, lead(mark) OVER w AS after, lead(mark, 2) OVER w AS later
      FROM marked WINDOW w AS (ORDER BY pos)
    ), contracted AS (
      SELECT word, step + 1 AS step, pos, mark >> 1 AS id,
        (CASE WHEN mark & 1 = 1 THEN later ELSE after END) >> 1 AS next
      FROM around WHERE before IS NULL OR before & 1 = 0
    )
    SELECT word, step, pos, c.id, rank
    FROM contracted AS c LEFT JOIN merges ON pair = c.id::BIGINT * 4294967296 + c.next
    UNION ALL
    SELECT word, -1, pos, id, rank FROM paired WHERE low IS NULL
  )
)
SELECT word, step, pos, id FROM steps WHERE step IN (-1, {steps}) ORDER BY pos
"""

_DECODE = """
SELECT text, string_agg(bytes, '' ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary USING (id) GROUP BY text
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a vocabulary file and their ranks, which are their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def _parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What merging a token's bytes by ranks below its own ends in."""
    own, parts = ranks[token], [token[k : k + 1] for k in range(len(token))]
    found = [ranks.get(a + b, own) for a, b in zip(parts, parts[1:], strict=False)]
    while found and (least := min(found)) < own:
        k = found.index(least)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del found[k]
        for i in (k - 1, k):
            if 0 <= i < len(found):
                found[i] = ranks.get(parts[i] + parts[i + 1], own)
    return parts


class Database:
    """A database of this process, with tables and queries over given columns."""

    def __init__(self):
        import duckdb

        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})

    def store(self, name: str, **columns) -> None:
        self.con.register("given", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def query(self, sql: str, name: str, **columns) -> dict[str, np.ndarray]:
        self.con.register(name, pa.table({k: pa.array(v) for k, v in columns.items()}))
        found = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return {c: found.column(c).to_numpy() for c in found.column_names}


class Merges:
    """The merge table of a vocabulary: words to ids."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        #: Tokens that are texts; a word that is no token is none of the others either.
        self.tokens = {t.decode(): r for t, r in self.ranks.items() if t.decode(errors="ignore").encode() == t}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [p for p in (_parts(t, self.ranks) for t in self.ranks if len(t) > 1) if len(p) == 2]
        a, b = (np.array([self.ranks[p[k]] for p in pairs], dtype=np.int64) for k in (0, 1))
        rank = np.array([self.ranks[p[0] + p[1]] for p in pairs], dtype=np.int64)
        #: Whether some token holds two bytes side by side.
        self.beside = np.zeros(1 << 16, dtype=bool)
        for token in self.ranks:
            held = np.frombuffer(token, np.uint8).astype(np.int64)
            self.beside[held[:-1] * 256 + held[1:]] = True
        self.tables = Database()
        self.tables.store("merges", pair=a << 32 | b, rank=(2 * rank + (a == b)).astype(np.int32))

    def _contract(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are no tokens, in a row, and how many each has."""
        data, lengths = text_bytes(column)
        data = data.astype(np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        last = np.ones(len(data), dtype=bool)
        last[:-1] = (owner[1:] != owner[:-1]) | ~self.beside[data[:-1] * 256 + data[1:]]
        part = np.cumsum(last) - last
        place = np.arange(len(data)) + part  # a gap after each part, for its end
        size = len(data) + int(last.sum())
        ids, parts = np.full(size, -1, dtype=np.int32), np.empty(size, dtype=np.int32)
        ids[place], parts[place] = self.byte[data], part
        parts[place[last] + 1] = part[last]
        now = {"word": parts, "pos": np.arange(size, dtype=np.int32), "id": ids}
        done = []
        while len(now["pos"]):
            found = self.tables.query(_CONTRACT.format(steps=STEPS), "positions", **now)
            ended = found["step"] < 0
            done.append((found["pos"][ended], found["id"][ended]))
            now = {k: found[k][~ended] for k in ("word", "pos", "id")}
        pos, ids = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        kept = np.argsort(pos)
        kept = kept[ids[kept] >= 0]
        owners = np.zeros(size, dtype=np.int64)
        owners[place] = owner
        return ids[kept].astype(np.uint32), np.bincount(owners[pos[kept]], minlength=len(lengths)).astype(np.int64)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without a cut by the pattern, in a row, and how many each has."""
        column = pa.array(words, pa.string())
        whole = np.fromiter(map(self.tokens.get, words, repeat(-1)), np.int64, len(words))
        lengths = np.ones(len(words), dtype=np.int64)
        open_ = np.flatnonzero(whole < 0)
        ids = []
        ends = np.cumsum(text_bytes(column)[1][open_])
        begin = 0
        while begin < len(open_):
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + WORD_BYTES, side="right")))
            some = open_[begin:end]
            found, lengths[some] = self._contract(column.take(pa.array(some)))
            ids.append(found)
            begin = end
        out = np.empty(int(lengths.sum()), dtype=np.uint32)
        alone = np.repeat(whole >= 0, lengths)
        out[alone] = whole[whole >= 0]
        out[~alone] = np.concatenate([np.zeros(0, np.uint32), *ids])
        return out, lengths


class Bytes:
    """The bytes of a vocabulary's tokens: ids to texts."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        tokens = [t.decode("latin-1") for t in ranks]  # a character per byte
        self.tables = Database()
        self.tables.store("vocabulary", id=np.array(list(ranks.values()), dtype=np.int64), bytes=tokens)

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The bytes of texts, given all their ids in a row and how many each has."""
        text = np.repeat(np.arange(len(lengths)), lengths)
        parts: list[list[str]] = [[] for _ in lengths]
        for begin in range(0, len(ids), DECODED):
            some = slice(begin, begin + DECODED)
            pos = np.arange(len(ids[some]))
            found = self.tables.query(_DECODE, "tokens", text=text[some], pos=pos, id=ids[some].astype(np.int64))
            for k, part in zip(found["text"], found["bytes"], strict=True):
                parts[k].append(part)
        return ["".join(p).encode("latin-1") for p in parts]


class Recursive(Encoder):
    """Texts to ids: blanks, pieces and words are looked up as in ``Encoder``, new words go to the merges."""

    def __init__(self, merges: Merges, pattern: str):
        import regex

        self.specials, self.words, self.pieces = [], _Store(), _Store()
        self.merges, self.matches = merges, regex.compile(pattern).findall

    def _learn(self, words: list[str]) -> None:
        found = [self.matches(w) for w in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = list(chain.from_iterable(found))
        new = list(dict.fromkeys(flat))
        ids, lengths = self.merges.words(new)
        if len(new) < len(flat) or len(new) > len(words):
            code = np.fromiter(map({m: k for k, m in enumerate(new)}.get, flat), np.int64, len(flat))
            ids = ids[ragged((np.cumsum(lengths) - lengths)[code], lengths[code])]
            lengths = sums(lengths[code], counts)
        self.words.add(words, lengths, ids)


@cache
def _encoder(path: str, pattern: str) -> Recursive:
    """The worker's encoder."""
    return Recursive(Merges(path), pattern)


@cache
def _bytes(path: str) -> Bytes:
    """The worker's decoder."""
    return Bytes(path)


def _mapped(frame: DataFrame, source: str, **made) -> DataFrame:
    """``frame`` with binary columns, each made from the batch and the ones before it. Whatever else
    has such a name is replaced."""
    kept = [f for f in frame.schema.fields if f.name not in made]
    schema = T.StructType([*kept, *(T.StructField(name, T.BinaryType()) for name in made)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, source):
            columns = {n: batch.column(n) for n in batch.schema.names}
            for name, make in made.items():
                columns[name] = pa.array(make(columns), pa.binary())
            names = [f.name for f in schema.fields]
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def _encoding(vocabulary: str, pattern: str, text: str):
    def make(columns: dict[str, pa.Array]) -> list[bytes]:
        given = pa.compute.fill_null(columns[text].cast(pa.string()), "")
        found, lengths = _encoder(vocabulary, pattern).encode(given)
        data = found.astype("<u4").tobytes()
        ends = 4 * np.cumsum(lengths)
        return [data[e - 4 * n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]

    return make


def _decoding(vocabulary: str, ids: str):
    def make(columns: dict[str, pa.Array]) -> list[bytes]:
        column = [v or b"" for v in columns[ids].to_pylist()]
        lengths = np.array([len(v) // 4 for v in column], dtype=np.int64)
        return _bytes(vocabulary).decode(np.frombuffer(b"".join(column), "<u4"), lengths)

    return make


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text as little-endian unsigned 32-bit integers.

    The pattern has to be the one of byte-level BPE (words with their leading blank), as
    ``tokens`` cuts texts at blanks ahead of it.
    """
    return _mapped(docs, text, **{ids: _encoding(vocabulary, pattern, text)})


def decode(frame: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``frame`` with the bytes that each row's ids stand for."""
    return _mapped(frame, ids, **{decoded: _decoding(vocabulary, ids)})


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``decode`` of ``encode`` by one worker per task instead of two."""
    return _mapped(docs, text, **{ids: _encoding(vocabulary, pattern, text), decoded: _decoding(vocabulary, ids)})
