"""Near-duplicate documents by SimHash, with pivot distance tables.

Fingerprints: a bit is set if it is set in over half the XXH64 hashes of the word shingles. The
distinct fingerprints are then linked at a small Hamming distance:

* Candidates share three of five bit blocks, as any two fingerprints at distance 2 or less do. So a
  fingerprint goes to ten buckets, each keyed by about 38 bits.
* In a bucket, a table holds each fingerprint's Hamming distances to ``PIVOTS`` reference
  fingerprints. By the triangle inequality these differ by at most 2 between linked ones, so pairs
  with a larger maximum coordinate difference are discarded (the first coordinate is the sort order
  of the bucket, so most are never formed) and the survivors verified.
* A bucket of more than ``BUCKET`` fingerprints would need too many pairs. Its members instead meet
  at the fingerprints one bit away: two at distance 2 have such a neighbour in common, and only
  ``1 + free bits`` fingerprints can share one. No link is lost and no group is unbounded.

A bucket gives one link per member at most (its smallest partner by reach), components come from
rounds of stars over distinct fingerprints. Copies are never paired.

Defined results: null and empty texts have fingerprint zero and link like any other. Rows without
an id get a component like all others, and a component of such rows only has a null id. Repeated
rows are all returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlake.llm import components
from batchlake.llm.arrow import ship, steps, with_columns
from batchlake.session import materialize

SHINGLE, DISTANCE, SEED = 3, 2, 42
PIVOTS = 16
BUCKET = 512
_BLOCK = 1 << 20

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _masks() -> list[int]:
    """Masks of three of five bit blocks: those every pair at distance 2 has one of in common."""
    edges = [64 * k // 5 for k in range(6)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [a | b | c for a, b, c in combinations(blocks, 3)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


MASKS = _masks()


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of their numbers, half their bits set on average."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % k, SEED) for k in range(n)], np.uint64)


# ---- fingerprints ----------------------------------------------------------------------------


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Words of a long text, a block at a time."""
    rest = b""
    for begin in range(0, len(data), _BLOCK):
        block = rest + data[begin : begin + _BLOCK]
        words = block.split()
        rest = words.pop() if words and block[-1:].strip() else b""
        yield words
    yield [rest] if rest else []


def _bit_counts(words: list[bytes], width: int) -> np.ndarray:
    """How many shingles of ``width`` words have each bit set, the highest bit first."""
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: len(words) - width + 1].tolist()
    parts = map(joined.__getitem__, map(slice, begins, ends[width - 1 :].tolist()))
    digests = b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED)))
    planes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    if len(planes) < 256:
        return np.unpackbits(planes, axis=1).sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(planes[:, k], minlength=256) @ _BITS for k in range(8)])


def fingerprint(text: str, width: int = SHINGLE) -> int:
    data = text.encode().lower()
    counts, n, held = np.zeros(64, np.int64), 0, []
    for words in [data.split()] if len(data) <= _BLOCK else _words(data):
        held += words
        if len(held) >= width:
            counts += _bit_counts(held, width)
            n += len(held) - width + 1
            held = held[len(held) - width + 1 :]
    if not n and held:
        counts, n = _bit_counts(held, len(held)), 1
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """``id``, ``fp`` (BIGINT) and ``mark`` (hash of the text) per document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            found = [fingerprint(t or "", width) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(doc_id), pa.array(np.array(found, np.uint64).view(np.int64)), batch.column("_mark")],
                ["id", "fp", "mark"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = with_columns(docs, doc_id, text).withColumn("_mark", F.xxhash64(text))
    return rows.mapInArrow(run, f"id {kind}, fp bigint, mark bigint")


# ---- links -----------------------------------------------------------------------------------


def _reach(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` nodes reaches over the links ``a``, ``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def bucket_links(bucket: np.ndarray, fps: np.ndarray, refs: np.ndarray, most: int = DISTANCE):
    """Links (fingerprint, smaller one) inside buckets; ``bucket`` numbers them in sorted order."""
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], bucket))
    bucket, fps, table = bucket[order], fps[order], table[order]
    near, pairs = np.arange(len(fps)), []
    for step in range(1, len(fps)):
        near = near[near + step < len(fps)]
        near = near[
            (bucket[near] == bucket[near + step])
            & (table[near + step, 0] - table[near, 0] <= most)
        ]
        if not len(near):
            break
        left = near[np.abs(table[near + step] - table[near]).max(axis=1) <= most]
        left = left[np.bitwise_count(fps[left] ^ fps[left + step]) <= most]
        pairs.append((left, left + step))
    if not pairs:
        return fps[:0], fps[:0]
    label = _reach(len(fps), *(np.concatenate(side) for side in zip(*pairs, strict=True)))
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, mask, fp) sorted by bucket to links, and the members of crowded buckets with
    their mask number. Holds one batch and at most ``BUCKET`` rows of an open bucket."""
    refs = pivots()
    part, mask, fps = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64))
    crowded = None

    def out(a, b, k) -> pa.RecordBatch:
        arrays = [pa.array(a), pa.array(b), pa.array(k, pa.int32())]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "mask"])

    def settle(part, mask, fps):
        """All buckets complete: links of the small ones, members of the crowded ones."""
        nonlocal crowded
        new = np.concatenate(([True], (part[1:] != part[:-1]) | (mask[1:] != mask[:-1])))
        bucket = np.cumsum(new) - 1
        sizes = np.bincount(bucket)
        wide = sizes[bucket] > BUCKET
        if crowded is not None:
            wide |= (part == crowded[0]) & (mask == crowded[1])
        if wide.any():
            yield out(fps[wide], fps[wide], mask[wide])
        pick = ~wide & (sizes[bucket] > 1)
        if pick.any():
            a, b = bucket_links(bucket[pick], fps[pick].view(np.uint64), refs)
            yield out(a.view(np.int64), b.view(np.int64), np.full(len(a), -1))

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "mask", "fp"))
        part, mask, fps = (
            np.concatenate(pair) for pair in zip((part, mask, fps), columns, strict=True)
        )
        last = np.flatnonzero((part != part[-1]) | (mask != mask[-1]))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield from settle(part[:cut], mask[:cut], fps[:cut])
            part, mask, fps, crowded = part[cut:], mask[cut:], fps[cut:], None
        if len(part) > BUCKET:
            crowded = (part[-1], mask[-1])
            yield out(fps, fps, mask)
            part, mask, fps = part[:0], mask[:0], fps[:0]
    if len(part):
        yield from settle(part, mask, fps)


def links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` at distance 2 or less."""
    ship(distinct.sparkSession)
    buckets = F.array(
        *[F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(MASKS)]
    )
    sent = distinct.select("fp", F.inline(buckets)).select("part", F.col("mask").cast("bigint"), "fp")
    sorted_ = sent.repartition("part", "mask").sortWithinPartitions("part", "mask")
    found = materialize(sorted_.mapInArrow(_scan, "a bigint, b bigint, mask int"), "buckets")

    free = F.lit(None)
    for k, m in enumerate(MASKS):
        free = F.when(F.col("mask") == k, F.lit(_signed(~m & (1 << 64) - 1))).otherwise(free)
    wide = found.where("mask >= 0").groupBy(F.col("a").alias("fp")).agg(F.bit_or(free).alias("free"))
    flips = F.filter(
        F.array(*[F.lit(_signed(1 << b)) for b in range(64)]),
        lambda bit: F.col("free").bitwiseAND(bit) != 0,
    )
    meet = wide.select(
        "fp",
        F.explode(F.concat(F.array("fp"), F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit)))).alias("z"),
    )
    # At most 65 fingerprints lie within one bit of z, so these lists are short.
    shared = meet.groupBy("z").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    star = shared.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a != b")
    return found.where("mask < 0").select("a", "b").unionByName(star.distinct())


def _classes(docs: DataFrame, width: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Stored fingerprint rows, and per fingerprint the root of its component."""
    rows = materialize(fingerprints(docs, width, doc_id, text), "fingerprints")
    distinct = rows.select("fp").distinct()
    stars = components.stars(links(distinct)).toDF("fp", "root")
    return rows, stars


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex) and ``component_id``, the smallest id that
    can be reached over links."""
    rows, stars = _classes(docs, width, doc_id, text)
    # Minima per fingerprint and per component are combined before they are shuffled.
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = least.join(stars, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(known, "fp").select(
        F.col("id").alias(doc_id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, width: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: of each component the one with the smallest id (rows
    without an id last, then by text hash), once."""
    rows, stars = _classes(docs, width, doc_id, text)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("first")
    least = rows.groupBy("fp").agg(first)
    chosen = (
        least.join(stars, "fp", "left")
        .groupBy(F.coalesce("root", "fp"))
        .agg(F.min("first").alias("first"))
        .select(F.xxhash64("first.id").alias("_key"), F.col("first.mark").alias("_mark"), F.col("first.id").alias("_id"))
    )
    names = docs.columns
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.xxhash64(doc_id).alias("_key"),
        F.xxhash64(text).alias("_mark"),
        F.col(doc_id).alias("_doc"),
    )
    # The last condition is no join key, so the rows stay where the keys put them for what follows.
    same = (
        (keyed["_key"] == chosen["_key"])
        & (keyed["_mark"] == chosen["_mark"])
        & F.coalesce(keyed["_doc"] == chosen["_id"], keyed["_doc"].isNull() & chosen["_id"].isNull())
    )
    kept = keyed.join(chosen, same, "left_semi").dropDuplicates(["_key", "_mark"])
    return kept.select(*[F.col("_row")[n].alias(n) for n in names])
