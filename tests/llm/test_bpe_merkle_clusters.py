"""Recursive BPE, the Merkle manifest and drift-bounded clusters against brute force."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import pytest
from batchlake.llm import bpe, centroids, merkle, queries
from pyspark.sql import functions as F

# ---- 11: byte-level BPE ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return queries.vocabulary("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pattern():
    import public_tokenizers

    return public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library(ranks, pattern):
    import tiktoken

    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens={})


def _little(ids):
    return np.array(ids, "<u4").tobytes()


def test_recursive_bpe_query(spark, sf, documents, library):
    found = {r["doc_id"]: r for r in queries.QUERIES["op11_recursive_bpe"](spark, sf).collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]
    assert len(found) == len(texts)
    for key, text in texts:
        ids, row = library.encode_ordinary(text), found[key]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(_little(ids)).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_recursive_bpe_odd_rows(odd, none, ranks, pattern, library):
    clashing = odd.withColumn("ids", F.lit("x")).withColumn("word", F.lit(1))
    rows = bpe.decode(bpe.encode(clashing, ranks, pattern), ranks).collect()
    want = Counter((r["doc_id"], _little(library.encode_ordinary(r["text"] or ""))) for r in odd.collect())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == want
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() and r["word"] == 1 for r in rows)
    assert bpe.round_trip(none, ranks, pattern).count() == 0


def test_recursive_bpe_of_random_words(ranks, pattern, library, monkeypatch):
    r, own = random.Random(11), bpe.Recursive(bpe.Merges(ranks), pattern)
    parts = [*"abst\n\t 'é中.,1é\xa0 \x1c\x85　", "  ", "'s", "'ll", " the", "ing", "\r\n", "aa", "  ", "é", "😀"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(1500)]
    texts += ["x" * 30_001, "ab" * 9_000, " " * 5_000 + "y", base64.b64encode(r.randbytes(9_000)).decode()]
    texts += ["".join(r.choice("etaoin") for _ in range(1_500))]
    monkeypatch.setattr(bpe, "STEPS", 5)  # several queries a word
    monkeypatch.setattr(bpe, "WORD_BYTES", 20_000)
    ids, lengths = own.encode(texts)
    ends = np.cumsum(lengths)
    for text, end, n in zip(texts, ends, lengths, strict=True):
        assert ids[end - n : end].tolist() == library.encode_ordinary(text), text[:40]
    monkeypatch.setattr(bpe, "DECODED", 1_000)
    assert bpe.Bytes(ranks).decode(ids, lengths) == [t.encode() for t in texts]
    # An id that is no token has no bytes.
    assert bpe.Bytes(ranks).decode(np.array([4_000_000, ids[0]]), np.array([1, 1]))[0] == b""


# ---- 12: Merkle manifest ---------------------------------------------------------------------


def _levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([merkle.digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 21, 64, 65])
def test_log_positions(n):
    leaves = [merkle.digest(str(i)) for i in range(n)]
    levels, top = _levels(leaves), merkle.height(n)
    log = merkle.append(leaves, top)
    assert len(levels) == top + 1 and len(log) == sum(map(len, levels))
    for level, row in enumerate(levels):
        for i, node in enumerate(row):
            assert log[merkle.position(level, i, n)] == node
    for p in range(n):
        path = "".join(log[merkle.position(level, o, n)] for level, o in merkle.siblings(p, n, top))
        assert merkle.fold(leaves[p], p, n, path) == (levels[-1][0], len(path))


def _plain_leaf(row, more=0):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if more and values[3] is not None:
        values[3] += more
    return merkle.digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _plain_leaf(r)))
        trees.append(_levels([_plain_leaf(r) for r in groups[g]]))
    roof = _levels([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for p, r in enumerate(groups[g]):
            path, changed = [], r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = _plain_leaf(r, int(changed))
            for levels, at in ((trees[k], p), (roof, k)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    path.append(other)
                    node = merkle.digest(other, node) if at & 1 else merkle.digest(node, other)
                    at //= 2
            proof = merkle.digest(*path)
            out.append((r["doc_id"], _plain_leaf(r), trees[k][-1][0], roof[-1][0], proof, node, node == roof[-1][0]))
    return Counter(out)


def _manifest(docs, span):
    return Counter(tuple(r) for r in queries.manifest_rows(docs, span).collect())


@pytest.mark.parametrize("span", [1, 3, 12])
def test_manifest_of_odd_rows(odd, none, span):
    assert _manifest(odd, span) == _plain_manifest(odd.collect())
    assert queries.manifest_rows(none, span).count() == 0


def test_manifest_in_rounds(documents):
    some = documents.where("doc_id < 90 OR lang = 'fr'")
    found = _manifest(some, 2)
    assert found == _plain_manifest(some.collect())
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


# ---- 13: drift-bounded clusters --------------------------------------------------------------


def _plain_clusters(rows, k=8, rounds=10, size=64):
    kept = [
        (key, [int(x) * 1024 if abs(x) >= 2**53 else math.floor(1024 * x) for x in v])
        for key, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    seeds = sorted((hashlib.sha256(f"3:{key}".encode()).hexdigest(), v) for key, v in kept if key is not None)
    centres = [v for _, v in seeds[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), i) for i, c in enumerate(centres))

    for _ in range(rounds):
        sums = defaultdict(list)
        for _, v in kept:
            sums[nearest(v)[1]].append(v)
        for i, members in sums.items():
            centres[i] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(key, *reversed(nearest(v))) for key, v in kept]
    total = Counter()
    for _, c, d in found:
        total[c] += d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    long = lambda x: x if x < 1 << 63 else None
    return Counter((key, c, long(d), long(total[c]), long(sum(total.values())), marks[c]) for key, c, d in found)


def _clustered(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "p") for r in rows], "vec_id bigint, embedding array<double>, pack string")
    found = centroids.cluster(frame, **options)
    return found, Counter(tuple(r) for r in centroids.with_inertia(found).collect())


def test_clusters_odd_rows(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(i % 5, 0.4) for _ in range(6)]) for i in range(300)]
    rows += [(500, None), (501, [1.0]), (502, [math.nan] * 6), (503, [math.inf] * 6), (504, [None] * 6)]
    rows += [(None, [0.5] * 6), (7, [0.25] * 6), (7, [0.25] * 6)] + [(600 + i, [1.0] * 6) for i in range(100)]
    found, got = _clustered(spark, rows, size=6)
    assert got == _plain_clusters(rows, size=6)
    n = sum(got.values())
    assert found.scanned[0] == n and sum(found.scanned[1:]) < 0.7 * n * (len(found.scanned) - 1)
    assert _clustered(spark, rows[:3], size=6)[1] == _plain_clusters(rows[:3], size=6)
    assert _clustered(spark, [], size=6)[1] == Counter()


def test_clusters_of_large_components(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([1, 1e3, 1e6, 1e12]) * r.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100, [1e300, 0.0, 0.0, 1.0]), (101, [-1e300, 0.0, 0.0, 1.0])]
    assert _clustered(spark, rows, k=5, rounds=4, size=4)[1] == _plain_clusters(rows, 5, 4, 4)


def test_loosening_bounds_every_point():
    """No point of a sphere comes closer than the bound says, and the bound is below the full drift."""
    r, tighter = np.random.default_rng(5), 0
    for _ in range(300):
        centre, a = (r.integers(-2000, 2000, 5).tolist() for _ in range(2))
        b = [x + int(d) for x, d in zip(a, r.integers(-300, 300, 5), strict=True)]
        radius = float(r.choice([0, 50, 800]))
        most = centroids.loosening(centre, radius, a, b)
        drift = math.dist(a, b)
        assert most <= drift * (1 + 1e-6)
        tighter += most < 0.95 * drift
        away = r.normal(size=(400, 5))
        points = centre + away / np.linalg.norm(away, axis=1, keepdims=True) * radius * r.random((400, 1))
        falls = np.linalg.norm(points - a, axis=1) - np.linalg.norm(points - b, axis=1)
        assert falls.max() <= most + 1e-6
    assert tighter > 100


def test_clusters_are_read_from_stored_rows(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(40)]
    found = centroids.cluster(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=3, rounds=2, size=4)
    plan = found.assigned._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "MapInArrow" not in plan
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("cluster_")]
