"""Operators over documents against brute force, on the test tables and on odd ones."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import plain
import pyarrow as pa
import pytest
from batchlake.llm import automaton, binary, boosting, components, packing, pii, quality, queries, secrets, simhash, tokens
from pyspark.sql import functions as F


def _rows(frame):
    return [tuple(r) for r in frame.collect()]


def _texts(frame, key="doc_id"):
    return [(r[0], r[1]) for r in frame.select(key, "text").collect()]


# ---- 1: quality rules ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(spark, sf):
    return queries.QUERIES["op1_quality_rules"](spark, sf).cache()


def _hold_counts(found, docs):
    want = Counter()
    for key, text in docs:
        c = plain.quality_counts(text)
        want[(key, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert Counter(_rows(found.select("doc_id", *quality.COUNTS, "base_failed"))) == want


def test_quality_counts(judged, documents):
    _hold_counts(judged, _texts(documents))


def test_quality_verdict(spark, sf, judged):
    assert judged.where("kept AND base_failed").count() == 0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = judged.where("NOT base_failed").join(labels, "doc_id")
    right = found.where((F.col("kept").cast("int")) == F.col("quality")).count()
    assert right >= 0.97 * found.count()


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    half = F.xxhash64("doc_id") % 2 == 0
    model = quality.fit_model(docs, labels.where(half))
    found = quality.judge(docs, model).where("NOT base_failed").join(labels.where(~half), "doc_id")
    good = found.where("quality = 1")
    assert good.where("kept").count() >= 0.98 * good.count()
    poor = found.where("quality = 0")
    assert poor.where("NOT kept").count() >= 0.9 * poor.count()


def test_quality_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (4, None)], "doc_id bigint, quality int")
    model = quality.fit_model(odd, labels)
    found = quality.judge(odd, model)
    _hold_counts(found, _texts(odd))
    assert found.where("kept").count() == 0  # all labels are 0
    constant = quality.fit_model(none, labels)
    assert quality.judge(none, constant).count() == 0
    kept = quality.keep_good(odd, constant)
    assert kept.schema == odd.schema
    assert kept.count() == quality.judge(odd, constant).where("kept").count() > 0


def test_trees_are_monotone():
    r = np.random.default_rng(0)
    x = r.normal(size=(800, 3))
    y = (np.sin(3 * x[:, 0]) - x[:, 1] + x[:, 2] + r.normal(size=800) / 2 > 0).astype(float)
    model = boosting.fit(x, y, [0, -1, 1], trees=40)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.85
    for feature, sign in ((1, -1), (2, 1)):
        for row in x[:40]:
            line = np.repeat(row[None], 50, axis=0)
            line[:, feature] = np.linspace(-3, 3, 50)
            assert (sign * np.diff(model.margin(line)) >= -1e-9).all()


def test_trees_walk_like_nested_nodes():
    r = np.random.default_rng(1)
    x = r.normal(size=(200, 2))
    model = boosting.fit(x, (x[:, 0] > 0).astype(float), [0, 0], trees=5, depth=3)

    def walk(t, node, row, level):
        if level == model.depth:
            return model.value[t, node]
        right = row[model.feature[t, node]] > model.threshold[t, node]
        return walk(t, 2 * node + 1 + right, row, level + 1)

    for row, margin in zip(x[:20], model.margin(x[:20]), strict=True):
        want = model.base + sum(walk(t, 0, row, 0) for t in range(len(model.value)))
        assert abs(want - margin) < 1e-9


# ---- 5: personal data ------------------------------------------------------------------------


def _hold_spans(found, docs, plainly, kinds):
    want = Counter()
    for key, text in docs:
        spans = plainly(text)
        want[(key, *(sum(s[0] == k for s in spans) for k in kinds), plain.digest(spans))] += 1
    columns = ["doc_id", *[f"n_{k}" for k in kinds], "base_sha256"]
    assert Counter(tuple(r[c] for c in columns) for r in found) == want


def test_personal_base_patterns():
    r = random.Random(2)
    parts = [*"@.+-() 019ab%é\n", "a@b.c", "1.2.3.4", "+1 (714) 555-9345", "4111111111111111", "256.1", ".com"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(20)))
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == plain.personal(text), text


def test_personal_data_keeps_the_base(spark, sf, documents):
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal(documents).collect()}
    hits = 0
    for key, text in _texts(documents):
        spans = [(s["kind"], s["start"], s["end"]) for s in found[key]]
        base = plain.personal(text)
        hits += len(base)
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert hits


def test_personal_query(spark, sf, documents):
    found = {r["doc_id"]: r for r in queries.QUERIES["op5_personal_data"](spark, sf).collect()}
    assert len(found) == documents.count()
    for key, text in _texts(documents):
        base, row = plain.personal(text), found[key]
        assert row["base_sha256"] == plain.digest(base), key
        for kind in pii.KINDS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        spans = [tuple(s.split(":")) for s in row["spans"].split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans)


SPELLED = [
    "write mary.ann99 [at] mail.example [dot] co [dot] uk now",
    "A.b (AT) c (DOT) com and j.doe@x.org, then 1 2 3",
    "pay 4111-1111-1111-1112 or 4111 1111 1111 1111 by phone 020 7946 0958",
]


def test_added_spans_stay_out_of_counts_and_digest(spark, sf):
    docs = spark.createDataFrame(list(enumerate(SPELLED)), "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in queries.personal_digest(docs).collect()}
    for key, text in enumerate(SPELLED):
        base, row = plain.personal(text), rows[key]
        assert row["base_sha256"] == plain.digest(base)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == k for b in base) for k in pii.KINDS]
    spelled = "mary.ann99 [at] mail.example [dot] co [dot] uk"
    assert rows[0]["n_email"] == 0 and rows[0]["spans"] == f"email:6:{6 + len(spelled)}"
    assert rows[1]["n_email"] == 1 and rows[1]["spans"].count("email") == 2


def test_personal_query_with_added_spans(spark, sf):
    more = sf.replace("sf0.001", "sf0.01")
    found = {r["doc_id"]: r for r in queries.QUERIES["op5_personal_data"](spark, more).collect()}
    added = 0
    for key, text in _texts(spark.read.parquet(f"{more}/documents.parquet")):
        base = plain.personal(text)
        assert found[key]["base_sha256"] == plain.digest(base), key
        added += len(found[key]["spans"].split(",")) > max(1, len(base))
    assert added


def test_personal_odd_rows(odd, none):
    found = pii.find_personal(odd)
    assert found.count() == odd.count()
    assert found.where("doc_id IN (0, 1, 2, 3)").where("size(spans) > 0").count() == 0
    assert pii.find_personal(none).count() == 0
    masked = pii.mask_personal(odd)
    assert masked.schema == odd.schema
    text = masked.where("doc_id = 8").first()["text"]
    assert text == "mail me: [EMAIL], [IP] or 10.0.0.256, [PHONE]"
    assert masked.where("doc_id = 0").first()["text"] is None


def test_crf_held_out():
    crf, right = pii.model(), 0
    held = pii.examples(300, seed=99)
    for text, entities in held:
        found = [(s, e, k) for k, s, e in pii.region_entities(text, 0, len(text), crf)]
        right += sorted(found) == sorted(entities)
    assert right >= 0.85 * len(held)


def test_crf_decodes_the_best_labelling():
    """Against every labelling of short sequences."""
    from batchlake.llm import semicrf

    r = np.random.default_rng(3)
    for n in (1, 2, 4, 5):
        model = semicrf.Model(r.normal(size=(2, 3)), r.normal(size=(3, 3)))
        x = r.normal(size=(n, semicrf.LONGEST, 3))
        valid = np.arange(n)[:, None] + np.arange(semicrf.LONGEST)[None] < n

        def every(at, n=n):
            if at == n:
                yield []
                return
            for rest in every(at + 1):
                yield [(at, 1, 0), *rest]
            for k in range(min(semicrf.LONGEST, n - at)):
                for rest in every(at + k + 1):
                    for y in (1, 2):
                        yield [(at, k + 1, y), *rest]

        def score(parts, model=model, x=x):
            total, last = 0.0, 0
            for at, units, y in parts:
                total += model.moves[last, y] + (model.weights[y - 1] @ x[at, units - 1] if y else 0)
                last = y
            return total

        best = max(every(0), key=score)
        want = [(a, u, y - 1) for a, u, y in best if y]
        got = semicrf.decode(model, n, lambda a, b, x=x, valid=valid: (x[a:b], valid[a:b]), block=2)
        assert got == want


# ---- 6: secrets ------------------------------------------------------------------------------


def test_automaton_accepts_like_re():
    r = random.Random(4)
    patterns = ["a(b|c)*d", "(ab|a)(c|bcd)", "a{2,3}b?", "[a-c]+d", "x[^a]y", "(a|b)*abb", "a?b?c?"]
    trees = [automaton.parse(p) for p in patterns]
    for pattern, tree in zip(patterns, trees, strict=True):
        auto = automaton.determinise([tree], anywhere=False)
        for _ in range(300):
            text = "".join(r.choice("abcdxy") for _ in range(r.randrange(8)))
            state = 0
            for c in text.encode():
                state = int(auto.step[(state << 8) + c])
            assert bool(auto.accepts[state]) == bool(re.fullmatch(pattern, text)), (pattern, text)


def test_minimal_automaton():
    # (a|b)*abb has four states; one more would be the dead one, which needs another byte.
    assert automaton.determinise([automaton.parse("(a|b)*abb")], anywhere=False).states == 5


def test_lanes_agree_with_one_run():
    auto = secrets.compile_rules(secrets.BASE).backward
    r = np.random.default_rng(5)
    data = r.choice(np.frombuffer(b"abcdef0123 token:=\xff", np.uint8), 5000)
    data[1000:3000] = ord("a")
    state, want = 0, []
    for c in data.tolist():
        state = int(auto.step[(state << 8) + c])
        want.append(state)
    for lanes in (1, 7, 64):
        assert automaton.states_of(auto, data, lanes).tolist() == want


def test_secrets_random_texts():
    r, scanner = random.Random(6), secrets.compile_rules()
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "=", ":", "'", '"', " ", "abc", "AKIA",
             "ABCDEFGH1234", "deadbeef", "0123456789abcdef", "é", "\n", "-"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(2000)]
    for text, spans in zip(texts, secrets.scan(pa.array(texts), scanner), strict=True):
        base = [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] in ("assign", "access", "hex")]
        assert base == plain.secrets(text), text


def test_secrets_query(spark, sf, documents):
    found = queries.QUERIES["op6_secret_automaton"](spark, sf).collect()
    _hold_spans(found, _texts(documents), plain.secrets, ["assign", "access", "hex"])
    assert any(r["spans"] for r in found)


def test_secrets_odd_rows(odd, none):
    found = queries.secret_digest(odd)
    _hold_spans(found.collect(), _texts(odd), plain.secrets, ["assign", "access", "hex"])
    more = secrets.find_secrets(odd).where("doc_id = 11").first()["spans"]
    assert [s["kind"] for s in more] == ["hex", "hex", "github"]
    assert secrets.find_secrets(none).count() == 0


# ---- 7: near duplicates ----------------------------------------------------------------------


def _hold_components(found, docs):
    fps = [plain.fingerprint(t) for _, t in docs]
    label = plain.reachable(sorted(set(fps)))
    group = dict(zip(sorted(set(fps)), label, strict=True))
    least = defaultdict(list)
    for (key, _), fp in zip(docs, fps, strict=True):
        least[group[fp]].append(key)
    want = Counter()
    for (key, _), fp in zip(docs, fps, strict=True):
        ids = [k for k in least[group[fp]] if k is not None]
        want[(key, f"{fp:016x}", min(ids) if ids else None)] += 1
    assert Counter(_rows(found)) == want
    return want


def test_near_duplicates(spark, sf, documents):
    found = queries.QUERIES["op7_simhash_dedup"](spark, sf)
    want = _hold_components(found.select("doc_id", "fingerprint", "component_id"), _texts(documents))
    assert any(k[0] != k[2] for k in want)
    kept = simhash.keep_one(documents)
    assert kept.schema == documents.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({k[2] for k in want})


def test_near_duplicates_odd_rows(odd, none):
    _hold_components(simhash.near_duplicates(odd), _texts(odd))
    kept = simhash.keep_one(odd)
    fps = {plain.fingerprint(t) for _, t in _texts(odd)}
    assert kept.count() == len(set(plain.reachable(sorted(fps))))
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("bucket", [4, 512])
def test_links_of_crowded_buckets(spark, bucket, monkeypatch):
    """Dense balls of fingerprints: pairs in small buckets, neighbours in crowded ones."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(bucket)
    fps = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(40):
            fp = centre
            for _ in range(r.randrange(5)):
                fp ^= 1 << r.randrange(64)
            fps.add(fp)
    fps = sorted(fps)
    label = plain.reachable(fps)
    frame = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    from batchlake.llm import components

    stars = {r["a"]: r["b"] for r in components.stars(simhash.links(frame)).collect()}
    roots = [stars.get(simhash._signed(f), simhash._signed(f)) for f in fps]
    assert len(set(zip(roots, label, strict=True))) == len(set(label)) == len(set(roots))


def test_long_texts_in_blocks(monkeypatch):
    text = "Ab cd  ef\tgh " * 50 + "tail"
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    assert simhash.fingerprint(text) == whole == plain.fingerprint(text)


@pytest.mark.parametrize("hub", [2, 10_000])
def test_components_with_hubs(spark, monkeypatch, hub):
    """A star, a chain and random links: each node gets the smallest of its component, hub or not."""
    monkeypatch.setattr(components, "HUB", hub)
    r = random.Random(9)
    links = [(0, k) for k in range(1, 80)] + [(k, k + 1) for k in range(100, 130)] + [(500, 500)]
    links += [tuple(r.sample(range(200, 260), 2)) for _ in range(45)]
    label = {k: k for pair in links for k in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    assert sorted(map(tuple, components.stars(frame).collect())) == sorted((k, v) for k, v in label.items() if k != v)


# ---- 8 and 9: token ids ----------------------------------------------------------------------


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary())


def test_words_encode_like_whole_texts():
    r, own, whole = random.Random(7), tokens.Encoder(queries.vocabulary()), _tokenizer()
    parts = [*"ab \n\t'.,1é中\xa0 　\x1c\x85-s", "  ", "'s", "'ll", " the", "\r\n", "word.", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        assert own.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_long_texts_encode_in_segments(monkeypatch):
    text = "some words, and  more\n" * 500
    whole = _tokenizer().encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(tokens, "STEP_BYTES", 400)
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    assert "".join(tokens.segments(text, 50)) == text
    assert tokens.Encoder(queries.vocabulary()).encode([text, "x"])[0].tolist()[: len(whole)] == whole


def _ids(docs, end):
    work = _tokenizer()
    return [[*work.encode(t or "", add_special_tokens=False).ids, end] for _, t in docs]


def test_arrow_sequences(spark, sf, documents):
    found = sorted(_rows(queries.QUERIES["op8_arrow_sequences"](spark, sf)))
    docs, start, want = sorted(_texts(documents)), 0, []
    for (key, _), ids in zip(docs, _ids(docs, 0), strict=True):
        want.append((key, start, len(ids), plain.crc(ids)))
        start += len(ids)
    assert found == want


def test_arrow_sequences_odd_rows(odd, none, spark):
    found = binary.round_trip(odd, queries.vocabulary())
    docs = _texts(odd)
    want = Counter((k, len(ids), plain.crc(ids)) for (k, _), ids in zip(docs, _ids(docs, 0), strict=True))
    rows = found.collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert binary.round_trip(none, queries.vocabulary()).count() == 0


def test_sequences_are_views(documents, tmp_path):
    shards = binary.write(documents, queries.vocabulary(), str(tmp_path / "ids"), length=64, rows=8).collect()
    docs = sorted(_texts(documents))
    stream = [i for ids in _ids(docs, 0) for i in ids]
    for row in shards:
        shard = binary.Sequences(row["path"])
        for i in (0, 9, (row["n_tokens"] - 1) // 64):
            ids, bits = shard.sequence(i)
            mask = shard.mask(i)
            assert len(ids) == len(mask) == 8 * len(bits) == 64
            assert not ids.flags.owndata and not bits.flags.owndata
            begin = row["start"] + 64 * i
            stop = min(begin + 64, row["start"] + row["n_tokens"])
            assert ids[mask].tolist() == stream[begin:stop]
            assert mask.sum() == stop - begin


def test_a_task_that_runs_again_leaves_one_shard(tmp_path):
    """A first attempt dies after some record batches; the second one writes the shard anew."""
    ids, keys = np.arange(100, dtype=np.uint16), pa.array([1, 2])
    lengths = np.array([60, 40])

    dead = binary._Shard(str(tmp_path / "shard-000000"), pa.uint16(), pa.int64(), 16, 2)
    dead.add(keys, ids[::-1].copy(), lengths)
    for _ in range(2):  # also if the attempt after a finished one runs
        alive = binary._Shard(str(tmp_path / "shard-000000"), pa.uint16(), pa.int64(), 16, 2)
        alive.add(keys, ids, lengths)
        alive.close()
    found = binary.Sequences(str(tmp_path / "shard-000000"))
    assert np.concatenate(list(found.span(0, 100))).tolist() == ids.tolist()
    assert found.mask(6).sum() == 4 and found.mask(0).all()
    assert [b.column("n").to_pylist() for b in found.index()] == [[60, 40]]


def test_shards_keep_the_order():
    """Ranges follow (id, tie), and an id that holds most rows is spread over its bounds."""
    r = np.random.default_rng(3)
    ids = np.where(r.random(4000) < 0.6, 7, r.integers(0, 15, 4000))
    ties = r.integers(-(2**63), 2**63 - 1, 4000)
    bounds = np.sort(ids)[[500 * k for k in range(1, 8)]]
    shard = binary._shard_of(pa.array(ids), ties, bounds)
    order = np.lexsort((ties, ids))
    assert (np.diff(shard[order]) >= 0).all() and np.bincount(shard).max() < 1200
    assert binary._shard_of(pa.array([None, 3], pa.int64()), np.zeros(2, np.int64), bounds)[0] == 0


def _hold_packing(rows, docs, capacity=2048):
    left = Counter()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    # Pieces of one row follow each other; equal ids share pieces of all their rows.
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    want = defaultdict(list)
    for (key, _), ids in zip(docs, _ids(docs, 1), strict=True):
        want[key].append(ids)
    assert set(pieces) == set(want)
    for key, lists in want.items():
        assert sum(p[1] for p in pieces[key]) == sum(map(len, lists))
        if len(lists) == 1:
            ids, at = lists[0], 0
            for start, length, crc, total in sorted(pieces[key]):
                assert (start, total) == (at, len(ids)) and crc == plain.crc(ids[at : at + length])
                at += length
            assert at == len(ids)
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        left[at] += 1
    return windows


def test_packing(spark, sf, documents):
    rows = queries.QUERIES["op9_packing"](spark, sf).collect()
    windows = _hold_packing(rows, _texts(documents))
    total = sum(r["length"] for r in rows)
    tasks = documents.rdd.getNumPartitions()
    assert 2048 * len(windows) <= 1.02 * total + 2048 * tasks


def test_packing_odd_rows(odd, none):
    _hold_packing(packing.pack(odd, queries.vocabulary()).collect(), _texts(odd))
    assert packing.pack(none, queries.vocabulary()).count() == 0


def test_differencing():
    assert sorted(map(len, packing.differencing([], 3))) == [0, 0, 0]
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in s) for s in packing.differencing([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]  # the textbook case: differencing ends at 2, the best is 0
    r = random.Random(8)
    for _ in range(50):
        sizes = [r.randint(1, 512) for _ in range(r.randint(1, 200))]
        sets = packing.deal(sizes, 2048)
        assert sorted(i for s in sets for i in s) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in s) for s in sets) <= 2048
    # Three pieces of 1,500 need a window each, though two windows would hold their sum.
    assert len(packing.deal([1500, 1500, 1000], 2048)) == 3


def test_hash_of_nothing():
    assert plain.digest([]) == hashlib.sha256(b"").hexdigest()
