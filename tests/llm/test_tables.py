"""Operators over vectors, conversations and pages, the mix and the pipeline."""

import hashlib
import html as html_module
import math
import random
import re
import time
from collections import Counter, defaultdict
from decimal import Decimal

import compare
import corpus_pipeline
import numpy as np
import plain
import pytest
from batchlake.llm import chat, html, mixing, queries, topk
from batchlake.session import materialize
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert compare.differences(queries.QUERIES[name](spark, sf), con, queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op3_chat_reply_trees", "op4_hierarchical_mix"])
def test_native_plans(spark, sf, name):
    plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "Cartesian", "BroadcastNestedLoop"):
        assert node not in plan


# ---- 2: top-k --------------------------------------------------------------------------------


def _plain_top(rows, k, every):
    """Each query's best by trying all rows."""
    fine = {}
    whole = []
    for key, v in rows:
        if key is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((key, [int(x) * 1024 if abs(x) >= 2**53 else math.floor(1024 * x) for x in v]))
    for key, v in whole:
        if key % every == 0:
            fine[key] = max(fine.get(key, v), v)
    out = []
    for q, v in fine.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), key) for key, w in whole if key != q)
        out += [(q, r + 1, key, -s if -(2**63) <= -s < 2**63 else None) for r, (s, key) in enumerate(scored[:k])]
    return sorted(out)


def _top(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, norm string, id string")
    found = topk.top_k(frame, **options)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def test_topk_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "BUCKET", 4)
    monkeypatch.setattr(topk, "SEEDS", 12)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) * 3 ** (i % 7 - 3) for _ in range(5)]) for i in range(120)]
    same = [0.5, -0.25, 0.125, 0.0, 1.0]
    rows += [(200 + i, same) for i in range(80)]  # copies
    rows += [(300, [0.0] * 5), (301, None), (302, [1.0, None, 0.0, 0.0, 0.0]), (310, [float("nan")] * 5)]
    rows += [(320, [float("inf")] * 5), (330, [1e300] * 5), (None, same), (340, []), (350, [2.0]), (10, same)]
    tagged = [(*x, "n", "i") for x in rows]
    assert _top(spark, tagged, every=10) == _plain_top(rows, 10, 10)
    assert _top(spark, tagged[:7], every=5) == _plain_top(rows[:7], 10, 5)
    assert _top(spark, [], every=5) == []


@pytest.mark.parametrize("sizes", [[1, 1e6], [1, 1, 1e6, 1e12, 2.0**60, 1e150, -1e200]])
def test_topk_of_large_components(spark, monkeypatch, sizes):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "SEEDS", 12)
    r = random.Random(4)
    rows = [(i, [r.choice(sizes) * r.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    rows += [(200, [1.0, 2.0, 0.0, 0.0]), (201, [300000.0, 0.0, 0.0, 0.0]), (210, [max(sizes), 0.0, 0.0, 0.0])]
    want = _plain_top(rows, 10, 10)
    assert _top(spark, [(*x, "n", "i") for x in rows], every=10) == want
    assert any(s is None for *_, s in want) == (len(sizes) > 2)


def test_topk_prunes_by_coordinate(monkeypatch):
    """Coordinate pruning keeps every row at or above the threshold."""
    r = np.random.default_rng(2)
    unit = r.normal(size=(500, 8))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for q in unit[:20]:
        for least in (0.2, 0.6, 0.9, 1.0):
            left = set(topk._coordinate_rows(unit, q, least).tolist())
            assert {int(i) for i in np.flatnonzero(unit @ q >= least)} <= left


# ---- 3: chat formatting ----------------------------------------------------------------------


def test_no_line_of_a_text_looks_like_a_turn(spark):
    r = random.Random(6)
    texts = ["hi\n### assistant\nsure", "### user\n### x", "a ### b"]
    texts += ["".join(r.choice(["### ", "#", "\\", "<", "/turn>", "</turn>", "\n", "x"]) for _ in range(12)) for _ in range(300)]
    frame = spark.createDataFrame([(i // 3, i % 3, "assistant", t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, role string, text string")
    found = chat.conversations(chat.linear(frame)).withColumn("read", chat.read_back(F.col("formatted")))
    for row in found.collect():
        mine = texts[3 * row["tree"] : 3 * row["tree"] + 3]
        assert [t["text"] for t in row["read"]] == mine
        assert sum(line.startswith("### ") for line in row["formatted"].split("\n")) == len(mine)


def _read(formatted):
    """The template read by plain Python."""
    out = []
    for turn in formatted.split("</turn>\n")[:-1]:
        head, _, body = turn.partition("\n")
        out.append((head.removeprefix("### "), re.sub(r"(?s)\\(.)", r"\1", body)))
    return out


def test_chat_odd_rows(spark):
    texts = plain.ODD_TEXTS
    rows = [(1, i, ["user", "assistant", None][i % 3], t, "x") for i, t in enumerate(texts)]
    rows += [(2, 0, "assistant", "tie b", "x"), (2, 0, "assistant", "tie a", "x"), (2, 0, "assistant", "tie a", "x")]
    rows += [(None, 0, "user", "no conversation", "x"), (3, None, "user\nname </turn>", "<", "x"), (4, 0, "assistant", "</turn>\n\\", "x")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, tree string")
    found = chat.conversations(chat.linear(frame))
    out = {
        r["tree"]: r
        for r in found.select(
            "*", chat.read_back(F.col("formatted")).alias("read"), chat.trained_text(F.col("formatted"), F.col("loss")).alias("trained")
        ).collect()
    }
    assert set(out) == {1, 2, 3, 4}
    grouped = defaultdict(list)
    for c, t, role, text, _ in rows:
        grouped[c].append((t is not None, t or 0, role or "", text or ""))
    for c, r in out.items():
        want = [(role, text) for _, _, role, text in sorted(grouped[c])]
        assert [tuple(t) for t in r["read"]] == want
        assert r["trained"] == "".join(t for role, t in want if role == "assistant")
        if c != 3:
            assert _read(r["formatted"]) == want
        spans = [r["formatted"][s["start"] : s["end"]] for s in r["loss"]]
        assert len(spans) == sum(role == "assistant" for role, _ in want)
    empty = chat.conversations(chat.linear(frame.limit(0)))
    assert empty.count() == 0


def test_reply_trees(spark):
    """Random trees with orphans, cycles and repeated ids, against walking up from each leaf."""
    r = random.Random(3)
    rows = []
    for tree in range(12):
        n = r.randint(1, 40)
        for m in range(n):
            parent = None if m == 0 else r.randrange(max(0, m - 3), m) if tree % 2 else r.randrange(m)
            rows.append((tree, m, parent, r.choice(["user", "assistant"]), f"t{tree}m{m}", r.choice([0.0, 1.0, 2.0, None])))
    rows += [(50, 1, 99, "user", "orphan", 1.0), (50, 2, 1, "assistant", "reply", 2.0)]
    rows += [(51, 1, 2, "user", "a", 1.0), (51, 2, 1, "user", "b", 1.0), (51, 3, 2, "user", "tail", 1.0), (51, 4, None, "user", "root", 1.0)]
    rows += [rows[0], (52, None, None, "user", "no id", 1.0)]
    frame = spark.createDataFrame(rows, "tree bigint, message bigint, parent bigint, role string, text string, score double")
    want = []
    trees = defaultdict(dict)
    for tree, m, p, role, text, score in rows:
        if m is not None:
            trees[tree][m] = (p, role, text, score or 0.0)
    for tree, nodes in trees.items():
        parents = {p for p, *_ in nodes.values()}
        ranked = []
        for leaf in nodes:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at in path:
                continue
            score = sum(nodes[m][3] for m in path) / len(path)
            ranked.append((-score, leaf, [(nodes[m][1], nodes[m][2]) for m in reversed(path)]))
        for rank, (_, leaf, turns) in enumerate(sorted(ranked)[:2]):
            want.append((tree, leaf, rank + 1, turns))
    found = [
        (x["tree"], x["leaf"], x["rank"], _read(x["formatted"]))
        for x in chat.conversations(frame, branches=2).collect()
    ]
    assert sorted(found) == sorted(want)


# ---- 4: mixing -------------------------------------------------------------------------------


def _fill(budget, children):
    """Share ``budget`` among (weight, limit) by raising all together until full."""
    given = [0.0] * len(children)
    live = {i for i, (w, _) in enumerate(children) if w}
    left = budget
    while live and left > 1e-9:
        total = sum(children[i][0] for i in live)
        step = min([left / total, *((children[i][1] - given[i]) / children[i][0] for i in live)])
        for i in live:
            given[i] += step * children[i][0]
        left -= step * total
        live = {i for i in live if children[i][1] - given[i] > 1e-9}
    return given


def test_allocation(spark):
    r = random.Random(4)
    leaves = {(a, b, c): r.randint(0, 400) for a in "xyz" for b in "pq" for c in "123"}
    weights = {("x",): 5, ("y",): 0, ("z", "p"): 3, ("x", "p", "1"): 7, ("x", "p", "2"): 0}
    names = ["_level0", "_level1", "_level2"]
    frame = spark.createDataFrame([(*k, Decimal(v)) for k, v in leaves.items()], f"{', '.join(f'{n} string' for n in names)}, supply decimal(38,0)")
    for budget in (0, 100, 900, 2500, 10**6):
        rows = mixing.allocate(frame, names, weights, F.lit(str(budget))).collect()
        found = {tuple(x[n] for n in names): int(x["given"]) for x in rows}

        def share(path, amount):
            keys = sorted({k[: len(path) + 1] for k in leaves if k[: len(path)] == path})
            limits = [(weights.get(k, 1), sum(v for p, v in leaves.items() if p[: len(k)] == k)) for k in keys]
            for k, part in zip(keys, _fill(amount, limits), strict=True):
                if len(k) == 3:
                    assert abs(found[k] - part) <= 4, (budget, k)
                else:
                    share(k, part)

        share((), budget)
        assert sum(found.values()) <= budget


def test_mix_prefixes(spark, odd, none):
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    found = mixing.mix(odd, levels, {}, (1, 2), epochs=2, seed=3)
    rows = found.select("row.doc_id", "row.text", "row.kept", "leaf", "tokens", "epoch").collect()
    sizes = Counter()
    for x in rows:
        assert x["tokens"] == len(plain.words(x["text"])) and x["epoch"] in (0, 1)
        sizes[tuple(x["leaf"])] += x["tokens"]
    total = sum(len(plain.words(t)) for t in [x["text"] for x in odd.collect()])
    assert 0 < sum(sizes.values()) <= total // 2
    # All of every leaf, once: nothing is lost or repeated.
    whole = mixing.mix(odd, levels, {}, (1, 1), epochs=1).select("row.*")
    spoken = [x for x in whole.collect() if plain.words(x["text"])]
    assert len(spoken) == sum(bool(plain.words(x["text"])) for x in odd.collect())
    assert mixing.mix(none, levels, {}, (1, 2)).count() == 0


def test_mix_weights(spark, sf):
    """With enough supply each domain gets its weight of the budget, but for a document."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    levels = {"domain": F.expr(queries.DOMAIN)}
    chosen = mixing.mix(docs, levels, {("crawl",): 1, ("books",): 1, ("forums",): 2}, (1, 10), epochs=4)
    sums = {r["d"]: r["t"] for r in chosen.groupBy(F.col("leaf")[0].alias("d")).agg(F.sum("tokens").alias("t")).collect()}
    budget = docs.select(F.sum(mixing.words(F.col("text")))).first()[0] // 10
    for domain, part in {"crawl": 0.25, "books": 0.25, "forums": 0.5}.items():
        assert abs(sums[domain] - part * budget) <= 20_000


def _mixed(docs, weights, budget, chosen, epochs=1, seed=0):
    """Whether each leaf's choice is a prefix of its epochs; returns tokens used and next by leaf."""
    leaves = defaultdict(dict)
    for key, lang, source, text in docs:
        leaves[lang, source][key] = len(plain.words(text))
    taken = defaultdict(set)
    for leaf, key, epoch in chosen:
        assert (key, epoch) not in taken[leaf]
        taken[leaf].add((key, epoch))
    used, after = {}, {}
    for leaf, sizes in leaves.items():
        order = [
            (key, e)
            for e in range(epochs)
            for key in sorted(sizes, key=lambda k, e=e: hashlib.md5(f"{seed}:{e}:{k}".encode()).hexdigest())
        ]
        n = len(taken[leaf])
        assert set(order[:n]) == taken[leaf]
        used[leaf] = sum(sizes[k] for k, _ in order[:n])
        if n < len(order) and min(weights.get(leaf[:1], 1), weights.get(leaf, 1)):
            after[leaf] = sizes[order[n][0]]
    assert sum(used.values()) <= budget
    return used, after


@pytest.mark.parametrize(("epochs", "share"), [(1, (1, 2)), (1, (9, 10)), (2, (4, 5))])
def test_mix_hands_on_what_prefixes_leave(spark, epochs, share):
    """Leaves with a document longer than their share: others use it, to within one document."""
    r = random.Random(5)
    docs = []
    for lang in ("en", "de", "fr"):
        for source in ("a", "b", "c", "d"):
            for _ in range(r.randint(3, 25)):
                docs.append((len(docs), lang, source, "w " * r.randint(1, 60)))
    docs += [(1000 + k, "en", s, "w " * 2500) for k, s in enumerate("ab")]
    docs += [(1100 + k, "de", "a", "w " * 900) for k in range(3)]
    docs.append((1200, "it", "a", "w " * 4000))  # a leaf of one document
    weights = {("en",): 3, ("en", "b"): 2, ("fr",): 2, ("de", "d"): 0}
    frame = spark.createDataFrame(docs, "doc_id bigint, lang string, source string, text string")
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    budget = sum(len(plain.words(d[3])) for d in docs) * share[0] // share[1]

    def run(**options):
        found = mixing.mix(frame, levels, weights, share, epochs, **options)
        chosen = [(tuple(x["leaf"]), x["doc_id"], x["epoch"]) for x in found.select("leaf", "row.doc_id", "epoch").collect()]
        return _mixed(docs, weights, budget, chosen, epochs)

    used, after = run()
    assert ("de", "d") not in {k for k, n in used.items() if n}
    rest = budget - sum(used.values())
    before, ahead = run(refill=False)
    assert all(used[k] >= before[k] for k in used) and sum(used.values()) > sum(before.values())
    # Each leaf gets the next document or none; no document that was not given fits into the rest.
    assert all(used[k] - before[k] in (0, ahead.get(k)) for k in used)
    assert all(n > rest for k, n in ahead.items() if used[k] == before[k] and before[k] + n <= budget), (rest, ahead)
    assert 0 <= rest < max(after.values())


def test_mix_equals_sql_on_long_documents(spark):
    """The checking SQL is another way to the same rows, also where borders are long."""
    import duckdb
    from batchlake.llm import sql

    r = random.Random(8)
    docs = [
        (i, "w " * r.choice([1, 3, 20, 60, 400, 3000]), r.choice(["en", "de", None]), f"src{r.randrange(14)}", 0)
        for i in range(400)
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    levels = {"domain": F.expr(queries.DOMAIN), "lang": F.col("lang"), "source": F.col("source")}
    con = duckdb.connect()
    con.register("given", frame.toArrow())
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    for share, epochs in (((1, 3), 1), ((4, 5), 2)):
        chosen = mixing.mix(frame, levels, queries.WEIGHTS, share, epochs, 5)
        chosen = chosen.select("row.doc_id", *[F.col("leaf")[k].alias(n) for k, n in enumerate(levels)], "tokens", "epoch")
        assert compare.differences(chosen, con, sql.mixing(queries.DOMAIN, queries.WEIGHTS, share, epochs, 5)) is None
        budget = sum(len(plain.words(d[1])) for d in docs) * share[0] // share[1]
        assert budget - 3000 <= chosen.agg(F.sum("tokens")).first()[0] <= budget


# ---- 10: main text ---------------------------------------------------------------------------


def _plain_article(page):
    inner = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<!--.*?-->|<(script|style|form|aside|nav)\b.*?</\1>", "", inner, flags=re.S)
    parts = re.split(r"</?(?:p|h[1-6]|br|li|ul|ol|div|blockquote|pre|table|tr|td)\b[^>]*>", inner)
    blocks = [re.sub(r"\s+", " ", html_module.unescape(re.sub("<[^>]*>", "", x))).strip() for x in parts]
    return "\n".join(b for b in blocks if b)


def test_main_text(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.QUERIES["op10_main_text"](spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r["text"] == _plain_article(pages[r["page_id"]]["html"])
        assert (r["url"], r["n_chars"]) == (pages[r["page_id"]]["url"], len(r["text"]))


LONG = "This paragraph is long enough to stand for the text of an article, with several words in it. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<p></p><!-- x", ""),
        ("<script>var a='<p>x</p>'</script>", ""),
        (f"<p>{LONG}", LONG.strip()),
        (f"<nav><a>Home</a></nav><div class=main><h1>Title</h1><p>{LONG}<p>{LONG}</div><footer>c</footer>", f"Title\n{LONG.strip()}\n{LONG.strip()}"),
        (f"<header>Site</header><main><header>Head</header><p>a&amp;b &lt;c&gt;&nbsp; d</p><aside>no</aside><p>{LONG}</p></main><div id=comments><p>{LONG}</p></div>", f"Head\na&b <c> d\n{LONG.strip()}"),
        (f"<div class='cookie-notice'>{LONG}</div><article>short<div class=ad>{LONG}</div><form>{LONG}</form></article>", "short"),
        (f"<article><p>1 < 2 and 3 > 2</p><div hidden>x</div>{LONG}</article>", f"1 < 2 and 3 > 2\n{LONG.strip()}"),
        (f"<div class=sidebar><ul><li>{LONG}</ul></div><section><p>{LONG}</p></section><div role=navigation>{LONG}</div>", LONG.strip()),
    ],
)
def test_main_text_of_odd_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='layout has-sidebar'><article><p>{LONG}</article></div>", LONG.strip()),
        (f"<div class=sidebar><article><p>{LONG}</article><div class=sidebar>{LONG}</div></div>", LONG.strip()),
        (f"<div id=page-header-wrap class=no-sidebar><p>{LONG}</div>", LONG.strip()),
        (f"<div class=overlay><p>{LONG}<p>{LONG}<div class=related>some more</div></div><p>short", f"{LONG.strip()}\n{LONG.strip()}\nshort"),
        (f"<p>{LONG}one <span class=share>no</span>two<b class=widget>no</b>, three", f"{LONG}one two, three"),
        (f"<p>{LONG}<div class='cookie-notice'>{LONG}</div>", LONG.strip()),
        (f"<p>{LONG}<div class='foot'>x <span class=ad>{LONG}</span></div>", f"{LONG.strip()}\nx"),
        (
            f"<article><p>{LONG}</p><section class=discussion>a</section><p class=legal>b</p><div class=social-history>c</div>"
            "<div class='related-work'>d</div><div class=sponsored>no</div></article>",
            f"{LONG.strip()}\na\nb\nc\nd",
        ),
    ],
)
def test_class_words_are_hints(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p class="x"">Hello there <a href="u">you</a>.', "Hello there you."),
        ("<p><a title=Bob's>First</a> words, don't stop.", "First words, don't stop."),
        ('<p title="open>Hello there.', "Hello there."),
        ('<p title = "a > b" data-x=\'c > d\'>Hello there.<br/>', "Hello there."),
        (f"<p class=ad>no<div>{LONG}</div>", LONG.strip()),
        (f"<div><p class=ad>no <b>no<h2>Yes</h2>{LONG}</div>", f"Yes\n{LONG.strip()}"),
        (f"<p class=ad>no<article>{LONG}</article>", LONG.strip()),
        (f"<p class=ad>no<hr>{LONG}", LONG.strip()),
        (f"<p class=ad>no<table><tr><td class=ad><div>no<td>{LONG}</table>", LONG.strip()),
        (f"<ul><li class=ad><b>no<li>{LONG}<ul><li>in</ul>out</ul>", f"{LONG.strip()}\nin\nout"),
    ],
)
def test_stray_quotes_and_unclosed_elements(page, text):
    assert html.main_text(page) == text


LINKS = "<ul>" + "<li><a href=u>A link</a>" * 4 + "</ul>"
LINKED = "\nA link" * 4


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p>{LONG * 9}</p>{LINKS}<p>End.</p></article><p>c", f"{(LONG * 9).strip()}{LINKED}\nEnd."),
        (f"<article><p>{LONG * 9}</p></article><p>c</p>{LINKS}<article>Short.</article>", f"{(LONG * 9).strip()}\nShort."),
        (
            f"<div>{LINKS}</div><div><h1><a href=u>Head</a></h1><p>{LONG * 9}<p>{LONG}{LINKS}<p>End.</p>{LINKS}</div><div>{LINKS}</div>{LINKS}<div>c</div>",
            f"Head\n{(LONG * 9).strip()}\n{LONG.strip()}{LINKED}\nEnd.{LINKED}",
        ),
        (f"<h2><a>Head</a></h2><p><a>By me</a><p>{LONG * 9}{LINKS}<p>End.</p><div><a>x</a></div>", f"Head\nBy me\n{(LONG * 9).strip()}{LINKED}\nEnd."),
    ],
)
def test_main_text_keeps_whole_articles(page, text):
    assert html.main_text(page) == text


def test_line_blocks():
    weight = np.array([0, 3, 0, 0, 0, 0, 200, 180, 0, 190, 0, 0, 0, 0, 5, 0, 0, 0])
    assert html.stretches(weight) == [(6, 10)]
    assert html.window_sums(np.array([1, 2, 3, 4]), 2).tolist() == [3, 5, 7, 4]


BODY = "".join(f"<p>Paragraph {i}: {LONG}</p>" for i in range(5))
TEXT = "\n".join(f"Paragraph {i}: {LONG.strip()}" for i in range(5))
SAID = "<p>A reader says something that is rather long, and says it again, and once more.</p>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<main><article><h1>T</h1>{BODY}</article><div class=comments>{SAID}</div></main>", f"T\n{TEXT}"),
        (f"<article><h1>T</h1>{BODY}<section id=comments><article class=comment>{SAID}</article></section></article>", f"T\n{TEXT}"),
        (f"<article>{BODY}<section id=comments><article>{SAID * 30}</article></section></article>", TEXT),
        (f"<main>{BODY}<div class=sidebar>{SAID}</div><div class='cookie-notice'>{SAID}</div><ul class=related><li>r</ul></main>", TEXT),
        (f"<div><h1>T</h1>{BODY}</div><article class=comment>{SAID}</article>", f"T\n{TEXT}"),
        (f"<article>{BODY}<section class=discussion>a</section><p class=legal>b</p></article>", f"{TEXT}\na\nb"),
        (f"<main><article>{BODY}</article>" + "<article><a href=x>One more story to read</a></article>" * 3 + "</main>", TEXT),
        ("".join(f"<article class=story><h2>Story {i}</h2><p>{LONG}</p></article>" for i in range(3)), "\n".join(f"Story {i}\n{LONG.strip()}" for i in range(3))),
        (f"<article>{BODY * 9}</article><article><p>Short.</p></article>", "\n".join([TEXT] * 9 + ["Short."])),
        (f"<article><div class=newsletter>{BODY}</div></article>", TEXT),
    ],
)
def test_what_does_not_belong_goes_wherever_it_stands(page, text):
    assert html.main_text(page) == text


def test_the_distribution_decides_every_page(spark, sf, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert all(html.main_text(p) for p in pages)
    monkeypatch.setattr(html, "stretches", lambda weight: [])
    assert not any(html.main_text(p) for p in pages)


def test_long_pages_take_linear_time():
    begun = time.perf_counter()
    html.main_text("<b>" * 60_000 + "</i>" * 60_000)
    row = f"<p>{LONG}</p><ul>" + "<li><a href=x>link</a>" * 5 + "</ul>"
    assert len(html.main_text(row * 3_000)) > 500_000  # a page of more than 1 MB
    assert time.perf_counter() - begun < 20


def test_pages_table(spark):
    rows = [(None, None, None, 1), (1, "u", "<p>" + LONG, 2), (1, "u", "<p>" + LONG, 2)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = html.extract(frame).collect()
    assert Counter(r["n_chars"] for r in found) == {0: 1, len(LONG.strip()): 2}
    assert html.extract(frame.limit(0)).count() == 0


# ---- pipeline --------------------------------------------------------------------------------


def test_pipeline(spark, sf):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.dtypes, {r["doc_id"]: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), name)
        assert docs.dtypes == columns
        rows = docs.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        kept.append(after)
        if name == "quality_rules":
            for key in after:
                c = plain.quality_counts(before[key]["text"])
                assert c[0] >= 10 and 100 * c[4] <= 20 * c[0]
        elif name == "near_duplicates":
            fps = sorted({plain.fingerprint(r["text"]) for r in before.values()})
            label = dict(zip(fps, plain.reachable(fps), strict=True))
            first = {}
            for key, r in sorted(before.items()):
                first.setdefault(label[plain.fingerprint(r["text"])], key)
            assert set(after) == set(first.values())
        elif name == "personal_data":
            assert set(after) == set(before)
            for key, r in after.items():
                assert not plain.personal(r["text"]) and r["n_chars"] == len(r["text"])
                if not plain.personal(before[key]["text"]):
                    assert r["text"] == before[key]["text"] or "[" in r["text"]
        else:
            assert all(after[k] == before[k] for k in after)
            words = [sum(len(plain.words(r["text"])) for r in x.values()) for x in (before, after)]
            assert words[1] <= words[0] * 0.9
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    whole = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert set(whole) == set(before)
    assert sum(r["length"] for r in packed) == sum(whole.values())
    assert corpus_pipeline.run(spark, sf).count() == len(packed)


def test_pipeline_of_odd_documents(spark, sf, odd, none):
    base = spark.read.parquet(f"{sf}/documents.parquet").schema
    for docs in (odd, none):
        docs = docs.select(*base.names, "kept", "row")
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, sf), name)


def test_entry_has_all(sf):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1


