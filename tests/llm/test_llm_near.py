"""Links and components are those of comparing all sets."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from restock.llm import near


def test_words_and_shingles():
    assert [w.decode() for w in near.words("AÉ\tb\x0bC D ")] == ["aÉ", "b", "c d"]
    assert near.shingles(None, 2) == near.shingles(" \n", 2) == set()
    assert near.shingles("One", 2) == {(b"one",)}
    assert near.shingles("a b a b", 2) == {(b"a", b"b"), (b"b", b"a")}
    for t in ("", "one", "a b a b", "x y z " * 50, "to be or not to be"):
        for width in (1, 2, 5):
            assert len(near.hashed(t, width)) == len(near.shingles(t, width))


@pytest.mark.parametrize(("distance", "errors"), [(35, 1), (20, 0), (40, 2)])
def test_signatures_within_the_distance_share_a_key(distance, errors):
    rng = np.random.default_rng(distance)
    a = rng.integers(0, 2**16, (200, near.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(near.SYMBOLS, distance, replace=False)] ^= 1
    one, two = near.keys(a, distance, errors), near.keys(b, distance, errors)
    assert (one == two).any(1).all()
    other = near.keys(rng.integers(0, 2**16, a.shape, dtype=np.uint16), distance, errors)
    assert not (one == other).any()


def test_one_key_of_a_chunk_counts():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 2**16, (300, near.SYMBOLS), dtype=np.uint16)
    b = np.where(rng.random(a.shape) < 0.15, rng.integers(0, 2**16, a.shape), a).astype(np.uint16)
    shared, out_a, out_b = near.keys(a) == near.keys(b), near.left_out(a), near.left_out(b)
    counts = shared & ((out_a == -1) | (out_a != out_b))
    at = 0
    for chunk in near.chunks():
        part = slice(at, at + len(chunk))
        differ = (a[:, chunk] != b[:, chunk]).sum(1)
        assert (counts[:, part].sum(1) == (differ <= 1)).all()
        at += len(chunk)


def test_sketches_differ_in_no_more_symbols(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(0, 2**16, (300, near.SYMBOLS), dtype=np.uint16)
    b = np.where(rng.random(a.shape) < rng.random((300, 1)), rng.integers(0, 2**16, a.shape), a).astype(np.uint16)
    rows = [(*map(int, x), *map(int, y), i) for i, (x, y) in enumerate(zip(near.sketch(a), near.sketch(b), strict=True))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in [*near.SKETCH, *near.LEAD, "i"]))
    found = {r.i for r in df.filter(near._near(near.SKETCH, near.LEAD, 30)).select("i").collect()}
    assert found == {i for i in range(300) if int(((a[i] & 3) != (b[i] & 3)).sum()) <= 30}
    assert found >= {i for i in range(300) if int((a[i] != b[i]).sum()) <= 30}


def test_distance_of_similar_sets():
    """Of sets at a similarity of 0.8, all but few stay within the distance, near what the binomial law says."""
    rng = np.random.default_rng(5)
    far, total = 0, 0
    for _ in range(400):
        values = rng.integers(0, 2**63, 900, dtype=np.uint64)
        a, b = (np.frombuffer(near.signature(v), "<u2") for v in (values[:810], np.concatenate([values[:720], values[810:]])))
        total += int((a != b).sum())
        far += int((a != b).sum()) > near.DISTANCE
    assert far == 0 and abs(total / 400 - 0.2 * near.SYMBOLS) < 1


def nodes(df):
    """Names of the plan's operators, with the rows that each has made."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        name, rows = p.nodeName(), p.metrics().get("numOutputRows")
        found.append((name, rows.get().value() if rows.isDefined() else None))
        inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}.get(name)
        todo += [getattr(p, inner)()] if inner else [p.children().apply(i) for i in range(p.children().size())]
    return found


def test_keys_take_one_worker_a_task_and_one_shuffle(spark, monkeypatch):
    """Two functions side by side hold two Python workers a task, and what is shuffled twice is made twice."""
    monkeypatch.setattr(near, "SIGNED", 100)
    rng = np.random.default_rng(3)
    rows = [(i, near.signature(rng.integers(0, 2**63, 50, dtype=np.uint64))) for i in range(450)]
    signed = near.stage(spark.createDataFrame(rows, "class long, signature binary"), "test-signed")
    keyed = near.Links._keyed(SimpleNamespace(signed=signed, distance=near.DISTANCE, errors=near.ERRORS))
    assert [n for n, _ in nodes(keyed)].count("ArrowEvalPython") == 1
    own = np.frombuffer(b"".join(s for _, s in rows), "<u2").reshape(-1, near.SYMBOLS)
    expected = {(i, k, g) for (i, _), ks, gs in zip(rows, near.keys(own).tolist(), near.left_out(own).tolist(), strict=True) for k, g in zip(ks, gs, strict=True)}
    assert {(r["class"], r.key, r.gone) for r in keyed.collect()} == expected and keyed.count() == 450 * 96
    both = keyed.join(keyed.groupBy("key").agg(F.min("class").alias("lead")), "key").filter("class <> lead")
    assert [n for n, _ in nodes(both)].count("ReusedExchange") == 1


def test_rare_shingles(spark):
    """What only one or two have is not joined; that is most of what a crowd of edited copies has."""
    rows = [(c, 1000 * c + i) for c in range(20) for i in range(50)] + [(c, -c // 2) for c in range(20)]
    rows += [(c, -100 - c // 4) for c in range(20)] + [(c, -200) for c in range(20)]
    each = near.stage(spark.createDataFrame(rows, "class long, shingle long"), "test-shingles")
    times = Counter(s for _, s in rows)
    found = near.rare_shingles(each, 4)
    assert sorted(map(tuple, found.collect())) == sorted((c, s, times[s]) for c, s in rows if times[s] <= 4)
    assert sum(n for name, n in nodes(found) if "Join" in name) == sum(2 < times[s] <= 4 for _, s in rows)
    assert near.rare_shingles(each.limit(0), 4).collect() == []


def brute(rows, width, percent=80):
    sets = [near.shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if s and 100 * both >= percent * len(s | sets[j]):
                root[find(i)] = find(j)
    ids: dict[int, list] = {}
    for i in range(len(rows)):
        ids.setdefault(find(i), []).append(rows[i][0])
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))], len(ids)


def check(spark, rows, width):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near.Links(near.written(df), width).components().collect()
    expected, components = brute(rows, width)
    assert sorted(map(str, [(r.id, r.n_shingles, r.component_id) for r in found])) == sorted(map(str, expected))
    stay = [r for r in found if r.stays]
    assert len(stay) == components and all(r.id == r.component_id for r in stay)


def test_awkward(spark):
    check(spark, [(i, t) for i, t, _ in samples.TEXTS], 2)


def test_no_rows(spark):
    assert near.Links(near.written(samples.none(spark)), 2).components().collect() == []
    assert near.deduplicate(samples.none(spark)).collect() == []


def edited(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(10**6)) if rng.random() < share else w for w in words]


@pytest.mark.parametrize(("crowd", "rare"), [(near.CROWD, near.RARE), (3, 2)])
def test_planted_copies(spark, monkeypatch, crowd, rare):
    """Copies with few and many edits, a group of near copies that hang together by chains, and a passage that many share."""
    monkeypatch.setattr(near, "CROWD", crowd)
    monkeypatch.setattr(near, "RARE", rare)
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts, passage = [], fresh(40)
    for _ in range(40):
        base = fresh(rng.randrange(30, 200))
        texts += [base, edited(rng, base, 0.02), edited(rng, base, 0.05), edited(rng, base, 0.12)]
    base = fresh(120)
    texts += [edited(rng, base, 0.045) for _ in range(90)]
    chain = fresh(150)
    for _ in range(25):
        chain = edited(rng, chain, 0.05)
        texts.append(chain)
    texts += [fresh(30) + passage + fresh(20) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, rows[i * 7][1].upper()) for i in range(20)]
    check(spark, rows, 2)


def test_one_of_each_stays(spark):
    rows = samples.awkward(spark)
    found = near.deduplicate(rows, width=2)
    assert found.columns == rows.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == [(False, i) for i in (-3, 0, 1, 2, 3, 6, 7, 8, 9)] + [(True, 0)]


def test_components_of_links(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(80)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    root: dict[int, int] = {x: x for p in links if p[0] != p[1] for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    found = near.connected(spark.createDataFrame(links, "a long, b long"))
    assert sorted((r.node, r.root) for r in found.collect()) == sorted(root.items())
