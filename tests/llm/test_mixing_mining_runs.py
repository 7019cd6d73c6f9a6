"""Curriculum mixing, hard-negative mining and periodic runs against plain versions, with edge cases."""

import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string"


def with_clashes(df, *names):
    for name in ("_id", "_text", "_source", "size", "n", "mark", "start", "copy", "target", "rank", "score", "slot", "_vec", "tile",
                 "_w", *names):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(1))
    return df


# --- 13: periodic runs

def plain_runs(w, shortest=6, exponent=4):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            smaller = any(all(w[k] == w[k + d] for k in range(i, j + q - d)) for d in range(1, q))
            if j + q - i >= max(shortest, exponent * q) and not smaller:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, w):
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2], brute.sha(lines),
            brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_texts(seed, count):
    rng = random.Random(seed)
    for i in range(count):
        w = [f"w{rng.randrange(rng.choice([1, 2, 3, 9]))}" for _ in range(rng.randint(0, 60))]
        if w and rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randint(1, 8)
            w = [w[k] if k < a else w[min(a + (k - a) % p, len(w) - 1)] for k in range(len(w))]
        yield i, rng.choice([" ", "\n", " \t "]).join(w)


def test_runs_match_plain_search(spark):
    from truetally.llm.runs import run_digests
    edge = [(900, None), (901, ""), (902, " \n "), (903, "a " * 3000), (904, "a b " * 2 + "a"), (905, "a b a b a b a b x"),
            (906, "é 日 " * 9), (900, None), (907, "x" * 100_000), (None, "no id " * 5), (908, ("a " * 7 + "b ") * 6)]
    docs = [*periodic_texts(3, 400), *edge, (5, "again " * 6), (5, "again " * 6)]
    got = run_digests(with_clashes(spark.createDataFrame([(i, t, "s") for i, t in docs], DOCS), "runs", "collapsed")).collect()
    want = [plain_digest(i, brute.words(t)) for i, t in docs]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_thue_morse_words_are_told_apart(spark):
    """Words that collide under every polynomial hash modulo 2**64."""
    from truetally.llm.runs import periodic_runs
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    a, b = ("".join("ab"[x ^ y] for x in bits) for y in (0, 1))
    rows = [(1, " ".join([a, b] * 4), "s"), (2, " ".join([a] * 8), "s")]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: [(0, 8, 2)], 2: [(0, 8, 1)]}


def test_run_parameters_and_a_long_text(spark):
    from truetally.llm.runs import find_runs, periodic_runs
    rng = random.Random(0)
    for _ in range(300):
        w = [rng.randrange(2) for _ in range(rng.randint(0, 50))]
        got = find_runs(np.array(w, np.int64), np.array([0, len(w)]), 2, 3)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == plain_runs(w, 2, 3)
    block = " ".join(f"v{rng.randrange(9999)}" for _ in range(60_000))
    r = periodic_runs(spark.createDataFrame([(1, " ".join([block] * 4), "s")], DOCS)).first()
    assert [tuple(x) for x in r.runs] == [(0, 240_000, 60_000)] and bytes(r.collapsed).decode() == block
    with pytest.raises(ValueError, match="exponent"):
        periodic_runs(spark.createDataFrame([], DOCS), min_exponent=2)


def test_registered_runs_over_planted_documents(spark, sf):
    from truetally.llm.queries import op13_periodic_runs
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        w = brute.words(r.text)
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n <= 1500:
            want.append(plain_digest(r.doc_id, w))
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, sf).collect()}
    assert len(want) > 150 and all(got[x[0]] == x for x in want)


# --- 12: hard negatives

EMBEDDINGS = "vec_id long, embedding array<double>, label int"


def plain_negatives(rows, is_anchor, low=30, high=90):
    full = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if None not in (i, v, c)
            and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, v, c in full:
        if not is_anchor(i):
            continue
        same = sorted({(-score(v, w), j) for j, w, d in full if d == c and j != i})[:5]
        other = sorted({(-score(v, w), j) for j, w, d in full if d != c})
        for s, j in same:
            window = [(-t, k) for t, k in other if low * -s <= 100 * -t <= high * -s][:10]
            out |= {(i, j, r, k, -s, t) for r, (t, k) in enumerate(window, 1)}
    return out


def embeddings(n, width, seed):
    rng = random.Random(seed)
    base = [[rng.uniform(-0.2, 0.5) for _ in range(width)] for _ in range(max(2, n // 3))]
    return [(i, [x + rng.choice([0, 0, rng.uniform(-0.1, 0.1)]) for x in rng.choice(base)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("bytes_, held", [(1 << 25, 1 << 20), (0, 10)])
def test_hard_negatives_match_plain_search(spark, monkeypatch, bytes_, held):
    from truetally.llm import hard_negatives as H
    monkeypatch.setattr(H, "BROADCAST_BYTES", bytes_)  # 0: the dealt join
    monkeypatch.setattr(H, "PER_SALT", 1)
    monkeypatch.setattr(H, "HELD", held)
    rows = embeddings(700, 7, 1)
    edge = [(1000, None, 1), (1001, [0.1] * 7, None), (1002, [0.1, None] * 3 + [0.2], 1), (1003, [math.nan] * 7, 2), (None, [0.3] * 7, 1),
            (1004, [math.inf] * 7, 2), (1005, [0.4, 0.4], 1), (1006, [], 1), (1007, [0.3] * 9, 2), rows[0], rows[0], rows[3],
            (0, [0.2] * 7, 3)]
    df = with_clashes(spark.createDataFrame([*rows, *edge], EMBEDDINGS).repartition(5))
    got = H.hard_negatives(df, F.col("vec_id") % 20 == 0).collect()
    assert {tuple(r) for r in got} == plain_negatives([*rows, *edge], lambda i: i % 20 == 0) and len(set(got)) == len(got)


def test_hard_negatives_of_nothing(spark):
    from truetally.llm.hard_negatives import hard_negatives
    empty = spark.createDataFrame([], EMBEDDINGS)
    assert hard_negatives(empty, F.col("vec_id") % 20 == 0).collect() == []
    assert hard_negatives(spark.createDataFrame(embeddings(9, 3, 0), EMBEDDINGS), F.lit(False)).collect() == []


def test_strassen_is_exact():
    from truetally.llm.hard_negatives import strassen
    rng = np.random.default_rng(0)
    for m, k, n in ((1, 1, 1), (70, 64, 65), (130, 257, 129), (33, 500, 64), (0, 3, 4)):
        a, b = rng.integers(-2 ** 28, 2 ** 28, (m, k)), rng.integers(-2 ** 28, 2 ** 28, (k, n))
        assert (strassen(a, b) == a @ b).all()


# --- 11: curriculum

def plain_targets(sizes, weights, share=1.5, repeat=2):
    left, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        level = left / sum(weights[s] for s in free) if free else 0
        over = [s for s in free if weights[s] * level > repeat * sizes[s]]
        if not over:
            return {s: capped.get(s, weights[s] * level) for s in sizes}
        for s in over:
            capped[s] = repeat * sizes[s]
            left -= capped[s]


def corpus():
    rng = random.Random(2)
    docs = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(800)]
    return [*docs, (900, None, "b"), (901, " \n", "a"), (902, "x " * 5000, "c"), (3, docs[3][1], docs[3][2]), (3, docs[3][1], docs[3][2]),
            (None, "no id", "a"), (903, "w", "only")]


def knots(spark, weights):
    rows = [(s, [(0.0, w * a), (0.3, w * b), (1.0, w * c)]) for s, w, a, b, c in weights]
    return spark.createDataFrame(rows, "source string, knots array<struct<t: double, w: double>>")


SHAPES = [("a", 5.0, 0.0, 1.0, 2.0), ("b", 2.0, 2.0, 0.5, 0.0), ("c", 1.0, 1.0, 1.0, 1.0), (None, 2.0, 0.0, 0.0, 1.0), ("é", 1.0, 3.0, 0.0, 1.0)]


def integral(shape, t):
    _, w, a, b, c = shape
    area = lambda p, q, width, x: w * (p * x + (q - p) / width * x * x / 2)
    return area(a, b, 0.3, min(t, 0.3)) + (area(b, c, 0.7, t - 0.3) if t > 0.3 else 0)


@pytest.mark.parametrize("bucket, sources", [(1_000, 10_000), (6, 1)])
def test_curriculum_targets_takes_and_positions(spark, monkeypatch, bucket, sources):
    from truetally.llm import curriculum as C
    monkeypatch.setattr(C, "BUCKET", bucket)
    monkeypatch.setattr(C, "SOURCES", sources)
    docs = corpus()
    df = with_clashes(spark.createDataFrame(docs, DOCS).repartition(4))
    plan = C.assign_positions(df, knots(spark, SHAPES)).collect()
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    shapes = {x[0]: x for x in SHAPES}
    weights = {s: integral(shapes[s], 1.0) if s in shapes else 0.0 for s in sizes}
    want = plain_targets(sizes, weights)
    assert sorted((repr(r.doc_id), r.size) for r in plan) == sorted((repr(i), len(brute.words(t))) for i, t, _ in docs)
    begun = {}
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(v.words for v in r.visits)
        begun.setdefault(r.source, []).extend((v.position, v.words) for v in r.visits)
    for s, target in want.items():  # the words supplied by each position follow the schedule's integral
        taken = sum(w for _, w in begun.get(s, []))
        assert taken == math.floor(target * (1 + 1e-12))
        so_far = 0
        for t, w in sorted(begun.get(s, [])):
            assert integral(shapes[s], t) / weights[s] * target == pytest.approx(so_far, abs=1e-6 * target + 1e-6)
            so_far += w
    again = C.assign_positions(df.repartition(7), knots(spark, SHAPES)).collect()
    assert sorted(map(repr, plan)) == sorted(map(repr, again))


def test_training_order_is_sorted_over_all_partitions(spark):
    from truetally.llm import curriculum as C
    plan = C.assign_positions(spark.createDataFrame(corpus(), DOCS), knots(spark, SHAPES))
    rows = C.training_order(plan).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and len(rows) == sum(len(r.visits) for r in plan.collect())
    first = [r.position for r in C.by_position(plan).collect()]
    some = [x for x in first if x is not None]
    assert some == sorted(some) and None not in first[:len(some)]


def test_curriculum_of_nothing_and_ranks(spark):
    from truetally.llm import curriculum as C
    empty = spark.createDataFrame([], DOCS)
    assert C.assign_positions(empty, knots(spark, SHAPES)).collect() == []
    blank = C.assign_positions(spark.createDataFrame([(1, None, "a"), (2, "", None)], DOCS), knots(spark, SHAPES)).collect()
    assert sorted((r.doc_id, r.target, r.taken, r.position) for r in blank) == [(1, 0.0, 0, None), (2, 0.0, 0, None)]
    assert C.assign_positions(spark.createDataFrame([(1, "a b", "z")], DOCS), knots(spark, SHAPES)).first().taken == 0
    names = [None, "b", "a", "é", "Z", ""]
    got = C.ranked(spark.createDataFrame([(x,) for x in names], "source string"), F.col("source").asc_nulls_last()).collect()
    assert sorted((r["rank"], r.source) for r in got) == list(enumerate(["", "Z", "a", "b", "é", None]))


def test_registered_queries_agree_with_sql(spark, sf):
    import duckdb

    from truetally.llm import queries
    con = duckdb.connect()
    for name, table in (("op11_curriculum", "documents"), ("op12_hard_negatives", "embeddings")):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
        cur = con.execute(queries.oracle_sql()[name])
        at = {c[0]: k for k, c in enumerate(cur.description)}
        df = queries.queries()[name](spark, sf)
        want = [tuple(r[at[c]] for c in df.columns) for r in cur.fetchall()]
        assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(map(repr, want))
