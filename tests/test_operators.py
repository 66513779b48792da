"""Operators against sequential models on random and edge inputs."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quern.operators import budget, dedup, evaluate, filters, order, pack
from quern.operators.shards import capped_shards
from quern.plans import corpus_queries


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def test_running_sum_and_position(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", None, "b"]), i * rng.choice([1, 1000]) + i, rng.randint(0, 9)) for i in range(300)]
    got = {(r.k, r.o): r.s for r in order.running_sum(frame(spark, rows, "k string, o bigint, v int"), ["k"], "o", F.col("v"), "s").collect()}
    for k, o, _ in rows:
        assert got[k, o] == sum(v for a, b, v in rows if a == k and b < o)
    assert order.position(spark.createDataFrame([], "o bigint"), [], "o").count() == 0


def test_ranges_of_an_uneven_order(spark):
    # five sources far apart, in one order, and one stray number
    rows = [((s << 44) + i, 1) for s in range(5) for i in range(400)] + [(1 << 62, 1)]
    d = frame(spark, rows, "o bigint, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in order.ranged(d, [], "o", F.col("v")).groupBy("__rs_range").count().collect()]
        composite = d.select(F.struct(F.shiftright("o", 44).alias("rank"), (F.col("o") % (1 << 44)).alias("row")).alias("o"), "v")
        got = {tuple(r.o): r.position for r in order.position(composite, [], "o").select("o", "position").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 2 * len(rows) / 4
    assert [got[k] for k in sorted(got)] == list(range(len(rows)))


def test_exact_first(spark):
    d = frame(spark, [(3, "a", "x"), (1, "a", "y"), (1, "a", "y"), (2, None, "z"), (5, None, "w"), (4, "", "v")], "i bigint, t string, other string")
    assert sorted((r.i, r.other) for r in dedup.exact_first(d, "t", "i").collect()) == [(1, "y"), (2, "z"), (4, "v")]
    assert dedup.exact_first(d.limit(0), "t", "i").count() == 0


def test_budget(spark):
    rows = [(1, 5), (2, 10), (3, None), (4, 1)]
    d = frame(spark, rows, "o bigint, n int")
    ids = lambda b: sorted(r.o for r in budget.within_budget(d, [], "o", "n", F.lit(b)).collect())
    assert (ids(0), ids(1), ids(5), ids(15), ids(16)) == ([], [1], [1], [1, 2], [1, 2, 3, 4])


def greedy(lengths, target):
    if sum(lengths) <= target:
        return sorted(lengths)
    out, total = [], 0
    for n in sorted(lengths):
        if total + n <= target:
            out.append(n)
            total += n
        if total >= 0.98 * target:
            break
    return out or sorted(lengths)[:1]


def test_smallest_within(spark):
    rng = random.Random(2)
    groups = {g: [rng.randint(1, 12) for _ in range(rng.randint(1, 12))] for g in range(60)}
    rows = [(g, i, n) for g, ns in groups.items() for i, n in enumerate(ns)]
    got = {}
    for r in budget.smallest_within(frame(spark, rows, "g int, i bigint, n int"), ["g"], "i", "n", F.lit(30)).collect():
        got.setdefault(r.g, []).append(r.n)
    assert {g: sorted(v) for g, v in got.items()} == {g: greedy(ns, 30) for g, ns in groups.items()}


def test_first_wins(spark):
    rng = random.Random(3)
    for trial in range(4):
        keys = {i: {rng.randint(0, 25) for _ in range(2)} for i in range(40)}
        kept, seen = [], set()
        for i in sorted(keys):
            if not keys[i] & seen:
                kept.append(i)
                seen |= keys[i]
        bands = frame(spark, [(i, k) for i, ks in keys.items() for k in ks], "ord bigint, key bigint")
        for fold_rows in (1_000_000, 20, 0):  # one pass, rounds and a pass, rounds only
            dropped = [r.ord for r in dedup.first_wins(bands, fold_rows).collect()]
            assert len(dropped) == len(set(dropped)) and set(dropped) == set(keys) - set(kept), trial
    chain = frame(spark, [(i, k) for i in range(30) for k in (i, i + 1)], "ord bigint, key bigint")
    assert {r.ord for r in dedup.first_wins(chain).collect()} == set(range(1, 30, 2))
    assert dedup.first_wins(chain.limit(0)).count() == 0


def test_admission_of_sources(spark):
    base = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcd"]
    rows = {
        "one": [(0, base[0]), (1, base[0]), (2, base[1]), (3, "too short"), (4, "too short"), (5, None)],
        "two": [(0, base[0].replace("a7 ", "z ")), (1, base[2]), (2, base[1]), (3, "too short"), (4, base[3])],
        "three": [(0, base[3]), (1, base[2]), (2, base[2])],
    }
    memory = dedup.Admission("words")
    admit = lambda s, limit=lambda d: d: sorted(r.i for r in memory.admit(frame(spark, rows[s], "i bigint, t string"), "t", "i", limit).collect())
    assert admit("one") == [0, 2, 3, 4, 5]
    assert admit("two", lambda d: d.where("i < 4")) == [1, 3]  # what a budget shuts out is not remembered
    assert admit("three") == [0]


def test_near_duplicates(spark):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(1, base), (2, base), (3, base.replace("word7 ", "other ")), (4, " ".join(f"else{i}" for i in range(80))), (5, "too short"), (6, "too short"), (7, ""), (8, None)]
    d = frame(spark, rows, "i bigint, t string")
    assert sorted(r.i for r in dedup.near_first(d, "t", "i").collect()) == [1, 4, 5]
    assert sorted(r.i for r in dedup.near_first_words(d, "t", "i").collect()) == [1, 4, 5, 6, 7, 8]
    assert sorted(r.i for r in dedup.near_first_words(d, "t", "i", short_exact=True).collect()) == [1, 4, 5, 7, 8]
    assert dedup.bands_for(0.8, 128)[0] * dedup.bands_for(0.8, 128)[1] <= 128


def next_fit(items, cap):
    rows, fill, row = {}, 0, 0
    for n, i in sorted((min(n, cap + 1), i) for i, n in items):
        if fill + n > cap and fill:
            row, fill = row + 1, 0
        rows[i] = row
        fill += n
        if n > cap:
            row, fill = row + 1, 0
    return rows


def test_next_fit(spark):
    rng = random.Random(4)
    for cap, most in ((20, 25), (50, 9), (10, 10)):
        items = [(i, rng.randint(1, most)) for i in range(150)]
        got = {r.i: r.row for r in pack.next_fit(frame(spark, items, "i bigint, n int"), "i", "n", cap).collect()}
        assert got == next_fit(items, cap)
    assert pack.next_fit(spark.createDataFrame([], "i bigint, n int"), "i", "n", 5).count() == 0


def test_stream_windows_and_batches(spark):
    rng = random.Random(5)
    seqs = [(i, [rng.randint(0, 99) for _ in range(rng.randint(0, 9))]) for i in range(40)]
    flat = [t for _, s in seqs for t in s]
    d = frame(spark, seqs, "i bigint, t array<int>")
    got = {r.row: r.tokens for r in pack.pack_stream(d, [], "i", "t", 7).collect()}
    assert got == {k: flat[k * 7 : k * 7 + 7] for k in range(len(flat) // 7)}
    win = {r.window: r.tokens for r in pack.sliding_windows(d, [], "i", "t", 10, 3).collect()}
    assert win == {k: flat[k * 3 : k * 3 + 10] for k in range((len(flat) - 10) // 3 + 1)}
    assert pack.pack_stream(d, [], "i", "t", len(flat) + 1).count() == 0
    left = pack.batches(d, "i", "t", 6, left=True, drop_last=True).collect()
    assert len({r.batch for r in left}) == 6 and all(len(r.input_ids) == len(r.labels) == len(r.attention_mask) for r in left)


def test_weighted_draws_can_resume(spark):
    w = spark.createDataFrame([("a", 3.0, 10), ("b", 1.0, 5), ("c", 0.0, 5), ("d", 2.0, 0)], "k string, w double, n int")
    all_ = {r.step: (r.k, r['index']) for r in budget.weighted_draws(spark, w, "k", "w", "n", 2000).collect()}
    rest = {r.step: (r.k, r['index']) for r in budget.weighted_draws(spark, w, "k", "w", "n", 500, start=1500).collect()}
    assert len(all_) == 2000 and all(all_[s] == v for s, v in rest.items())
    share = sum(k == "a" for k, _ in all_.values()) / 2000
    assert abs(share - 0.75) < 0.04 and {k for k, _ in all_.values()} == {"a", "b"}


def test_outliers(spark):
    rows = [("s", i, 10.0) for i in range(12)] + [("s", 12, 101.0), ("s", 13, 100.0), ("s", 14, None)]
    got = {r.i for r in budget.without_outliers(spark.createDataFrame(rows, "k string, i int, n double"), "k", "i", "n").collect()}
    assert got == set(range(12)) | {13}


def test_outliers_of_whole_sources(spark, tmp_path):
    rng = random.Random(5)
    sizes = [int(4 * 2 ** rng.uniform(0, 11)) for _ in range(2600)]
    rows = [(i, "x" * n, "one" if i % 13 else "two") for i, n in enumerate(sizes)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    expected, kept = set(), {"one": [], "two": []}
    for i, t, s in rows:
        if len(kept[s]) <= 10 or len(t) // 4 <= 10 * statistics.median(kept[s]):
            kept[s].append(len(t) // 4)
            expected.add((i, s, len(t) // 4))
    got = [(r.doc_id, r.source, r.tokens) for r in corpus_queries.filter_outliers(spark, str(tmp_path)).collect()]
    assert len(got) == len(expected) < len(rows) and set(got) == expected and max(got)[0] > 2400
    # a null key is a key, and other columns stay
    d = spark.createDataFrame([(None, i, 10, "a") for i in range(12)] + [(None, 12, 101, "b"), (None, 13, 100, "c")], "k string, i int, n int, t string")
    assert {(r.i, r.t) for r in budget.without_outliers(d, "k", "i", "n").collect()} == {(i, "a") for i in range(12)} | {(13, "c")}


def test_adaptive_quotas(spark):
    d = spark.createDataFrame([(1, 2), (2, 50), (3, 0), (4, 50)], "s int, n int")
    assert [r.quota for r in budget.adaptive_quotas(d, "s", "n", 30).orderBy("s").collect()] == [2, 9, 0, 19]
    assert budget.adaptive_quotas(d.limit(0), "s", "n", 30).count() == 0


def test_recommendations(spark):
    grades = spark.createDataFrame([("a", "x", "poor"), ("a", "y", "acceptable"), ("a", "z", "excellent"), ("b", "w", "poor")], "k string, m string, g string")
    advice = spark.createDataFrame([("x", ["one", "two"]), ("y", ["two", "three"]), ("z", ["four"])], "metric string, advice array<string>")
    assert {r.k: r.advice for r in evaluate.recommendations(grades, advice, ["k"], "m", "g").collect()} == {"a": ["one", "two", "three"], "b": []}


def test_capped_shards(spark):
    rows = [("a", 1, 5), ("a", 2, 50), ("a", 3, 1), ("a", 4, 1), ("b", 1, 1)]
    d = frame(spark, rows, "s string, o bigint, n int")
    cut = lambda **k: {(r.s, r.o): r.shard for r in capped_shards(d, "s", "o", "n", 10, **k).collect()}
    assert cut() == {("a", 1): 0, ("a", 2): 0, ("a", 3): 1, ("a", 4): 1, ("b", 1): 0}
    assert cut(overflow=True) == {("a", 1): 0, ("a", 2): 1, ("a", 3): 2, ("a", 4): 2, ("b", 1): 0}
    assert cut(max_docs=1) == {("a", 1): 0, ("a", 2): 1, ("a", 3): 2, ("a", 4): 3, ("b", 1): 0}


def capped(rows, tokens, docs, overflow):
    out, at, shard, used, n = {}, None, 0, 0, 0
    for s, o, t in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        t = t or 0
        if s != at or not out:
            at, shard, used, n = s, 0, 0, 0
        elif (used > 0 and used + t > tokens) if overflow else (used >= tokens or docs is not None and n >= docs):
            shard, used, n = shard + 1, 0, 0
        out[s, o] = shard
        used, n = used + t, n + 1
    return out


def test_capped_shards_over_ranges(spark):
    rng = random.Random(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for sizes, tokens, docs, overflow in (((0, 1, 2, 9), 20, None, False), ((0, 0, 0, 5, 30), 20, None, True), ((1, 3, 50), 20, 7, False), ((0,), 5, 3, False), ((0, None, 4), 9, None, True), ((2,), 10_000, None, False)):
            rows = [(s, i * 3 + k, rng.choice(sizes)) for k, s in enumerate(["a", "b", None]) for i in range({"a": 300, "b": 40}.get(s, 5))]
            d = frame(spark, rows, "s string, o bigint, n int")
            got = capped_shards(d, "s", "o", "n", tokens, docs, overflow).collect()
            assert len(got) == len(rows) and {(r.s, r.o): r.shard for r in got} == capped(rows, tokens, docs, overflow)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert capped_shards(d.limit(0), "s", "o", "n", 5).count() == 0


@pytest.mark.parametrize(
    ("p", "c", "r", "fault"),
    [("a", "b", "c", None), (None, "b", "c", "missing_prompt"), ("a", " \n", "c", "empty_chosen"), ("a", "b", "b", "same"), (" ", None, "c", "missing_chosen")],
)
def test_preference_fault(spark, p, c, r, fault):
    d = spark.createDataFrame([(p, c, r)], "p string, c string, r string")
    assert d.select(filters.preference_fault(F.col("p"), F.col("c"), F.col("r"))).first()[0] == fault


def test_perplexity_edges(spark):
    rows = [("a", 25.0, 10), ("a", float("nan"), 5), ("b", 1.0, 0), ("c", 1.0, 2), ("c", 3.0, 2)]
    got = {r.k: r.perplexity for r in evaluate.perplexity(spark.createDataFrame(rows, "k string, l double, n int"), ["k"], "l", "n").collect()}
    assert math.isclose(got["a"], math.exp(20)) and got["b"] == float("inf") and math.isclose(got["c"], math.exp(2))


def test_response_scores(spark):
    texts = ["", "abcd", "a" * 10, "No.", "the the the the the the the", "This is fine, is it not? Yes."]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in d.select(F.round(evaluate.response_quality(F.col("t")), 6), F.round(evaluate.repetition(F.col("t")), 6), evaluate.is_smoke_valid(F.col("t"))).collect()]
    assert got == [(0.0, 0.0, False), (0.2, 0.0, False), (0.6, 0.0, False), (0.4, 0.0, False), (0.4, 1.0, False), (1.0, 0.0, True)]


def test_grades(spark):
    rows = [(20.0, "<20", "<30", "<40"), (40.0, "<20", "<30", "<40"), (41.0, "<20", "<30", "<40"), (0.65, ">0.65", ">0.5", ">0.1"), (0.05, ">0.65", ">0.5", ">0.1")]
    d = spark.createDataFrame(rows, "v double, g string, a string, p string")
    assert [r[0] for r in d.select(evaluate.graded(*[F.col(c) for c in "vgap"])).collect()] == ["excellent", "acceptable", "poor", "excellent", "poor"]
