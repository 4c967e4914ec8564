"""The paths that only run on hot keys or long chains, against brute force on small data."""

import random

from pyspark.sql import functions as F

from sievelight.operators import audits, dedup, evaluation as E, skew, terms


def test_blocked_lag_and_running(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aab"), p, rng.randint(0, 9)) for p in rng.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "k string, p int, v int")
    got = {(r.k, r.p): (r.before, r.total) for r in skew.blocked_running(
        skew.blocked_lag(df, ["k"], ["p"], F.floor(F.col("p") / 7), {"before": F.col("v")}),
        ["k"], ["p"], F.floor(F.col("p") / 7), F.col("v"), "total", F.sum, lambda a, b: a + b).collect()}
    for key in "ab":
        run, last = 0, None
        for _, p, v in sorted(r for r in rows if r[0] == key):
            run += v
            assert got[(key, p)] == (last, run)
            last = v


def test_hot_keys_are_salted(spark):
    rows = [("hot", i) for i in range(50)] + [("cold%d" % i, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, i int")
    marked = dedup.mark_duplicates(df, ["k"], ["i"], hot_rows=10).collect()
    assert sorted((r.k, r.i) for r in marked if not r.duplicate_delivery) == sorted([("hot", 0)] + [("cold%d" % i, i) for i in range(5)])
    assert len(marked) == len(rows)


def _ttl_brute(rows, ttl):
    keep, last = [], {}
    for t, i, k in sorted((t, i, k) for k, t, i in rows):
        if k not in last or t - last[k] > ttl:
            last[k] = t
            keep.append(i)
    return sorted(keep)


def test_ttl_fold_and_rounds_agree_with_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randint(0, 3000), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, i long").withColumn("ts", F.timestamp_seconds("t"))
    want = _ttl_brute(rows, 100)
    for fold in (10_000, 5):  # 5: every long key goes through the rounds
        got = dedup.dedup_ttl(df, ["k"], "ts", "i", ttl=100, max_fold=fold)
        assert sorted(r.i for r in got.collect()) == want


def test_span_matching_is_greedy_by_overlap(spark):
    rng = random.Random(4)
    found, expected = [], []
    for rec in range(30):
        for j in range(rng.randint(0, 6)):
            s = rng.randint(0, 700)
            found.append((rec, "p", "pii", "f%02d" % j, s, s + rng.randint(1, 400)))
        for j in range(rng.randint(0, 6)):
            s = rng.randint(0, 700)
            expected.append((rec, "p", "pii", "e%02d" % j, s, s + rng.randint(1, 400)))
    cols = "record_id int, field_path string, category string, {} string, start int, end int"
    m = E.match_spans(spark.createDataFrame(found, cols.format("found_id")), spark.createDataFrame(expected, cols.format("entity_id")))
    got = {(r.record_id, r.found_id, r.entity_id) for r in m.collect()}
    want = set()
    for rec in range(30):
        pairs = [(-(min(f[5], e[5]) - max(f[4], e[4])), e[3], f[3]) for f in found if f[0] == rec for e in expected
                 if e[0] == rec and f[4] < e[5] and e[4] < f[5]]
        used_f, used_e = set(), set()
        for _, e, f in sorted(pairs):
            if e not in used_e and f not in used_f:
                used_e.add(e), used_f.add(f)
                want.add((rec, f, e))
    assert got == want


def test_span_chain_of_any_length(spark, monkeypatch):
    """A chain in which each pair only becomes the best once its better neighbour is settled; hot blocks of 64 positions."""
    monkeypatch.setattr(E, "BLOCK", 64)
    cols = "record_id int, field_path string, category string, {} string, start int, end int"
    at, found, expected = 0, [], []
    for i in range(200):  # overlaps shrink along the chain, so the first pairs win in turn
        width = 1000 - 2 * i
        expected.append((1, "p", "pii", "e%03d" % i, at, at + width + (width - 1)))
        found.append((1, "p", "pii", "f%03d" % i, at + width - 1, at + 2 * width - 1 + (width - 2)))
        at += 2 * width - 1
    m = E.match_spans(spark.createDataFrame(found, cols.format("found_id")), spark.createDataFrame(expected, cols.format("entity_id")))
    assert sorted((r.found_id, r.entity_id) for r in m.collect()) == [("f%03d" % i, "e%03d" % i) for i in range(200)]


def test_rules_of_any_length(spark):
    base = [(1, "x y"), (2, "ab"), (3, "-"), (4, "longer phrase"), (5, "a."), (6, ""), (7, None)]
    texts = spark.createDataFrame([(1, "Max Y ab"), (2, "a longer phrase - a.b"), (3, "cab"), (4, None), (5, "")], "id int, t string")
    want = {1: ["x y", "ab", ""], 2: ["-", "longer phrase", "a.", ""], 3: [""], 5: [""]}
    for more in (0, 3000):  # the result does not depend on the number of rules
        rules = spark.createDataFrame(base + [(100 + i, f"absent {i}") for i in range(more)], "pos int, term string")
        assert {r.id: r.terms for r in terms.match_rules(texts, rules, "id", "t").collect()} == want


def test_hostile_rules_equal_brute_force(spark):
    """Overlapping, nested, one-character, repeated and non-ASCII terms; 100 000 rules; several shards."""
    rng = random.Random(9)
    words = ["ab", "ba", "a b", "b a", " ", ".", "..", "a.", ".a", "ab ab", "ü", "ü.", "über x", "aa", "a-a-a", "-a-", "🙂", "🙂 a"]
    base = [(i, rng.choice(words) if i % 3 else rng.choice(words) + rng.choice(words)) for i in range(200)] + [(7, "ab"), (8, "ab"), (9, None), (10, "")]
    rows = [(i, "".join(rng.choice(["ab", "a", " ", ".", "ü", "über X", "-a", "🙂", "B A", "Ab "]) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(0, "a.b"), (100, "." * 50_000 + "ab ab"), (101, None)]
    want = {}
    for i, t in rows:
        if t is not None:
            low = t.lower()
            token = set(terms._TOKEN.findall(low))
            own = {(p, r) for p, r in base if r is not None and (r in token if r.isalnum() else r in low)}
            want[i] = want.get(i, set()) | own
    want = {i: [r for _, r in sorted(own)] for i, own in want.items()}
    texts = spark.createDataFrame(rows, "id int, t string").repartition(3)
    for more, chars in ((0, 400), (100_000, terms.SHARD_CHARS)):
        rules = spark.createDataFrame(base + [(1000 + i, f"absent {i}") for i in range(more)], "pos int, term string")
        assert {r.id: r.terms for r in terms.match_rules(texts, rules, "id", "t", chars).collect()} == want


def test_lineage_of_deep_chains_and_cycles(spark):
    from sievelight.operators.catalogue import resource_lineage

    rng, parent = random.Random(12), {}
    parent |= {f"n{i}": f"n{i - 1}" if i else None for i in range(1000)}
    parent |= {f"x{i}": f"n{rng.randrange(1000)}" for i in range(300)} | {f"h{i}": "n0" for i in range(300)}  # a hot folder
    parent |= {f"c{i}": f"c{(i + 1) % 7}" for i in range(7)} | {"self": "self", "t0": "c3", "t1": "t0", "lost": "nowhere"}
    rows = [("p", k, v) for k, v in parent.items()] + [("q", "n5", None), ("p", "n7", "n6"), ("p", None, "n1")]

    def end(node):
        seen = [node]
        while parent[node] in parent:
            node = parent[node]
            if node in seen:
                return None, None, True
            seen.append(node)
        return node, len(seen) - 1, False

    want = sorted([("p", k, *end(k)) for k in parent] + [("q", "n5", "n5", 0, False)])
    df = spark.createDataFrame(rows, "provider string, resource_id string, parent_id string").repartition(3)
    assert sorted(map(tuple, resource_lineage(df).select("provider", "resource_id", "root_id", "depth", "cyclic").collect())) == want
    assert resource_lineage(df.limit(0)).collect() == []


def test_distributed_rank_equals_rank(spark):
    from pyspark.sql import Window

    rng = random.Random(13)
    df = spark.createDataFrame([(i, rng.choice([None, 0.0, -0.0, float("nan"), 1.5, round(rng.random(), 2)])) for i in range(700)], "i int, v double").repartition(5)
    got = skew.ranked(df, "v", "r")
    want = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert sorted((x.i, x.r) for x in got.collect()) == sorted((x.i, x.r) for x in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("_total")[0]
    assert skew.ranked(df.limit(0), "v", "r").collect() == []


def test_cursor_versions_stay_few_and_survive_failures(spark, tmp_path, monkeypatch):
    import os

    from sievelight.streaming import cursor

    out, folder = str(tmp_path / "out"), str(tmp_path / "cursors")

    def batch(n):
        return spark.createDataFrame([("r1", f"2024-01-{n + 1:02d}", f"e{n}"), ("r2", "2024-01-01", "e0")],
                                     "repository_id string, updated_at string, provider_event_id string")

    def now():
        return {r.repository_id: r.updated_at for r in cursor.read_cursors(spark, folder).collect()}

    assert now() == {}
    for n in range(6):
        cursor.advance_cursor(batch(n), n, out, folder)
        assert now() == {"r1": f"2024-01-{n + 1:02d}", "r2": "2024-01-01"}
    assert sorted(f for f in os.listdir(folder) if f.startswith("version=")) == ["version=4", "version=5"]
    # A replay of the last batch starts from the version before it.
    assert {r.repository_id: r.updated_at for r in cursor.read_cursors(spark, folder, 5).collect()}["r1"] == "2024-01-05"
    for step in ("point_to", "drop_other_versions"):
        with monkeypatch.context() as m:
            m.setattr(cursor, step, lambda *a: 1 / 0)
            try:
                cursor.advance_cursor(batch(6), 6, out, folder)
            except ZeroDivisionError:
                pass
        assert now()["r1"] == ("2024-01-06" if step == "point_to" else "2024-01-07")
    cursor.advance_cursor(batch(6), 6, out, folder)
    assert now()["r1"] == "2024-01-07" and spark.read.parquet(out).count() == 14


def test_daily_runs_with_a_history_equal_one_run(spark, tmp_path):
    from sievelight.operators.history import SeenIds, dedup_run

    rng = random.Random(17)
    rows = [(rng.choice(["a", "b", "c", "", None] + [f"x{k}" for k in range(40)]), rng.randint(0, 4999), i) for i in range(400)]

    def table(rows):
        return spark.createDataFrame(rows, "k string, t long, i long").withColumn("ts", F.timestamp_seconds("t"))

    want = sorted(r.i for r in dedup.dedup_ttl(table(rows), ["k"], "ts", "i", ttl=700).collect())
    history = SeenIds(spark, str(tmp_path / "seen"), ["k"], 4)
    got = []
    for day in range(5):
        own = table([r for r in rows if day * 1000 <= r[1] < (day + 1) * 1000])
        if day == 3:  # a repeated run starts from the version before it
            dedup_run(own, day, history, "ts", "i", "1970-01-01 01:06:40+00:00", ttl=700)
        plan = history.of(own)
        if plan is not None:
            text = plan._jdf.queryExecution().executedPlan().toString()
            seen = text[text.index("seen_") - 3000 if text.index("seen_") > 3000 else 0:]
            assert "Bucketed: true" in text and text.count("Exchange") == 1, seen
        until = f"1970-01-01 {(day + 1) * 1000 // 3600:02d}:{(day + 1) * 1000 % 3600 // 60:02d}:{(day + 1) * 1000 % 60:02d}+00:00"
        got += [r.i for r in dedup_run(own, day, history, "ts", "i", until, ttl=700).collect()]
    assert sorted(got) == want
    assert history.read().agg(F.min("last")).first()[0] >= (5000 - 700) * 1_000_000


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    from sievelight.sources.landing import read_file_lines

    lines = [f"{i} é🙂 " + "x" * (i % 300) for i in range(5000)] + ["y" * 200_000, "", "last"]
    (tmp_path / "big.log").write_bytes("\n".join(lines).encode())
    (tmp_path / "bad.log").write_bytes(b"a\xff\nb")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = read_file_lines(spark, str(tmp_path), "*.log")
        got = df.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    big = sorted((r for r in got if r.path.endswith("big.log")), key=lambda r: (r.start, r["at"]))
    assert [r.line for r in big] == lines and len({r.task for r in big}) > 20
    assert sorted(r.line for r in got if r.path.endswith("bad.log")) == ["a\ufffd", "b"]


def test_rows_without_id_and_ties(spark):
    rows = [("x", 1, 1), ("x", 1, 1), ("", 1, 2), ("", 1, 2), (None, 1, 3), (None, 1, 3), ("y", 1, 4), ("y", 500, 5)]
    df = spark.createDataFrame(rows, "k string, t long, i long").withColumn("ts", F.timestamp_seconds("t"))
    assert sorted(r.i for r in dedup.dedup_deliveries(df, ["k"], ["ts", "i"]).collect()) == [1, 2, 2, 3, 3, 4]
    assert sorted(r.i for r in dedup.dedup_ttl(df, ["k"], "ts", "i", ttl=100).collect()) == [1, 2, 2, 3, 3, 4, 5]
    marks = sorted((r.i, r.duplicate_delivery) for r in dedup.mark_duplicates(df, ["k"], ["ts", "i"]).collect())
    assert marks == [(1, False), (1, True), (2, False), (2, False), (3, False), (3, False), (4, False), (5, True)]


def test_run_caps_count_landed_pages(spark):
    from sievelight.sources import pages as pg

    rows = [("gaps", n, 1, 10) for n in [*range(1, 51), *range(152, 261)]] + [("zero", n, 1, 10) for n in range(101)]
    rows += [("fine", n, 1, 10) for n in range(100)] + [("late", 200, 1, 9 << 20), ("late", 1, 1, 10)]
    got = pg.audit_run_caps(spark.createDataFrame(rows, "run_id string, page_no int, n_items long, n_bytes long"))
    assert sorted(map(tuple, got.select("run_id", "page_no", "reason").collect())) == [
        ("gaps", 202, "max_pages_exceeded"), ("late", 200, "oversized_body"), ("zero", 100, "max_pages_exceeded")]


def test_cursor_waits_and_never_goes_back(spark):
    from sievelight.operators import cursors as I

    rows = [("a", "2024-01-01", "e1", "advance"), ("a", "2024-01-02", "e2", "retry"), ("a", "2024-01-03", "e3", "advance"),
            ("b", "2024-01-01", "e1", "quarantine"), ("c", "2024-01-01", "e1", "advance")]
    batch = spark.createDataFrame(rows, "repository_id string, updated_at string, provider_event_id string, verdict string")
    new = I.next_cursor(I.delivered(batch, "verdict"))
    assert sorted((r.repository_id, r.updated_at) for r in new.collect()) == [("a", "2024-01-01"), ("c", "2024-01-01")]
    now = spark.createDataFrame([("c", "2024-05-01", "e9", 1), ("d", "2024-01-01", "e1", 1)], new.schema)
    assert sorted((r.repository_id, r.updated_at) for r in I.merge_cursors(now, new).collect()) == [
        ("a", "2024-01-01"), ("c", "2024-05-01"), ("d", "2024-01-01")]


def test_ledger_link_skips_broken_entries(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    c = [sha(f"c{i}") for i in range(4)]
    ch1 = sha(c[1] + c[0])
    ch3 = sha(c[3] + ch1)
    rows = [("l", 0, c[0], "GENESIS", None, True), ("l", 1, c[1], c[0], ch1, False), ("l", 2, c[2], None, None, False),
            ("l", 3, c[3], ch1, ch3, False)]
    df = spark.createDataFrame(rows, "l string, pos int, content string, previous string, chain string, is_genesis boolean")
    assert [(r.pos, r.problem) for r in audits.audit_ledger(df, "l", block_size=1).collect()] == [(2, "missing_hash")]
