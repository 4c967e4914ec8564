"""Findings of round 3, each on a small table that showed it."""

import hashlib

from pyspark.sql import functions as F

from sievelight.functions import sensitive as S
from sievelight.functions.canonical import canonical, json_object
from sievelight.operators import evaluation as E, redaction as R
from sievelight.plans import common, q_delivery, q_redaction, q_sources
from sievelight.sources import pages as pg
from sievelight.streaming import dedup as stream_dedup


def events(spark, folder, n, event_id="id", k="76"):
    """An events table of ``n`` rows of one type; ``event_id`` and ``k`` are SQL over ``id``."""
    spark.range(n).selectExpr(
        f"CAST({event_id} AS BIGINT) AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "CAST(id AS BIGINT) AS user_id", "'view' AS event_type",
        "1.0D AS value", f"concat('{{\"k\": ', CAST({k} AS INT), '}}') AS props").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_digests_of_a_long_file_pass_the_range_of_a_long(spark, tmp_path):
    folder = events(spark, tmp_path, 80_000, "id * 16")
    (row,) = q_sources.local_file_lines(spark, folder).collect()
    want = sum(int(hashlib.md5(f'{i * 16}|é|{{"k": 76}}'.encode()).hexdigest()[:12], 16) for i in range(80_000))
    assert want > 2**63 and (int(row.digests), row.n_lines) == (want, 80_000)


def test_digests_that_fit_stay_longs(spark, tmp_path):
    assert dict(q_sources.local_file_lines(spark, events(spark, tmp_path, 64)).dtypes)["digests"] == "bigint"


def test_the_first_event_is_admitted(spark, tmp_path):
    got = q_delivery.admitted_events(spark, events(spark, tmp_path, 2)).where("source = 'linear'").collect()
    assert sorted(r.event_id for r in got) == [0, 1]


def test_tasks_of_text_rules_are_bounded_by_rows(spark):
    one_file = spark.range(0, 9_000, 1, 1)
    assert common.spread(one_file, 500).rdd.getNumPartitions() == 18
    assert common.spread(one_file).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


class Store:
    """A state handle in memory that counts its calls."""

    def __init__(self):
        self.calls, self.timers, self.map, self.value = 0, [], {}, None

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return Last(self)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)

    def exists(self):
        return self._called(bool(self.map))

    def containsKey(self, k):
        return self._called(k in self.map)

    def getValue(self, k):
        return self._called(self.map[k])

    def updateValue(self, k, v):
        self._called(self.map.update({k: v}))

    def removeKey(self, k):
        self._called(self.map.pop(k))

    def keys(self):
        return self._called(iter(list(self.map)))

    def iterator(self):
        return self._called(iter(list(self.map.items())))

    def clear(self):
        self._called(self.map.clear())

    def _called(self, out):
        self.calls += 1
        return out


class Last:
    def __init__(self, store):
        self.store = store

    def exists(self):
        return self.store.value is not None

    def get(self):
        return self.store.value

    def update(self, v):
        self.store.value = v

    def clear(self):
        self.store.value = None


class Clock:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = lambda: ms


def test_a_waiting_row_costs_one_call_of_the_state():
    store, judge = Store(), stream_dedup.TtlJudge(100)
    judge.init(store)
    rows = [(i, True, i, i * 1_000_000) for i in range(1000)] + [(1000, True, 1000, 0)]
    got = list(judge.handleInputRows(("a",), iter(rows), Clock(0)))
    assert got == [(1000, "duplicate")] and len(store.timers) == 1
    first = dict(judge.handleExpiredTimer(("a",), Clock(500_000), None))
    assert sorted(first) == list(range(500)) and [i for i in first if first[i] == "accepted"] == [0, 101, 202, 303, 404]
    assert len(store.timers) == 3  # that of the first row, of the next one that waits, and of the window
    rest = dict(judge.handleExpiredTimer(("a",), Clock(2_000_000), None))
    assert [i for i in rest if rest[i] == "accepted"] == [505, 606, 707, 808, 909] and not store.map
    assert store.calls < 1000 + 500 + 20


def test_plain_observations_are_written_by_one_call(spark, tmp_path):
    rows = q_redaction.tracked(spark, events(spark, tmp_path, 40, k="id")).withColumns({
        "metadata": F.when(F.col("event_id") % 4 == 1, F.create_map(F.lit("z"), F.lit('q"\\\x0b\u00e9/'), F.lit("a"), F.lit(None).cast("string")))
        .when(F.col("event_id") % 4 == 2, F.create_map(F.lit("tombstone"), F.lit("true"))).when(F.col("event_id") % 4 == 3, F.col("metadata")),
        "title": F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.lit("t\x1f\x7f\u2028"))})
    plain = canonical(json_object(R.observation_fields()))
    got = rows.select(R.observation_json().alias("a"), plain.alias("b")).collect()
    assert len(got) == 40 and all(r.a == r.b for r in got)
    # A writer call per text, map value and map key took most of the time of a receipt.
    used = rows.select(R.observation_json().alias("a"))._jdf.queryExecution().analyzed().toString()
    assert used.index("arrays_overlap") < used.index("to_json(struct(author")


def test_text_without_any_rule_is_scanned_once(spark):
    found = [
        "AKIA" + "A" * 16, "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE" + " KEY-----", "eyJa.eyJb.c", "xoxb-" + "a" * 10, "AIza" + "a" * 35, "sk_live_" + "a" * 24,
        "rk_live_" + "a" * 24, "glpat-" + "a" * 20, "npm_" + "a" * 36, "sk-" + "a" * 32, "sk-proj-" + "a" * 32, "github_pat_" + "a" * 82, "MRN : 12345",
        "Social_Security_Number = x", "dob:", "patient id\u00a0: 1234567", "4111" + "1" * 12, "a@b.co", "(555) 123-4567", "+44 20 7946 0958", "tel 1-2-3-4-5-6-7",
        "\u0664\u0665\u0666\u0661\u0662\u0663\u0664\u0665\u0666\u0667", "DefaultEndpointsProtocol=https;AccountName=a;AccountKey=" + "a" * 40 + ";"]
    clean = ["", "T click", "alice 123456", "task-list ghosts AKI"]
    rows = spark.createDataFrame([(t,) for t in found + clean], "t string").select(
        "t", S.maybe_any(F.col("t")).alias("maybe"), S.redact(F.col("t")).alias("r"), S.redact_with_findings(F.col("t")).alias("f"),
        F.size(S.detect(F.col("t"))).alias("hits"), S.maybe_hit(F.col("t")).alias("maybe_hit")).collect()
    for r in rows:
        assert r.maybe == (r.t in found) and (r.r != r.t) == (r.t in found), r.t
        assert r.f.text == r.r and r.f.credential + r.f.pii + r.f.secret == (1 if r.t in found else 0), r
        assert r.maybe_hit or not r.hits, r.t


def test_relay_pages_are_read_once(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 4, "b"), (1, 6, "a"), (2, 1, "a"), (2, 1, "a"), (2, 2, None), (3, 5, None), (3, 6, None), (4, 7, "x"), (4, 7, "x"), (4, 9, "x")]
    out = pg.check_relay_chain(spark.createDataFrame(rows, "run_id long, page_no int, end_cursor string"))
    assert sorted(map(tuple, out.collect())) == [(1, 4, "circular_cursor"), (4, 9, "circular_cursor")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_spans_are_labelled_by_matches_made_once(spark):
    cols = "record_id long, field_path string, category string, {} string"
    expected = spark.createDataFrame([(1, "b", "p", "e1"), (1, "b", "p", "e1"), (1, "b", "p", "e2"), (2, "b", "q", None)], cols.format("entity_id"))
    found = spark.createDataFrame([(1, "b", "p", "f1"), (3, "b", "q", "f1")], cols.format("found_id"))
    matches = spark.createDataFrame([(1, "b", "p", "f1", "e1", True)], cols.format("found_id") + ", entity_id string, exact boolean")
    out = E.label_spans(found, expected, matches)
    assert sorted(map(tuple, out.collect())) == [("p", "fn", False), ("p", "tp", True), ("p", "tp", True), ("q", "fn", False), ("q", "fp", False)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
