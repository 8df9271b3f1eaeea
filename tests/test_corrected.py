"""The self-correcting scorer: late rows, corrections, hot customers, eviction."""

from datetime import timedelta

from pyspark.sql import functions as F

from test_rules import T0, make_fixture
from vigil.operators.rules import RULE_COLUMNS, RuleConfig, score_transactions
from vigil.streaming.corrected import SHARDS, corrected_scores, latest_scores
from vigil.streaming.flows import state_rows

COLUMNS = ("transaction_id string, customer_id string, card_number string, merchant_id string, amount double, device_id string, city string, "
           "transaction_timestamp timestamp, is_international boolean")
CFG = RuleConfig(min_bucket_seconds=900, velocity_count=3, card_test_count=2)
FLAGS = list(RULE_COLUMNS.values())


class Scorer:
    def __init__(self, spark, folder, watermark="2 days"):
        self.spark, self.folder, self.watermark, self.rows = spark, folder, watermark, []
        self.customers = spark.createDataFrame([(f"C{i}", "DEV1") for i in range(5)], "customer_id string, trusted_device_id string")
        self.merchants = spark.createDataFrame([("M0", "HIGH", False), ("M1", "LOW", True)], "merchant_id string, merchant_risk string, is_blacklisted boolean")

    def send(self, rows):
        self.rows += rows
        df = self.spark.createDataFrame(rows, COLUMNS)
        df.write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(df.schema).parquet(f"{self.folder}/in")
        self.query = (corrected_scores(stream, self.customers, self.merchants, CFG, self.watermark).writeStream.format("parquet")
                      .option("path", f"{self.folder}/out").option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start())
        self.query.awaitTermination()
        return self.spark.read.parquet(f"{self.folder}/out")

    def batch(self):
        df = self.spark.createDataFrame(self.rows, COLUMNS)
        return self.compared(score_transactions(df, self.customers, self.merchants, CFG))

    @staticmethod
    def compared(df):
        return sorted((tuple(r) for r in df.select("transaction_id", "customer_id", "transaction_timestamp", "fraud_score", "fraud_reason", *FLAGS).collect()), key=repr)


def test_five_batches_with_late_rows_equal_batch_scoring(spark, workdir):
    rows = sorted(make_fixture(n=400), key=lambda r: r[7])
    rows += [(None, "C0", "x", "M0", 5.0, None, "Delhi", T0 + timedelta(minutes=1), None), ("T00001", "C1", "x", None, None, None, None, T0 + timedelta(minutes=2), True),
             ("T00001", "C1", "x", None, None, None, None, T0 + timedelta(minutes=2), True), ("none", "C2", "x", "M9", 9.0, "DEV1", "Delhi", None, False),
             ("none", "C2", "x", "M9", 9.0, "DEV1", "Delhi", None, False), ("nobody", None, "x", "M1", 9.0, "DEV1", "Delhi", T0, False)]
    turn = [min(4, i * 5 // 400 + (1 if i % 7 == 0 else 0)) for i in range(len(rows))]
    s = Scorer(spark, workdir)
    for n in range(5):
        out = s.send([r for r, t in zip(rows, turn) if t == n])
    assert s.compared(latest_scores(out)) == s.batch()
    assert out.filter("revision > 0").count() > 10 and out.groupBy("customer_id", "bucket", "seq", "revision").count().filter("count > 1").isEmpty()
    # the hot customer's rows are spread over many state keys
    keys = dict(out.filter("bucket IS NOT NULL").groupBy("customer_id").agg(F.countDistinct("bucket")).collect())
    assert keys["C0"] > 10


def test_a_late_row_corrects_the_row_after_it_and_closed_buckets_are_evicted(spark, workdir):
    def tx(i, minute, city, amount=50.0):
        return (f"T{i}", "C1", "x", "M9", amount, "DEV1", city, T0 + timedelta(minutes=minute), False)

    s = Scorer(spark, workdir, watermark="60 minutes")
    out = s.send([tx(1, 0, CFG.travel_from), tx(3, 20, CFG.travel_to)])
    assert {r.transaction_id: r.rule_impossible_travel for r in out.collect()} == {"T1": False, "T3": True}
    out = s.send([tx(2, 10, "Mumbai")])
    third = {r.revision: (r.rule_impossible_travel, r.fraud_score) for r in out.filter("transaction_id = 'T3'").collect()}
    assert third[0][0] and not third[1][0] and third[1][1] < third[0][1] and len(third) == 2
    assert s.compared(latest_scores(out)) == s.batch()
    held = state_rows(s.query)
    s.send([tx(4, 60 * 24, "Delhi")])
    s.send([tx(5, 60 * 24 + 1, "Delhi")])
    assert 0 < state_rows(s.query) <= held
    before = latest_scores(s.spark.read.parquet(f"{workdir}/out")).count()
    out = s.send([tx(6, 5, "Delhi")])                                      # a day late: dropped
    assert latest_scores(out).count() == before == 5


def test_state_keys_are_bounded_however_many_customers(spark, workdir):
    """Before, every customer of a time bucket was a state key of its own."""
    rows = [(f"T{i}", f"N{i}", "x", "M0", 5.0, "DEV1", "Delhi", T0 + timedelta(minutes=i % 7), False) for i in range(900)]
    s = Scorer(spark, workdir)
    out = s.send(rows)
    assert s.compared(latest_scores(out)) == s.batch()
    assert 0 < state_rows(s.query) <= 2 * 2 * SHARDS                     # keys and timers of a bucket and the next


def test_customers_of_one_shard_do_not_see_each_other(spark, workdir, monkeypatch):
    monkeypatch.setattr(corrected_scores, "__defaults__", (*corrected_scores.__defaults__[:-1], 1))
    rows = sorted(make_fixture(n=300), key=lambda r: r[7])
    s = Scorer(spark, workdir)
    s.send([r for i, r in enumerate(rows) if i % 5])
    out = s.send([r for i, r in enumerate(rows) if not i % 5])
    assert s.compared(latest_scores(out)) == s.batch()
    assert out.select("customer_id").distinct().count() > 1 and out.filter("revision > 0").count() > 5
