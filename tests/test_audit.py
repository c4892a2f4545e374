from __future__ import annotations

import json

import pytest
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryException

from acadmetric.catalog.governance import ACTOR, event_changes
from acadmetric.operators.audit import (
    Actor, audit_from_changes, bucket_digests, checked_changes, rolled_up, snapshot_changes, snapshot_changes_by_digest, unequal_buckets)
from acadmetric.schema import TABLES, Column, Table
from acadmetric.sources.driver import SCHEMAS, StarTables
from acadmetric.streaming import checked_stream
from acadmetric.streaming.audit_stream import audit_all, change_stream

FEED = ("op string, before struct<a:int,b:int,note:string>, after struct<a:int,b:int,note:string>, "
        "changed_at timestamp_ntz")


def feed(spark):
    import datetime as dt

    at = dt.datetime(2024, 1, 1, 12, 0, 0, 179575)
    return spark.createDataFrame([
        ("INSERT", None, (1, 2, None), at),
        ("UPDATE", (1, 2, None), (1, 2, None), at),
        ("UPDATE", (1, 2, None), (1, 3, "x"), at),
        ("DELETE", (1, 3, "x"), None, at),
    ], FEED)


def test_log_of_a_change_feed(spark):
    log = audit_from_changes(feed(spark), "rt_x", ["a", "b"], Actor("maria", application_user="painel")).collect()
    assert [r.au_tp_operacao for r in log] == ["I", "A", "A", "E"]
    assert [r.au_ds_chave_registro for r in log] == ["a=1;b=2;", "a=1;b=2;", "a=1;b=3;", "a=1;b=3;"]
    assert log[0].au_ds_dados_anteriores is None and log[3].au_ds_dados_novos is None
    assert json.loads(log[0].au_ds_dados_novos) == {"a": 1, "b": 2, "note": None}
    assert json.loads(log[2].au_ds_dados_anteriores)["b"] == 2
    assert {(r.au_ds_usuario_sessao, r.au_nu_ip_sessao, r.au_ds_usuario_aplicacao) for r in log} == {
        ("maria", "local", "painel")}
    assert log[0].au_dt_operacao.microsecond == 179575


def test_snapshots_show_no_idle_update_and_split_key_changes(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "y", "n"), (3, "z", None)], "k int, v string, w string")
    new = spark.createDataFrame([(1, "x", None), (2, "y", None), (4, "z", None)], "k int, v string, w string")
    changes = snapshot_changes(old, new, ["k"], F.current_timestamp())
    log = audit_from_changes(changes, "t", ["k"], Actor("maria"))
    got = sorted((r.au_tp_operacao, r.au_ds_chave_registro) for r in log.collect())
    assert got == [("A", "k=2;"), ("E", "k=3;"), ("I", "k=4;")]


def test_changes_applied_to_the_old_snapshot_give_the_new_one(spark):
    old = spark.range(50).select((F.col("id") % 40).alias("k"), F.col("id").alias("v")).dropDuplicates(["k"])
    new = old.filter("k % 7 <> 0").withColumn("v", F.when(F.col("k") % 3 == 0, None).otherwise(F.col("v"))).unionAll(
        spark.range(100, 105).select("id", "id"))
    changes = snapshot_changes(old, new, ["k"], F.current_timestamp())
    touched = changes.select("before.k").filter("k IS NOT NULL")
    applied = old.join(touched, "k", "left_anti").unionAll(
        changes.filter("op <> 'DELETE'").select("after.k", "after.v"))
    assert sorted(rows(applied), key=str) == sorted(rows(new), key=str)


def test_stream_equals_batch_and_restarts_without_repeats(spark, small, tmp_path):
    batch = audit_from_changes(event_changes(StarTables(spark, small).events), "events", ["event_id"], ACTOR)

    def run():
        return audit_all(spark, small, SCHEMAS["events"], "events.parquet", event_changes, "events", ["event_id"],
                         ACTOR, str(tmp_path / "log"), str(tmp_path / "checkpoint"))

    want = sorted(rows(batch.select(sorted(batch.columns))), key=str)
    assert sorted(rows(run().select(sorted(batch.columns))), key=str) == want
    assert run().count() == len(want)


def test_changes_are_split_before_they_are_logged(spark):
    pair = "struct<co_seq_producao:int,co_seq_docente:int,tp_participacao:string>"
    feed = spark.createDataFrame([
        ("INSERT", None, (1, 2, "AP")), ("INSERT", None, (1, 3, "XX")), ("UPDATE", (1, 2, "AP"), (None, 2, "CA")),
        ("DELETE", (9, 9, "ZZ"), None),
    ], f"op string, before {pair}, after {pair}").withColumn("changed_at", F.current_timestamp())
    checked = checked_changes(feed, TABLES["rt_producao_docente"])
    rejected = checked.filter(F.size("broken_rules") > 0)
    assert sorted(r.broken_rules[0] for r in rejected.collect()) == [
        "check: tp_participacao domain", "required: co_seq_producao"]
    accepted = checked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    log = audit_from_changes(accepted, "rt_producao_docente", ["co_seq_producao", "co_seq_docente"], Actor("maria"))
    assert sorted((r.au_tp_operacao, r.au_ds_chave_registro) for r in log.collect()) == [
        ("E", "co_seq_producao=9;co_seq_docente=9;"), ("I", "co_seq_producao=1;co_seq_docente=2;")]
    assert accepted.count() + rejected.count() == feed.count()


def snapshots(spark):
    old = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("a"), F.lit(None).cast("long").alias("b"), F.col("id").cast("string").alias("t"))
    moved = F.col("k") == 77  # the value goes from one column to the other
    new = old.withColumn("b", F.when(moved, F.col("a"))).withColumn("a", F.when(~moved, F.col("a"))).filter("k <> 9").unionByName(
        spark.createDataFrame([(5000, 1, None, "n")], old.schema)).withColumn("t", F.when(F.col("k") == 1234, "x").otherwise(F.col("t")))
    return old, new


def test_digests_find_the_same_changes(spark):
    old, new = snapshots(spark)
    want = sorted(rows(snapshot_changes(old, new, ["k"], F.lit(1))), key=str)
    for buckets in (1, 16, 4096):
        assert sorted(rows(snapshot_changes_by_digest(old, new, ["k"], F.lit(1), buckets)), key=str) == want
    assert [r[0] for r in want] == ["DELETE", "INSERT", "UPDATE", "UPDATE"]
    assert rows(snapshot_changes_by_digest(old, old.repartition(7), ["k"], F.lit(1))) == []


def test_equal_buckets_are_in_no_shuffle(spark):
    old, new = snapshots(spark)
    apart = rows(unequal_buckets(bucket_digests(old, ["k"], 4096), bucket_digests(new, ["k"], 4096)))
    assert 0 < len(apart) <= 4
    df = snapshot_changes_by_digest(old, new, ["k"], F.lit(1), 4096)
    df.collect()
    plan, shuffled, leaves = df._jdf.queryExecution().executedPlan().executedPlan(), 0, []

    def walk(node):
        nonlocal shuffled
        if node.nodeName() == "Exchange" and "k#" in node.simpleString(200) and "bucket" not in node.simpleString(200):
            shuffled += node.metrics().apply("shuffleRecordsWritten").value()
        children = [node.plan()] if node.nodeName().endswith("QueryStage") else []
        found = node.children()
        children += [found.apply(i) for i in range(found.length())]
        for child in children:
            walk(child)

    walk(plan)
    assert shuffled <= 16


def test_digests_roll_up(spark):
    old, new = snapshots(spark)
    a, b = (bucket_digests(d, ["k"], 64) for d in (old, new))
    top = rolled_up(a, 64).first()
    assert top.rows == 2000 and top.bucket == 0
    assert sorted(rows(unequal_buckets(a, b))) == sorted(rows(unequal_buckets(a, b, fanout=8)))
    assert rows(unequal_buckets(a, a, fanout=8)) == []


RULED = Table("tb_x", (Column("k", T.LongType()), Column("v", T.StringType(), True, 5), Column("g", T.LongType(), False)), ("k",), unique=("v",),
              references={"g": ("tb_g", "id")})


def change(i, op, before, after):
    import datetime as dt

    return i, op, before, after, dt.datetime(2024, 1, 1)


def store_of(spark, path):
    return checked_stream.CheckedStore(path, RULED, {"tb_g": spark.range(3)}, Actor("maria"))


BATCHES = [
    [change(1, "INSERT", None, (1, "a", 0)), change(2, "INSERT", None, (1, "b", 0)), change(3, "INSERT", None, (2, "too long", None)),
     change(4, "INSERT", None, (3, "c", 9)), change(5, "INSERT", None, (4, "d", 1))],
    [change(6, "INSERT", None, (1, "e", 0)), change(7, "UPDATE", (4, "d", 1), (4, "dd", 2)), change(8, "UPDATE", (1, "a", 0), (7, "a", 0)),
     change(9, "INSERT", None, (8, "dd", 0)), change(10, "INSERT", None, (9, "d", 0))],
    [change(11, "DELETE", (7, "a", 0), None), change(12, "INSERT", None, (1, "z", None)), change(13, "INSERT", None, (7, "y", None))],
]
# Judged against the table as it was before the batch.
BROKEN = {2: ["pk: k"], 3: ["length: v"], 4: ["fk: g"], 6: ["pk: k"], 9: ["unique: v"], 10: ["unique: v"], 13: ["pk: k"]}
FEED_SCHEMA = T.StructType([T.StructField("change_id", T.LongType()), T.StructField("op", T.StringType()), T.StructField("before", RULED.struct),
                            T.StructField("after", RULED.struct), T.StructField("changed_at", T.TimestampNTZType())])


def deliver(spark, path, batch):
    spark.createDataFrame(batch, FEED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/feed")


def run_stream(spark, path):
    store_of(spark, f"{path}/store").start(change_stream(spark, f"{path}/feed", FEED_SCHEMA)).awaitTermination()


def test_a_stream_judges_changes_against_the_stored_table(spark, tmp_path):
    store = store_of(spark, f"{tmp_path}/store")
    for i, batch in enumerate(BATCHES):
        deliver(spark, tmp_path, batch)
        run_stream(spark, tmp_path)
        if i == 1:
            before = sorted(rows(store.current(spark)))
            store.compact(spark)
            assert sorted(rows(store.current(spark))) == before
    got = {r.change_id: r.broken_rules for r in store.changes(spark).collect()}
    assert got == {c[0]: BROKEN.get(c[0], []) for b in BATCHES for c in b}
    assert sorted(rows(store.current(spark)), key=str) == [(1, "z", None), (4, "dd", 2)]
    assert {r.au_ds_chave_registro for r in store.log(spark).filter("batch = 2").collect()} == {"k=7;", "k=1;"}
    assert store.log(spark).count() == 13 - len(BROKEN)


@pytest.mark.parametrize("step", ["log", "ledger"])
def test_a_batch_that_stops_half_way_is_judged_once(spark, tmp_path, monkeypatch, step):
    store = store_of(spark, f"{tmp_path}/store")
    deliver(spark, tmp_path, BATCHES[0])
    run_stream(spark, tmp_path)
    deliver(spark, tmp_path, BATCHES[1])

    def stops(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        if step == "log":
            patch.setattr(checked_stream, "audit_from_changes", stops)
        else:
            patch.setattr(checked_stream.CheckedStore, "_mark", stops)
        with pytest.raises(StreamingQueryException):
            run_stream(spark, tmp_path)
    assert store.committed(spark) == [0] and store.changes(spark).count() == 5
    run_stream(spark, tmp_path)
    run_stream(spark, tmp_path)
    assert store.committed(spark) == [0, 1]
    got = {r.change_id: r.broken_rules for r in store.changes(spark).collect()}
    assert got == {c[0]: BROKEN.get(c[0], []) for b in BATCHES[:2] for c in b}
    assert store.changes(spark).count() == 10 and store.log(spark).count() == 4
