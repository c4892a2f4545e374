"""The audit log, derived from change feeds or from pairs of snapshots.

A change feed has the columns ``op`` (INSERT, UPDATE, DELETE), ``before`` and
``after`` (structs, null where there is no such row) and ``changed_at``; a
``change_id``, where the feed has one, becomes the key of the log.
Deriving the log is a projection without state, so the same function serves
batches and streams. An update that changes nothing is logged from a feed; a
pair of snapshots cannot show it. An update of a key is one change in a feed
and a delete plus an insert between snapshots.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acadmetric.functions.keys import key_text, record_image
from acadmetric.operators.quality import with_broken_rules
from acadmetric.schema import Table

# Operation codes of the log.
OPERATIONS = {"INSERT": "I", "UPDATE": "A", "DELETE": "E"}


@dataclass(frozen=True)
class Actor:
    """Who changed the data; a job passes what a database session would know."""

    session_user: str
    address: str = "local"
    application_user: str | None = None


def audit_from_changes(feed: DataFrame, table: str, key: Sequence[str], actor: Actor) -> DataFrame:
    """One log row per change. The key is read from the new row, or from the old one on delete."""
    op = F.col("op")
    code = F.when(op == "INSERT", OPERATIONS["INSERT"]).when(op == "UPDATE", OPERATIONS["UPDATE"]).when(
        op == "DELETE", OPERATIONS["DELETE"])
    deleted = op == "DELETE"
    numbered = [F.col("change_id").alias("co_seq_auditoria")] if "change_id" in feed.columns else []
    return feed.select(
        *numbered,
        F.col("changed_at").alias("au_dt_operacao"),
        code.alias("au_tp_operacao"),
        F.lit(table).alias("au_nm_tabela"),
        F.when(deleted, key_text(key, "before")).otherwise(key_text(key, "after")).alias("au_ds_chave_registro"),
        F.lit(actor.session_user).alias("au_ds_usuario_sessao"),
        F.lit(actor.address).alias("au_nu_ip_sessao"),
        F.lit(actor.application_user).cast("string").alias("au_ds_usuario_aplicacao"),
        F.when(op != "INSERT", record_image(F.col("before"))).alias("au_ds_dados_anteriores"),
        F.when(~deleted, record_image(F.col("after"))).alias("au_ds_dados_novos"),
    )


def checked_changes(feed: DataFrame, table: Table) -> DataFrame:
    """The feed with ``broken_rules`` of the new row: accepted changes have an empty list.

    Only rules that a row can break by itself are decided here, without state,
    so that a stream can be split as well. Deletes are accepted.
    """
    row = feed.select(F.struct("*").alias("_change"), *[
        F.col(f"after.{c.name}").alias(c.name) for c in table.columns])
    broken = with_broken_rules(row, table).select("_change.*", "broken_rules")
    none = F.array().cast("array<string>")
    return broken.withColumn("broken_rules", F.when(F.col("op") == "DELETE", none).otherwise(F.col("broken_rules")))


def checked_batch(feed: DataFrame, table: Table, held: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The feed with ``broken_rules`` of row, key, unique and reference rules, against the stored table and its parents.

    ``feed`` needs a ``change_id``; the changes of a batch are judged against the table as it was, and those that bring the
    same new key or natural key are judged together: the first by change_id stays. A change that keeps its row's key or
    natural key does not compete for it. Values are looked up once each, so one that a third of the changes share is one row.
    """
    checked = checked_changes(feed, table)
    for rule, columns in [("pk", table.key), *(("unique", (c,)) for c in table.unique)]:
        new = [F.col(f"after.{c}") for c in columns]
        brings = (F.col("op") != "DELETE") & reduce(Column.__and__, [c.isNotNull() for c in new]) & ~F.coalesce(
            reduce(Column.__and__, [F.col(f"before.{c}") == F.col(f"after.{c}") for c in columns]), F.lit(False))
        names = [f"_new_{i}" for i in range(len(columns))]
        claims = checked.filter(brings).select(*[v.alias(n) for v, n in zip(new, names, strict=True)], "change_id")
        first = claims.groupBy(*names).agg(F.min("change_id").alias("_first"))
        taken = held.select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)]).distinct().withColumn("_taken", F.lit(True))
        judged = first.join(taken, names, "left")
        keyed = checked.select("*", *[F.when(brings, v).alias(n) for v, n in zip(new, names, strict=True)]).join(judged, names, "left")
        broken = F.col("_first").isNotNull() & (F.coalesce("_taken", F.lit(False)) | (F.col("_first") != F.col("change_id")))
        checked = _marked(keyed, broken, f"{rule}: {','.join(columns)}", checked.columns)
    for column, (parent, parent_column) in table.references.items():
        known = parents[parent].select(F.col(parent_column).alias("_value")).distinct().withColumn("_known", F.lit(True))
        keyed = checked.withColumn("_value", F.when(F.col("op") != "DELETE", F.col(f"after.{column}"))).join(known, "_value", "left")
        checked = _marked(keyed, F.col("_value").isNotNull() & F.col("_known").isNull(), f"fk: {column}", checked.columns)
    return checked


def _marked(df: DataFrame, broken: Column, rule: str, columns: Sequence[str]) -> DataFrame:
    more = F.when(broken, F.array_append("broken_rules", F.lit(rule))).otherwise(F.col("broken_rules"))
    return df.withColumn("broken_rules", more).select(*columns)


def snapshot_changes(old: DataFrame, new: DataFrame, key: Sequence[str], changed_at: Column) -> DataFrame:
    """The change feed between two snapshots with the same columns and a unique key."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"_{name}_{c}") for c in key],
                         F.struct(*old.columns).alias(name))

    same_key = [F.col(f"_before_{c}") == F.col(f"_after_{c}") for c in key]
    both = side(old, "before").join(side(new, "after"), same_key, "full_outer")
    before, after = F.col("before"), F.col("after")
    op = F.when(before.isNull(), "INSERT").when(after.isNull(), "DELETE").when(
        ~before.eqNullSafe(after), "UPDATE")
    return both.select(op.alias("op"), "before", "after", changed_at.alias("changed_at")).filter(F.col("op").isNotNull())


def bucket_digests(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, total, mixed): a digest of the rows of each bucket of keys, at most ``buckets`` rows.

    Two independent 64-bit hashes of a row are summed and combined by exclusive or, so the order of rows does not matter and digests of
    parts combine. Missing values are hashed by their places, as a hash alone passes over them.
    """
    row = [*[F.col(c) for c in df.columns], F.array(*[F.col(c).isNull() for c in df.columns])]
    first, second = F.xxhash64(F.lit(1), *row), F.xxhash64(F.lit(2), *row)
    return df.groupBy(_bucket(key, buckets).alias("bucket")).agg(
        F.count("*").alias("rows"), F.sum(first.cast("decimal(20,0)")).alias("total"), F.bit_xor(second).alias("mixed"))


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def rolled_up(digests: DataFrame, fanout: int) -> DataFrame:
    """The digests one level up: each of ``fanout`` neighbouring buckets."""
    return digests.groupBy(F.expr(f"cast(bucket div {fanout} as int)").alias("bucket")).agg(
        F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed"))


def unequal_buckets(old: DataFrame, new: DataFrame, fanout: int | None = None) -> DataFrame:
    """(bucket) whose digests differ or are on one side only.

    With ``fanout``, digests one level up are compared first and only the children of unequal ones after them: for digests that are
    stored, and far apart.
    """
    if fanout:
        parents = F.broadcast(unequal_buckets(rolled_up(old, fanout), rolled_up(new, fanout)).withColumnRenamed("bucket", "parent"))
        old, new = (d.join(parents, F.expr(f"bucket div {fanout} = parent"), "left_semi") for d in (old, new))
    same = [F.col(f"o.{c}") == F.col(f"n.{c}") for c in ("bucket", "rows", "total", "mixed")]
    gone = old.alias("o").join(new.alias("n"), same, "left_anti").select("bucket")
    come = new.alias("n").join(old.alias("o"), same, "left_anti").select("bucket")
    return gone.union(come).distinct()


def snapshot_changes_by_digest(old: DataFrame, new: DataFrame, key: Sequence[str], changed_at: Column, buckets: int = 1 << 14,
                               old_digests: DataFrame | None = None, new_digests: DataFrame | None = None) -> DataFrame:
    """The change feed of :func:`snapshot_changes` for snapshots that agree in most buckets of keys.

    Digests are compared first; rows of buckets with equal digests are dropped where they are read and take part in no
    shuffle. The numbers of unequal buckets, at most ``buckets``, are sent to every task. Digests that were stored with a
    snapshot may be given, made with the same key and number of buckets; then a snapshot is read once. That different rows have
    equal digests has a chance of about 2^-120; a change that is not seen that way is not logged.
    """
    apart = unequal_buckets(
        bucket_digests(old, key, buckets) if old_digests is None else old_digests,
        bucket_digests(new, key, buckets) if new_digests is None else new_digests)

    def differing(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", _bucket(key, buckets)).join(
            F.broadcast(apart.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi").select(*df.columns)

    return snapshot_changes(differing(old), differing(new), key, changed_at)
