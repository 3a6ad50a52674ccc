"""Keyed writes as associative folds.

Applying rows one by one, where a column either takes the newest value, keeps its first one,
or takes the newest non-null one, equals one aggregate per column over the arrival order.
So a batch is folded to one row per key first (map-side partial results, whatever the skew),
and the stored table only takes part in one join on unique keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import keep_old
from vitrine.functions.times import utc_date

@dataclass(frozen=True)
class Policy:
    """How each stored column follows a batch.

    ``last``: the newest row's value, null included.  ``last_non_null``: the newest value that
    is not null.  ``first``: the value from when the key was first stored.
    """

    key: str
    last: tuple[str, ...] = ()
    last_non_null: tuple[str, ...] = ()
    first: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, *self.last, *self.last_non_null, *self.first)


PRODUCTS = Policy(
    key="product_id",
    last=(
        "product_group",
        "model_number",
        "set_size",
        "name",
        "name_full",
        "condition",
        "model_code",
        "price_yen",
        "url",
        "updated_at",
    ),
    first=("created_at",),
)
CARD_INDEX = Policy(
    key="card_id",
    last=("lang", "set_code", "card_code"),
    last_non_null=("data_id", "rarity"),
)
CARD_PRICES = Policy(
    key="card_id",
    last=("lang", "set_code", "card_code"),
    last_non_null=("data_id", "rarity", "usd_price", "eur_price"),
)


def fold(batch: DataFrame, policy: Policy, order: Sequence[Column | str]) -> DataFrame:
    """Reduce a batch to one row per key; ``order`` is the arrival order within it."""
    arrival = F.struct(*order)
    folded = []
    if policy.last:
        folded.append(F.max_by(F.struct(*policy.last), arrival).alias("_last"))
    folded += [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), arrival)).alias(c)
        for c in policy.last_non_null
    ]
    folded += [F.min_by(F.col(c), arrival).alias(c) for c in policy.first]
    out = batch.groupBy(policy.key).agg(*folded)
    rest = (*policy.last_non_null, *policy.first)
    return out.select(policy.key, *(["_last.*"] if policy.last else []), *rest)


def _renamed(folded: DataFrame, policy: Policy) -> DataFrame:
    """The batch under other column names, so both sides of a join can come from one source."""
    return folded.select(*(F.col(c).alias(f"_new_{c}") for c in policy.columns))


def _next_state(policy: Policy) -> list[Column]:
    key = F.col(f"_new_{policy.key}")

    def new(column: str) -> Column:
        return F.col(f"_new_{column}")

    return [
        F.coalesce(key, F.col(policy.key)).alias(policy.key),
        *(F.when(key.isNotNull(), new(c)).otherwise(F.col(c)).alias(c) for c in policy.last),
        *(keep_old(new(c), F.col(c)).alias(c) for c in policy.last_non_null),
        *(keep_old(F.col(c), new(c)).alias(c) for c in policy.first),
    ]


def merge(stored: DataFrame, folded: DataFrame, policy: Policy) -> DataFrame:
    """The next state of a table, in a form where a small batch can be broadcast to it.

    Stored rows are updated through a left join; keys not stored yet are appended.  Neither
    join needs the stored table shuffled when the planner finds the batch below its broadcast
    limit, and both become shuffled joins above it.  ``folded`` should be a written table: it
    is read three times and its size on disk decides the plan.
    """
    stored, new = stored.select(*policy.columns), _renamed(folded, policy)
    same_key = F.col(policy.key) == F.col(f"_new_{policy.key}")
    updated = stored.join(new, same_key, "left").select(*_next_state(policy))
    keys = new.select(f"_new_{policy.key}")
    known = stored.select(policy.key).join(keys, same_key, "left_semi")
    inserted = folded.select(*policy.columns).join(known, policy.key, "left_anti")
    return updated.unionByName(inserted)


def upsert(
    stored: DataFrame, batch: DataFrame, policy: Policy, order: Sequence[Column | str]
) -> DataFrame:
    """Fold a batch and merge it into the stored table; returns the new state."""
    return merge(stored, fold(batch, policy, order), policy)


def state_of(batch: DataFrame, policy: Policy, order: Sequence[Column | str]) -> DataFrame:
    """A batch as one row of state per key: every stored value with its arrival.

    States form a set under ``merge_states``: which batch comes first, is late or comes twice does
    not matter.  ``order`` is the arrival order over all batches; where it ties, the larger value
    counts as the newer.  Rows without a key are left out."""

    def seen(value: Column) -> Column:
        return F.struct(F.struct(*order).alias("at"), value.alias("value"))

    rows = batch.where(F.col(policy.key).isNotNull()).select(
        policy.key,
        seen(F.struct(*policy.last)).alias("_last"),
        *(F.when(F.col(c).isNotNull(), seen(F.col(c))).alias(c) for c in policy.last_non_null),
        *(seen(F.col(c)).alias(c) for c in policy.first),
    )
    return merge_states(rows, policy)


def merge_states(states: DataFrame, policy: Policy) -> DataFrame:
    """One row of state per key from the states of any number of batches.

    Maxima and minima of (arrival, value): associative, commutative and unmoved by repeats, with
    partial results before the shuffle."""
    return states.groupBy(policy.key).agg(
        F.max("_last").alias("_last"),
        *(F.max(c).alias(c) for c in policy.last_non_null),
        *(F.min(c).alias(c) for c in policy.first),
    )


def values_of(states: DataFrame, policy: Policy) -> DataFrame:
    """The table that merged states stand for."""
    rest = (*policy.last_non_null, *policy.first)
    return states.select(policy.key, "_last.value.*", *(F.col(f"{c}.value").alias(c) for c in rest))


def snapshots(records: DataFrame, identity: Sequence[str] = ()) -> DataFrame:
    """Price observations to append, one per accepted record, duplicates included; ``identity`` names
    further columns that tell one record from another."""
    return records.select(
        *identity,
        "product_id",
        "observed_at",
        "price_yen",
        utc_date(F.col("observed_at")).alias("observed_date"),
    )


def daily_prices(
    captures: DataFrame, tie_break: Sequence[str] = (), currency: str = "JPY"
) -> DataFrame:
    """The latest capture per product and day, with the default currency filled in.

    Folding its own result with further captures gives what folding all captures gives, if
    ``tie_break`` settles captures of one time."""
    newest = F.struct("captured_at", *tie_break)
    values = F.struct("captured_at", "price", "currency", "stock_status")
    return (
        captures.withColumn("captured_date", utc_date(F.col("captured_at")))
        .groupBy("product_id", "captured_date")
        .agg(F.max_by(values, newest).alias("_latest"))
        .select("product_id", "captured_date", "_latest.*")
        .withColumn("currency", F.coalesce(F.col("currency"), F.lit(currency)))
    )
