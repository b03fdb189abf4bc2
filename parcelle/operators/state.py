"""Keyed listing state: upsert, processed flags, stale deactivation,
duplicate removal and incremental intake.

Scale notes
-----------
* The batch is aggregated to one row per key *before* it meets the state
  (``max`` + ``count`` + ``min`` are partial aggregates, so a key holding a
  third of the batch is combined map-side). The state has one row per key, so
  the full outer join has no hot key on either side.
* Duplicate removal never ranks a whole key group: it aggregates the first id
  per key and joins back on the composite ``(key, id)``, whose hash spreads a
  hot key over all partitions.
* Each state version should be written to a new path, see
  ``parcelle.operators.sinks``, or kept in hash buckets of which an upsert
  reads and rewrites only those its batch touches, without shuffling the
  state; see ``parcelle.operators.buckets``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions.dates import days_before, timestamp_lit
from parcelle.operators.clean import unprocessed

KEY = "listing_url"
ID = "_id"
# Fields overwritten by a newer sighting (the source is set as well).
DATA_FIELDS = ["source", "department", "price", "price_per_m2", "surface_m2", "rooms", "bedrooms",
               "address", "city", "postal_code", "property_type", "features", "description",
               "last_seen_at"]
STATE_COLUMNS = [ID, KEY, *DATA_FIELDS, "first_seen_at", "is_active", "update_count", "processed"]
# Fixed value: listings not seen for this many days are deactivated.
STALE_DAYS = 30
# The stored key: null has a value of its own, so that keys meet by plain equality.
STORED_KEY = "_key"


def stored_key(key: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def original_key(stored: Column) -> Column:
    return F.when(stored != "", F.substring(stored, F.lit(2), F.length(stored)))


def _key_match(left: DataFrame, right: DataFrame, key: str) -> Column:
    """Null-safe key equality (a null key matches a null key)."""
    return left[key].eqNullSafe(right[key])


def _latest_order(batch: DataFrame, order: Sequence[str] | None) -> list[str]:
    """Sort key deciding the latest sighting: last-seen time, then the id, then
    every other data field, the feature list last, so equal timestamps still
    give one answer."""
    if order is not None:
        return list(order)
    ties = [c for c in DATA_FIELDS if c in batch.columns and c not in ("features", "last_seen_at")]
    return [c for c in ["last_seen_at", ID, *ties, "features"] if c in batch.columns]


def aggregate_batch(batch: DataFrame, key: str = KEY, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the latest sighting's fields (by ``order``, then by the other fields), the number
    of sightings and the earliest first-seen time. A batch without ids (a
    normalised source) gets the key as id."""
    if ID not in batch.columns:
        batch = batch.withColumn(ID, F.col(key).cast("string"))
    fields = [c for c in [ID, *DATA_FIELDS] if c in batch.columns]
    # one struct, the order first: what decides the latest sighting is carried once
    decides = _latest_order(batch, order)
    latest = F.max(F.struct(*decides, *[c for c in fields if c not in decides]))
    agg = batch.groupBy(key).agg(latest.alias("_latest"), F.count(F.lit(1)).alias("_n"),
                                 F.min("first_seen_at" if "first_seen_at" in batch.columns else F.lit(None).cast("timestamp")).alias("_first_seen"))
    return agg.select(key, *[F.col(f"_latest.{c}").alias(c) for c in fields], "_n", "_first_seen")


def upsert(current: DataFrame | None, batch: DataFrame, key: str = KEY, keyed: bool = False) -> DataFrame:
    """New state after applying ``batch`` to ``current`` (keyed upsert).

    Matched keys take the latest batch values for the data fields and
    ``source``, become active, keep ``first_seen_at`` and ``processed``, and add
    the number of batch rows to ``update_count``. New keys also get the
    earliest ``first_seen_at`` of their batch rows and no ``processed`` flag.
    A field that the batch lacks keeps the state's values; one that the state
    lacks is null for keys the batch does not touch. ``current=None`` is the
    initial load.

    With ``keyed`` the state also carries its (string) key as ``_key``, which is never null. An upsert of such a
    state meets the batch by plain equality, so a state that was just loaded is joined where its load left it; a
    null-safe equality is a join on other expressions and shuffles the whole state and the batch once more.
    """
    if not keyed and (current is None or STORED_KEY not in current.columns):
        return merge_state(current, aggregate_batch(batch, key), key)
    if ID not in batch.columns:
        batch = batch.withColumn(ID, F.col(key).cast("string"))
    b = aggregate_batch(batch.withColumn(STORED_KEY, stored_key(F.col(key))), STORED_KEY)
    if current is not None:
        current = (current if STORED_KEY in current.columns else current.withColumn(STORED_KEY, stored_key(F.col(key)))).drop(key)
    rows = merge_state(current, b, STORED_KEY, null_keys=False)
    return rows.select(ID, original_key(F.col(STORED_KEY)).alias(key), *[c for c in rows.columns if c not in (ID, STORED_KEY)],
                       *([STORED_KEY] if keyed else []))


def merge_state(current: DataFrame | None, b: DataFrame, key: str = KEY, null_keys: bool = True) -> DataFrame:
    """The upsert of an aggregated batch. Without ``null_keys`` the keys are known not to be null and meet by plain
    equality, which a state bucketed by the key serves without a shuffle."""
    held = set() if current is None else set(current.columns)
    fields = [c for c in DATA_FIELDS if c in b.columns or c in held]
    if current is None:
        return b.select(
            ID, key, *[F.col(c) for c in fields],
            F.col("_first_seen").alias("first_seen_at"),
            F.lit(True).alias("is_active"),
            F.col("_n").cast("bigint").alias("update_count"),
            F.lit(None).cast("boolean").alias("processed"),
        )
    columns = [ID, key, *[c for c in STATE_COLUMNS if c not in (ID, KEY)]]
    cur = current.select(*[c for c in columns if c in held]).withColumn("_cur", F.lit(True))
    same = F.col(f"s.{key}").eqNullSafe(F.col(f"b.{key}")) if null_keys else F.col(f"s.{key}") == F.col(f"b.{key}")
    j = cur.alias("s").join(b.alias("b"), same, "full_outer")
    hit = F.col("b._n").isNotNull()
    exists = F.col("s._cur").isNotNull()

    def pick(c: str) -> Column:
        if c not in b.columns:
            return F.col(f"s.{c}").alias(c)
        old = F.col(f"s.{c}") if c in held else F.lit(None)
        return F.when(hit, F.col(f"b.{c}")).otherwise(old).alias(c)

    return j.select(
        F.when(exists, F.col(f"s.{ID}")).otherwise(F.col(f"b.{ID}")).alias(ID),
        F.when(exists, F.col(f"s.{key}")).otherwise(F.col(f"b.{key}")).alias(key),
        *[pick(c) for c in fields],
        F.when(exists, F.col("s.first_seen_at")).otherwise(F.col("b._first_seen")).alias("first_seen_at"),
        F.when(hit, F.lit(True)).otherwise(F.col("s.is_active")).alias("is_active"),
        (F.coalesce(F.col("s.update_count"), F.lit(0))
         + F.coalesce(F.col("b._n"), F.lit(0))).cast("bigint").alias("update_count"),
        F.col("s.processed").alias("processed"),
    )


def upsert_counters(current: DataFrame | None, batch: DataFrame, key: str = KEY) -> DataFrame:
    """One row: ``scraped`` batch rows, ``inserted`` new keys, ``modified`` =
    scraped - inserted (every matched row changes the counter).

    Computed as one aggregation over the union of state keys and batch rows
    (no distinct, no join): a single partial-aggregated shuffle, and a null
    key meets the null key as in the upsert."""
    rows = batch.select(F.col(key), F.lit(0).alias("_in_state"), F.lit(1).alias("_n"))
    if current is not None:
        rows = current.select(F.col(key), F.lit(1).alias("_in_state"), F.lit(0).alias("_n")).unionByName(rows)
    per_key = rows.groupBy(key).agg(F.max("_in_state").alias("_s"), F.sum("_n").alias("_n"))
    out = per_key.filter(F.col("_n") > 0).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("scraped"),
        F.count_if(F.col("_s") == 0).cast("bigint").alias("inserted"))
    return out.withColumn("modified", F.col("scraped") - F.col("inserted"))


def run_counters(current: DataFrame, batch: DataFrame, run_col: str = "run_id", key: str = KEY) -> DataFrame:
    """Per run of the batch: ``new_properties`` (keys that the state lacks) and
    ``updated_properties`` (the run's other rows). The batch is counted per
    (run, key) first, so a hot key is combined before the join."""
    per_key = batch.groupBy(run_col, F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    held = current.select(F.col(key).alias("_held")).distinct().withColumn("_hit", F.lit(True))
    j = per_key.join(held, F.col("_key").eqNullSafe(F.col("_held")), "left")
    out = j.groupBy(run_col).agg(F.count_if(F.col("_hit").isNull()).alias("new_properties"), F.sum("_n").alias("_rows"))
    return out.select(run_col, "new_properties", (F.col("_rows") - F.col("new_properties")).alias("updated_properties"))


def mark_processed(raw: DataFrame, clean_ids: DataFrame, id_col: str = ID,
                   clean_id_col: str = "Id") -> DataFrame:
    """Set ``processed = true`` on rows whose id survived cleaning; other rows
    keep their flag. The id set stays a DataFrame (never collected)."""
    ids = clean_ids.select(F.col(clean_id_col).alias("_pid")).distinct().withColumn("_hit", F.lit(True))
    j = raw.join(ids, raw[id_col] == ids["_pid"], "left")
    return j.withColumn("processed", F.when(F.col("_hit"), F.lit(True)).otherwise(F.col("processed"))) \
            .drop("_pid", "_hit")


def deactivate(df: DataFrame, now, days: int = STALE_DAYS) -> DataFrame:
    """``is_active = false`` where ``last_seen_at < now - days`` (strict) and the
    row is active; a null ``last_seen_at`` leaves the row unchanged."""
    stale = (F.col("last_seen_at") < days_before(now, days)) & F.col("is_active")
    return df.withColumn("is_active", F.when(stale, F.lit(False)).otherwise(F.col("is_active")))


def _first_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(order).alias("_first"))


def _is_first(df: DataFrame, firsts: DataFrame, key: str, order: str) -> Column:
    return df[key].eqNullSafe(firsts[key]) & (df[order] == firsts["_first"])


def dedupe(df: DataFrame, key: str = KEY, order: str = ID) -> DataFrame:
    """Keep the row with the smallest ``order`` value (unique id) per key."""
    firsts = _first_ids(df, key, order)
    return df.join(firsts, _is_first(df, firsts, key, order), "left_semi")


def delete_candidates(df: DataFrame, key: str = KEY, order: str = ID) -> DataFrame:
    """Rows sharing a key with a smaller id: the ones duplicate removal deletes."""
    firsts = _first_ids(df, key, order)
    return df.join(firsts, _is_first(df, firsts, key, order), "left_anti")


def duplicate_groups(df: DataFrame, key: str = KEY, order: str = ID) -> DataFrame:
    """Per key with more than one row: first id and row count."""
    return (df.groupBy(key).agg(F.min(order).alias("doc_id"), F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1))


def key_violations(df: DataFrame, key: str = KEY) -> DataFrame:
    """Unique-key check: keys held by more than one row (empty when unique)."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


def incremental_batch(raw: DataFrame, ledger: DataFrame, id_col: str = ID,
                      ledger_id_col: str = "Id", limit: int | None = None) -> DataFrame:
    """Rows neither flagged processed nor recorded in the ledger of processed
    ids (anti-join), as the cleaning input."""
    pending = raw.join(ledger.select(F.col(ledger_id_col).alias(id_col)), id_col, "left_anti")
    return unprocessed(pending, limit)


__all__ = ["aggregate_batch", "upsert", "merge_state", "upsert_counters", "run_counters", "mark_processed", "deactivate", "dedupe",
           "delete_candidates", "duplicate_groups", "key_violations", "incremental_batch",
           "timestamp_lit"]
