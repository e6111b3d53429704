"""Latest risk state per actor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.instants import instant_text
from riskloom.operators import segments
from riskloom.operators.dedup import chain
from riskloom.session import ensure_checkpoint_dir

_PAYLOAD = [name for name in schemas.RISK_SIGNAL.fieldNames() if name != "emitted_at"]


def state_key(actor_id: Column) -> Column:
    return F.concat(F.lit(schemas.HOT_KEY_PREFIX), actor_id)


def payload() -> Column:
    """The stored JSON text: the signal with its fields in fixed order."""
    return F.to_json(F.struct(*_PAYLOAD, instant_text(F.col("emitted_at")).alias("emitted_at")))


def latest(signals: DataFrame, write_order: Sequence[str]) -> DataFrame:
    """Newest signal per actor; of equal ones the last written stays.

    An aggregate, so each map task sends one row per actor, however many it has read.
    """
    kept = [c for c in signals.columns if c != "actor_id"]
    newest = F.max_by(F.struct(*kept), F.struct("emitted_at", *write_order))
    return signals.groupBy("actor_id").agg(newest.alias("_s")).select("actor_id", "_s.*")


def as_state(newest: DataFrame) -> DataFrame:
    """Rows of the state table: key, actor, time of the signal, payload."""
    return newest.select(
        state_key(F.col("actor_id")).alias("key"),
        "actor_id",
        F.unix_millis("emitted_at").alias("emitted_at_ms"),
        payload().alias("payload"),
    )


def live_at(
    writes: DataFrame, written_ms: str, as_of_ms: int, ttl_ms: int, write_order: Sequence[str]
) -> DataFrame:
    """State at a point in time: the latest write per actor unless it has expired.

    ``writes`` must come in emission order, as ``signals.risk_signals`` gives them: an
    actor's ``emitted_at`` never falls, so every write is accepted and renews the time
    to live. (Replays out of that order go through ``streaming.sinks.HotStateTable``.)
    """
    seen = latest(writes.where(F.col(written_ms) <= as_of_ms), write_order)
    return seen.withColumn("expires_ms", F.col(written_ms) + ttl_ms).where(
        F.col("expires_ms") > as_of_ms
    )


def accepted_writes(
    writes: DataFrame, written_ms: str, emitted_ms: str, ttl_ms: int, write_order: Sequence[str]
) -> DataFrame:
    """Writes that change the state, with their place ``write_no`` among the actor's writes.

    A write is accepted if its actor has no live state or one that is not newer. It then
    replaces the state and renews its time to live; a rejected write renews nothing.
    ``write_order`` is unique per actor and never goes back in ``written_ms``. Rows without
    an actor, a time of writing or of emission are left out.

    What follows an accepted write is the first one after it that is as new or comes after
    its time to live. It depends on the accepted write alone, so every write points to it,
    and the pointers are followed from an actor's first write by doubling. The first such
    write is found in a tree of maxima over an actor's writes. Writes are numbered in
    segments and meet by (actor, block), so no actor is one task.
    """
    if ttl_ms <= 0:
        raise ValueError("hot state TTL must be positive")
    spark = writes.sparkSession
    ensure_checkpoint_dir(spark)
    known = writes.where(
        F.col("actor_id").isNotNull() & F.col(written_ms).isNotNull() & F.col(emitted_ms).isNotNull()
    )
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = segments.place(known, pieces, "actor_id", write_order)
    placed = segments.with_carry(placed, "actor_id", {"_before": F.count("*")})
    number = F.row_number().over(segments.within("actor_id", write_order))
    number = number + F.coalesce("_before", F.lit(0))
    numbered = placed.select(*writes.columns, number.cast("bigint").alias("write_no")).checkpoint()
    slim = numbered.select(
        "actor_id",
        F.col("write_no").alias("_pos"),
        F.col(emitted_ms).alias("_emitted"),
        F.col(written_ms).alias("_written"),
    )
    steps = _followers(slim, ttl_ms)
    reached = chain(slim.where("_pos = 1"), steps, ["actor_id"])
    return numbered.join(reached.withColumnRenamed("_pos", "write_no"), ["actor_id", "write_no"])


def upserted(
    writes: DataFrame, written_ms: str, emitted_ms: str, ttl_ms: int, write_order: Sequence[str]
) -> DataFrame:
    """The state that all writes leave: the last accepted write per actor, and their number."""
    accepted = accepted_writes(writes, written_ms, emitted_ms, ttl_ms, write_order)
    kept = [c for c in writes.columns if c != "actor_id"]
    last = F.max_by(F.struct(*kept), "write_no").alias("_s")
    per_actor = accepted.groupBy("actor_id").agg(last, F.count("*").alias("accepted_writes"))
    return per_actor.select("actor_id", "_s.*", "accepted_writes")


def _followers(writes: DataFrame, ttl_ms: int) -> DataFrame:
    """``_pos`` and ``_to``, the first later write that is as new or beyond the time to live.

    Block b of level k of the tree holds positions b * 2**k up to the next block. A search
    goes down into a block that holds a follower, and from others on to the largest block
    that begins behind them: at most two blocks a level.
    """
    tree = _tree(writes)
    asking = writes.select(
        "*", F.lit(0).alias("_level"), (F.col("_pos") + 1).alias("_block")
    )
    found = None
    while True:
        met = asking.join(tree, ["actor_id", "_level", "_block"])
        holds = (F.col("_newest") >= F.col("_emitted")) | (
            F.col("_latest") >= F.col("_written") + ttl_ms
        )
        met = met.withColumn("_holds", holds).checkpoint()
        here = met.where("_holds AND _level = 0").select(
            "actor_id", "_pos", F.col("_block").alias("_to")
        )
        found = here if found is None else found.unionByName(here)
        on = met.where("NOT (_holds AND _level = 0)")
        if on.isEmpty():
            return found
        # Even numbers of blocks begin a block of the level above.
        up = F.expr("bit_count((_block + 1) ^ _block) - 1").cast("int")
        asking = on.select(
            *writes.columns,
            F.expr("IF(_holds, _level - 1, _level)").alias("_from"),
            F.when(F.col("_holds"), 0).otherwise(up).alias("_up"),
            F.expr("IF(_holds, 2 * _block, _block + 1)").alias("_next"),
        ).select(
            *writes.columns,
            F.expr("_from + _up").alias("_level"),
            F.expr("shiftright(_next, _up)").alias("_block"),
        )


def _tree(writes: DataFrame) -> DataFrame:
    """Largest time of emission and of writing of every block, level by level."""
    level = writes.select(
        "actor_id",
        F.lit(0).alias("_level"),
        F.col("_pos").alias("_block"),
        F.col("_emitted").alias("_newest"),
        F.col("_written").alias("_latest"),
    )
    most = writes.agg(F.max("_pos")).first()[0] or 0
    # A row per write and level, summed up before the shuffle where writes lie together.
    levels = F.explode(F.sequence(F.lit(1), F.lit(max(1, int(most).bit_length())))).alias("_up")
    above = level.select("actor_id", "_block", "_newest", "_latest", levels).groupBy(
        "actor_id", F.col("_up").alias("_level"), F.expr("shiftright(_block, _up)").alias("_block")
    )
    above = above.agg(F.max("_newest").alias("_newest"), F.max("_latest").alias("_latest"))
    return level.unionByName(above).checkpoint()
