"""Retry queues over a ledger of attempts: who is pending, blocked, resting, due or new, and what a night's run takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Failures in a row that block; days of rest after a failure; days after which a pending capture expires; attempts a success.
BLOCK_AFTER, REST_DAYS, EXPIRY_DAYS, ATTEMPTS_PER_CAPTURE = 3, 7, 30, 3
# End of fixed values.
DAY = 86_400


def seconds_since(c: Column, now: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp(c)


def state(now: Column, result: Column, attempted: Column, capture: Column, failures: Column, retry_blocked: bool = False) -> Column:
    """pending, blocked, cooling, due or fresh: the first that holds."""
    out = F.when((result == "PENDING") & capture.isNotNull(), "pending")
    if not retry_blocked:
        out = out.when(F.coalesce(failures, F.lit(0)) >= BLOCK_AFTER, "blocked").when(
            (result == "FAILED") & attempted.isNotNull() & (seconds_since(attempted, now) < REST_DAYS * DAY), "cooling"
        )
    return out.when(attempted.isNotNull(), "due").otherwise("fresh")


def expired(now: Column, submitted: Column, attempted: Column) -> Column:
    """A pending capture older than its term, counted from its submission, never from a later look at it."""
    return F.coalesce(seconds_since(F.coalesce(submitted, attempted), now) > EXPIRY_DAYS * DAY, F.lit(False))


def queue(candidates: DataFrame, ledger: DataFrame, now: Column, retry_blocked: bool = False) -> DataFrame:
    """candidates(slug, url) with state and place: fresh ones first, then due ones, each by slug and url; others have no place.

    A place is the number of waiting links of earlier slugs plus the link's place in its own, so that no task sorts the whole queue.
    """
    led = ledger.select("url", "last_result", "last_attempt", "capture", "consecutive_hard_failures")
    c = F.col
    out = candidates.join(led, "url", "left").withColumn("state", state(now, c("last_result"), c("last_attempt"), c("capture"), c("consecutive_hard_failures"), retry_blocked))
    out = out.withColumn("tier", F.when(c("state") == "fresh", 0).when(c("state") == "due", 1))
    waiting = out.where("tier is not null").groupBy("tier", "slug").agg(F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("tier", "slug").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = waiting.select("tier", "slug", ahead.alias("ahead"))  # a row a slug and tier
    place = c("ahead") + F.row_number().over(Window.partitionBy("tier", "slug").orderBy("url"))
    return out.join(before, ["tier", "slug"], "left").select("slug", "url", "state", F.when(c("tier").isNotNull(), place).alias("place"))


def streaks(attempts: DataFrame, keys: list[str], order: str, outcome: str = "outcome") -> DataFrame:
    """attempts with streak: hard failures in a row up to the row. OK and PENDING start anew, hard adds one, others (soft, skipped) change nothing.

    Islands are running counts of resets; both windows share one sort by key and order.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    reset = F.sum(F.col(outcome).isin("OK", "PENDING").cast("int")).over(w)
    island = attempts.withColumn("__island", reset)
    v = Window.partitionBy(*keys, "__island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.sum((F.col(outcome) == "hard").cast("int")).over(v)).drop("__island")


def budgeted(attempts: DataFrame, keys: list[str], order: str, budget: int, success: Column, fault: Column | None = None) -> DataFrame:
    """The attempts that a run makes: until `budget` successes, three times as many attempts, or an account fault, which is made but ends the run."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    won = F.coalesce(F.sum(success.cast("int")).over(before), F.lit(0))
    lost = F.coalesce(F.sum(fault.cast("int")).over(before), F.lit(0)) if fault is not None else F.lit(0)
    made = attempts.withColumns({"__won": won, "__lost": lost, "__n": F.row_number().over(w)})
    return made.where((F.col("__won") < budget) & (F.col("__lost") == 0) & (F.col("__n") <= ATTEMPTS_PER_CAPTURE * budget)).drop("__won", "__lost", "__n")


def pending(ledger: DataFrame) -> DataFrame:
    """Pending rows with a capture, oldest submission first; a missing one comes first, ties by url."""
    return ledger.where("last_result = 'PENDING' and capture is not null").orderBy(F.coalesce("capture_submitted", F.lit("")), "url")


def totals(queued: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of states per key."""
    return queued.groupBy(*keys).agg(F.count("*").alias("needed"), *[F.count_if(F.col("state") == s).alias(s) for s in ("pending", "blocked", "cooling", "due", "fresh")])


def recordable(ledger: DataFrame, needed: DataFrame) -> DataFrame:
    """Successful captures whose link is still needed; a second run over what it wrote finds nothing."""
    return ledger.where("last_result = 'OK' and capture is not null").join(needed.select("slug", "url").distinct(), "url", "left_semi")
