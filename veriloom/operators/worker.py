"""A capture worker's passes over a ledger: what is planned, what a run attempted, what was read back, and what pages have yet to say of it.

The far side is reached elsewhere; its answers come as tables. Each pass is a function of ledger and answers, so that a pass that is computed again
gives the same ledger. Ledgers have the fields of files.LEDGER and url; times are stamps like 2026-10-06T031500Z.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import dates as D
from veriloom.operators import ordered, queue
from veriloom.sources import sinks

# What counts against a source, what only concerns the account, and how much of a message is kept.
HARD = ("error:no-request", "error:blocked", "error:forbidden", "http-403", "http-202")
ACCOUNT = ("error:too-many-daily-captures", "playback-429", "submit-401")
MESSAGE = 500
# End of fixed values.
THROTTLED = "playback-429"
_FIELDS = ("page", "last_attempt", "last_result", "last_detail", "last_message", "attempts", "consecutive_hard_failures", "capture", "capture_submitted")


def _is(c: str, values: tuple[str, ...]) -> Column:
    return F.coalesce(F.col(c).isin(*values), F.lit(False))


def _said(c: str) -> Column:
    """A text, null if empty."""
    return F.nullif(F.col(c), F.lit(""))


def plan(candidates: DataFrame, ledger: DataFrame, now: Column, budget: int, most: int | None = None, retry_blocked: bool = False) -> DataFrame:
    """(slug, url, place, part, last_detail) of candidates(slug, url): part is attempt, beyond (waiting, but past the most attempts of a run), pending, blocked or cooling.

    most: attempts of a run, by default three a capture. retry_blocked lets blocked and cooling ones in again, never pending ones.
    """
    most = queue.ATTEMPTS_PER_CAPTURE * budget if most is None else most
    dated = ledger.withColumn("last_attempt", when("last_attempt"))
    queued = queue.queue(candidates, dated, now, retry_blocked)
    part = F.when(F.col("place") <= most, "attempt").when(F.col("place").isNotNull(), "beyond").otherwise(F.col("state"))
    return queued.join(ledger.select("url", "last_detail"), "url", "left").select("slug", "url", F.col("place").cast("long").alias("place"), part.alias("part"), "last_detail")


def when(stamp: str) -> Column:
    """A ledger's stamp as a timestamp; null if it can't be read."""
    return F.coalesce(D.stamp(stamp), F.try_to_timestamp(F.col(stamp)))


def run(planned: DataFrame, answers: DataFrame, budget: int, most: int | None = None) -> DataFrame:
    """What a run attempted of plan(): (url, page, seq, at, result, detail, message, capture), up to so many stored captures, `most` attempts or an account fault.

    answers(url, at, result, detail, message, capture): what is recorded of the far side, PENDING where a capture was stored; a url's last one counts.
    A candidate without an answer wasn't reached.
    """
    most = queue.ATTEMPTS_PER_CAPTURE * budget if most is None else most
    fields = ("at", "result", "detail", "message", "capture")
    last = answers.groupBy("url").agg(F.max(F.struct(*fields)).alias("a")).select("url", "a.*")
    tried = planned.where("place is not null").select("url", F.col("slug").alias("page"), F.col("place").alias("seq")).join(last, "url")
    fault = _is("detail", ACCOUNT)
    return ordered.within_budget(tried, ["seq", "url"], (F.col("result") == "PENDING") & ~fault, fault, budget, most)


def noted(ledger: DataFrame, attempts: DataFrame, bump: bool = True) -> DataFrame:
    """The ledger after attempts as run() returns them, any number a url, in order of seq.

    An account fault is SKIPPED and counts against nobody; what was stored or confirmed ends a row of hard failures; other failures leave it. Empty
    details and messages leave what was said before. bump=False: confirmations, which are the second half of an attempt already counted.
    """
    fault = _is("detail", ACCOUNT)
    kept = ~fault & _is("result", ("OK", "PENDING"))
    a = attempts.withColumns({"__fault": fault, "__kept": kept, "__hard": ~fault & ~kept & _is("detail", HARD)})
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("seq")))
    stored = F.col("__kept") & (F.col("result") == "PENDING")
    per_url = a.groupBy("url").agg(
        F.max_by("page", "seq").alias("n_page"), F.max_by("at", "seq").alias("n_at"), F.max_by(F.when(F.col("__fault"), "SKIPPED").otherwise(F.col("result")), "seq").alias("n_result"),
        last(_said("detail")).alias("n_detail"), last(F.substring(_said("message"), 1, MESSAGE)).alias("n_message"), F.count("*").alias("n_attempts"),
        last(F.when(F.col("__kept"), F.col("capture"))).alias("n_capture"), last(F.when(stored, F.col("at"))).alias("n_submitted"), F.max(F.when(F.col("__kept"), F.col("seq"))).alias("n_reset"),
    )
    hard = a.where("__hard").select("url", "seq").join(per_url.select("url", "n_reset"), "url").where("n_reset is null or seq > n_reset").groupBy("url").agg(F.count("*").alias("n_hard"))
    new = per_url.join(hard, "url", "left")
    touched = F.col("n_attempts").isNotNull()
    failures = F.when(F.col("n_reset").isNull(), F.coalesce("consecutive_hard_failures", F.lit(0))).otherwise(0) + F.coalesce("n_hard", F.lit(0))
    counted = F.coalesce("attempts", F.lit(0)) + (F.col("n_attempts") if bump else F.lit(0))
    out = {
        "page": F.coalesce("n_page", "page"), "last_attempt": F.when(touched, F.col("n_at")).otherwise(F.col("last_attempt")), "last_result": F.when(touched, F.col("n_result")).otherwise(F.col("last_result")),
        "last_detail": F.coalesce("n_detail", "last_detail"), "last_message": F.coalesce("n_message", "last_message"), "attempts": F.when(touched, counted).otherwise(F.col("attempts")).cast("int"),
        "consecutive_hard_failures": F.when(touched, failures).otherwise(F.col("consecutive_hard_failures")).cast("int"), "capture": F.coalesce("n_capture", "capture"), "capture_submitted": F.coalesce("n_submitted", "capture_submitted"),
    }
    return ledger.select("url", *_FIELDS).join(new, "url", "full_outer").select("url", *[c.alias(k) for k, c in out.items()])


def looked(ledger: DataFrame, looks: DataFrame, now: Column) -> DataFrame:
    """(url, page, capture, outcome) of pending captures: confirmed, unplayable, expired or left.

    looks(url, seen): played, no-playback, inconclusive or playback-429. Captures are read oldest submission first; the first throttled read ends the
    pass, and what comes after it is left, whatever was seen. An inconclusive read leaves a capture until its term, counted from its submission, is over.
    """
    pending = ledger.where("last_result = 'PENDING' and capture is not null")
    seen = looks.groupBy("url").agg(F.max("seen").alias("seen"))
    at = F.struct(F.coalesce("capture_submitted", F.lit("")).alias("since"), F.col("url").alias("of"))
    rows = pending.join(seen, "url", "left").withColumn("__at", at)
    stop = rows.where(F.col("seen") == THROTTLED).agg(F.min("__at").alias("__stop"))
    over = queue.expired(now, when("capture_submitted"), when("last_attempt"))
    outcome = (
        F.when(F.coalesce(F.col("__at") >= F.col("__stop"), F.lit(False)), "left").when(F.col("seen") == "played", "confirmed").when(F.col("seen") == "no-playback", "unplayable")
        .when((F.col("seen") == "inconclusive") & over, "expired").otherwise("left")
    )
    return rows.crossJoin(F.broadcast(stop)).select("url", "page", "capture", outcome.alias("outcome"))  # stop is one row


def confirmed(ledger: DataFrame, outcomes: DataFrame, at: Column) -> DataFrame:
    """The ledger after looked(): what was confirmed is OK, what didn't play back or expired FAILED; the rest stays as it is."""
    result = F.when(F.col("outcome") == "confirmed", "OK").otherwise("FAILED")
    detail = F.when(F.col("outcome") == "confirmed", "ok").when(F.col("outcome") == "unplayable", "no-playback").otherwise("pending-expired")
    seen = outcomes.where("outcome <> 'left'")
    null = F.lit(None).cast("string")
    return noted(ledger, seen.select("url", "page", F.lit(1).alias("seq"), at.alias("at"), result.alias("result"), detail.alias("detail"), null.alias("message"), null.alias("capture")), bump=False)


def recorded(pages: DataFrame, ledger: DataFrame, today: str, heading: str, entry: str, item: str = "{name} → [{capture}]({capture})") -> DataFrame:
    """(slug, md, captures, reason) of pages(slug, html, md) that link sources whose captures they don't tell: the new Markdown, or why it must be written by hand.

    entry: a site's own form of {today}, {when} (were captures requested) and {items}; item: of {name} and {capture}. A capture that page or Markdown
    link already isn't told again, so that a second pass writes nothing. The heading must occur once.
    """
    ok = ledger.where("last_result = 'OK' and capture is not null")
    asked = F.substring(F.coalesce(_said("capture_submitted"), _said("last_attempt"), F.lit("")), 1, 10)
    ok = ok.select(F.col("page").alias("slug"), "url", asked.alias("asked"), "capture")
    needed = sinks.needed_links(pages.select("slug", "html")).distinct()
    due = ok.join(needed, ["slug", "url"], "left_semi").groupBy("slug").agg(F.array_sort(F.collect_set(F.struct("asked", "url", "capture"))).alias("due"))  # links of one page
    told = due.join(pages, "slug").withColumn("due", F.filter("due", lambda x: ~F.coalesce(F.contains("md", x["capture"]), F.lit(False)))).where("size(due) > 0")
    items = F.array_join(F.transform("due", lambda x: sinks.filled(item, name=sinks.source_name(F.col("html"), x["url"]), capture=x["capture"])), "; ")
    text = sinks.filled(entry, today=F.lit(today), when=sinks.range_text(F.transform("due", lambda x: x["asked"]), F.lit(today)), items=items)
    md = sinks.insert_after(F.col("md"), heading, text)
    reason = F.when(F.col("md").isNull(), "no Markdown source").when(md.isNull(), "the heading doesn't occur once")
    return told.select("slug", md.alias("new"), F.size("due").cast("long").alias("captures"), reason.alias("reason")).withColumnRenamed("new", "md")
