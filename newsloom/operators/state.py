"""Next states of feeds, sites and requests, as snapshots: every function is DataFrame -> DataFrame, nothing is updated in place.

Times are intervals from a given ``now``. Cases: null failures count as none, a null mode stays null, a null next attempt is due.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETRY_S, CRAWL_S, REFRESH_DAYS, MOST_FAILURES = 1200, 4, 7, 4
#: Codes of a feed scan that gave no entries, by what was missing first. Fixed values.
SCAN_CODES = {"error": 979, "no_result": 978, "no_status": 977, "no_feed": 967, "gone": 976, "no_entries": 975}
#: Codes of a page that was not stored, by cause. Fixed values.
FETCH_CODES = {"failed": 900, "no_connection": 901, "known": 902, "bad_url": 903, "too_large": 904, "not_text": 905, "broken_off": 917, "http_error": 918}


def seconds(c: Column) -> Column:
    return F.make_dt_interval(secs=c.cast("decimal(18,6)"))


def repeatable(key: Column) -> Column:
    """A factor in [0, 1) that looks random and is the same in every run."""
    return (key * 7919 % 10007) / F.lit(10007.0)


def after_scan(feeds: DataFrame, outcome: Column, now: Column) -> DataFrame:
    """(id, disabled, failures, next_scan) of the feeds: 'gone' disables at once, 'failed' when the feed had failed more
    than MOST_FAILURES times before, 'ok' resets the count; all are due again after ttl * (0.5 + a factor in [0, 1))."""
    before = F.coalesce("failures", F.lit(0))
    off = F.when(outcome == "gone", True).when(outcome == "failed", F.col("disabled") | (before > MOST_FAILURES)).otherwise(F.col("disabled"))
    failures = F.when(outcome == "failed", before + 1).when(outcome == "ok", 0).otherwise(before)
    due = now + seconds(F.floor(F.col("effective_ttl") * (0.5 + repeatable(F.col("id")))))
    return feeds.select("id", off.alias("disabled"), failures.cast("int").alias("failures"), F.when(outcome.isNotNull(), due).otherwise(F.col("next_scan")).alias("next_scan"))


def statistics(feeds: DataFrame, found: DataFrame) -> DataFrame:
    """(id, unchanged_iter, last_overlap, found_total, found_new) after a scan that gave (id, n_entries, n_new)."""
    j = feeds.join(found, "id")
    unchanged = F.when(F.col("n_new") == 0, F.coalesce("unchanged_iter", F.lit(0)) + 1).otherwise(0)
    overlap = F.when(F.col("n_entries") == 0, F.lit(1.0)).otherwise(F.col("n_new") / F.col("n_entries"))
    return j.select("id", unchanged.cast("int").alias("unchanged_iter"), F.round(overlap, 6).alias("last_overlap"), (F.col("found_total") + F.col("n_entries")).alias("found_total"), (F.col("found_new") + F.col("n_new")).alias("found_new"))


def next_mode(mode: Column, ascending: Column, descending: Column, faulty: Column) -> Column:
    """The pruning mode after a scan. 'L' learns: '0' where times are missing or in the future, else 'D' or 'A' by the
    order seen, else 'X'. 'D' and 'A' are verified: 'F' where the times are faulty, 'Y' where the order doesn't hold. Others stay."""
    learnt = F.when(faulty, "0").when(descending, "D").when(ascending, "A").otherwise("X")
    held = F.when(mode == "D", descending).otherwise(ascending)
    return F.when(mode == "L", learnt).when(mode.isin("D", "A"), F.when(faulty, "F").when(~held, "Y").otherwise(mode)).otherwise(mode)


def retried(requests: DataFrame, failed: Column, now: Column) -> DataFrame:
    """Requests (id, next_attempt): those that failed are due again after RETRY_S."""
    return requests.select("id", F.when(failed, now + seconds(F.lit(RETRY_S))).otherwise(F.col("next_attempt")).alias("next_attempt"))


def unlocked(sites: DataFrame, now: Column, pause_s: int = CRAWL_S) -> DataFrame:
    """Sites (id, locked, next_request): locked ones are opened, with a polite pause before the next request."""
    return sites.select("id", F.lit(False).alias("locked"), F.when(F.col("locked"), now + seconds(F.lit(pause_s))).otherwise(F.col("next_request")).alias("next_request"))


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The next snapshot: rows of ``new`` replace those of ``old`` with an equal key, others stay; ``changed`` tells which."""
    cols = [c for c in old.columns if c != key]
    a = old.select(F.col(key), F.struct(*cols).alias("a"))
    b = new.select(F.col(key), F.struct(*cols).alias("b"))
    j = a.join(b, key, "full")
    changed = F.when(F.col("b").isNull(), "kept").when(F.col("a").isNull(), "added").when(F.col("a").eqNullSafe(F.col("b")), "same").otherwise("replaced")
    return j.select(key, F.coalesce("b", "a").alias("r"), changed.alias("changed")).select(key, *(F.col(f"r.{c}").alias(c) for c in cols), "changed")


def refreshed(stored: DataFrame, seen: DataFrame, key: str, now: Column) -> DataFrame:
    """Like ``upserted`` for metadata with a column ``updated``, but only rows older than REFRESH_DAYS are replaced, and none added."""
    old = stored.where(F.col("updated") < now - seconds(F.lit(REFRESH_DAYS * 86_400))).select(key)
    return upserted(stored, seen.join(old.distinct(), key, "left_semi"), key)


def fetch_code(http: Column, mime: Column, size: Column, lost: Column, most: int = 2_000_000) -> Column:
    """The code a fetched page is logged with: internal codes as they are, errors, too large, not text, lost, else the status."""
    return (
        F.when(http.isNull(), FETCH_CODES["no_connection"]).when(http.between(900, 979), http).when(http >= 400, FETCH_CODES["http_error"])
        .when(size > most, FETCH_CODES["too_large"]).when(~F.coalesce(F.startswith(mime, F.lit("text/")), F.lit(False)), FETCH_CODES["not_text"])
        .when(lost, FETCH_CODES["broken_off"]).otherwise(http)
    )
