"""URL filters by temporal list join.

Block and allow lists change: an entry adds or removes a pattern on a date.
Entries become validity intervals, and every capture is judged by the entries
that were active when it was fetched (an as-of join), never by today's list.

A pattern is a host (which covers its subdomains) or a host with a path prefix,
written as in a URL, with or without the scheme.  A capture is turned into the
patterns that could cover it, as far as the longest host and path of the list go,
so the join is one of equal keys with a condition on dates.  The longest active pattern
decides; at equal length allowing wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^(?:[a-z][a-z0-9+.\-]*:)?//[^/?#]*([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port, a leading ``www.`` and final dots;
    empty if there is none."""
    low = F.translate(F.coalesce(url.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(F.regexp_replace(F.regexp_extract(low, HOST, 1), r"\.+$", ""), r"^www\.", "")


def path_of(url: Column) -> Column:
    """Path in lower case, without query and fragment."""
    return F.regexp_extract(F.translate(F.coalesce(url.cast("string"), F.lit("")), _UPPER, _LOWER), PATH, 1)


def steps_of(url: Column) -> Column:
    """Steps of the path, without empty ones."""
    return F.filter(F.split(path_of(url), "/"), lambda s: s != "")


def pattern_of(pattern: Column) -> Column:
    """A pattern in the form in which captures give it; empty if it has no host,
    or a query or fragment, without which captures are compared."""
    p = F.translate(F.trim(F.coalesce(pattern.cast("string"), F.lit(""))), _UPPER, _LOWER)
    url = F.when(p.rlike(r"^(?:[a-z][a-z0-9+.\-]*:)?//"), p).otherwise(F.concat(F.lit("//"), p))
    host = host_of(url)
    return F.when((host == "") | p.rlike("[?#]"), F.lit("")).otherwise(
        F.array_join(F.concat(F.array(host), steps_of(url)), "/"))


def keys_of(url: Column, max_labels: int, max_steps: int) -> Column:
    """The patterns of at most ``max_labels`` labels or ``max_steps`` steps that
    cover a URL: its host and the hosts above it, and the host with each prefix of
    its path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    above = F.transform(F.sequence(F.greatest(F.lit(1), n - max(1, max_labels) + 1), n),
                        lambda k: F.array_join(F.slice(labels, k, n - k + 1), "."))
    steps = steps_of(url)
    m = F.least(F.size(steps), F.lit(max_steps))
    below = F.when(m > 0, F.transform(F.sequence(F.lit(1), m), lambda k: F.concat_ws(
        "/", host, F.array_join(F.slice(steps, 1, k), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(above, below)))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of dated entries.

    ``entries``: pattern, kind ('block' or 'allow'), action ('add' or 'remove'),
    entry_date.  Returns pattern, kind, valid_from, valid_to (exclusive; null:
    still valid), the pattern in the form of ``pattern_of``.  Rows with a null or
    another value in any column are left out, also patterns that are none;
    of entries of one pattern, kind and date, a removal wins.  Entries are first
    reduced to one a date, so the window below has at most as many rows a
    pattern as there are dates, however often a pattern is listed.
    """
    ok = (F.col("kind").isin("block", "allow") & F.col("action").isin("add", "remove")
          & F.col("entry_date").isNotNull() & (F.col("pattern") != ""))
    daily = (entries.select(pattern_of(F.col("pattern")).alias("pattern"), "kind", "action", F.col("entry_date").cast("date").alias("entry_date"))
             .where(ok).groupBy("pattern", "kind", "entry_date")
             .agg(F.min(F.col("action") == "add").alias("added")))
    w = Window.partitionBy("pattern", "kind").orderBy("entry_date")
    return (daily.withColumn("valid_to", F.lead("entry_date").over(w)).where("added")
            .select("pattern", "kind", F.col("entry_date").alias("valid_from"), "valid_to"))


def longest(entries: DataFrame) -> tuple[int, int]:
    """Largest numbers of labels and of path steps of the patterns."""
    parts = F.split(pattern_of(F.col("pattern")), "/")
    r = entries.agg(F.max(F.size(F.split(parts[0], r"\."))).alias("labels"), F.max(F.size(parts) - 1).alias("steps")).head()
    return r["labels"] or 0, r["steps"] or 0


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
          time_col: str = "fetch_date") -> DataFrame:
    """Judge every capture by the entries active at its fetch time.

    Returns a row for each capture: the three named columns, host, blocked, rule
    (the deciding pattern, null if none), rule_kind, n_active (active patterns
    that cover it).  Captures without host or fetch time are covered by nothing.
    Equal (url, time) pairs are joined once, so a URL captured over and over is
    one key; its captures get the verdict back by a second join.
    """
    caps = captures.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                           F.col(time_col).cast("date").alias("_day"))
    once = caps.where("_url is not null and _day is not null").select("_url", "_day").distinct()
    keyed = once.withColumn("_key", F.explode(keys_of(F.col("_url"), *longest(entries))))
    held = intervals(entries)
    # filled bottom-up: (length, allow first, pattern) of the longest active entry
    verdict = (keyed.join(held, (F.col("_key") == F.col("pattern")) & (F.col("valid_from") <= F.col("_day"))
                          & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to"))))
               .groupBy("_url", "_day")
               .agg(F.max(F.struct(F.length("pattern").alias("n"), (F.col("kind") == "allow").alias("allow"),
                                   F.col("pattern").alias("pattern"))).alias("top"),
                    F.count("*").alias("n_active")))
    return (caps.join(verdict, ["_url", "_day"], "left")
            .select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), F.col("_day").alias(time_col),
                    host_of(F.col("_url")).alias("host"),
                    F.coalesce(~F.col("top.allow"), F.lit(False)).alias("blocked"),
                    F.col("top.pattern").alias("rule"),
                    F.when(F.col("top.allow"), "allow").when(~F.col("top.allow"), "block").alias("rule_kind"),
                    F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active")))
