"""Adoption, stickiness and growth of user segments, from an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import guarded_ratio, named


def engagement_inputs(
    events: DataFrame,
    segments: DataFrame,
    user: str,
    timestamp: str,
    event_type: str,
    segment: str,
) -> DataFrame:
    """Rows ``(segment, adoption, stickiness, growth)``.

    ``segments`` maps each user to one segment under the same user column name.

    - adoption: mean over users of the share of all event types they used
    - stickiness: mean daily active users over mean weekly active users
    - growth: user-days that start a streak of active days over user-days that
      were followed by a day of absence; a zero divisor counts as 1

    Events are reduced once to distinct (user, day, type) rows, from which everything
    else follows: the branches share that one scan and its exchange, and a user's share
    of the log does not matter afterwards.
    """
    log = events.select(
        named(user).alias("user"),
        F.to_date(named(timestamp)).alias("day"),
        named(event_type).alias("type"),
    ).where(F.col("user").isNotNull())
    log = log.distinct()
    members = segments.select(named(user).alias("user"), named(segment).alias(segment))

    type_total = log.agg(F.count_distinct("type")).scalar()
    adoption = (
        log.select("user", "type")
        .distinct()
        .groupBy("user")
        .agg(F.count("type").alias("types"))
        .join(members, "user")
        .groupBy(named(segment))
        .agg(F.avg(F.col("types") / type_total).alias("adoption"))
    )

    last_day = log.agg(F.max("day")).scalar()
    by_user = Window.partitionBy("user").orderBy("day")
    user_days = log.select("user", "day").distinct()
    streaks = user_days.select(
        "user",
        "day",
        # NULL neighbours: the first and the last active day of a user.
        (F.coalesce(F.date_diff("day", F.lag("day").over(by_user)), F.lit(0)) != 1).alias("starts"),
        (F.coalesce(F.date_diff(F.lead("day").over(by_user), "day"), F.lit(0)) != 1).alias("ends"),
    ).join(members, "user")

    # Daily figures first: one row per segment and day, from which both the mean
    # number of daily users and the growth totals follow.
    daily = streaks.groupBy(named(segment), "day").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if("starts").alias("started"),
        F.count_if(F.col("ends") & (F.col("day") < last_day)).alias("left"),
    )
    by_day = daily.groupBy(named(segment)).agg(
        F.avg("users").alias("dau"),
        guarded_ratio(F.sum("started"), F.sum("left")).alias("growth"),
    )
    by_week = (
        user_days.select("user", F.date_trunc("week", "day").alias("week"))
        .distinct()
        .join(members, "user")
        .groupBy(named(segment), "week")
        .agg(F.count(F.lit(1)).alias("users"))
        .groupBy(named(segment))
        .agg(F.avg("users").alias("wau"))
    )
    return (
        adoption.join(by_day, segment)
        .join(by_week, segment)
        .select(segment, "adoption", (F.col("dau") / F.col("wau")).alias("stickiness"), "growth")
    )
