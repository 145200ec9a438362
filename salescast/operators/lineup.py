"""Line-up operators: X07 parse, J05 nearest-date match, W08 running time slots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.dates import add_days, fractional_hours
from salescast.functions.text import split_lineup


def parse_lineup(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """X07 + U02: one distinct (id, artist) row per line-up entry."""
    return (df.select(id_col, F.explode(split_lineup(F.col(text_col))).alias("artist"))
            .dropDuplicates([id_col, "artist"]))


def match_to_events(parties: DataFrame, events: DataFrame, tolerance_days: int = 1,
                    events_bound: int | None = None) -> DataFrame:
    """Match each party (archive date - 1 day = estimated date) to the event
    whose start date is within +-``tolerance_days``; smallest gap, then
    earliest start, then name.

    Of the events that start on one date only the first by start and name can win, so
    events are reduced to one per date (a combinable aggregate) before the match.  A
    party's +-``tolerance_days`` dates are exploded and equi-joined: at most
    ``2 * tolerance_days + 1`` candidates per party, however many events a date has.
    parties: party_id, archive_ts, ...; events: event_name, event_start, event_end.
    """
    from salescast.session import broadcast_bounded

    est = F.date_sub(F.to_date("archive_ts"), 1)
    p = parties.withColumn("est_date", est).withColumn(
        "cand_date", F.explode(F.sequence(F.date_sub(F.col("est_date"), tolerance_days),
                                          F.date_add(F.col("est_date"), tolerance_days))))
    first = F.min_by(F.struct("event_name", "event_start", "event_end"), F.struct("event_start", "event_name"))
    e = (events.withColumn("start_date", F.to_date("event_start")).groupBy("start_date").agg(first.alias("e"))
         .select("start_date", "e.*"))
    if events_bound is not None:
        e = broadcast_bounded(e, events_bound)
    j = p.join(e, p.cand_date == e.start_date, "inner")
    j = j.withColumn("gap_days", F.abs(F.datediff(F.col("start_date"), F.col("est_date"))))
    best = F.min_by(F.struct("event_name", "event_start", "event_end", "gap_days"),
                    F.struct("gap_days", "event_start", "event_name"))
    keep = [c for c in parties.columns if c != "party_id"]
    agg = j.groupBy("party_id", *keep).agg(best.alias("m"))
    return agg.select("party_id", *keep, "m.event_name", "m.event_start", "m.event_end", "m.gap_days")


def time_slots(matched: DataFrame, artists_col: str = "artists", min_h: float = 0.5, max_h: float = 2.0) -> DataFrame:
    """Equal slots laid end to end: length = clip(total hours / n, 0.5, 2) h,
    each slot clipped at the event end."""
    n = F.size(artists_col)
    total = fractional_hours("event_start", "event_end")
    slot_h = F.least(F.greatest(total / n, F.lit(min_h)), F.lit(max_h))
    x = matched.withColumn("slot_hours", slot_h).select("*", F.posexplode(artists_col).alias("slot", "artist"))
    start = F.col("event_start") + F.make_dt_interval(secs=F.col("slot") * F.col("slot_hours") * 3600)
    x = x.withColumn("slot_start", start)
    end = F.col("slot_start") + F.make_dt_interval(secs=F.col("slot_hours") * 3600)
    return x.withColumn("slot_end", F.least(end, F.col("event_end")))


__all__ = ["parse_lineup", "match_to_events", "time_slots", "add_days"]
