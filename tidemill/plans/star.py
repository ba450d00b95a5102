"""Star-schema job and tourism job (Q07, Q08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import dates
from tidemill.operators.joins import join_rounded
from tidemill.operators.loads import union_all
from tidemill.operators.quality import check_nonempty, check_unique, combine
from tidemill.operators.relational import keep_codes
from tidemill.operators.scale import distinct_rows
from tidemill.session import materialise
from tidemill.sources.sinks import write_table


def songplays(events: DataFrame, songs: DataFrame, duration_scale: int | None = None) -> DataFrame:
    """Fact rows: plays left-joined to songs on title, artist and duration."""
    plays = events.where("page = 'NextSong'").withColumn("start_time", dates.epoch_ms(F.col("ts")))
    known = songs.select("song_id", "artist_id", "title", "artist_name", "duration")
    joined = join_rounded(plays, known, [("song", "title"), ("artist", "artist_name")], ("length", "duration"), duration_scale, "left")
    key = dates.play_key(F.col("sessionid"), F.col("start_time")).alias("playid")
    return distinct_rows(joined.select(key, "start_time", "userid", "level", "song_id", "artist_id", "sessionid", "location", "useragent"))


def users(events: DataFrame) -> DataFrame:
    return events.where("page = 'NextSong' and userid is not null").select("userid", "firstname", "level").distinct()


def songs_dim(songs: DataFrame) -> DataFrame:
    return songs.select("song_id", "title", "artist_id", "year", "duration").distinct()


def artists(songs: DataFrame) -> DataFrame:
    return songs.select("artist_id", "artist_name", "artist_location").distinct()


def time_dim(plays: DataFrame) -> DataFrame:
    """Parts of every distinct start time."""
    return dates.time_parts(plays.select("start_time").distinct(), "start_time", sunday_first=True)


def star_schema(events: DataFrame, songs: DataFrame, duration_scale: int | None = None) -> dict[str, DataFrame]:
    """Fact and four dimensions from the two staging tables.

    The fact is written once, so that the time table comes from it and not from a
    second pass over the staging tables.
    """
    plays = materialise(songplays(events, songs, duration_scale))
    return {
        "songplays": plays,
        "users": users(events),
        "songs": songs_dim(songs),
        "artists": artists(songs),
        "time": time_dim(plays),
    }


def star_checks(star: dict[str, DataFrame]) -> DataFrame:
    return combine([check_nonempty(star), check_unique("unique_playid", star["songplays"], ["playid"])])


def write_star(star: dict[str, DataFrame], out: str, release_year: bool = False) -> None:
    """Write all tables; plays are partitioned by play year and month.

    ``release_year`` partitions by the song's release year instead of the play year.
    """
    plays = star["songplays"].withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    if release_year:
        years = star["songs"].select("song_id", F.col("year").alias("_ry"))
        plays = plays.join(years, "song_id", "left").withColumn("year", F.col("_ry")).drop("_ry")
    write_table(plays, f"{out}/songplays", ["year", "month"])
    write_table(star["time"], f"{out}/time", ["year", "month"])
    for name in ("users", "songs", "artists"):
        write_table(star[name], f"{out}/{name}")


def tourism(
    frames: Sequence[DataFrame], mode: str, visa: str, exclude: Sequence, include: Sequence
) -> dict[str, DataFrame]:
    """Arrivals by air on tourist visas, pre-aggregated per file and combined.

    Each frame has columns mode, visa, citizenship, address, arrival (day number),
    id and any number of grouping columns. Returns the fact and its time table.
    """
    parts = []
    for df in frames:
        kept = keep_codes(df.where((F.col("mode") == mode) & (F.col("visa") == visa)), "citizenship", exclude=exclude)
        kept = keep_codes(kept, "address", include=include)
        keys = [c for c in df.columns if c != "id"]
        parts.append(kept.groupBy(*keys).agg(F.count("id").alias("passengers")))
    fact = union_all(parts).withColumn("arrival", dates.sas_date(F.col("arrival")))
    time = fact.select("arrival", F.year("arrival").alias("year"), F.month("arrival").alias("month")).distinct()
    return {"fact": fact, "time": time}
