"""Structured Streaming jobs (R01-R03). Each run takes what is new and stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.operators.scale import top_per_key
from tidemill.plans import star
from tidemill.session import discard, materialise
from tidemill.streaming import store


def file_stream(spark: SparkSession, src: str, schema, fmt: str = "parquet", pattern: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(src)


def ingest_stream(
    rows: DataFrame, out: str, checkpoint: str, keys: Sequence[str], event_time: str | None, bound: str = "30 days"
) -> StreamingQuery:
    """Append rows of new files once; rows whose keys are stored are left out.

    The checkpoint remembers the files already read. Copies of a row are looked for within
    ``bound`` of event time, and, for rows that come later than that, by their keys in the
    whole table, so that a late file is loaded once too. With ``event_time`` None, which
    has to be said, all rows are looked for by their keys. A batch that runs again
    replaces what it wrote.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        first = [F.col(c) for c in ([event_time] if event_time else []) + [c for c in df.columns if c != event_time]]
        batch = materialise(store.hashed(top_per_key(df, list(keys), first), keys))
        if event_time:
            store.append_timed(batch, batch_id, out, keys, event_time, bound)
        else:
            store.append_unseen(batch, batch_id, out, keys)
        discard(batch)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to its own partition; running it again replaces that partition."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def upsert_batch(df: DataFrame, batch_id: int, out: str, keys: Sequence[str], newest: Sequence[Column]) -> None:
    """Append keys not stored before; within the batch the newest row wins."""
    batch = materialise(store.hashed(top_per_key(df, list(keys), newest), keys))
    store.append_unseen(batch, batch_id, out, keys)
    discard(batch)


def upsert_stream(rows: DataFrame, out: str, checkpoint: str, keys: Sequence[str], newest: Sequence[Column]) -> StreamingQuery:
    def each(df: DataFrame, batch_id: int) -> None:
        upsert_batch(df, batch_id, out, keys, newest)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def star_stream(events: DataFrame, songs: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Fact rows of each batch, and the users, times, songs and artists not stored before.

    Of a user's rows in a batch the latest counts; of a song's or artist's, the first in order.
    """

    def each(df: DataFrame, batch_id: int) -> None:
        plays = materialise(star.songplays(df, songs))
        append_batch(plays, f"{out}/songplays", batch_id)
        listeners = df.where("page = 'NextSong' and userid is not null").select("userid", "firstname", "level", "ts")
        upsert_batch(listeners, batch_id, f"{out}/users", ["userid"], [F.desc("ts"), F.col("level"), F.col("firstname")])
        upsert_batch(star.time_dim(plays), batch_id, f"{out}/time", ["start_time"], [F.col("start_time")])
        for name, dim, key in (("songs", star.songs_dim(songs), "song_id"), ("artists", star.artists(songs), "artist_id")):
            upsert_batch(dim, batch_id, f"{out}/{name}", [key], [F.col(c) for c in dim.columns])

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
