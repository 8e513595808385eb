"""The operators on streams: the event table read as a stream to its end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillstone.operators import joins, topn, windows
from rillstone.operators.rows import parse_json, split_lines, split_words
from rillstone.operators.scan import count, earliest, highest, latest, lowest, total
from rillstone.plans import (  # noqa: F401
    join_queries,
    rolling_queries,
    row_queries,
    state_queries,
    window_queries,
)
from rillstone.plans.registry import CHECKS, query
from rillstone.plans.tables import EV, PRICED, priced_orders, shape_events, table, table_stream, two_arrivals
from rillstone.session import fresh_path
from rillstone.sinks.tables import BATCH, read_latest, read_once, to_upsert, write_once
from rillstone.sources.files import read_rows_stream
from rillstone.streaming import dimensions, processors, stateful
from rillstone.streaming.batches import (
    changelog_batches,
    count_window_batches,
    distinct_batches,
    distinct_state_batches,
    distinct_states,
    last_n_batches,
    live_list_batches,
    mark_late_batches,
    multiset_batches,
    multiset_totals,
    rolling_batches,
    ttl_batches,
)
from rillstone.streaming.runner import closing_rows, run, run_to_end, write_closing_row
from rillstone.timeunits import as_ntz, epoch_micros

Build = Callable[[DataFrame], DataFrame]


def _drained(spark: SparkSession, sf: str, build: Build) -> DataFrame:
    """The result rows of a query that holds nothing back."""
    out = fresh_path(spark, "out")
    run(build(shape_events(table_stream(spark, sf, "events"))), fresh_path(spark, "progress"), path=out)
    return spark.read.parquet(out)


def _to_end(
    spark: SparkSession, sf: str, build: Build, each=None, kinds: Sequence[str] = ("closing",)
) -> DataFrame:
    """The result rows of a query that waits for the watermark, without those of the closing rows."""
    schema = table(spark, sf, "events").schema
    closing, out = fresh_path(spark, "closing"), fresh_path(spark, "out")

    def stream() -> DataFrame:
        both = table_stream(spark, sf, "events").unionByName(closing_rows(spark, schema, closing))
        return build(shape_events(both))

    def close() -> None:
        for i, kind in enumerate(kinds):
            own = {"event_id": -1 - i, "user_id": -1 - i, "event_type": kind, "value": 0.0, "props": '{"k": -1}'}
            write_closing_row(spark, schema, closing, "ts", own)

    sink = {"each": each(out)} if each else {"path": out}
    run_to_end(stream, fresh_path(spark, "progress"), close, **sink)
    return read_once(spark, out) if each else spark.read.parquet(out)


#: how much later than a newer row an event may come; the closing row moves the watermark past it all
_DELAY = "2 hours"


def _real(df: DataFrame, real: Column, *bounds: str) -> DataFrame:
    """Bounds as plain timestamps, without what the closing row made, which is told by its own key."""
    for name in bounds:
        df = df.withColumn(name, as_ntz(name))
    return df.where(real)


def _users() -> Column:
    return F.col("user_id") >= 0


def _kinds() -> Column:
    return F.col("event_type") != "closing"


@query("stream_word_count", CHECKS["word_count"])
def stream_word_count(spark, sf):
    """Counts per word in update mode, kept as the newest value per word."""
    docs = table_stream(spark, sf, "documents").select("doc_id", "text")
    lines = split_lines(docs, "text")
    counts = split_words(lines, "line").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = fresh_path(spark, "counts")
    run(counts, fresh_path(spark, "progress"), each=to_upsert(out, ["word"], "n"), mode="update")
    return read_latest(spark, out, ["word"])


@query("stream_parse_json", CHECKS["parse_json_drop_bad"])
def stream_parse_json(spark, sf):
    out = fresh_path(spark, "out")
    text = row_queries.with_broken(table_stream(spark, sf, "events"))
    run(parse_json(text, "j", row_queries._PROPS)[0], fresh_path(spark, "progress"), path=out)
    return spark.read.parquet(out)


@query("stream_side_output", CHECKS["side_output_route"])
def stream_side_output(spark, sf):
    """One pass over each micro-batch, and a folder per output."""
    out = fresh_path(spark, "out")

    def write(df, batch_id):
        row_queries.mixed_outputs(df).write.mode("overwrite").partitionBy("output").parquet(f"{out}/{BATCH}={batch_id}")

    run(shape_events(table_stream(spark, sf, "events")), fresh_path(spark, "progress"), each=write)
    return read_once(spark, out)


@query("stream_geo_enrich", CHECKS["geo_enrich"])
def stream_geo_enrich(spark, sf):
    """A stream looking up a table."""
    return _drained(spark, sf, lambda events: join_queries.with_province(spark, sf, events))


@query("stream_tumble_keyed", CHECKS["tumble_keyed"])
def stream_tumble_keyed(spark, sf):
    def build(events):
        timed = windows.with_event_time(events, "ts", _DELAY)
        return windows.tumble(timed, "ts", "1 hour", {"cents": total("cents"), "n": count()}, ["user_id"])

    return _real(_to_end(spark, sf, build), _users(), "window_start", "window_end")


@query("stream_slide_keyed", CHECKS["slide_keyed"])
def stream_slide_keyed(spark, sf):
    def build(events):
        timed = windows.with_event_time(events, "ts", _DELAY)
        folds = {"cents": total("cents"), "n": count()}
        return windows.slide(timed, "ts", "2 hours", "1 hour", folds, ["user_id"])

    return _real(_to_end(spark, sf, build), _users(), "window_start", "window_end")


@query("stream_session_keyed", CHECKS["session_keyed"])
def stream_session_keyed(spark, sf):
    def build(events):
        timed = windows.with_event_time(events, "ts", _DELAY)
        folds = {"cents": total("cents"), "n": count()}
        return windows.session(timed, "ts", "6 hours", folds, ["user_id"])

    return _real(_to_end(spark, sf, build), _users(), "window_start", "window_end")


@query("stream_window_history", CHECKS["window_reduce_history"])
def stream_window_history(spark, sf):
    """Window sums as they close, added to the key's total so far."""
    held = fresh_path(spark, "held")

    def build(events):
        timed = windows.with_event_time(events, "ts", _DELAY)
        return windows.tumble(timed, "ts", "1 hour", {"cents": total("cents")}, ["user_id"])

    def add_up(out):
        return rolling_batches(out, held, ["user_id"], "window_start", {"cents_so_far": total("cents")})

    return _real(_to_end(spark, sf, build, each=add_up), _users(), "window_start").drop("window_start", "window_end")


@query("stream_hot_items", CHECKS["hot_items_topn"])
def stream_hot_items(spark, sf):
    """A window closes whole in one micro-batch, where its items are ranked."""
    def build(events):
        timed = windows.with_event_time(events, "ts", _DELAY)
        return windows.slide(
            timed.withColumnRenamed("k", "item"), "ts", "10 hours", "2 hours", {"hits": count()},
            ["event_type", "item", "category"],
        )

    def rank_each(out):
        groups = ["window_start", "category", "event_type"]
        order = [F.col("hits").desc(), F.col("item").asc()]
        return lambda df, batch_id: write_once(topn.top_n(df, groups, order, 3), out, batch_id)

    return _real(_to_end(spark, sf, build, each=rank_each), _kinds(), "window_start", "window_end")


@query("stream_timer_delay", CHECKS["timer_delay"])
def stream_timer_delay(spark, sf):
    """Timers fire when the watermark passes them, once per key and time."""
    def build(events):
        due = events.select("event_type", "k", (F.col("ts") + F.expr("INTERVAL 20 MINUTES")).alias("fires_at"))
        timed = windows.with_event_time(due, "fires_at", _DELAY)
        return timed.groupBy("fires_at", "event_type", "k").agg(F.count(F.lit(1)).alias("set")).drop("set")

    return _real(_to_end(spark, sf, build), _kinds(), "fires_at")


def _side(events: DataFrame, kind: str, name: str) -> DataFrame:
    rows = events.where(F.col("event_type") == kind).select(
        F.col("event_id").alias(f"{name}_id"), "user_id", "ts", F.col("cents").alias(f"{name}_cents")
    )
    return windows.with_event_time(rows, "ts", _DELAY)


def _window_join(how: str) -> Build:
    def build(events):
        joined = joins.window_join(
            _side(events, "view", "view"), _side(events, "click", "click"), ["user_id"], "1 hour", how
        )
        return joined.select(*join_queries._PAIR)

    return build


@query("stream_window_join_inner", CHECKS["window_join_inner"])
def stream_window_join_inner(spark, sf):
    return _real(_drained(spark, sf, _window_join("inner")), F.lit(True), "window_start", "window_end")


@query("stream_window_join_left", CHECKS["window_join_left"])
def stream_window_join_left(spark, sf):
    joined = _to_end(spark, sf, _window_join("left"), kinds=("view", "click"))
    return _real(joined, _users(), "window_start", "window_end")


@query("stream_interval_join", CHECKS["interval_join"])
def stream_interval_join(spark, sf):
    six_hours = 6 * 3_600_000_000

    def build(events):
        clicks = _side(events, "click", "click").withColumnRenamed("ts", "right_ts")
        return joins.interval_join(
            _side(events, "view", "view"), clicks, ["user_id"], -six_hours, six_hours
        ).select("user_id", "view_id", "click_id", "view_cents", "click_cents")

    return _drained(spark, sf, build)


@query("stream_rolling_sum", CHECKS["rolling_sum"])
def stream_rolling_sum(spark, sf):
    """Over arrivals of several files; a key with most of the rows is split inside the micro-batch."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = rolling_batches(out, held, ["event_type"], "event_id", {"cents_so_far": total("cents")})
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents"), progress, each=each)
    return read_once(spark, out).drop("cents")


@query("stream_changelog", CHECKS["retract_changelog"])
def stream_changelog(spark, sf):
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = changelog_batches(out, held, ["event_type"], "event_id", "cents")
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents"), progress, each=each)
    return read_once(spark, out)


@query("stream_list_last10", CHECKS["state_list_last10"])
def stream_list_last10(spark, sf):
    """The nine rows of a user that the next one needs are carried on, and no others."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = last_n_batches(out, held, ["user_id"], "event_id", "event_type", 10)
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "user_id", "event_type"), progress, each=each)
    return read_once(spark, out).select("event_id", "user_id", F.array_join("last_values", ",").alias("actions"))


def _expiring(spark, sf, each_of, *columns):
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "ts", *columns), progress, each=each_of(out, held))
    return read_once(spark, out)


@query("stream_value_ttl", CHECKS["state_value_ttl"])
def stream_value_ttl(spark, sf):
    """A user's sum and the time of its last row are carried on while the sum can still grow."""
    def each(out, held):
        return ttl_batches(out, held, ["user_id"], "event_id", "ts", "6 hours", "cents", delay=_DELAY)

    return _expiring(spark, sf, each, "user_id", "cents").drop("ts", "cents")


@query("stream_map_ttl", CHECKS["state_map_ttl"])
def stream_map_ttl(spark, sf):
    """An entry of a user's map expires on its own: the entry is part of the key."""
    def each(out, held):
        return ttl_batches(out, held, ["user_id", "event_type"], "event_id", "ts", "6 hours", "cents", delay=_DELAY)

    return _expiring(spark, sf, each, "user_id", "event_type", "cents").drop("ts", "cents")


@query("stream_list_ttl", CHECKS["state_list_ttl"])
def stream_list_ttl(spark, sf):
    """Elements are carried on while they live; an element expires on its own."""
    def each(out, held):
        return live_list_batches(out, held, ["user_id"], "event_id", "ts", "6 hours", "event_type", delay=_DELAY)

    lists = _expiring(spark, sf, each, "user_id", "event_type")
    return lists.select("event_id", "user_id", F.array_join("live_values", ",").alias("actions"))


@query("stream_count_window", CHECKS["count_window_keyed"])
def stream_count_window(spark, sf):
    """Per key the sum of every five rows; of an open window only its sum is carried on."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = count_window_batches(out, held, 5, "event_id", {"cents": total("cents")}, ["event_type"])
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents"), progress, each=each)
    return read_once(spark, out)


def _ad_counts(spark, sf):
    out, held, pairs, progress = (fresh_path(spark, n) for n in ("out", "held", "pairs", "progress"))
    each = distinct_batches(
        out, held, pairs, ["aid", "event_type"], "event_id", "user_id", distinct="users"
    )
    for stream in two_arrivals(spark, sf):
        ads = shape_events(stream).select("event_id", F.col("k").alias("aid"), "event_type", "user_id")
        run(ads, progress, each=each)
    return out, held


@query("stream_ad_counts", CHECKS["ad_counts_running"])
def stream_ad_counts(spark, sf):
    """Running hits and distinct users over two arrivals of files."""
    return read_once(spark, _ad_counts(spark, sf)[0])


@query("stream_ad_counts_now", CHECKS["ad_counts_sql"])
def stream_ad_counts_now(spark, sf):
    """The exact counts per ad and event that the same stream has reached."""
    return read_latest(spark, _ad_counts(spark, sf)[1], ["aid", "event_type"])


@query("stream_rolling_reduce", CHECKS["rolling_reduce"])
def stream_rolling_reduce(spark, sf):
    """Several running aggregates at once, with large keys split inside the micro-batch."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    folds = {"total_cents": total("cents"), "n": count(), "least_k": lowest("k"), "most_k": highest("k")}
    each = rolling_batches(out, held, ["event_type"], "event_id", folds)
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents", "k"), progress, each=each)
    return read_once(spark, out).drop("cents", "k")


def _facts_and_changes(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    named = F.when(kind.isin("signup", "view"), F.concat(F.lit("name-"), F.col("k").cast("string")))
    return events.where(kind != "click").select(
        "event_id",
        (F.col("user_id") % 10).alias("cid"),
        "cents",
        (kind != "purchase").alias("is_change"),
        named.alias("name"),
    )


@query("stream_dim_join", CHECKS["broadcast_dim_join"])
def stream_dim_join(spark, sf):
    """In the state store, one key in one task per micro-batch; the form below has no such limit."""
    def build(events):
        return stateful.dim_asof_stream(_facts_and_changes(events), "cid", "event_id", "is_change", "name")

    return _drained(spark, sf, build)


@query("stream_dim_join_split", CHECKS["broadcast_dim_join"])
def stream_dim_join_split(spark, sf):
    """The same with large dimension keys split inside the micro-batch, over two arrivals of files."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    current = latest("event_id", F.col("name"), when=F.col("is_change"))
    each = rolling_batches(out, held, ["cid"], "event_id", {"current": current})
    for stream in two_arrivals(spark, sf):
        run(_facts_and_changes(shape_events(stream)), progress, each=each)
    facts = read_once(spark, out).where(~F.col("is_change"))
    return facts.select("event_id", "cid", "cents", F.col("current.value").alias("name"))


@query(
    "stream_late_split",
    f"""WITH {EV}, seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM (SELECT event_id, event_type, cents, ts - to_microseconds((event_id * 37) % 11 * 600000000) AS ts FROM ev))
    SELECT event_id, event_type, cents, coalesce(epoch_us(time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01'))
      + 3600000000 <= newest, false) AS is_late FROM seen""",
)
def stream_late_split(spark, sf):
    """Late rows by the newest time of all earlier rows, carried from micro-batch to micro-batch."""
    out, seen = fresh_path(spark, "out"), fresh_path(spark, "seen")
    events = shape_events(table_stream(spark, sf, "events"))
    shifted = events.withColumn(
        "ts", F.timestamp_micros(epoch_micros("ts") - F.expr("(event_id * 37) % 11 * 600000000"))
    ).select("event_id", "event_type", "cents", "ts")
    late = mark_late_batches(out, seen, "ts", "1 hour", "0 seconds", "event_id")
    run(shifted, fresh_path(spark, "progress"), each=late)
    return read_once(spark, out)


@query("stream_rolling_max", CHECKS["rolling_max"])
def stream_rolling_max(spark, sf):
    """The running maximum with the other columns of the key's first row, carried from micro-batch to micro-batch."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    folds = {"best": highest("cents"), "first": earliest("event_id", F.struct("user_id", "k"))}
    each = rolling_batches(out, held, ["event_type"], "event_id", folds)
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents", "user_id", "k"), progress, each=each)
    rows = read_once(spark, out)
    first = [F.col(f"first.value.{c}").alias(c) for c in ("user_id", "k")]
    return rows.select("event_id", "event_type", F.col("best").alias("cents"), *first)


@query(
    "stream_grand_total",
    f"WITH {EV} SELECT event_id, CAST(sum(cents) OVER (ORDER BY event_id) AS BIGINT) AS cents_so_far FROM ev",
)
def stream_grand_total(spark, sf):
    """The total of all rows so far, at each row; no single task sees all of a micro-batch."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = rolling_batches(out, held, [], "event_id", {"cents_so_far": total("cents")})
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "cents"), progress, each=each)
    return read_once(spark, out).drop("cents")


@query("stream_window_cogroup", CHECKS["window_cogroup"])
def stream_window_cogroup(spark, sf):
    """Both sides from one stream, met in one windowed aggregation."""
    def build(events):
        return joins.window_cogroup(
            _side(events, "view", "view"), _side(events, "click", "click"), ["user_id"], "1 hour",
            {"views": count(), "view_cents": total("view_cents")},
            {"clicks": count(), "click_cents": total("click_cents")},
        )

    return _real(_to_end(spark, sf, build, kinds=("view", "click")), _users(), "window_start", "window_end")


@query("stream_timer_topn", CHECKS["timer_topn_per_key"])
def stream_timer_topn(spark, sf):
    """Timers at the end of each day: the rows of a day are spread over several micro-batches, a hot key over salts."""
    schema = table(spark, sf, "events").schema
    closing, out, progress = (fresh_path(spark, n) for n in ("closing", "out", "progress"))

    def fire(df, batch_id):
        write_once(processors.merged_top(df, ["event_type"], "cents", "event_id", 3), out, batch_id)

    def deliver(stream):
        events = shape_events(stream.unionByName(closing_rows(spark, schema, closing)))
        timed = windows.with_event_time(events, "ts", _DELAY)
        top = processors.top_timers(timed, ["event_type"], "ts", "1 day", "cents", "event_id", 3, salts=4)
        with processors.rocksdb(spark):
            run(top, progress, each=fire)

    for stream in two_arrivals(spark, sf):
        deliver(stream)
    last = {"event_id": -1, "user_id": -1, "event_type": "closing", "value": 0.0, "props": '{"k": -1}'}
    write_closing_row(spark, schema, closing, "ts", last)
    deliver(stream)
    end = as_ntz(F.timestamp_millis("ends"))
    fired = read_once(spark, out).where(_kinds()).withColumn("window_end", end)
    return fired.select((F.col("window_end") - F.expr("INTERVAL 1 DAY")).alias("window_start"), "window_end", "event_type", "event_id", "cents", "rank_no")


@query("stream_distinct_now", CHECKS["ad_counts_sql"])
def stream_distinct_now(spark, sf):
    """Hits and exact distinct users per ad and event from bitmaps that merge from micro-batch to micro-batch."""
    held, progress = fresh_path(spark, "held"), fresh_path(spark, "progress")
    for stream in two_arrivals(spark, sf):
        ads = shape_events(stream).select("event_id", F.col("k").alias("aid"), "event_type", "user_id")
        run(ads, progress, each=distinct_state_batches(held, ["aid", "event_type"], "user_id"))
    return distinct_states(spark, held, ["aid", "event_type"], hits="hits", distinct="users")


@query(
    "stream_retracted_max",
    f"""WITH {PRICED}, sums AS (SELECT nation, region, sum(cents) AS cents FROM priced GROUP BY ALL)
    SELECT region, count(*) AS nations, CAST(sum(cents) AS BIGINT) AS cents, CAST(min(cents) AS BIGINT) AS least, CAST(max(cents) AS BIGINT) AS most
    FROM sums GROUP BY region""",
)
def stream_retracted_max(spark, sf):
    """Aggregates of a changelog: each nation's income so far goes out with every order and the new one comes in, and
    the region's largest, smallest and total income follow."""
    arriving, changes, held, counted, progress, again = (fresh_path(spark, n) for n in ("orders", "changes", "held", "counted", "progress", "progress"))
    orders = priced_orders(spark, sf).select("o_orderkey", "nation", "region", "cents")
    middle = orders.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    for part in (F.col("o_orderkey") <= middle, F.col("o_orderkey") > middle):
        orders.where(part).write.mode("append").parquet(arriving)
        stream = read_rows_stream(spark, arriving, orders.schema)
        run(stream, progress, each=changelog_batches(changes, held, ["region", "nation"], "o_orderkey", "cents"))
        log = read_rows_stream(spark, f"{changes}/*", spark.read.parquet(changes).drop(BATCH).schema)
        run(log, again, each=multiset_batches(counted, ["region"], "cents", "is_insert"))
    return multiset_totals(spark, counted, ["region"], "cents", n="nations", total="cents", least="least", most="most")


@query("stream_tumble_two_sources", CHECKS["tumble_keyed"])
def stream_tumble_two_sources(spark, sf):
    """Windows over two sources, one of which comes hours behind the other: none closes before both are past it."""
    schema = table(spark, sf, "events").schema
    ahead, behind, out, progress = (fresh_path(spark, n) for n in ("ahead", "behind", "out", "progress"))
    for folder in (ahead, behind):
        closing_rows(spark, schema, folder)  # both folders are there from the start

    def deliver():
        sources = [read_rows_stream(spark, folder, schema) for folder in (ahead, behind)]
        events = shape_events(windows.least_watermark([s.withColumn("ts", F.col("ts").cast("timestamp")) for s in sources], "ts", _DELAY))
        sums = windows.tumble(events, "ts", "1 hour", {"cents": total("cents"), "n": count()}, ["user_id"])
        run(sums, progress, path=out)

    events = table(spark, sf, "events")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    first, early = F.col("user_id") % 2 == 0, F.coalesce(F.col("event_id") <= middle, F.lit(False))
    # the first source is through before the second has begun, and the second ends with its earlier half last seen alone
    for folder, part in ((ahead, first), (behind, ~first & early), (behind, ~first & ~early)):
        events.where(part).write.mode("append").parquet(folder)
        deliver()
    for folder in (ahead, behind):
        own = {"event_id": -1, "user_id": -1, "event_type": "closing", "value": 0.0, "props": '{"k": -1}'}
        write_closing_row(spark, schema, folder, "ts", own)
    deliver()
    return _real(spark.read.parquet(out), _users(), "window_start", "window_end")


@query(
    "stream_dim_latest",
    """SELECT event_id, user_id, CASE WHEN user_id % 7 <> 0 OR event_id % 2 = 1
      THEN 'v' || event_id % 2 || '-' || user_id % 13 END AS label FROM events""",
)
def stream_dim_latest(spark, sf):
    """Every micro-batch looks rows up in the newest snapshot of the dimension, which changes between two arrivals."""
    dim, arriving, out, progress = (fresh_path(spark, n) for n in ("dim", "arriving", "out", "progress"))
    events = table(spark, sf, "events").select("event_id", "user_id")
    users = events.select("user_id").distinct()
    for version in (0, 1):
        label = F.concat(F.lit(f"v{version}-"), (F.col("user_id") % 13).cast("string")).alias("label")
        known = users if version else users.where("user_id % 7 <> 0")
        dimensions.publish(known.select("user_id", label), dim, version)
        events.where(F.col("event_id") % 2 == version).write.mode("append").parquet(arriving)
        rows = read_rows_stream(spark, arriving, events.schema)
        run(rows, progress, each=dimensions.lookup_latest(dim, out, ["user_id"]))
    return read_once(spark, out)
