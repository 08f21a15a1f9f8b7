"""foreachBatch sinks that keep their state as versioned tables.

Version n is the state after batch n and is a function of version n-1 and the
batch alone.  A replayed batch overwrites its own version, so results are exact
after any failure.  State lives in the shared folder, never on one machine.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from growthloom.operators.affiliates import affiliate_run
from growthloom.operators.email import WELCOME_HOURS
from growthloom.operators.joins import apart, attribute, next_buy
from growthloom.operators.members import transition_changes
from growthloom.plans import delta_mart
from growthloom.plans.booking import ADDED, Books, book, fresh
from growthloom.plans.daily import Sources
from growthloom.plans.keyed import HOT_ROWS, latest_by, micros
from growthloom.plans.leads import capture, clean_leads
from growthloom.plans.purchases import checkouts, route_checkouts
from growthloom.session import discard, scratch_path, stage


HOUR = 3_600_000_000  # microseconds


class _State:
    def __init__(self, path: str):
        self.path = path

    def at(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/batch_id={batch_id}"

    def load(self, name: str, batch_id: int, like: DataFrame) -> DataFrame:
        """The state before batch `batch_id`, empty at the start."""
        if batch_id == 0:
            return like.where(F.lit(False))
        return like.sparkSession.read.schema(like.schema).parquet(self.at(name, batch_id - 1))

    def save(self, name: str, batch_id: int, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.at(name, batch_id))
        return df.sparkSession.read.schema(df.schema).parquet(self.at(name, batch_id))

    def clock(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """One row with the newest event time seen so far."""
        top = batch.agg(F.max("at").alias("seen"))
        before = self.load("clock", batch_id, top)
        return self.save("clock", batch_id, top.unionByName(before).agg(F.max("seen").alias("seen")))


class MartUpsert(_State):
    """Upsert a stream into a mart by appending changed rows and compacting now and then.

    A batch writes its own rows only; every `compact_every` batches a new base
    version is made of the base before it and the deltas since.  `read` merges
    base and deltas.  All columns but the key are overwritten.
    """

    def __init__(self, path: str, key: list[str], set_cols: list[str], order: list[str] | None = None,
                 compact_every: int = 20):
        super().__init__(path)
        self.key, self.set_cols, self.order, self.compact_every = key, set_cols, order, compact_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        one = latest_by(batch, self.key, self.order) if self.order else batch
        delta = self.save("delta", batch_id, one.select(*self.key, *self.set_cols))
        if (batch_id + 1) % self.compact_every == 0:
            self.save("base", batch_id, self.read(delta, batch_id, compacting=True))

    def read(self, like: DataFrame, batch_id: int, compacting: bool = False) -> DataFrame:
        """The mart after batch `batch_id`; `like` has its columns."""
        reader = like.sparkSession.read.schema(like.schema)
        base = (batch_id + (0 if compacting else 1)) // self.compact_every * self.compact_every - 1
        parts = [
            reader.parquet(self.at("delta", n)).withColumn("_batch", F.lit(n)) for n in range(base + 1, batch_id + 1)
        ]
        if base >= 0:
            parts.append(reader.parquet(self.at("base", base)).withColumn("_batch", F.lit(base)))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        return latest_by(every, self.key, ["_batch"]).select(*like.columns)


class AttributionSink(_State):
    """Credit each purchase to the latest click before it.

    The stream holds both sides as (key, id, at, kind), kind 0 click and 1 buy;
    rows may come up to `late` after newer ones.  A purchase is held until the
    clock has passed it by `late`, so that all of its clicks are there, and is then
    credited once.  Besides the held purchases only the clicks that can still win
    are kept: the newest one per key before the lateness limit and those after it.
    No click-buy pairs are formed.  `rest` credits what is held when a stream ends.
    A purchase that comes later than `late`, or without a time, is credited at once.
    """

    def __init__(self, path: str, key: str, days: int = 60, late: str = "1 hour", rows: int = HOT_ROWS):
        super().__init__(path)
        self.key, self.days, self.late, self.rows = key, days, late, rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        limit = self.clock(batch, batch_id).select(F.col("seen") - F.expr(f"interval {self.late}")).scalar()
        held = F.coalesce(F.col("at") >= limit, F.lit(False))
        clicks = self._with_kept("clicks", batch.where("kind = 0"), batch_id)
        buys = self._with_kept("buys", batch.where("kind = 1"), batch_id)
        self.save("credited", batch_id, attribute(clicks, buys.where(~held), [self.key], self.days, self.rows))
        self.save("buys", batch_id, buys.where(held))
        # Clicks whose cookie has run out can never win again.
        alive = clicks.where(F.col("at") >= limit - F.expr(f"interval {self.days} days"))
        settled = latest_by(alive.where(F.col("at") <= limit), [self.key], ["at", "id"]).select(self.key, "id", "at")
        self.save("clicks", batch_id, settled.unionByName(clicks.where(F.col("at") > limit)))

    def _with_kept(self, name: str, rows: DataFrame, batch_id: int) -> DataFrame:
        fresh = rows.select(self.key, "id", "at")
        return fresh.unionByName(self.load(name, batch_id, fresh))

    def rest(self, like: DataFrame, batch_id: int) -> DataFrame:
        """Credits of the purchases held after batch `batch_id`; `like` is an empty frame of (key, id, at)."""
        clicks, buys = (self.load(name, batch_id + 1, like) for name in ("clicks", "buys"))
        return attribute(clicks, buys, [self.key], self.days, self.rows)


class AbandonedSink(_State):
    """Emit checkouts that had no purchase within `wait` once the clock is past it.

    The stream holds (key, id, at, kind): kind 1 checkout, 0 purchase, others
    only move the clock.  Kept between batches: checkouts still waiting, and
    purchases that a late checkout may still match.
    """

    def __init__(self, path: str, key: str, wait: str = "1 hour", late: str = "10 minutes", rows: int = HOT_ROWS):
        super().__init__(path)
        self.key, self.wait, self.late, self.rows = key, wait, late, rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        cols = [self.key, "id", "at", "kind"]
        fresh = batch.where("kind in (0, 1)").select(*cols)
        rows = fresh.unionByName(self.load("open", batch_id, fresh))
        limit = self.clock(batch, batch_id).select(F.col("seen") - F.expr(f"interval {self.late}")).scalar()
        starts = next_buy(rows.where("kind = 1"), rows.where("kind = 0"), self.key, self.rows)
        ends = F.col("at") + F.expr(f"interval {self.wait}")
        unmet = starts.where(F.col("next_at").isNull() | (F.col("next_at") > ends))
        self.save("abandoned", batch_id, unmet.where(ends <= limit).drop("next_at"))
        waiting = unmet.where(ends > limit).select(*cols[:3], F.lit(1).alias("kind"))
        self.save("open", batch_id, waiting.unionByName(rows.where((F.col("kind") == 0) & (F.col("at") >= limit))))


class DripSink(_State):
    """Emit the welcome steps that fell due, once each.

    The stream holds (subscriber_id, at, is_start); all rows move the clock, which stands `late` behind the newest time.  A
    subscriber begins with the earliest start once the clock has passed it.  Its steps then go to a calendar, a table with
    a folder per hour in which steps fall due; nothing there is rewritten, a batch reads the hours the clock went through,
    so what is read follows the steps that fall due.  Who began is
    remembered as a list of ids, appended to and looked up, never rewritten.
    """

    def __init__(self, path: str, late: str = "1 hour"):
        super().__init__(path)
        self.late = late

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, shift = batch.sparkSession, F.expr(f"interval {self.late}")
        before = self.load("clock", batch_id, batch.agg(F.max("at").alias("seen"))).agg((F.max("seen") - shift).alias("seen"))
        clock = self.clock(batch, batch_id).select((F.col("seen") - shift).alias("seen"))
        # Two values: where the clock was, where it is now.
        was, now = before.first()["seen"], clock.first()["seen"]
        starts = batch.where("is_start and at is not null").select("subscriber_id", "at")
        starts = starts.unionByName(self.load("pending", batch_id, starts)).groupBy("subscriber_id").agg(F.min("at").alias("at"))
        passed = F.lit(False) if now is None else F.coalesce(F.col("at") <= F.lit(now), F.lit(False))
        self.save("pending", batch_id, starts.where(~passed))
        begun = starts.where(passed)
        if batch_id > 0:
            known = spark.read.schema("subscriber_id {}, batch_id long".format(starts.schema["subscriber_id"].dataType.simpleString())).parquet(f"{self.path}/began")
            begun = begun.join(known.where(F.col("batch_id") < batch_id), "subscriber_id", "left_anti")
        begun = self.save("began", batch_id, begun)
        steps = F.posexplode(F.array(*[F.lit(h) for h in WELCOME_HOURS]))
        planned = begun.select("subscriber_id", "at", steps.alias("_n", "_h")).select(
            "subscriber_id", (F.col("_n") + 1).cast("long").alias("step"), (F.col("at") + F.make_dt_interval(hours=F.col("_h"))).alias("send_at"))
        due = F.lit(False) if now is None else F.col("send_at") <= F.lit(now)
        later = planned.where(~due).withColumn("due_hour", F.floor(micros(F.col("send_at")) / HOUR).cast("long"))
        later.write.mode("overwrite").partitionBy("due_hour").parquet(f"{self.path}/calendar/batch_id={batch_id}")
        ready = planned.where(due)
        if batch_id > 0 and was is not None:
            calendar = spark.read.schema(f"{self._ddl(planned)}, batch_id long, due_hour long").parquet(f"{self.path}/calendar")
            low, high = (F.floor(micros(F.lit(t)) / HOUR) for t in (was, now))
            hours = calendar.where((F.col("due_hour") >= low) & (F.col("due_hour") <= high) & (F.col("batch_id") < batch_id))
            ready = ready.unionByName(hours.where(due & (F.col("send_at") > F.lit(was))).select(*planned.columns))
        self.save("steps", batch_id, ready.select("subscriber_id", "step", "send_at"))

    @staticmethod
    def _ddl(df: DataFrame) -> str:
        return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def split_late(df: DataFrame, at: str, seen_until, delay: str) -> tuple[DataFrame, DataFrame]:
    """(in time, late) against the newest event time seen before."""
    late = F.coalesce(F.col(at) < seen_until - F.expr(f"interval {delay}"), F.lit(False))
    return df.where(~late), df.where(late)


class LateSplitter(_State):
    """Events in time and late events go to two tables.  Rows need `at`."""

    def __init__(self, path: str, delay: str):
        super().__init__(path)
        self.delay = delay

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.load("clock", batch_id, batch.agg(F.max("at").alias("seen")))
        ok, late = split_late(batch, "at", before.agg(F.max("seen")).scalar(), self.delay)
        self.save("ok", batch_id, ok)
        self.save("late", batch_id, late)
        self.clock(batch, batch_id)


class MartSink(LateSplitter):
    """Keeps the daily mart up from a stream: every batch adds its changes to the days it touches, late events like others.

    `derive` turns events into the mart's sources.  Late events are also kept apart, as `LateSplitter` does; a late day is
    not rebuilt from its events but gets their sums added.
    """

    def __init__(self, path: str, delay: str, derive: Callable[[DataFrame], Sources]):
        super().__init__(path, delay)
        self.derive, self.mart = derive, f"{path}/mart"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        super().__call__(batch, batch_id)
        delta_mart.apply(delta_mart.changes(self.derive(batch)), self.mart, batch_id)


class IntakeSink(_State):
    """Checkout messages to purchases, subscription checkouts, skipped messages and
    affiliate commissions, set-wise per micro-batch.

    Rows need id, received_at, body.  Commissions are made when they also have the
    column `affiliate_id`.  Bodies are parsed once; all outputs start from that table.
    """

    def __init__(self, path: str, products: DataFrame, profiles: DataFrame, affiliates: DataFrame):
        super().__init__(path)
        self.products, self.profiles, self.affiliates = products, profiles, affiliates

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.save("checkouts", batch_id, checkouts(batch))
        out = route_checkouts(rows, self.products, self.profiles)
        bought = self.save("purchases", batch_id, out.purchases)
        self.save("subscriptions", batch_id, out.subscriptions)
        self.save("skipped", batch_id, out.skipped)
        if "affiliate_id" in batch.columns:
            brought = bought.drop("product_type").join(apart(batch.select("id", "affiliate_id")), "id")
            self.save("commissions", batch_id, affiliate_run(brought, self.affiliates, self.products))


class BookingSink(_State):
    """Checkout messages booked once, over all micro-batches.

    Each batch writes only what it adds, besides the ledger of the messages it applied; a message that an earlier batch
    applied is left out before any table is touched, so a redelivery books nothing.  A replayed batch reads the ledgers
    before its own and overwrites its own additions.  `read` gives the tables after the stream.
    """

    def __init__(self, path: str, products: DataFrame, books: Books):
        super().__init__(path)
        self.products, self.books = products, books

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = fresh(checkouts(batch), self._earlier(batch, "ledger", "id long", batch_id))
        rows = self.save("checkouts", batch_id, rows)
        met = self._earlier(batch, "people", "email string, subscriber_id string, profile_id string", batch_id)
        subs, profs = self.books.subscribers.select("id", "email"), self.books.profiles.select("id", "email")
        if met is not None:
            subs = subs.unionByName(met.select(F.col("subscriber_id").alias("id"), "email")).distinct()
            profs = profs.unionByName(met.select(F.col("profile_id").alias("id"), "email")).distinct()
        for name, df in book(rows, self.products, subs, profs, lambda sold: self.save("sold", batch_id, sold)).items():
            self.save(name, batch_id, df)

    def _earlier(self, batch: DataFrame, name: str, schema: str, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        every = batch.sparkSession.read.schema(f"{schema}, batch_id long").parquet(f"{self.path}/{name}")
        return every.where(F.col("batch_id") < batch_id).drop("batch_id")

    def added(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: spark.read.parquet(f"{self.path}/{name}").drop("batch_id") for name in ADDED}

    def read(self, spark: SparkSession) -> Books:
        return self.books.after(self.added(spark))


class TransitionSink(_State):
    """Lifecycle changes of a stream that takes back what a late message disproves.

    Messages are (key, price, at, id) and may come in any order.  The log of messages lies in folders by a hash of the key; a
    batch reads the folders of its own keys, classifies these keys' messages without and with the batch in one scan, and writes the
    difference: rows with sign -1 that no longer hold, rows with sign +1 that do now.  A late message so re-classifies itself
    and the one after it.  A message that comes again changes nothing.  `read` folds the changes.
    """

    def __init__(self, path: str, key: str, price: str, at: str, tie: str, buckets: int = 16, rows: int = HOT_ROWS):
        super().__init__(path)
        self.columns, self.buckets, self.rows = [key, price, at, tie], buckets, rows

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        key, _, _, tie = self.columns
        bucket = F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        rows = self.save("batch", batch_id, batch.select(*self.columns).dropDuplicates([key, tie]))
        past, ddl = rows.where(F.lit(False)), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        if batch_id > 0:
            hit = [r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()]  # `buckets` values at most
            log = batch.sparkSession.read.schema(f"{ddl}, batch_id long, bucket int").parquet(f"{self.path}/log")
            log = log.where((F.col("batch_id") < batch_id) & F.col("bucket").isin(hit))
            past = stage(log.select(*self.columns).join(rows.select(key).distinct(), key, "left_semi"), "past-messages")
        fresh = rows.join(past.select(key, tie), [key, tie], "left_anti").select(*self.columns)
        fresh.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/log/batch_id={batch_id}")
        fresh = batch.sparkSession.read.schema(ddl).parquet(f"{self.path}/log/batch_id={batch_id}").select(*self.columns)
        self.save("changes", batch_id, transition_changes(past, fresh, *self.columns, self.rows))
        discard(past)

    def read(self, spark: SparkSession) -> DataFrame:
        changes = spark.read.parquet(f"{self.path}/changes").drop("batch_id")
        rest = [c for c in changes.columns if c != "sign"]
        return changes.groupBy(*rest).agg(F.sum("sign").alias("sign")).where("sign > 0").drop("sign")


class LeadSink(_State):
    """Lead messages to new subscribers, tags and invalid leads.

    An address is new when neither the given subscribers nor an earlier batch has
    it.  Each batch adds only its own rows to the state.
    """

    def __init__(self, path: str, subscribers: DataFrame):
        super().__init__(path)
        self.subscribers = subscribers

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        known = self.subscribers.select("email")
        if batch_id > 0:
            made = batch.sparkSession.read.schema("email string, batch_id long").parquet(f"{self.path}/new_subscribers")
            known = known.unionByName(made.where(F.col("batch_id") < batch_id).select("email"))
        out = capture(self.save("leads", batch_id, clean_leads(batch)), known)
        self.save("new_subscribers", batch_id, out.new_subscribers)
        self.save("tags", batch_id, out.tags)
        self.save("invalid", batch_id, out.invalid)


def run_batches(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> int:
    """Drive a foreachBatch sink to the end of the input; returns the last batch id."""
    last = [-1]

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        last[0] = batch_id

    query = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
    return last[0]


def run_sink(df: DataFrame, make: Callable[[str], _State], name: str, table: str) -> DataFrame:
    """Run a sink in a fresh folder and read one of its output tables."""
    path = scratch_path(df.sparkSession, name)
    run_batches(df, make(path), f"{path}-checkpoint")
    return df.sparkSession.read.parquet(f"{path}/{table}").drop("batch_id")


def run_attribution(df: DataFrame, make: Callable[[str], AttributionSink], name: str) -> DataFrame:
    """Credits of a stream that has ended: those given on the way and those of the purchases still held."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    sink = make(path)
    last = run_batches(df, sink, f"{path}-checkpoint")
    rest = sink.rest(spark.createDataFrame([], df.select(sink.key, "id", "at").schema), last)
    if last < 0:
        return rest
    return spark.read.schema(rest.schema).parquet(f"{path}/credited").select(*rest.columns).unionByName(rest)


def run_upsert(df: DataFrame, name: str, key: list[str], set_cols: list[str], order: list[str] | None = None,
               mode: str = "update") -> DataFrame:
    """Upsert a stream into a mart and read it."""
    path = scratch_path(df.sparkSession, name)
    sink = MartUpsert(path, key, set_cols, order)
    last = run_batches(df, sink, f"{path}-checkpoint", mode)
    like = df.sparkSession.createDataFrame([], df.select(*key, *set_cols).schema)
    return sink.read(like, last) if last >= 0 else like
