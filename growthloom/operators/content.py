"""Videos, hooks, scripts, publishing."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from growthloom.functions import exprs as X
from growthloom.functions.sketches import SKETCH, quantile, sketch
from growthloom.operators.joins import visual_at
from growthloom.plans import keyed

METRICS = ["views", "likes", "shares", "comments", "saves"]
# Posting hours (weekday, weekend) per platform
POSTING_HOURS = {"tiktok": (19, 21), "instagram": (12, 10), "youtube": (18, 11)}


def content_totals(content: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    parts = F.col("likes") + F.col("shares") + F.col("comments") + F.col("saves")
    return content.groupBy(*by).agg(
        F.coalesce(F.sum("views"), F.lit(0)).alias("total_content_views"),
        F.coalesce(F.sum(parts), F.lit(0)).alias("total_engagement"),
        F.coalesce(F.sum("follower_gain"), F.lit(0)).alias("new_followers"),
    )


def video_daily_sums(content: DataFrame) -> DataFrame:
    return content.groupBy("video_id", "event_date").agg(*[F.sum(m).alias(m) for m in METRICS])


def rebuild_video_totals(content: DataFrame) -> DataFrame:
    """Lifetime totals from the daily facts, so that a rerun cannot count twice."""
    return content.groupBy("video_id").agg(*[F.sum(m).alias(f"total_{m}") for m in METRICS])


def hook_stats(videos: DataFrame, hooks: DataFrame, top: int | None = 10) -> DataFrame:
    """Views, likes and mean engagement per hook; videos are summed before the join."""
    rate = F.try_divide(
        (F.col("total_likes") + F.col("total_shares") + F.col("total_comments") + F.col("total_saves")).cast("double"),
        F.col("total_views").cast("double"),
    )
    sums = videos.groupBy(F.col("hook_id").alias("id")).agg(
        F.sum("total_views").alias("total_views"), F.sum("total_likes").alias("total_likes"),
        F.round(F.avg(F.round(rate, 6)), 4).alias("avg_engagement"),
    )
    out = sums.join(hooks.select("id", "hook_text"), "id")
    return out.orderBy(F.desc_nulls_last("total_views"), F.asc("id")).limit(top) if top else out


def hook_engagement(content: DataFrame, videos: DataFrame, as_of: Column, top: int = 3) -> DataFrame:
    """(likes + shares) / views per hook over seven days, top by views."""
    week = content.where(
        (F.col("event_date") >= F.to_date(as_of - F.expr("interval 7 days"))) & (F.col("event_date") <= F.to_date(as_of))
    )
    per_video = week.groupBy(F.col("video_id").alias("id")).agg(
        F.sum("views").alias("v"), F.sum(F.col("likes") + F.col("shares")).alias("e")
    )
    sums = per_video.join(videos.select("id", "hook_id"), "id").groupBy("hook_id").agg(
        F.sum("v").alias("total_views"), F.sum("e").alias("engaged")
    )
    return (
        sums.select("hook_id", "total_views", X.ratio("engaged", "total_views").alias("eng_rate_ls"))
        .orderBy(F.desc_nulls_last("total_views"), F.asc("hook_id"))
        .limit(top)
    )


def platform_report(content: DataFrame) -> DataFrame:
    """Metric rows by platform columns with a total."""
    sums = content.rollup("platform").agg(
        F.sum("views").alias("views"), F.sum("shares").alias("shares"), F.sum("saves").alias("saves"),
        F.sum("follower_gain").alias("followers"),
    )
    rates = sums.select(
        F.coalesce("platform", F.lit("total")).alias("platform"),
        F.col("views").cast("double"), F.col("shares").cast("double"),
        X.ratio("saves", "views").alias("save_rate"), F.col("followers").cast("double"),
    )
    long = rates.unpivot(["platform"], ["views", "shares", "save_rate", "followers"], "metric", "value")
    return long.groupBy("metric").pivot("platform", ["tiktok", "instagram", "youtube", "total"]).agg(F.max("value"))


def pillar_rank(content: DataFrame, videos: DataFrame, as_of: Column) -> DataFrame:
    """Content pillars ranked by mean watch time per view over seven days."""
    week = content.where(
        (F.col("event_date") >= F.to_date(as_of - F.expr("interval 7 days"))) & (F.col("event_date") <= F.to_date(as_of))
    )
    per_video = week.groupBy(F.col("video_id").alias("id")).agg(F.sum("views").alias("v"), F.sum("watch_cs").alias("w"))
    pillars = per_video.join(videos.select("id", "category"), "id").groupBy("category").agg(
        F.sum("v").alias("views"), F.sum("w").alias("watch_cs")
    )
    mean = X.ratio("watch_cs", "views")
    # One row per pillar: the unpartitioned window is small.
    return pillars.withColumn("mean_watch_cs", mean).withColumn(
        "place", F.rank().over(Window.orderBy(F.desc_nulls_last("mean_watch_cs"))).cast("long")
    )


def traffic_mix(content: DataFrame) -> DataFrame:
    cols = ["from_fyp", "from_profile", "from_search", "from_hashtags"]
    sums = content.agg(*[F.sum(c).alias(c) for c in cols])
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    rows = [F.struct(F.lit(c).alias("origin"), F.col(c).alias("views"), X.ratio(c, total).alias("share")) for c in cols]
    return sums.select(F.inline(F.array(*rows)))


def hook_catalog(hooks: DataFrame) -> DataFrame:
    """Hooks per category and trigger with all subtotals."""
    tenths = (F.col("estimated_performance") * 10).cast("long")
    return hooks.cube("category", "trigger_type").agg(
        F.count(F.lit(1)).alias("hooks"),
        X.ratio(F.sum(tenths), F.count(F.lit(1)) * 10, 4).alias("mean_score"),
        F.max("estimated_performance").cast("double").alias("max_score"),
    )


def top_hooks(hooks: DataFrame, n: int, by: str) -> DataFrame:
    return hooks.where(F.col(by).isNotNull()).orderBy(F.desc_nulls_last(by), F.asc("id")).limit(n)


def next_hooks(hooks: DataFrame, used: DataFrame, n: int = 20) -> DataFrame:
    """Best hooks no script has used; ties keep catalog order."""
    free = hooks.join(used.select("hook_text").distinct(), "hook_text", "left_anti")
    return free.orderBy(F.desc_nulls_last("estimated_performance"), F.asc("id")).limit(n)


def random_pick(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable random choice: smallest seeded hashes first."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed))), key).limit(n)


def assign_templates(picked: DataFrame, order: Sequence[Column], first_no: int = 41, prefix: str = "script-") -> DataFrame:
    """Round-robin template, voice and id for an already limited choice of hooks."""
    # Template numbers and voices in turn
    templates, voices = ["1", "2", "3", "9"], ["Adam (v2)", "Antoni"]
    i = F.row_number().over(Window.orderBy(*order)) - 1
    numbered = picked.withColumn("_i", i)
    return numbered.withColumns(
        {
            "position": F.col("_i").cast("long"),
            "script_id": F.concat(F.lit(prefix), F.lpad((F.col("_i") + first_no).cast("string"), 3, "0")),
            "template_no": F.element_at(F.array(*[F.lit(t) for t in templates]), F.col("_i") % 4 + 1),
            "voice": F.element_at(F.array(*[F.lit(v) for v in voices]), F.col("_i") % 2 + 1),
        }
    ).drop("_i")


def production_order(df: DataFrame, order: Sequence[Column], batch: int = 10) -> DataFrame:
    """Overall order number and batch number."""
    numbered = keyed.number_rows(df, order, "order_no")
    return numbered.withColumn("batch", F.floor((F.col("order_no") - 1) / batch) + 1)


def with_timed_lines(scripts: DataFrame, lines: str, name: str, visuals: str | None = None) -> DataFrame:
    """Add an array of (line_no, line, words, start_s, end_s), and the visual of each line if asked.

    Inside the row, so no text is shuffled.  Running sums go by blocks of lines: sums of the blocks before, then of the lines
    before within the block, so a script of n lines costs n times the root of n additions and no array is copied.
    """
    def ends(words: Column) -> Column:
        """Word counts to running sums, 0 in front."""
        block = F.ceil(F.sqrt(F.size(words) + F.lit(1))).cast("int")
        plus = lambda a, b: a + b
        zero = F.lit(0).cast("long")
        sums = F.transform(F.sequence(F.lit(0), F.floor(F.size(words) / block).cast("int")),
                           lambda b: F.aggregate(F.slice(words, b * block + 1, block), zero, plus))
        before = F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), zero, plus))
        return F.transform(F.sequence(F.lit(0), F.size(words)), lambda i: before[F.floor(i / block).cast("int")] + F.aggregate(
            F.slice(words, F.floor(i / block).cast("int") * block + 1, i % block), zero, plus))

    def timed(seen: Column) -> Column:
        def one(line: Column, i: Column) -> Column:
            fields = [
                (i + 1).cast("long").alias("line_no"), line.alias("line"), (seen[i + 1] - seen[i]).alias("words"),
                X.speech_seconds(seen[i]).alias("start_s"), X.speech_seconds(seen[i + 1]).alias("end_s"),
            ]
            return F.struct(*fields, *([visual_at(visuals, i).alias("visual")] if visuals else []))

        return F.transform(lines, one)

    # One-element arrays bind the counts and the sums to variables: they are made once per script.
    bound = F.transform(F.array(F.transform(lines, X.word_count)), ends)
    return scripts.withColumn(name, F.transform(bound, timed)[0])


def timecodes(scripts: DataFrame, keep: Sequence[str], lines: str, visuals: str | None = None) -> DataFrame:
    """One row per script line with its words, start and end second."""
    return with_timed_lines(scripts, lines, "_timed", visuals).select(*keep, F.inline("_timed"))


def lint(df: DataFrame, text: str, forbidden: Sequence[str] = tuple(X.FORBIDDEN_WORDS),
         preferred: Sequence[str] = tuple(X.PREFERRED_WORDS)) -> DataFrame:
    """Distinct forbidden and preferred words in the whole text, and the verdict."""
    return df.withColumns(
        {
            "forbidden_hits": X.vocabulary_hits(text, list(forbidden)),
            "preferred_hits": X.vocabulary_hits(text, list(preferred)),
        }
    ).withColumn("passed", F.col("forbidden_hits") == 0)


def spec_check(df: DataFrame, text: str) -> DataFrame:
    """Spoken length against each platform's limits, one row per platform."""
    words = X.word_count(text)
    rows = [
        F.struct(
            F.lit(p).alias("platform"), F.lit(lo).alias("_lo"), F.lit(hi).alias("_hi"), F.lit(closed).alias("_closed")
        )
        for p, lo, hi, closed in X.VIDEO_LIMITS
    ]
    sized = df.withColumn("words", words).withColumn("seconds", X.speech_seconds("words"))
    long = sized.withColumn("_l", F.explode(F.array(*rows))).select("*", "_l.*").drop("_l")
    top = F.when(F.col("_closed"), F.col("seconds") <= F.col("_hi")).otherwise(F.col("seconds") < F.col("_hi"))
    low, high = X.SCRIPT_WORDS
    return long.withColumns(
        {
            "duration_ok": (F.col("seconds") >= F.col("_lo")) & top,
            "words_ok": F.col("words").between(low, high),
        }
    ).drop("_lo", "_hi", "_closed")


def queue_stats(queue: DataFrame) -> DataFrame:
    states = ["queued", "processing", "published", "failed", "skipped"]
    return queue.groupBy("platform").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in states],
        F.count_if((F.col("status") == "failed") & (F.col("retry_count") >= F.col("max_retries"))).alias("exhausted"),
    )


def retry_queue(queue: DataFrame, as_of: Column, rows: int = keyed.HOT_ROWS) -> DataFrame:
    """Jobs to run now, numbered per platform in schedule order."""
    ready = queue.where(
        F.col("status").isin("queued", "failed") & (F.col("retry_count") < F.col("max_retries"))
        & (F.col("scheduled_for") <= as_of)
    )
    return keyed.scan_by_key(ready, ["platform"], "scheduled_for", ["id"], {"run_order": ("rownum", "platform")}, rows)


def schedule_posts(videos: DataFrame, at: str, platform: str) -> DataFrame:
    """Next day's posting time of the platform, by weekday or weekend."""
    table = F.create_map(
        *[x for p, (wd, we) in POSTING_HOURS.items() for x in (F.lit(p), F.array(F.lit(wd), F.lit(we)))]
    )
    day = F.date_add(F.to_date(at), 1)
    weekend = F.dayofweek(day).isin(1, 7)
    hours = F.try_element_at(table, F.col(platform))
    hour = F.when(weekend, hours[1]).otherwise(hours[0])
    return videos.withColumn("post_at", day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour))


PAGE_BY = ("section", "device", "country")


def page_stats_by_day(views: DataFrame, by: Sequence[str] = PAGE_BY) -> DataFrame:
    """Views, load times and time on page per day and group: sums and sketches, which any range of days merges."""
    work = views.withColumns({"_load": F.col("page_load_ms").cast("double"), "_stay": F.col("time_on_page_seconds").cast("double")})
    return work.groupBy(F.to_date("viewed_at").alias("day"), *by).agg(
        F.count(F.lit(1)).alias("views"), F.sum("page_load_ms").alias("load"), F.max("page_load_ms").alias("max_load"),
        F.sum("time_on_page_seconds").alias("stay"), F.count("time_on_page_seconds").alias("stays"),
        sketch("_load").alias("loads"), sketch("_stay").alias("times"))


def page_stats(days: DataFrame, by: Sequence[str] = PAGE_BY) -> DataFrame:
    """Views, load times and time on page by section, device and country, with subtotals, from the rows of any days."""
    sums = days.rollup(*by).agg(
        F.sum("views").alias("views"), F.sum("load").alias("_load"), F.max("max_load").alias("max_load"), F.sum("stay").alias("_stay"),
        F.sum("stays").alias("_stays"), F.kll_merge_agg_double("loads", SKETCH).alias("_loads"), F.kll_merge_agg_double("times", SKETCH).alias("_times"))
    return sums.select(
        *by, "views", X.ratio("_load", "views", 2).alias("mean_load"), quantile("_loads", 0.95).alias("p95_load"), "max_load",
        X.ratio("_stay", "_stays", 2).alias("mean_stay"), quantile("_times", 0.5).alias("median_stay"))
