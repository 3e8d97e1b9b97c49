"""Registered queries: every operator over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.functions import labels, texts, times
from trailmark.operators import ads, categories, funnel, regions, sampling, sessions
from trailmark.params import JobParams
from trailmark.plans.area_top_products import area_top_products
from trailmark.plans.page_funnel import page_convert_rates
from trailmark.session import stream_session
from trailmark.sinks import staging
from trailmark.sources.actions import scan_actions, scan_clicks
from trailmark.sources.click_log import parse_click_log
from trailmark.sources.dimensions import city_dimension
from trailmark.sources.tasks import task_params
from trailmark.streaming.ad_blacklist import AdBlacklistStream, publish_totals, totals_table
from trailmark.verification.views import Views

TASK_ID = 1
ALL = JobParams(
    task_id=TASK_ID, start_date="2024-01-01", end_date="2024-01-30", page_flow=(1, 2, 3, 4)
)
SAMPLE_TOTAL = 600
SEED = "0"
CLICK_THRESHOLD = 4
STREAM_THRESHOLD = 4
STREAM_KEEP_DAYS = 30
LEVELS = {"ASIA": "A", "EUROPE": "A", "AMERICA": "B", "AFRICA": "C"}
OTHER_LEVEL = "D"

AGE = replace(ALL, start_age=20, end_age=50)
PROFESSION = replace(ALL, professionals=("HOUSEHOLD", "MACHINERY"))
CITY = replace(ALL, cities=tuple(f"NATION_{n}" for n in range(15)))
SEX = replace(ALL, sex="male")
KEYWORDS = replace(ALL, keywords=("kw1", "kw2", "kw3"))
CATEGORIES = replace(ALL, category_ids=(1, 2, 12, 21, 33, 42, 54, 65, 77, 80, 91))
EVERY = replace(
    AGE,
    professionals=("HOUSEHOLD", "MACHINERY", "BUILDING"),
    cities=CITY.cities,
    sex="male",
    keywords=KEYWORDS.keywords,
    category_ids=CATEGORIES.category_ids,
)

Query = Callable[[SparkSession, str], DataFrame]


def _log(v: Views, params: JobParams = ALL) -> DataFrame:
    return scan_actions(v.actions, params.start_date, params.end_date)


def _selected(v: Views, params: JobParams = ALL) -> DataFrame:
    return sessions.selected_sessions(_log(v, params), v.users, params)


def _detail(v: Views) -> DataFrame:
    return sessions.session_detail(_log(v), _selected(v))


def _with_time_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: times.format_time(F.col(name)) for name in names})


def action_scan_by_date(v: Views) -> DataFrame:
    rows = scan_actions(v.actions, "2024-01-05", "2024-01-20")
    return _with_time_text(rows, "action_time")


def click_scan_by_time(v: Views) -> DataFrame:
    return scan_clicks(v.actions, "2024-01-05", "2024-01-20")


def city_dim(v: Views) -> DataFrame:
    return city_dimension(v.cities)


def task_parameters(v: Views) -> DataFrame:
    return task_params(v.tasks)


def session_rollup(v: Views) -> DataFrame:
    rollup = sessions.session_rollup(_log(v), lists=True)
    rollup = rollup.withColumns(
        {
            "search_keywords": texts.list_text(F.col("search_keywords")),
            "click_category_ids": texts.id_list_text(F.col("click_category_ids")),
        }
    )
    return _with_time_text(rollup, "start_time", "end_time")


def session_user_join(v: Views) -> DataFrame:
    joined = sessions.join_users(sessions.session_rollup(_log(v)), v.users)
    return _with_time_text(joined, "start_time", "end_time")


def _filtered(params: JobParams) -> Callable[[Views], DataFrame]:
    def query(v: Views) -> DataFrame:
        return _selected(v, params).select(
            "session_id", "user_id", *sessions.USER_COLUMNS, "visit_length", "step_length"
        )

    return query


def session_detail(v: Views) -> DataFrame:
    return _with_time_text(_detail(v), "action_time")


def visit_length_histogram(v: Views) -> DataFrame:
    return sessions.visit_length_histogram(_selected(v))


def step_length_histogram(v: Views) -> DataFrame:
    return sessions.step_length_histogram(_selected(v))


def session_stat_ratios(v: Views) -> DataFrame:
    return sessions.session_stat_ratios(_selected(v), TASK_ID)


def session_hour_counts(v: Views) -> DataFrame:
    counts = sampling.session_hour_counts(_selected(v))
    return counts.withColumn("date_hour", F.concat_ws("_", "date", "hour"))


def sample_quota(v: Views) -> DataFrame:
    return sampling.sample_quota(sampling.session_hour_counts(_selected(v)), SAMPLE_TOTAL)


def _sample(v: Views) -> DataFrame:
    return sampling.sample_sessions(_selected(v), SAMPLE_TOTAL, SEED)


def session_sample(v: Views) -> DataFrame:
    return sampling.sample_report(_log(v), _sample(v), TASK_ID)


def session_sample_detail(v: Views) -> DataFrame:
    detail = sampling.sample_detail(_log(v), _sample(v))
    return categories.detail_record(detail, TASK_ID, "sample").drop("top_category_id")


def _session_categories(v: Views) -> DataFrame:
    return sessions.session_detail(categories.session_category_counts(_log(v)), _selected(v))


def category_distinct(v: Views) -> DataFrame:
    return categories.category_distinct(_log(v))


def category_click_counts(v: Views) -> DataFrame:
    return categories.category_click_counts(_log(v))


def category_order_counts(v: Views) -> DataFrame:
    return categories.category_order_counts(_log(v))


def category_pay_counts(v: Views) -> DataFrame:
    return categories.category_pay_counts(_log(v))


def category_counts(v: Views) -> DataFrame:
    return categories.category_counts(_session_categories(v))


def category_ranked(v: Views) -> DataFrame:
    return categories.category_ranked(category_counts(v))


def category_top10(v: Views) -> DataFrame:
    return categories.category_top(category_counts(v), TASK_ID)


def session_category_clicks(v: Views) -> DataFrame:
    return categories.session_category_clicks(_log(v))


def category_top_sessions(v: Views) -> DataFrame:
    touched = _session_categories(v)
    top = categories.category_top(categories.category_counts(touched), TASK_ID)
    return categories.category_top_sessions(touched, top, TASK_ID)


def category_top_session_detail(v: Views) -> DataFrame:
    detail = categories.category_top_session_detail(_log(v), category_top_sessions(v))
    return categories.detail_record(detail, TASK_ID, "top_category", "top_category_id")


def page_pairs(v: Views) -> DataFrame:
    return funnel.page_pairs(_log(v)).select("event_id", "session_id", "from_page", "to_page")


def page_pair_counts(v: Views) -> DataFrame:
    return funnel.page_pair_counts(funnel.page_pairs(_log(v)))


def start_page_pv(v: Views) -> DataFrame:
    return funnel.start_page_pv(_log(v), ALL.page_flow)


def page_flow_matches(v: Views) -> DataFrame:
    return funnel.page_flow_matches(_log(v), ALL.page_flow)


def page_convert_rate(v: Views) -> DataFrame:
    return page_convert_rates(v.actions, ALL)


def page_convert_text(v: Views) -> DataFrame:
    return funnel.page_convert_text(page_convert_rates(v.actions, ALL), TASK_ID)


def _clicks(v: Views) -> DataFrame:
    return scan_clicks(v.actions, ALL.start_date, ALL.end_date)


def click_city_join(v: Views) -> DataFrame:
    return regions.click_city_join(_clicks(v), city_dimension(v.cities))


def area_product_counts(v: Views) -> DataFrame:
    return regions.area_product_counts(_clicks(v), city_dimension(v.cities))


def area_product_enriched(v: Views) -> DataFrame:
    return regions.area_product_enriched(area_product_counts(v), v.products)


def area_top3(v: Views) -> DataFrame:
    return area_top_products(v.actions, v.cities, v.products, ALL, LEVELS, OTHER_LEVEL)


def product_status(v: Views) -> DataFrame:
    return v.products.select(
        "product_id",
        "product_name",
        labels.json_field(F.col("extend_info"), "product_status").alias("status"),
        labels.product_status(F.col("extend_info")).alias("product_status"),
    )


def area_level(v: Views) -> DataFrame:
    level = labels.area_level(F.col("area"), LEVELS, OTHER_LEVEL)
    return city_dimension(v.cities).withColumn("area_level", level)


def time_functions(v: Views) -> DataFrame:
    """Texts with an unpadded hour; those of error events are unreadable."""
    text = F.date_format("ts", times.TIME_INPUT)
    # Fields of the same event beyond their range: 13 months, 31 days, 24 hours more.
    parts = [F.year("ts"), F.month("ts") + 13, F.day("ts") + 31, F.hour("ts") + 24]
    parts += [F.minute("ts") + 75, F.second("ts") + 61]
    beyond = F.format_string("%d-%d-%d %d:%d:%d and more", *parts)
    events = v.table("events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(text).alias("text"),
        F.lit("2024-01-15 9:05:07").alias("other"),
        F.date_format("ts", times.DATE_KEY).alias("key"),
        beyond.alias("beyond"),
    )
    text, other, time = F.col("text"), F.col("other"), F.col("time")
    events = events.withColumn("time", times.parse_time(text))  # read once, written often
    return events.select(
        "event_id",
        times.format_time(time).alias("time_text"),
        times.format_date(time).alias("date_text"),
        times.format_date_key(time).alias("date_key"),
        times.format_minute(time).alias("minute_text"),
        times.date_hour(time).alias("date_hour"),
        times.format_date(times.parse_date_key(F.col("key"))).alias("key_date"),
        times.is_before(text, other).alias("is_before"),
        times.is_after(text, other).alias("is_after"),
        times.text_seconds_between(other, text).alias("seconds"),
        times.format_time(times.parse_time(F.col("beyond"))).alias("rolled_over"),
    )


def string_functions(v: Views) -> DataFrame:
    """A record text per event; its keyword is empty for errors, its page comes twice."""
    user, k = F.col("user_id").cast("string"), F.get_json_object("props", "$.k")
    keyword = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    record = F.concat(
        F.lit("userid="), user, F.lit("|keyword="), keyword, F.lit("|page="), k, F.lit("|page=x")
    )
    events = v.table("events").select(
        "event_id",
        keyword.alias("keyword"),
        k.alias("k"),
        record.alias("record"),
        F.concat(F.lit(","), k, F.lit(","), user, F.lit(",,")).alias("list"),
    )
    record = F.col("record")
    return events.select(
        "event_id",
        texts.is_empty(F.col("keyword")).alias("is_empty"),
        texts.is_not_empty(F.col("keyword")).alias("is_not_empty"),
        texts.trim_comma(F.col("list")).alias("trimmed"),
        texts.pad_two(F.col("k")).alias("padded"),
        texts.record_field(record, "userid").alias("record_user"),
        texts.record_field(record, "keyword").alias("record_keyword"),
        texts.record_field(record, "page").alias("record_page"),
        texts.record_field(record, "absent").alias("record_absent"),
        texts.with_record_field(record, "page", "home").alias("record_changed"),
    )


def ad_log_parse(v: Views) -> DataFrame:
    parsed = parse_click_log(v.click_lines(v.clicks, cut=True))
    return parsed.select(
        "event_id", "millis", "province", "city", "user_id", "ad_id", "malformed"
    )


def ad_blacklist(v: Views) -> DataFrame:
    return ads.ad_blacklist(v.clicks, CLICK_THRESHOLD)


def ad_filter_blacklist(v: Views) -> DataFrame:
    kept = ads.without_blacklisted(v.clicks, ad_blacklist(v))
    return kept.select("event_id", "day", "user_id", "ad_id", "batch")


def ad_daily_counts(v: Views) -> DataFrame:
    return ads.ad_daily_counts(v.clicks, CLICK_THRESHOLD)


# Streams already run, by application and input folder, with the folder they keep.
_streams: dict[tuple[str, str], tuple[AdBlacklistStream, str]] = {}


def _run(v: Views) -> tuple[AdBlacklistStream, str]:
    """The stream run over all clicks; four queries look at what one run leaves."""
    key = v.spark.sparkContext.applicationId, v.folder
    if key not in _streams:
        folder = staging.run_folder(v.spark, "ad-stream")
        _streams[key] = _run_stream(v, folder), folder
    return _streams[key]


def _streamed(v: Views) -> AdBlacklistStream:
    return _run(v)[0]


def drop_streams(spark: SparkSession) -> None:
    """Forgets the streams of this application and deletes what they left."""
    application = spark.sparkContext.applicationId
    for key in [key for key in _streams if key[0] == application]:
        staging.drop_folder(spark, _streams.pop(key)[1])


def _run_stream(v: Views, folder: str) -> AdBlacklistStream:
    """One micro-batch per click batch number: each round drops the next batch's files
    into the folder and restarts the query from its checkpoint."""
    lines = v.click_lines(v.stream_clicks)
    lines.select("batch", "value").write.partitionBy("batch").text(f"{folder}/batches")
    stored = v.spark.read.text(f"{folder}/batches")
    totals = totals_table(v.spark, f"{folder}/totals")
    stream = AdBlacklistStream(
        v.spark,
        f"{folder}/state",
        STREAM_THRESHOLD,
        publish=publish_totals(totals),
        keep_days=STREAM_KEEP_DAYS,
    )
    source = stream_session(v.spark).readStream.format("text").schema("value string")
    numbers = sorted(row.batch for row in stored.select("batch").distinct().collect())
    for number in numbers:
        batch = stored.where(F.col("batch") == number).select("value")
        batch.write.mode("append").text(f"{folder}/incoming")
        stream.start(source.load(f"{folder}/incoming"), available_now=True).awaitTermination()
    return stream


def ad_stream_counts(v: Views) -> DataFrame:
    return _streamed(v).counts.read_all()


def ad_stream_blacklist(v: Views) -> DataFrame:
    return _streamed(v).blacklist.read_all()


def ad_stream_filter(v: Views) -> DataFrame:
    """Clicks kept per micro-batch: by how much a batch raised the totals it changed."""
    stored = v.spark.read.parquet(f"{_streamed(v).counts.root}/batches")
    earlier = W.partitionBy(*ads.CLICK_KEYS).orderBy("batch_id")
    before = F.coalesce(F.lag("click_count").over(earlier), F.lit(0))
    raised = stored.withColumn("kept", F.col("click_count") - before)
    return raised.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.sum("kept").alias("kept_clicks")
    )


def ad_upserted_counts(v: Views) -> DataFrame:
    """Totals as the stream kept them up to date by key, batch by batch."""
    return totals_table(v.spark, f"{_run(v)[1]}/totals").read()


_QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    "action_scan_by_date": action_scan_by_date,
    "click_scan_by_time": click_scan_by_time,
    "city_dim": city_dim,
    "task_params": task_parameters,
    "session_rollup": session_rollup,
    "session_user_join": session_user_join,
    "session_filter_age": _filtered(AGE),
    "session_filter_profession": _filtered(PROFESSION),
    "session_filter_city": _filtered(CITY),
    "session_filter_sex": _filtered(SEX),
    "session_filter_keywords": _filtered(KEYWORDS),
    "session_filter_categories": _filtered(CATEGORIES),
    "session_filter_all": _filtered(EVERY),
    "session_detail": session_detail,
    "visit_length_histogram": visit_length_histogram,
    "step_length_histogram": step_length_histogram,
    "session_stat_ratios": session_stat_ratios,
    "session_hour_counts": session_hour_counts,
    "sample_quota": sample_quota,
    "session_sample": session_sample,
    "session_sample_detail": session_sample_detail,
    "category_distinct": category_distinct,
    "category_click_counts": category_click_counts,
    "category_order_counts": category_order_counts,
    "category_pay_counts": category_pay_counts,
    "category_counts": category_counts,
    "category_ranked": category_ranked,
    "category_top10": category_top10,
    "session_category_clicks": session_category_clicks,
    "category_top_sessions": category_top_sessions,
    "category_top_session_detail": category_top_session_detail,
    "page_pairs": page_pairs,
    "page_pair_counts": page_pair_counts,
    "start_page_pv": start_page_pv,
    "page_flow_matches": page_flow_matches,
    "page_convert_rate": page_convert_rate,
    "page_convert_text": page_convert_text,
    "click_city_join": click_city_join,
    "area_product_counts": area_product_counts,
    "area_product_enriched": area_product_enriched,
    "area_top3": area_top3,
    "product_status": product_status,
    "area_level": area_level,
    "time_functions": time_functions,
    "string_functions": string_functions,
    "ad_log_parse": ad_log_parse,
    "ad_blacklist": ad_blacklist,
    "ad_filter_blacklist": ad_filter_blacklist,
    "ad_daily_counts": ad_daily_counts,
    "ad_stream_counts": ad_stream_counts,
    "ad_stream_blacklist": ad_stream_blacklist,
    "ad_stream_filter": ad_stream_filter,
    "ad_upserted_counts": ad_upserted_counts,
}


def _over_views(query: Callable[[Views], DataFrame]) -> Query:
    return lambda spark, folder: query(Views(spark, folder))


def queries() -> dict[str, Query]:
    return {name: _over_views(query) for name, query in _QUERIES.items()}
