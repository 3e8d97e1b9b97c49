"""The jobs' input tables, derived from the given parquet tables by Spark."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH_SECONDS = 21_600
STREAM_BATCH_SECONDS = 864_000

# Schemas seen so far: reading a file's footer takes a job.
_schemas: dict[str, T.StructType] = {}

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


class Views:
    """Lazily built input tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        # Event times carry no zone; everything derived from them is read as UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    @cached_property
    def _events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "cast(get_json_object(props, '$.k') AS bigint) AS k",
        )

    @cached_property
    def actions(self) -> DataFrame:
        numbered = self._events.selectExpr(
            "*", "1 + user_id % 30 AS span", "(day(ts) - 1) div (1 + user_id % 30) AS sno"
        )
        dated = numbered.selectExpr("*", "date_add(DATE '2024-01-01', int(sno * span)) AS sday")
        timed = dated.selectExpr(
            "*",
            "cast(sday AS timestamp_ntz) AS start",
            "timestampdiff(SECOND, cast(sday AS timestamp_ntz), ts) div 1200L AS elapsed",
        )
        return timed.selectExpr(
            "event_id",
            "date_format(sday, 'yyyy-MM-dd') AS update_date",
            "user_id",
            "concat(user_id, '_', sno) AS session_id",
            "k % 10 AS page_id",
            "start + make_dt_interval(0, int(user_id % 24), 0, elapsed) AS action_time",
            "CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword",
            "CASE WHEN event_type = 'click' THEN k END AS click_category_id",
            "CASE WHEN event_type = 'click' THEN 7 * k % 100 END AS click_product_id",
            "CASE WHEN event_type = 'purchase' THEN concat(k, ',', (k + 1) % 100) END"
            " AS order_category_ids",
            "CASE WHEN event_type = 'purchase' THEN string(3 * k % 100) END AS order_product_ids",
            "CASE WHEN event_type = 'signup' THEN string(k) END AS pay_category_ids",
            "CASE WHEN event_type = 'signup' THEN string(5 * k % 100) END AS pay_product_ids",
            "user_id % 25 AS city_id",
        )

    @cached_property
    def users(self) -> DataFrame:
        nation = self.table("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
        customers = self.table("customer").join(nation, "c_nationkey")
        return customers.selectExpr(
            "c_custkey AS user_id",
            "c_name AS username",
            "c_name AS name",
            "int(18 + c_custkey % 50) AS age",
            "c_mktsegment AS professional",
            "n_name AS city",
            "if(c_custkey % 2 = 0, 'female', 'male') AS sex",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            """concat('{"product_status": ', p_size % 2, '}') AS extend_info""",
        )

    @cached_property
    def cities(self) -> DataFrame:
        region = self.table("region").selectExpr("r_regionkey AS n_regionkey", "r_name")
        located = self.table("nation").join(region, "n_regionkey")
        return located.selectExpr(
            "n_nationkey AS city_id", "n_name AS city_name", "r_name AS area"
        )

    @cached_property
    def tasks(self) -> DataFrame:
        """A task per customer, with parameters present, absent and empty in turn."""
        start_age = """if(c_custkey % 3 = 0,
            concat('"startAge":["', 18 + c_custkey % 50, '"],'), '')"""
        end_age = """if(c_custkey % 2 = 0, '"endAge":["60"],', '"endAge":[],')"""
        return self.table("customer").selectExpr(
            "c_custkey AS task_id",
            "c_name AS task_name",
            "string(null) AS create_time",
            "string(null) AS start_time",
            "string(null) AS finish_time",
            "'session' AS task_type",
            "'new' AS task_status",
            f"""concat(
                '{{"startDate":["2024-01-', lpad(string(1 + c_custkey % 28), 2, '0'), '"],',
                '"endDate":["2024-01-30"],', {start_age}, {end_age},
                '"professionals":["', c_mktsegment, ',MACHINERY"],',
                '"cities":["NATION_', c_nationkey, '"],',
                '"sex":["', if(c_custkey % 5 = 0, 'male', ''), '"],',
                '"keywords":["kw1,kw2","kw3"],"categoryIds":["1,', c_custkey, '"],',
                '"targetPageFlow":["1,2,3,4"]}}') AS task_param""",
        )

    def _clicks_every(self, seconds: int) -> DataFrame:
        place = self.cities.selectExpr(
            "bigint(city_id) AS city_id", "area AS province", "city_name AS city"
        )
        located = self._events.selectExpr("*", "user_id % 25 AS city_id").join(place, "city_id")
        return located.selectExpr(
            "event_id",
            "ts",
            "date_format(ts, 'yyyy-MM-dd') AS day",
            "province",
            "city",
            "user_id",
            "k % 2 AS ad_id",
            f"timestampdiff(SECOND, {_EPOCH}, ts) div {seconds}L AS batch",
            "event_type",
        )

    @cached_property
    def clicks(self) -> DataFrame:
        return self._clicks_every(BATCH_SECONDS)

    @cached_property
    def stream_clicks(self) -> DataFrame:
        return self._clicks_every(STREAM_BATCH_SECONDS)

    def click_lines(self, clicks: DataFrame, cut: bool = False) -> DataFrame:
        """Log lines; with ``cut`` those of error events lack their last field, and one
        event in 50 has its time in nanoseconds.

        A blank inside a place name becomes an underscore.
        """
        ad = "if(event_type <> 'error', ad_id, null)" if cut else "ad_id"
        time = f"timestampdiff(MILLISECOND, {_EPOCH}, ts)"
        if cut:
            time = f"{time} * if(event_id % 50 = 7, 1000000L, 1L)"
        return clicks.selectExpr(
            "event_id",
            "batch",
            f"""concat_ws(' ', string({time}),
                replace(province, ' ', '_'), replace(city, ' ', '_'),
                string(user_id), string({ad})) AS value""",
        )
