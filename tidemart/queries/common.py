"""What the query modules share: result types, and the SQL for the derived inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import pin_results
from tidemart.sources import given
from tidemart.sources import messages as message_source
from tidemart.workspace import fresh_folder

# Columns whose value is the time of the run.
RUN_TIMES = ("processing_time", "created_at", "processing_timestamp")

# The first day of the given events: open-ended bounds from here cover whole tables.
FIRST_DAY = "2024-01-01"


@dataclass(frozen=True)
class Query:
    """``build`` makes the result; ``sql`` gives the same rows on the given tables."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return presentable(self.build(pin_results(spark), folder))


_LANDED: dict[tuple, str] = {}


def state(spark: SparkSession, folder: str) -> tuple:
    """The given files that messages are made of, with their sizes and times: other files, other messages."""
    found = []
    for name in ("events", "orders", "lineitem", "part"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        own = files.getFileStatus(path)
        for status in files.listStatus(path) if own.isDirectory() else [own]:
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def landing(spark: SparkSession, folder: str) -> str:
    """The message stream of the given events as files, written once per application and state of them.

    Messages come out of files as they would off a broker: nothing of how they were made can be
    folded into the queries that read them.
    """
    key = (spark.sparkContext.applicationId, state(spark, folder))
    if key not in _LANDED:
        files = fresh_folder(spark, "messages")
        message_source.to_files(given.messages(spark, folder), files)
        _LANDED[key] = files
    return _LANDED[key]


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return message_source.from_files(spark, landing(spark, folder), stream=False)


def presentable(rows: DataFrame) -> DataFrame:
    """Result types both engines have: bigint, double, text, date, timestamp without zone."""

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return rows.select(*[shown(f) for f in rows.schema if f.name not in RUN_TIMES])


def exact_mean(total: str, entries: str) -> str:
    """SQL: money average rounded half up to six digits, in whole numbers."""
    return (
        f"CAST((2 * CAST({total} * 100 AS HUGEINT) * 10000 + {entries}) "
        f"// (2 * {entries}) AS DOUBLE) / 1e6"
    )


def exact_ratio(units: str, views: str) -> str:
    """SQL: units per view rounded half up to eleven digits, in whole numbers."""
    return (
        f"CAST((2 * CAST({units} AS HUGEINT) * 100000000000 + {views}) "
        f"// (2 * {views}) AS DOUBLE) / 1e11"
    )


def exact_decimal_mean(column: str, digits: int) -> str:
    """SQL: average of a column with so many digits, rounded half up to four more."""
    total = f"CAST(sum(CAST({column} AS DECIMAL(30,{digits}))) * 1{'0' * digits} AS HUGEINT)"
    rows = f"count({column})"
    scaled = f"CAST((2 * {total} * 10000 + {rows}) // (2 * {rows}) AS DECIMAL(22,0))"
    unit = f"CAST(0.{'0' * (digits + 3)}1 AS DECIMAL(18,{digits + 4}))"
    # By way of text: a whole number beyond 2^53 is no exact double.
    return f"CAST(CAST({scaled} * {unit} AS VARCHAR) AS DOUBLE)"


PAGE_VIEWS_SQL = """
views AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts, CAST(ts AS DATE) AS d,
         CAST(user_id AS VARCHAR) AS user_id,
         CONCAT('s', CAST(event_id % 977 AS VARCHAR)) AS session_id,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS product_id
  FROM events WHERE event_type = 'view')"""

PURCHASES_SQL = """
purchases AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_id, e.ts, CAST(e.ts AS DATE) AS d,
         CAST(e.user_id AS VARCHAR) AS user_id,
         CAST(e.value AS DECIMAL(10,2)) AS total_amount, o.o_orderpriority AS payment_method
  FROM events e JOIN orders o ON o.o_orderkey = e.event_id WHERE e.event_type = 'purchase')"""

ITEMS_SQL = """
items AS (
  SELECT e.ts, CAST(l.l_partkey AS VARCHAR) AS product_id, CAST(l.l_quantity AS INT) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(l.l_extendedprice AS DECIMAL(10,2)) AS total_price,
         p.p_type AS category, p.p_brand AS brand
  FROM events e JOIN lineitem l ON l.l_orderkey = e.event_id JOIN part p ON p.p_partkey = l.l_partkey
  WHERE e.event_type = 'purchase')"""

# What the message stream holds, from the fault rules alone: no JSON is parsed.
MESSAGES_SQL = """
given AS (
  SELECT event_id AS n, ts, user_id, CAST(user_id AS VARCHAR) AS uid, event_type AS given_type,
         json_extract_string(props, '$.k') AS k, CAST(value AS DECIMAL(12,2)) AS amount,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
              WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'user_session'
              ELSE 'product_update' END AS kind
  FROM events),
msg AS (
  SELECT *, n % 97 = 0 AS broken,
         CASE WHEN n % 7 = 0 THEN NULL WHEN given_type = 'error' THEN k ELSE uid END AS msg_key,
         CASE WHEN n % 97 <> 0 THEN CONCAT('e', CAST(n AS VARCHAR)) END AS payload_id,
         CASE WHEN n % 97 = 0 THEN 'unknown' WHEN n % 53 = 0 THEN 'mystery' ELSE kind END AS event_type,
         CASE WHEN n % 97 <> 0 AND n % 41 <> 0 THEN ts END AS payload_time,
         ts + INTERVAL 2 SECOND AS arrival,
         CASE WHEN n % 97 <> 0 AND n % 31 <> 0 AND given_type <> 'error' THEN uid END AS payload_user,
         CASE WHEN n % 97 <> 0 AND n % 31 <> 0 THEN k END AS payload_product,
         CONCAT('s', CAST(n % 977 AS VARCHAR)) AS session_id,
         CASE kind WHEN 'page_view' THEN 'page-views' WHEN 'add_to_cart' THEN 'order-events'
              WHEN 'purchase' THEN 'purchases' WHEN 'user_session' THEN 'user-sessions'
              ELSE 'product-updates' END AS topic,
         CAST(user_id % 3 AS BIGINT) AS part
  FROM given),
bronze AS (
  SELECT *, COALESCE(msg_key, payload_id, CONCAT('kafka_', CAST(n AS VARCHAR))) AS bronze_id,
         COALESCE(payload_time, arrival) AS bronze_time
  FROM msg),
accepted AS (
  SELECT * FROM bronze
  WHERE (event_type IN ('page_view', 'user_session') AND payload_user IS NOT NULL)
     OR (event_type = 'purchase' AND payload_user IS NOT NULL AND n % 43 <> 0)
     OR (event_type = 'add_to_cart' AND payload_user IS NOT NULL AND CAST(k AS INT) % 5 > 0)
     OR (event_type = 'product_update' AND payload_product IS NOT NULL))"""


def _json(name: str, value: str, when: str | None = None, *, quoted: bool = True) -> str:
    """SQL: one field of a JSON object; NULL, so left out, unless ``when`` holds."""
    mark = '"' if quoted else ""
    text = f"""concat('"{name}":{mark}', {value}, '{mark}')"""
    return f"CASE WHEN {when} THEN {text} END" if when else text


def _one_of(*values: str, number: str = "n") -> str:
    """SQL: one of some texts by number."""
    return f"list_extract({list(values)!r}, CAST({number} % {len(values)} + 1 AS BIGINT))"


_VIEW, _CLICK, _BUY, _SIGN, _UPDATE = (f"given_type = '{t}'" for t in ("view", "click", "purchase", "signup", "error"))
_ITEM_SQL = ", ',', ".join(
    [
        _json("product_id", "IF(i = 1, k, concat(k, '-', i))"),
        _json("quantity", "i", quoted=False),
        _json("unit_price", "amount", quoted=False),
        _json("total_price", "CAST(amount * i AS DECIMAL(12,2))", quoted=False),
        _json("category", _one_of("Books", "Sports", "Clothing", number="(n + i)")),
        _json("brand", "concat('brand-', n % 7)"),
    ]
)
_ADDRESS_SQL = ", ',', ".join(
    [
        _json("street", "concat(n % 100, ' Main St')"),
        _json("city", _one_of("Lund", "Oslo", "Turku")),
        _json("state", "'XX'"),
        _json("zip_code", "lpad(CAST(n % 100000 AS VARCHAR), 5, '0')"),
        _json("country", "'US'"),
    ]
)
_FIELDS_SQL = ",\n    ".join(
    [
        _json("event_id", "concat('e', n)"),
        _json("event_type", "CASE WHEN n % 53 = 0 THEN 'mystery' ELSE kind END"),
        _json("timestamp", "CASE WHEN n % 41 = 0 THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END"),
        _json("user_id", "uid", "given_type <> 'error' AND n % 31 <> 0"),
        _json("session_id", "session_id", "given_type <> 'error'"),
        _json("product_id", "k", "n % 31 <> 0"),
        _json("page_type", _one_of("product_detail", "category", "search_results", "home"), _VIEW),
        _json("referrer", _one_of("google.com", "direct", "email"), f"{_VIEW} AND n % 5 <> 0"),
        _json("quantity", "CAST(k AS INT) % 5", _CLICK, quoted=False),
        _json("price", "amount", _CLICK, quoted=False),
        _json("total_value", "CAST(amount * (CAST(k AS INT) % 5) AS DECIMAL(12,2))", _CLICK, quoted=False),
        _json("cart_id", "concat('c', n % 89)", _CLICK),
        _json("order_id", "concat('o', n)", _BUY),
        _json("total_amount", "CASE WHEN n % 43 = 0 THEN '123456789.12' ELSE CAST(amount AS VARCHAR) END", _BUY, quoted=False),
        _json("subtotal", "CAST(amount + 5 AS DECIMAL(12,2))", _BUY, quoted=False),
        _json("discount_percent", "n % 4 * 5", _BUY, quoted=False),
        _json("discount_amount", "'5.005'", _BUY, quoted=False),
        _json("payment_method", _one_of("credit_card", "debit_card", "paypal", "apple_pay"), _BUY),
        _json("shipping_method", _one_of("standard", "expedited", "overnight"), _BUY),
        _json("shipping_address", f"concat('{{', {_ADDRESS_SQL}, '}}')", f"{_BUY} AND n % 6 <> 0", quoted=False),
        _json(
            "items",
            f"concat('[', array_to_string(list_transform(range(1, n % 4 + 1), lambda i: concat('{{', {_ITEM_SQL}, '}}')), ','), ']')",
            f"{_BUY} AND n % 29 <> 0",
            quoted=False,
        ),
        _json("session_type", _one_of("login", "logout"), _SIGN),
        _json("device_type", _one_of("mobile", "desktop", "tablet"), f"({_VIEW} OR {_SIGN})"),
        _json("ip_address", "concat('10.0.0.', n % 256)", f"({_VIEW} OR {_SIGN})"),
        _json("update_type", _one_of("price_change", "inventory_update", "rating_update"), _UPDATE),
        _json(
            "metadata",
            f"""concat('{{', {_json("k", "k")}, ',"flag":', CASE WHEN n % 3 = 0 THEN 'true' ELSE 'false' END, ',"depth":', n % 100, '}}')""",
            quoted=False,
        ),
    ]
)
# The text of a message, field by field.
BODY_SQL = f"CASE WHEN broken THEN '{{oops' ELSE concat('{{', concat_ws(',', {_FIELDS_SQL}), '}}') END"
