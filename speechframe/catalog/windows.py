"""Ordinals, running sums and top rows of groups."""

from pyspark.sql import functions as F

from speechframe.catalog.base import Catalog, on_samples, rounded, samples, table
from speechframe.operators import ordinal, stats

CATALOG = Catalog()
add = CATALOG.add

add(
    "ordinal_by_value",
    lambda s, d: ordinal.with_ordinal(table(s, d, "events").select("event_id", "value"), ["value", "event_id"], start=1),
    "SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS ordinal FROM events",
)
add(
    "ordinal_per_user",
    lambda s, d: ordinal.with_ordinal(table(s, d, "events").select("event_id", "user_id"), ["event_id"], by="user_id"),
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ordinal FROM events",
)
add(
    "cumulative_hours",
    lambda s, d: rounded(ordinal.cumulative_hours(samples(s, d))),
    on_samples(
        """SELECT row_number() OVER w - 1 AS sample_index, idx, round(duration, 6) AS duration, round(sum(duration) OVER w / 3600, 6) AS cumulative_hours
        FROM samples WINDOW w AS (ORDER BY duration, idx ROWS UNBOUNDED PRECEDING)"""
    ),
)
add(
    "cumulative_prices",
    lambda s, d: rounded(ordinal.running_sum(table(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "o_totalprice"), 2),
    "SELECT o_orderkey, o_totalprice, round(sum(o_totalprice) OVER (ORDER BY o_totalprice, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM orders",
)
add(
    "running_total_per_day",
    lambda s, d: rounded(ordinal.running_total(table(s, d, "events").withColumn("day", F.dayofyear("ts")), "day", "value"), 4),
    """SELECT day, rows, round(total, 4) AS batch_sum, round(sum(total) OVER (ORDER BY day), 4) AS running_total
    FROM (SELECT CAST(dayofyear(ts) AS INTEGER) AS day, count(*) AS rows, sum(value) AS total FROM events GROUP BY 1)""",
)
add(
    "top_accents_per_source",
    lambda s, d: stats.top_values_per_group(samples(s, d), "dataset", "accent", 3),
    on_samples(
        """SELECT * FROM (SELECT dataset, accent, count(*) AS count,
        CAST(row_number() OVER (PARTITION BY dataset ORDER BY count(*) DESC, accent) AS INTEGER) AS rank
        FROM samples WHERE accent IS NOT NULL GROUP BY 1, 2) WHERE rank <= 3"""
    ),
)
add(
    "largest_orders_per_status",
    lambda s, d: ordinal.top_k_per_group(
        table(s, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice"), "o_orderstatus", [F.desc("o_totalprice"), F.asc("o_orderkey")], 5
    ),
    """SELECT * FROM (SELECT o_orderstatus, o_orderkey, o_totalprice,
    CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders) WHERE rank <= 5""",
)
add(
    "first_row_per_speaker",
    lambda s, d: ordinal.first_per_group(samples(s, d), "speaker_id", "idx", ["idx", "gender", "age", "accent"]),
    on_samples(
        """SELECT speaker_id, idx, gender, age, accent FROM samples WHERE idx IN (SELECT min(idx) FROM samples GROUP BY speaker_id)"""
    ),
)
add(
    "top_n_by_price",
    lambda s, d: ordinal.top_n(table(s, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10),
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
add(
    "sort_sources_by_accents",
    lambda s, d: ordinal.sort_desc(stats.distinct_per_group(samples(s, d), "dataset", "accent"), "distinct_values", "dataset"),
    on_samples("SELECT dataset, count(DISTINCT accent) AS distinct_values FROM samples GROUP BY 1 ORDER BY 2 DESC, 1"),
)
