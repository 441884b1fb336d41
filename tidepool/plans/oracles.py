"""The jobs of the registry as SQL over the same tables, for checking their results."""

from __future__ import annotations

import re

from tidepool.functions.dates import shift_day
from tidepool.plans.views import ACTIVE_CAP, AS_OF, DENIED, FIRST_DAY, LAST_DAY

DAY = shift_day(AS_OF, -1)


def back(days: int) -> str:
    """A day before the run day, as an SQL text."""
    return f"'{shift_day(AS_OF, -days)}'"


_DENIED = ", ".join(f"'{d}'" for d in DENIED)
_CATALOGS = "merchandise_catalog_id BETWEEN 1 AND 10"


def _january(column: str) -> str:
    days = f"date_diff('day', DATE '1995-01-01', CAST({column} AS DATE))"
    return f"strftime(DATE '{FIRST_DAY}' + CAST(((({days}) % 30) + 30) % 30 AS INTEGER), '%Y-%m-%d')"


def _features(source: str, days: str) -> str:
    """Features from numbered behaviours ``source`` for the label days ``days``."""
    return f"""
    SELECT ad_id, 0 AS part,
           string_agg(CAST(item_no AS VARCHAR), ',' ORDER BY ts, item_id, behavior_type) AS item_seq,
           string_agg(CAST(behavior_type AS VARCHAR), ',' ORDER BY ts, item_id, behavior_type)
               AS behavior_seq,
           string_agg(CAST(item_no AS VARCHAR), ',' ORDER BY ts, item_id, behavior_type)
               FILTER (WHERE behavior_type = 2) AS item_car,
           string_agg(CAST(item_no AS VARCHAR), ',' ORDER BY ts, item_id, behavior_type)
               FILTER (WHERE behavior_type = 3) AS item_purchase,
           CAST(NULL AS VARCHAR) AS item_category, count(*) AS n_items,
           d.label_dt AS dt
    FROM {source} b JOIN ({days}) d
      ON b.dt BETWEEN strftime(CAST(d.label_dt AS DATE) - 2, '%Y-%m-%d') AND d.label_dt
    GROUP BY ad_id, d.label_dt"""


def _days(first: str, last: str) -> str:
    return (f"SELECT strftime(CAST(unnest(generate_series(DATE '{first}', DATE '{last}', "
            f"INTERVAL 1 DAY)) AS DATE), '%Y-%m-%d') AS label_dt")


def _draw(upper: int, *parts: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT) % {upper})"


PARTS: dict[str, str] = {
    "logged": """
    SELECT *, epoch_us(ts) AS micros, strftime(ts, '%Y-%m-%d') AS dt,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           (CAST(json_extract_string(props, '$.k') AS BIGINT) + 7) % 100 AS k2
    FROM events""",
    "item_events": f"""
    SELECT CAST(user_id AS VARCHAR) AS ad_id,
           regexp_replace(replace(item, ' ', ''), '^([0-9]+):([0-9a-zA-Z\\-_]+):([0-9]+)$', '\\2:\\3')
               AS item_id,
           CASE event_type WHEN 'view' THEN 'ViewContent' WHEN 'click' THEN 'AddToCart'
                           ELSE 'revenue' END AS behavior_name,
           micros AS ts, dt
    FROM (SELECT *, unnest(string_split(CASE WHEN event_id % 2 = 0
                THEN '9:c' || (k % 10) || ':' || k || ', 9:c' || (k2 % 10) || ':' || k2
                ELSE '9:c' || (k % 10) || ':' || k END, ',')) AS item
          FROM logged
          WHERE event_type IN ('view', 'click', 'purchase')
            AND CAST(user_id AS VARCHAR) NOT IN ({_DENIED}))""",
    "behaviours": """
    SELECT ad_id, item_id,
           CASE behavior_name WHEN 'ViewContent' THEN 1 WHEN 'AddToCart' THEN 2
                              WHEN 'revenue' THEN 3 END AS behavior_type, ts, dt
    FROM item_events WHERE item_id NOT IN ('', ' ')""",
    "active": f"""
    SELECT item_id, item_num, row_number() OVER (ORDER BY item_num DESC, item_id) AS item_no,
           {back(1)} AS dt
    FROM (SELECT item_id, count(item_id) AS item_num FROM behaviours
          WHERE dt BETWEEN {back(10)} AND {back(1)}
          GROUP BY item_id ORDER BY item_num DESC, item_id LIMIT {ACTIVE_CAP})""",
    "numbered": """
    SELECT b.*, a.item_no FROM behaviours b JOIN active a ON b.item_id = a.item_id""",
    "features": _features("numbered", f"SELECT {back(1)} AS label_dt"),
    "earlier_features": _features("numbered", f"SELECT {back(2)} AS label_dt"),
    "week_features": _features("numbered", _days(shift_day(AS_OF, -7), shift_day(AS_OF, -1))),
    "month_features": _features("numbered", _days(FIRST_DAY, LAST_DAY)),
    "sample": f"""
    SELECT f.ad_id, f.item_seq, f.behavior_seq, f.item_car, f.item_purchase,
           f.item_category, n.item_no AS item_target, n.behavior_type AS label, n.dt
    FROM numbered n JOIN earlier_features f ON n.ad_id = f.ad_id
     AND n.dt = strftime(CAST(f.dt AS DATE) + 1, '%Y-%m-%d')
    WHERE n.dt = '{DAY}' AND len(string_split(f.item_seq, ',')) >= 5""",
    "documents_json": f"""
    SELECT ad_id, 0 AS part,
           to_json({{content_ids_list: list(item_id ORDER BY ts DESC, item_id DESC, behavior_name DESC),
                    behavior_types_list:
                        list(behavior_name ORDER BY ts DESC, item_id DESC, behavior_name DESC),
                    has_view: max(CASE WHEN behavior_name = 'ViewContent' THEN 1 ELSE 0 END),
                    has_add_to_car: max(CASE WHEN behavior_name = 'AddToCart' THEN 1 ELSE 0 END)
                   }})::VARCHAR AS user_behavior_f,
           {back(1)} AS dt
    FROM item_events
    WHERE dt BETWEEN {back(7)} AND {back(2)} AND item_id IS NOT NULL AND item_id <> ''
    GROUP BY ad_id""",
    "impressions": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ots, CAST(o_custkey AS VARCHAR) AS ad_id,
           o_orderkey % 200 AS creative_id, 'u' || o_custkey AS uuid,
           CAST(round(o_totalprice * 1e6) AS BIGINT) AS sales_e6,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS postback,
           CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END AS click,
           {_january('o_orderdate')} AS dt
    FROM orders""",
    "extension": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ots,
           CASE WHEN o_orderkey % 17 <> 0 THEN least(o_totalprice, 1e5) END AS sw,
           {_january('o_orderdate')} AS dt
    FROM orders""",
    "shown": f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS ots, l_orderkey % 200 AS creative_id,
           'c' || (l_partkey % 100 % 10) || ':' || (l_partkey % 100) AS mc_item_id,
           {_january('l_shipdate')} AS dt
    FROM lineitem""",
    "creatives": """
    SELECT p_partkey AS creative_id, CASE WHEN p_size <= 40 THEN p_size END AS merchandise_catalog_id
    FROM part""",
    "catalogue_impressions": f"""
    SELECT s.mc_item_id, c.merchandise_catalog_id AS core_label, i.*
    FROM impressions i JOIN shown s ON i.ots = s.ots
    JOIN creatives c ON s.creative_id = c.creative_id
    WHERE i.dt = {back(1)} AND s.dt >= {back(4)} AND {_CATALOGS}""",
    "material": f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS ots, 'cmp' || (o_orderkey % 50) AS campaign_id,
           o_totalprice, o_orderpriority, o_custkey,
           CASE WHEN o_orderstatus <> 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS click,
           CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS postback,
           {_january('o_orderdate')} AS dt
    FROM orders""",
    "pairs": """
    SELECT o_custkey AS u, l_partkey AS i, sum(l_quantity) * 100 + 1 AS x
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "idf": """
    SELECT u, ln((SELECT count(DISTINCT i) FROM pairs)) - ln(1 + count(*)) AS idf
    FROM pairs GROUP BY u""",
    "tfidf_raw": "SELECT u, i, sqrt(x) * idf AS r FROM pairs JOIN idf USING (u)",
    "cosine_raw": "SELECT u, i, x AS r FROM pairs",
    "bm25_raw": """
    SELECT u, i, x * 101.0 / (100.0 * (0.8 + 0.2 * len_i / (SELECT avg(len_i) FROM lengths)) + x) * idf
               AS w
    FROM pairs JOIN idf USING (u) JOIN lengths USING (i)""",
    "lengths": "SELECT i, sum(x) AS len_i FROM pairs GROUP BY i",
    "typed": """
    SELECT event_id, label, u.name, u.kind, u.text_value, u.number_value, u.text_values,
           u.counted, u.weight_map
    FROM (
      SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
        unnest([
          {name: 'label', kind: 'dense', text_value: NULL::VARCHAR,
           number_value: CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
           text_values: NULL::VARCHAR[], counted: NULL::VARCHAR[], weight_map: NULL::MAP(VARCHAR, DOUBLE)},
          {name: 'ctr_label', kind: 'labels', text_value: NULL,
           number_value: CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'cvr_label', kind: 'labels', text_value: NULL,
           number_value: CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'value', kind: 'dense', text_value: NULL, number_value: value,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'value_text', kind: 'dense', text_value: NULL, number_value: value,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'kind', kind: 'sparse', text_value: event_type, number_value: NULL,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'hour', kind: 'sparse', text_value: CAST(hour(ts) AS VARCHAR), number_value: NULL,
           text_values: NULL, counted: NULL, weight_map: NULL},
          {name: 'items', kind: 'embedding', text_value: NULL, number_value: NULL,
           text_values: ['c' || (k % 10) || ':' || k, 'c' || (k2 % 10) || ':' || k2],
           counted: ['c' || (k % 10) || ':' || k, 'c' || (k2 % 10) || ':' || k2], weight_map: NULL},
          {name: 'ids', kind: 'embedding', text_value: NULL, number_value: NULL,
           text_values: [CAST(k AS VARCHAR), CAST(k2 AS VARCHAR)],
           counted: [CAST(k AS VARCHAR), CAST(k2 AS VARCHAR)], weight_map: NULL},
          {name: 'parts', kind: 'embedding', text_value: NULL, number_value: NULL,
           text_values: NULL, counted: ['0.5', '1.5'], weight_map: NULL},
          {name: 'weights', kind: 'weighted_embedding', text_value: NULL, number_value: NULL,
           text_values: NULL, counted: NULL,
           weight_map: MAP {'c' || (k % 10): value, 'all': 1.0::DOUBLE}}
        ]) AS u
      FROM logged)""",
    "dense_long": "SELECT name, label, number_value AS x FROM typed WHERE kind = 'dense'",
    "weight_long": """
    SELECT name, label, e.key AS key, e.value AS x
    FROM (SELECT name, label, unnest(map_entries(weight_map)) AS e FROM typed
          WHERE kind = 'weighted_embedding')""",
    "value_long": """
    SELECT name, kind, unnest(CASE WHEN kind = 'sparse' THEN [text_value] ELSE counted END) AS value
    FROM typed WHERE kind IN ('sparse', 'embedding')""",
    "positives": "SELECT DISTINCT ad_id, item_no FROM numbered",
    "unowned": f"""
    SELECT ad_id, list_filter(range(1, {ACTIVE_CAP + 1}), lambda x: NOT list_contains(own, x)) AS free
    FROM (SELECT ad_id, list(item_no) AS own FROM positives GROUP BY ad_id)""",
    "labelled": """
    SELECT ad_id, concat_ws(':', ad_id, CAST(ts AS VARCHAR), CAST(item_no AS VARCHAR),
                                CAST(behavior_type AS VARCHAR)) AS row_id,
           item_no, dt FROM numbered""",
    "month": """
    SELECT l.row_id, l.ad_id, l.item_no, f.item_seq, f.item_car, f.item_purchase
    FROM labelled l JOIN month_features f ON l.ad_id = f.ad_id
     AND l.dt = strftime(CAST(f.dt AS DATE) + 1, '%Y-%m-%d')
    WHERE len(string_split(f.item_seq, ',')) >= 5""",
    "coordinates": """
    SELECT vec_id, unnest(generate_series(1, 64)) AS d, CAST(unnest(embedding) AS DOUBLE) AS x
    FROM embeddings""",
    "listed": """
    SELECT row_id, 0 AS list, unnest(string_split(item_seq, ',')) AS item FROM month
    UNION ALL
    SELECT row_id, 1, unnest(string_split(item_car, ',')) FROM month WHERE item_car IS NOT NULL
    UNION ALL
    SELECT row_id, 2, unnest(string_split(item_purchase, ',')) FROM month
    WHERE item_purchase IS NOT NULL""",
    "pooled": """
    SELECT row_id, d, sum(mean) AS x
    FROM (SELECT row_id, list, d, avg(x) AS mean
          FROM listed JOIN coordinates ON CAST(item AS BIGINT) = vec_id GROUP BY 1, 2, 3)
    GROUP BY row_id, d""",
    "user_vector": "SELECT row_id, list(x ORDER BY d) AS v FROM pooled GROUP BY row_id",
    "item_vector": "SELECT vec_id AS item, CAST(embedding AS DOUBLE[]) AS v FROM embeddings",
    "month_pairs": """
    SELECT row_id, item_no AS item, 1 AS label FROM month
    UNION ALL
    SELECT row_id, negative, 0 FROM month_negatives""",
    "scored": """
    SELECT p.row_id, p.item, p.label, list_dot_product(u.v, i.v) AS logit,
           1.0 / (1.0 + exp(-list_dot_product(u.v, i.v))) AS score
    FROM month_pairs p JOIN user_vector u ON p.row_id = u.row_id
    JOIN item_vector i ON p.item = i.item""",
}


def _negatives(rows: str, per_row: int, attempts: int = 8) -> str:
    draw = _draw(ACTIVE_CAP, "ad_id", "row_id", "draw", "attempt", "0")
    return f"""
    SELECT ad_id, row_id, item_no, draw, negative
    FROM (SELECT c.ad_id, c.row_id, c.item_no, c.draw,
                 coalesce(min_by(c.item, c.attempt) FILTER (
                              WHERE c.attempt < {attempts} AND NOT list_contains(o.own, c.item)),
                          any_value(r.free[CAST(c.item % greatest(len(r.free), 1) AS INTEGER) + 1])
                              FILTER (WHERE c.attempt = {attempts})) AS negative
          FROM (SELECT t.*, {draw} + 1 AS item
                FROM (SELECT ad_id, row_id, item_no, g.draw, a.attempt
                      FROM {rows}, range({per_row}) g(draw), range({attempts + 1}) a(attempt)) t) c
          JOIN (SELECT ad_id, list(item_no) AS own FROM positives GROUP BY ad_id) o
            ON c.ad_id = o.ad_id
          JOIN unowned r ON c.ad_id = r.ad_id
          GROUP BY ALL)
    WHERE negative IS NOT NULL"""


PARTS["month_negatives"] = _negatives("month", 1)


def _needed(text: str, found: list[str]) -> list[str]:
    for name in PARTS:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+\(?{name}\b", text):
            _needed(PARTS[name], found)
            found.append(name)
    return found


def _with(select: str) -> str:
    names = _needed(select, [])
    if not names:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in names) + "\n" + select


def _knn(raw: str, scaled: bool) -> str:
    weights = f"""
    SELECT u, i, r / n AS w FROM {raw}
    JOIN (SELECT i, sqrt(sum(r * r)) AS n FROM {raw} GROUP BY i) USING (i)""" if scaled else (
        f"SELECT u, i, w FROM {raw}")
    body = _with(f"SELECT * FROM ({weights})")
    return f"""
    WITH weighted AS ({body}),
    met AS (SELECT a.i AS item, b.i AS neighbour, round(sum(a.w * b.w), 9) AS score
            FROM weighted a JOIN weighted b ON a.u = b.u AND a.i <> b.i GROUP BY 1, 2)
    SELECT item, rank, neighbour, round(score, 6) AS score
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, neighbour)
                         AS INTEGER) AS rank FROM met)
    WHERE rank <= 10"""


def _event_totals(first: int, users: str, names: list[str]) -> str:
    return _with(f"""
    SELECT count(*) AS {names[0]}, count(DISTINCT ad_id) AS {names[1]},
           count(DISTINCT item_id) AS {names[2]},
           CAST(sum(CASE WHEN behavior_name = 'ViewContent' THEN 1 ELSE 0 END) AS BIGINT) AS {names[3]},
           CAST(sum(CASE WHEN behavior_name = 'AddToCart' THEN 1 ELSE 0 END) AS BIGINT) AS {names[4]},
           CAST(sum(CASE WHEN behavior_name = 'revenue' THEN 1 ELSE 0 END) AS BIGINT) AS {names[5]}
    FROM item_events
    WHERE dt BETWEEN {back(first)} AND {back(1)} AND ad_id IN ({users})""")


def _rates(n: str = "count(*)") -> str:
    return f"""
           round(sum(click) / {n}, 5) AS vctr,
           round(sum(postback) / nullif(sum(click), 0), 5) AS cvr,
           round(sum(postback) / {n}, 5) AS vctcvr,
           round(sum(sales_e6) / 1e6 * 1000 / {n}) AS vrpm,
           round(sum(sales_e6 / 1e6) / nullif(sum(postback), 0)) AS cpa"""


def _stats(source: str, keys: str) -> str:
    return _with(f"""
    SELECT {keys}, count(*) AS count, round(sum(label), 4) AS positive, round(min(x), 4) AS min,
           round(max(x), 4) AS max, round(avg(x), 4) AS mean, round(avg(x * x), 4) AS square_mean,
           round(var_pop(x), 4) AS variance
    FROM {source} GROUP BY {keys}""")


_EVENT_NAMES = ["total_events", "users_count", "items_count", "view_count", "add_to_car_count",
                "revenue_count"]
_CATALOG_NAMES = ["total_events", "unique_users_count", "unique_items_count", "total_view_count",
                  "total_add_to_car_count", "total_revenue_count"]


def _split(member: str, suffix: str) -> str:
    def summed(x: str, name: str, kind: str = "BIGINT") -> str:
        total = f"sum(CASE WHEN {member} THEN {x} ELSE 0 END)"
        total = f"round({total}, 6)" if kind == "DOUBLE" else f"CAST({total} AS BIGINT)"
        return f"{total} AS {name}{suffix}"

    return ", ".join([
        f"count(DISTINCT CASE WHEN {member} THEN ad_id END) AS active{suffix}_user_count",
        summed("sales_e6 / 1e6", "sales", "DOUBLE"), summed("1", "vimp"),
        summed("postback", "pb"), summed("click", "click"), summed("sw", "sw", "DOUBLE"),
    ])


ORACLES: dict[str, str] = {
    "scan_dt_range": _with(f"SELECT * FROM behaviours WHERE dt BETWEEN {back(3)} AND {back(1)}"),
    "scan_dimension": _with(f"SELECT * FROM creatives WHERE {_CATALOGS}"),
    "delimited_roundtrip": _with("SELECT * FROM features"),
    "partition_replace": _with(f"""
    SELECT dt, count(*) AS n,
           CAST(sum(CASE WHEN dt BETWEEN {back(7)} AND {back(2)} THEN click ELSE 0 END) AS BIGINT)
               AS clicks
    FROM impressions WHERE dt <> {back(1)} GROUP BY dt"""),
    "ctas_partitioned": _with("SELECT * FROM catalogue_impressions"),
    "export_by_day": _with(f"""
    SELECT * FROM impressions WHERE dt BETWEEN {back(9)} AND {back(1)}"""),
    "shards": _with("SELECT count(*) AS n, 1 AS in_shards, 6 AS shards FROM shown"),
    "missing_table": _with("""
    SELECT DISTINCT item_id, CAST(NULL AS BIGINT) AS item_no, CAST(NULL AS VARCHAR) AS dt
    FROM behaviours"""),
    "parameterised_sql": _with(f"""
    SELECT dt, count(*) AS n, CAST(sum(click) * 100 AS BIGINT) AS clicks FROM impressions
    WHERE dt BETWEEN {back(10)} AND {back(1)} GROUP BY dt"""),
    "behaviour_extract": _with("SELECT * FROM behaviours"),
    "behaviour_extract_json": _with("SELECT * FROM behaviours"),
    "category_counts": _with(f"""
    SELECT string_split(item_id, ':')[1] AS category, count(*) AS counts, '{DAY}' AS dt
    FROM item_events WHERE dt = '{DAY}' GROUP BY 1"""),
    "active_items": _with("SELECT * FROM active"),
    "stable_item_index": _with(f"""
    SELECT item_id, row_number() OVER (ORDER BY old_no NULLS LAST, item_id) AS item_no,
           {back(1)} AS dt
    FROM (SELECT coalesce(p.item_id, t.item_id) AS item_id, p.old_no
          FROM (SELECT item_id, row_number() OVER (ORDER BY item_id) AS old_no
                FROM (SELECT DISTINCT item_id FROM behaviours WHERE dt = {back(10)})) p
          FULL JOIN (SELECT DISTINCT item_id FROM behaviours
                     WHERE dt BETWEEN {back(9)} AND {back(1)}) t ON p.item_id = t.item_id)"""),
    "dense_index": """
    SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS item_index
    FROM (SELECT DISTINCT l_partkey FROM lineitem)""",
    "user_features": _with("SELECT * FROM features"),
    "backfill_user_features": _with("SELECT * FROM week_features"),
    "user_sessions": _with(f"""
    SELECT ad_id, 0 AS part,
           string_agg(CAST(item_no AS VARCHAR), ','
                      ORDER BY ts DESC, item_id DESC, behavior_type DESC) AS item_nos,
           string_agg(CAST(behavior_type AS VARCHAR), ','
                      ORDER BY ts DESC, item_id DESC, behavior_type DESC) AS behavior_types,
           count(*) AS n_items, dt
    FROM numbered WHERE dt = '{DAY}' GROUP BY ad_id, dt"""),
    "user_behaviour_arrays": _with(f"""
    SELECT ad_id, 0 AS part,
           string_agg(item_id, ',' ORDER BY ts DESC, item_id DESC, behavior_name DESC) AS content_ids,
           string_agg(behavior_name, ',' ORDER BY ts DESC, item_id DESC, behavior_name DESC)
               AS behavior_types,
           max(CASE WHEN behavior_name = 'ViewContent' THEN 1 ELSE 0 END) AS has_view,
           max(CASE WHEN behavior_name = 'AddToCart' THEN 1 ELSE 0 END) AS has_add_to_car,
           {back(1)} AS dt
    FROM item_events
    WHERE dt BETWEEN {back(7)} AND {back(2)} AND item_id IS NOT NULL AND item_id <> ''
    GROUP BY ad_id"""),
    "session_corpus": _with(f"""
    SELECT ad_id, 0 AS part, string_agg(item_id, ' ' ORDER BY ts, item_id) AS events,
           '{AS_OF}-10day' AS dt
    FROM item_events WHERE dt BETWEEN {back(9)} AND {back(0)} GROUP BY ad_id"""),
    "user_category_sequences": _with(f"""
    SELECT ad_id, 0 AS part, string_agg(item_id, ',' ORDER BY ts, item_id) AS item_seq,
           string_agg(string_split(item_id, ':')[1], ',' ORDER BY ts, item_id) AS category_seq, dt
    FROM item_events WHERE dt = '{DAY}' GROUP BY ad_id, dt"""),
    "user_positives": _with("""
    SELECT ad_id, string_agg(CAST(item_no AS VARCHAR), ',' ORDER BY item_no) AS item
    FROM positives GROUP BY ad_id"""),
    "min_length_filter": _with("""
    SELECT ad_id, CASE WHEN len(string_split(item_seq, ',')) >= 5 THEN 1 ELSE 0 END AS five,
           CASE WHEN len(list_distinct(string_split(item_seq, ','))) >= 6 THEN 1 ELSE 0 END
               AS six_different
    FROM features"""),
    "train_sample": _with("SELECT *, 0 AS part FROM sample"),
    "train_sample_conversions": _with(f"""
    SELECT n.ad_id, s.item_nos, s.behavior_types, n.item_no AS item_target,
           n.behavior_type AS label, n.dt, 0 AS part
    FROM numbered n JOIN (
        SELECT ad_id, count(*) AS n_items,
               string_agg(CAST(item_no AS VARCHAR), ','
                          ORDER BY ts DESC, item_id DESC, behavior_type DESC) AS item_nos,
               string_agg(CAST(behavior_type AS VARCHAR), ','
                          ORDER BY ts DESC, item_id DESC, behavior_type DESC) AS behavior_types
        FROM numbered WHERE dt = {back(2)} GROUP BY ad_id) s ON n.ad_id = s.ad_id
    WHERE n.dt = '{DAY}' AND n_items >= 5 AND n.behavior_type IN (2, 3)"""),
    "train_examples": _with("""
    SELECT ad_id, {0} AS item_seq, {1} AS behavior_seq, {2} AS item_car, {3} AS item_purchase,
           '' AS item_category, item_target, CAST(label AS BIGINT) AS label
    FROM sample WHERE len(list_distinct(string_split(item_seq, ','))) > 5""".format(*[
        "coalesce(array_to_string(list_sort(list_distinct(list_transform("
        f"string_split({c}, ','), lambda s: CAST(s AS BIGINT)))), ','), '')"
        for c in ("item_seq", "behavior_seq", "item_car", "item_purchase")
    ])),
    "negative_downsample": _with(f"""
    SELECT ots, click FROM material
    WHERE click > 0 OR {_draw(1_000_000, 'ots', '7')} < 200000"""),
    "negative_sampling": _with(_negatives("labelled", 10)),
    "left_join_condition": _with("""
    SELECT i.ots, i.ad_id, i.click,
           CAST(json_extract_string(d.user_behavior_f, '$.has_view') AS INTEGER) AS has_view
    FROM impressions i LEFT JOIN documents_json d ON i.ad_id = d.ad_id AND i.click > 0"""),
    "latest_per_key": """
    SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id, epoch_us(max(ts)) AS ts
    FROM events GROUP BY user_id""",
    "user_behaviour_json": _with("SELECT * FROM documents_json"),
    "impression_items": _with("SELECT * FROM catalogue_impressions"),
    "ctr_sample": _with(f"""
    SELECT s.ots, s.ad_id AS ad_id_plus, m.campaign_id, s.mc_item_id AS item_id,
           CAST(s.core_label AS VARCHAR) AS core_label, d.user_behavior_f AS itemf,
           CASE WHEN m.ots IS NOT NULL THEN to_json({{price: m.o_totalprice, source: 'cf'}})::VARCHAR END
               AS cf,
           CASE WHEN m.ots IS NOT NULL THEN to_json({{priority: m.o_orderpriority}})::VARCHAR END AS cxf,
           CASE WHEN m.ots IS NOT NULL THEN to_json({{customer: m.o_custkey, source: 'uf'}})::VARCHAR END
               AS uf,
           m.click AS ctr_label, m.postback AS cvr_label, '{DAY}' AS dt, 0 AS part
    FROM catalogue_impressions s
    LEFT JOIN material m ON s.ots = m.ots AND m.dt = '{DAY}'
    LEFT JOIN documents_json d ON s.ad_id = d.ad_id
    WHERE m.click > 0 OR {_draw(1_000_000, 's.ots', 's.mc_item_id', '7')} < 200000"""),
    "ctr_feature_merge": _with(f"""
    SELECT s.ots, s.ad_id AS ad_id_plus, m.campaign_id, s.mc_item_id AS item_id,
           CAST(s.core_label AS VARCHAR) AS core_label, m.click AS ctr_label,
           m.postback AS cvr_label, m.dt, 0 AS part, 'cf' AS source, m.o_orderpriority AS priority,
           m.o_custkey AS customer, m.o_totalprice AS price,
           CAST(json_extract_string(d.user_behavior_f, '$.has_view') AS INTEGER) AS has_view,
           CAST(json_array_length(d.user_behavior_f, '$.content_ids_list') AS INTEGER) AS n_items
    FROM catalogue_impressions s JOIN material m ON s.ots = m.ots AND m.dt = '{DAY}'
    JOIN documents_json d ON s.ad_id = d.ad_id"""),
    "ctr_feature_merge_limited": _with(f"""
    SELECT s.ots, s.ad_id AS ad_id_plus, s.mc_item_id AS item_id,
           CAST(s.core_label AS VARCHAR) AS core_label, m.click AS ctr_label, m.postback AS cvr_label,
           '{DAY}' AS dt
    FROM catalogue_impressions s JOIN material m ON s.ots = m.ots AND m.dt = '{DAY}'
    
    JOIN documents_json d ON s.ad_id = d.ad_id
    ORDER BY s.ots, item_id, ad_id_plus, core_label LIMIT 10"""),
    "typed_features": _with("""
    SELECT event_id, name, kind, label, text_value, round(number_value, 6) AS number_value,
           array_to_string(text_values, ',') AS text_values, CAST(len(counted) AS INTEGER) AS n_values,
           array_to_string(list_sort(map_keys(weight_map)), ',') AS weight_keys,
           round(list_sum(map_values(weight_map)), 6) AS weight_sum
    FROM typed"""),
    "feature_stats_dense": _stats("dense_long", "name"),
    "feature_stats_weighted": _stats("weight_long", "name, key"),
    "feature_stats_categorical": _with("""
    SELECT name, kind, value, count(*) AS n, t.count, t.positive
    FROM value_long JOIN (SELECT name, kind, count(*) AS count, sum(label) AS positive FROM typed
                          GROUP BY ALL) t USING (name, kind)
    GROUP BY ALL"""),
    "feature_stats_report": _with(f"""
    SELECT '{AS_OF}' AS dt, name, 'dense' AS kind, CAST(NULL AS VARCHAR) AS key,
           CAST(NULL AS BIGINT) AS rank, count(*) AS n
    FROM dense_long GROUP BY name
    UNION ALL SELECT '{AS_OF}', name, kind, NULL, NULL, count(*) FROM typed
    WHERE kind IN ('sparse', 'embedding') GROUP BY name, kind
    UNION ALL SELECT '{AS_OF}', name, kind, value,
                     row_number() OVER (PARTITION BY name, kind ORDER BY count(*) DESC, value), count(*)
    FROM value_long GROUP BY name, kind, value
    UNION ALL SELECT '{AS_OF}', name, 'weighted_embedding', key,
                     row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, key), count(*)
    FROM weight_long GROUP BY name, key"""),
    "scalar_functions": f"""
    SELECT o_orderkey, 's:' || o_custkey AS item_id, string_split(o_orderpriority, ':')[1] AS category,
           o_custkey AS as_number, TRY_CAST(o_orderstatus AS BIGINT) AS not_a_number,
           CASE WHEN o_orderkey % 17 <> 0 THEN least(o_totalprice, 1e5) END AS capped,
           round(o_totalprice / nullif(o_orderkey % 5, 0), 5) AS ratio,
           array_to_string(list_sort(list_distinct([o_custkey, 3])), ',') AS ids,
           o_orderpriority AS prefixed, 2 AS merged,
           round(1.0 / (1.0 + exp(-o_totalprice / 1e5)), 6) AS sigmoid,
           round(tanh(o_totalprice / 1e6), 6) AS tanh,
           {_draw(1000, 'o_orderkey', '7')} AS draw,
           CAST(round(o_totalprice) AS BIGINT) AS whole, o_totalprice AS cents
    FROM orders""",
    "report_event_totals": _event_totals(
        1, f"SELECT ad_id FROM impressions WHERE dt BETWEEN {back(29)} AND {back(0)}", _EVENT_NAMES),
    "report_event_totals_catalog": _event_totals(
        7, f"""SELECT i.ad_id FROM impressions i JOIN creatives c ON i.creative_id = c.creative_id
               WHERE i.dt BETWEEN {back(29)} AND {back(0)} AND {_CATALOGS}""", _CATALOG_NAMES),
    "report_user_overlap": _with(f"""
    SELECT count(DISTINCT ad_id) AS users_count FROM impressions
    WHERE dt BETWEEN {back(29)} AND {back(0)}
      AND ad_id IN (SELECT ad_id FROM item_events WHERE dt = {back(1)})"""),
    "report_item_response": _with(f"""
    SELECT r.dt, count(DISTINCT mc_item_id) AS unique_active_item_count,
           count(DISTINCT b.item_id) AS unique_behavior_item_count,
           CAST(sum(CASE WHEN behavior_name = 'ViewContent' THEN 1 ELSE 0 END) AS BIGINT)
               AS active_ui_view_count,
           CAST(sum(CASE WHEN behavior_name = 'AddToCart' THEN 1 ELSE 0 END) AS BIGINT)
               AS active_ui_add_to_car_count,
           CAST(sum(CASE WHEN behavior_name = 'revenue' THEN 1 ELSE 0 END) AS BIGINT)
               AS active_ui_revenue_count,
           round(sum(sales_e6 / 1e6), 6) AS sales, count(r.ots) AS vimp,
           CAST(sum(postback) AS BIGINT) AS pb, CAST(sum(click) AS BIGINT) AS click, {_rates()}
    FROM impressions r JOIN shown s ON r.ots = s.ots
    JOIN extension x ON r.ots = x.ots
    JOIN creatives c ON r.creative_id = c.creative_id
    LEFT JOIN (SELECT DISTINCT ad_id, item_id, dt, behavior_name FROM item_events
               WHERE dt BETWEEN {back(7)} AND {back(1)}) b
      ON r.ad_id = b.ad_id AND b.item_id = s.mc_item_id AND r.dt = b.dt
    WHERE r.dt BETWEEN {back(7)} AND {back(1)} AND s.dt BETWEEN {back(7)} AND {back(1)}
      AND x.dt BETWEEN {back(7)} AND {back(1)} AND r.ad_id NOT IN ({_DENIED}) AND {_CATALOGS}
    GROUP BY r.dt"""),
    "report_performance": _with(f"""
    SELECT v.dt, count(DISTINCT uuid) AS uu, round(sum(sales_e6 / 1e6), 6) AS sales,
           count(v.ots) AS vimp, CAST(sum(postback) AS BIGINT) AS pb,
           CAST(sum(click) AS BIGINT) AS click, {_rates()}, round(sum(sw), 6) AS sw
    FROM impressions v JOIN extension x ON v.ots = x.ots
    JOIN creatives c ON c.creative_id = v.creative_id
    WHERE v.dt = {back(1)} AND {_CATALOGS} GROUP BY v.dt"""),
    "report_cold_start": _with(f"""
    SELECT {back(4)} AS dt,
           CASE WHEN a.ad_id IS NOT NULL THEN 'ad_cold_start'
                WHEN b.ad_id IS NOT NULL THEN 'behavior_cold_start'
                ELSE 'without_cold_start' END AS label,
           count(DISTINCT i.ad_id) AS cold_start_user_count, round(sum(sales_e6 / 1e6), 6) AS sales,
           round(sum(sw), 6) AS sw, count(*) AS vimp, CAST(sum(click) AS BIGINT) AS click,
           CAST(sum(postback) AS BIGINT) AS pb, count(DISTINCT a.ad_id) AS ad_cold_start_user_count,
           count(DISTINCT b.ad_id) AS behavior_cold_start_user_count
    FROM impressions i JOIN extension x ON i.ots = x.ots
    JOIN creatives c ON i.creative_id = c.creative_id
    LEFT JOIN (SELECT ad_id FROM impressions WHERE dt BETWEEN {back(9)} AND {back(4)}
               GROUP BY ad_id HAVING count(*) < 3) a ON i.ad_id = a.ad_id
    LEFT JOIN (SELECT ad_id FROM item_events WHERE dt BETWEEN {back(9)} AND {back(4)}
               GROUP BY ad_id HAVING count(behavior_name) < 10) b ON i.ad_id = b.ad_id
    WHERE i.dt BETWEEN {back(3)} AND {back(1)} AND x.dt BETWEEN {back(9)} AND {back(1)}
      AND {_CATALOGS}
    GROUP BY 2"""),
    "report_reach_split": _with(f"""
    SELECT i.dt, {_split('true', '')}, {_split('merchandise_catalog_id IS NOT NULL', '_catalogue')},
           {_split(_CATALOGS, '_selected')}
    FROM impressions i JOIN extension x ON i.ots = x.ots
    LEFT JOIN creatives c ON i.creative_id = c.creative_id
    WHERE i.dt BETWEEN {back(2)} AND {back(1)} AND x.dt BETWEEN {back(2)} AND {back(1)}
    GROUP BY i.dt"""),
    "interaction_scores": """
    SELECT o_custkey AS "user", l_partkey AS item, round(sum(l_quantity * 100 + 1), 6) AS score
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "vocabulary_lookup": """
    SELECT dense_rank() OVER (ORDER BY o_custkey) - 1 AS user_index,
           dense_rank() OVER (ORDER BY l_partkey) - 1 AS item_index,
           CAST(sum(l_quantity) AS DOUBLE) AS score, 1 AS contiguous
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "item_knn_tfidf": _knn("tfidf_raw", True),
    "item_knn_cosine": _knn("cosine_raw", True),
    "item_knn_bm25": _knn("bm25_raw", False),
    "embedding_topk": _with("""
    SELECT item, rank, neighbour, round(score, 6) AS score
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, neighbour)
                         AS INTEGER) AS rank
          FROM (SELECT a.item, b.item AS neighbour,
                       round(list_cosine_similarity(a.v, b.v), 9) AS score
                FROM item_vector a JOIN item_vector b ON a.item <> b.item))
    WHERE rank <= 10"""),
    "embedding_topk_text": _with("""
    SELECT item, string_agg(neighbour || '=' || round(score, 6), ',' ORDER BY rank) AS topk
    FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, neighbour) AS rank
          FROM (SELECT a.item, b.item AS neighbour,
                       round(list_cosine_similarity(a.v, b.v), 9) AS score
                FROM item_vector a JOIN item_vector b ON a.item <> b.item))
    WHERE rank <= 10 GROUP BY item"""),
    "approx_topk_quality": """
    SELECT count(*) AS items, 10 * count(*) AS found, 1 AS finds_most, 1 AS compares_less
    FROM embeddings""",
    "forest_quality": "SELECT count(*) AS items, 10 * count(*) AS found, 1 AS finds_most FROM embeddings",
    "user_category_vectors": _with("""
    SELECT ad_id, CAST(sum(n) AS BIGINT) AS n,
           coalesce(string_agg(category, ',' ORDER BY category) FILTER (WHERE counts > 100), '') AS categories
    FROM (SELECT ad_id, string_split(item_id, ':')[1] AS category, count(*) AS n
          FROM item_events GROUP BY ALL)
    JOIN (SELECT string_split(item_id, ':')[1] AS category, count(*) AS counts
          FROM item_events GROUP BY ALL) USING (category)
    GROUP BY ad_id HAVING sum(n) > 10"""),
    # users of the same categories are a cluster while there are no more kinds of them than clusters
    "cluster_sizes": _with("""
    SELECT CAST(row_number() OVER (ORDER BY users DESC) - 1 AS INTEGER) AS place, users
    FROM (SELECT categories, count(*) AS users
          FROM (SELECT ad_id, string_agg(category, ',' ORDER BY category) FILTER (WHERE counts > 100) AS categories
                FROM (SELECT ad_id, string_split(item_id, ':')[1] AS category, count(*) AS n
                      FROM item_events GROUP BY ALL)
                JOIN (SELECT string_split(item_id, ':')[1] AS category, count(*) AS counts
                      FROM item_events GROUP BY ALL) USING (category)
                GROUP BY ad_id HAVING sum(n) > 10) GROUP BY categories)"""),
    "cluster_quality": _with("""
    SELECT count(*) AS users, 1 AS nearest, 1 AS beats_one_cluster
    FROM (SELECT ad_id FROM item_events GROUP BY ad_id HAVING count(*) > 10)"""),
    "skipgram_quality": _with("""
    SELECT count(*) AS items, 1 AS beats_chance, 1 AS beats_cooccurrence
    FROM (SELECT item_id FROM item_events WHERE dt <= '2024-01-30' GROUP BY item_id HAVING count(*) >= 5)"""),
    "als_quality": """
    SELECT count(*) AS pairs, 1 AS beats_chance, 1 AS beats_popularity
    FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "user_item_scores": _with("""
    SELECT m.row_id, m.item_no AS item, round(list_dot_product(u.v, i.v), 6) AS logit,
           round(1.0 / (1.0 + exp(-list_dot_product(u.v, i.v))), 6) AS score
    FROM month m JOIN user_vector u ON m.row_id = u.row_id
    JOIN item_vector i ON m.item_no = i.item"""),
    "ranking_by_bounds": _with("""
    SELECT count(*) AS records, 1 AS equal
    FROM (SELECT DISTINCT m.row_id, m.item_no FROM month m JOIN user_vector u ON m.row_id = u.row_id)"""),
    "hit_rate": _with("""
    SELECT count(*) AS records, """ + ", ".join(
        f"round(avg(CASE WHEN rank <= {k} THEN 1.0 ELSE 0.0 END), 6) AS hr_{k}"
        for k in (1, 5, 10, 20, 50, 100, 500)) + """
    FROM (SELECT row_id, item_no, 1 + count(*) FILTER (
                     WHERE s > own OR (s = own AND item < item_no)) AS rank
          FROM (SELECT m.row_id, m.item_no, i.item,
                       round(list_dot_product(u.v, i.v), 9) AS s,
                       round(list_dot_product(u.v, t.v), 9) AS own
                FROM month m JOIN user_vector u ON m.row_id = u.row_id
                JOIN item_vector t ON t.item = m.item_no
                JOIN item_vector i ON i.item <> m.item_no AND i.item BETWEEN 1 AND """ + str(ACTIVE_CAP) + """)
          GROUP BY row_id, item_no)"""),
    "auc": _with("""
    SELECT CAST(count(*) FILTER (WHERE label = 1) AS BIGINT) AS positives,
           CAST(count(*) FILTER (WHERE label = 0) AS BIGINT) AS negatives,
           round((sum(r) FILTER (WHERE label = 1)
                  - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
                 / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)), 6) AS auc
    FROM (SELECT label, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r
          FROM (SELECT label, round(score, 9) AS s FROM scored))"""),
    "evaluation_summary": _with("""
    SELECT count(*) AS pairs,
           round(avg(CASE WHEN label = 1 THEN -ln(greatest(least(score, 1 - 1e-7), 1e-7))
                          ELSE -ln(1 - greatest(least(score, 1 - 1e-7), 1e-7)) END), 6) AS loss,
           round(avg(CASE WHEN label = 1 THEN score END), 6) AS positive_score,
           round(avg(CASE WHEN label = 0 THEN score END), 6) AS negative_score
    FROM scored"""),
}
ORACLES["auc_binned"] = ORACLES["auc"].replace(
    "round(score, 9) AS s",
    "greatest(least(ceil(round(score, 9) * 199) - 1, 198), 0) AS s",
)

# the same rows from what daily runs have stored
for _name, _like in (
    ("published_days", "partition_replace"),
    ("appended_item_index", "stable_item_index"),
    ("incremental_user_features", "user_features"),
    ("latest_per_key_stored", "latest_per_key"),
    ("report_event_totals_daily", "report_event_totals"),
    ("report_event_totals_catalog_daily", "report_event_totals_catalog"),
    ("report_user_overlap_daily", "report_user_overlap"),
    ("report_reach_split_daily", "report_reach_split"),
):
    ORACLES[_name] = ORACLES[_like]
ORACLES["next_day_stored"] = _with("""
    SELECT b.dt, count(*) AS n, CAST(sum(f.n) AS BIGINT) AS events
    FROM behaviours b JOIN (SELECT ad_id, dt, count(*) AS n FROM behaviours GROUP BY ALL) f
      ON b.ad_id = f.ad_id AND b.dt = strftime(CAST(f.dt AS DATE) + 1, '%Y-%m-%d')
    GROUP BY b.dt""")
