"""The results as SQL over the given tables, without any JSON in between."""

from __future__ import annotations

# Readings: one per event (MV), and what their payloads hold (ITEMS).
_MV = """
mv AS (
  SELECT event_id,
         'S' || user_id AS station_id,
         'Rate ' || event_type AS parameter,
         CASE WHEN event_id % 2 = 0 THEN 'mgL' ELSE 'pct' END AS unit,
         'S' || user_id || '-' || event_type || '-i-subdaily-'
           || CASE WHEN event_id % 2 = 0 THEN 'mgL' ELSE 'pct' END AS measure_id,
         strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS datetime,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS precise,
         value,
         strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') || 'T00:00:00+00:00' AS ingested_at
  FROM events
)"""

_ITEMS = (
    _MV
    + """,
items AS (
  SELECT event_id, 0 AS pos, station_id, parameter, unit, measure_id, datetime, precise, value,
         CASE WHEN event_id % 2 = 0 THEN 'Good' END AS quality,
         CASE WHEN event_id % 3 = 0 THEN 'Complete' END AS completeness, ingested_at
  FROM mv
  UNION ALL
  SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END, station_id, parameter, unit,
         measure_id, replace(datetime, 'Z', '+00:00'), replace(precise, 'Z', '+00:00'), NULL,
         'Suspect', NULL, ingested_at
  FROM mv WHERE event_id % 5 = 0
)"""
)

# Stations: each item of each document (STATION_ITEMS), the last one per station (STATIONS).
_STATION_ITEMS = """
station_copies AS (
  SELECT s_suppkey, n_name, s_nationkey, s_acctbal, s_name AS label, 0 AS pos
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT s_suppkey, n_name, s_nationkey, s_acctbal, NULL,
         CASE WHEN s_suppkey % 7 = 0 THEN 2 ELSE 1 END
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 11 = 0
),
station_items AS (
  SELECT s_suppkey AS landing_id, CAST(pos AS BIGINT) AS pos, 'S' || s_suppkey AS station_id,
         label, n_name AS river_name, s_acctbal AS lat, s_acctbal AS long, s_suppkey AS easting,
         CAST(s_nationkey AS BIGINT) AS northing,
         CASE WHEN s_suppkey % 3 = 0 THEN 'Active' END AS status,
         '2024-01-31T00:00:00+00:00' AS ingested_at
  FROM station_copies
)"""

_STATIONS = (
    _STATION_ITEMS
    + """,
stations AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY landing_id DESC, pos DESC) AS rn
    FROM station_items
  ) WHERE rn = 1
),
dimension AS (
  SELECT row_number() OVER (ORDER BY station_id) AS station_key, station_id FROM stations
)"""
)

_SILVER = (
    _ITEMS
    + ","
    + _STATIONS
    + """,
silver AS (
  SELECT * FROM (
    SELECT event_id AS landing_id, CAST(pos AS BIGINT) AS pos, station_id,
           lower(parameter) AS parameter, unit, measure_id,
           replace(datetime, 'Z', '+00:00') AS datetime, value, quality, completeness, ingested_at,
           row_number() OVER (
             PARTITION BY measure_id, replace(datetime, 'Z', '+00:00'), ingested_at
             ORDER BY event_id, pos) AS rn
    FROM items WHERE station_id IN (SELECT station_id FROM stations)
  ) WHERE rn = 1
)"""
)

_SILVER_COLUMNS = (
    "landing_id, pos, station_id, parameter, unit, measure_id, datetime, value, quality,"
    " completeness, ingested_at"
)
_FACT_COLUMNS = (
    "station_key, s.station_id, parameter, unit, measure_id, datetime, value, quality,"
    " completeness, ingested_at"
)

# What the station documents offer; requested: rate click, rate purchase.
_OFFERS = """
kinds AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS kind),
units AS (SELECT unnest(['mgL', 'pct']) AS unit),
offered AS (
  SELECT s_suppkey, 'S' || s_suppkey AS station_id, 'rate ' || kind AS parameter
  FROM supplier CROSS JOIN kinds WHERE kind <> 'purchase' OR s_suppkey % 6 <> 5
),
measured AS (
  SELECT s_suppkey, 'S' || s_suppkey AS station_id, 'rate ' || kind AS parameter,
         'S' || s_suppkey || '-' || kind || '-i-subdaily-' || unit AS measure_id
  FROM supplier CROSS JOIN kinds CROSS JOIN units WHERE kind <> 'click' OR s_suppkey % 10 <> 9
),
wanted AS (
  SELECT unnest([0, 1]) AS nth, unnest(['rate click', 'rate purchase']) AS parameter
)"""

# Landing rows of several kinds, told apart by the dataset name.
_MIXED_ROWS = """
mixed AS (
  SELECT event_id AS id,
         CASE event_id % 6
           WHEN 0 THEN 'station_search'
           WHEN 1 THEN upper('readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id)
           WHEN 2 THEN 'readings-latest' || measure_id
           WHEN 3 THEN 'rainfall_' || measure_id
           ELSE 'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id
         END AS dataset,
         ingested_at
  FROM mv
)"""
_MIXED = _MV + "," + _MIXED_ROWS

_SPOTTY = (
    _MV
    + """,
spotty AS (
  SELECT event_id, parameter, measure_id, ingested_at,
         CASE WHEN event_id % 13 = 0 THEN '' ELSE unit END AS unit,
         CASE WHEN event_id % 17 <> 0 THEN station_id END AS station_id,
         CASE WHEN event_id % 29 = 0 THEN '' ELSE datetime END AS datetime
  FROM mv
)"""
)

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?([+-]\d{2}:\d{2})?)?$"

# The newest batch of the whole run, to the microsecond: items, silver and facts.
_RUN = (
    _ITEMS
    + ","
    + _STATIONS
    + """,
newest AS (
  SELECT greatest(max(ingested_at), '2024-01-31T00:00:00+00:00') AS batch FROM mv
),
run_bronze AS (
  SELECT * FROM items WHERE ingested_at = (SELECT batch FROM newest)
),
run_silver AS (
  SELECT * FROM (
    SELECT *, replace(precise, 'Z', '+00:00') AS moment,
           row_number() OVER (
             PARTITION BY measure_id, replace(precise, 'Z', '+00:00') ORDER BY event_id, pos) AS rn
    FROM run_bronze WHERE station_id IN (SELECT station_id FROM stations)
  ) WHERE rn = 1
)"""
)


def _with(parts: str, query: str) -> str:
    return f"WITH {parts} {query}"


SQL: dict[str, str] = {
    "flagship_fact": _with(
        _SILVER, f"SELECT {_FACT_COLUMNS} FROM silver s JOIN dimension d USING (station_id)"
    ).replace("s.station_id", "station_id"),
    "flatten_readings": _with(
        _ITEMS,
        """SELECT event_id AS landing_id, CAST(pos AS BIGINT) AS pos, station_id, parameter, unit,
        measure_id, datetime, value, quality, completeness, ingested_at FROM items""",
    ),
    "flatten_stations": _with(_STATION_ITEMS, "SELECT * FROM station_items"),
    "parse_dataset_name": _with(
        _MV
        + """, named AS (
          SELECT event_id, CASE event_id % 7
            WHEN 0 THEN 'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id || '__extra'
            WHEN 1 THEN 'readings_latest__' || replace(parameter, ' ', '_')
            ELSE 'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id
          END AS dataset, parameter, measure_id, unit, station_id, event_id % 7 <> 1 AS complete
          FROM mv)""",
        """SELECT event_id, dataset, complete, parameter,
        CASE WHEN complete THEN measure_id END AS measure_id,
        CASE WHEN complete THEN unit END AS unit,
        CASE WHEN complete THEN station_id END AS station_id FROM named""",
    ),
    "props_value": """
        SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k,
               try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k_double
        FROM events""",
    "norm_text": r"""
        SELECT o_orderkey, trim(regexp_replace(
          lower(' _' || o_orderpriority || chr(9) || '-- ' || o_orderstatus || '__'),
          '[\s_-]+', ' ', 'g')) AS norm
        FROM orders""",
    "last_segment": """
        SELECT page_id, regexp_extract(
          CASE WHEN page_id % 3 = 0 THEN url || '//' ELSE url END, '([^/]*)/*$', 1) AS segment
        FROM pages""",
    "lower_ascii": """
        SELECT p_partkey, translate(p_type || ' ' || p_brand || ' ÀÉß',
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
        FROM part""",
    "normalize_ts": _with(
        _MV
        + """, spelled AS (
          SELECT event_id, replace(CASE event_id % 6
            WHEN 0 THEN substring(datetime, 1, 10)
            WHEN 1 THEN '2024-02-30T00:00:00Z'
            WHEN 2 THEN substring(datetime, 1, 4)
            WHEN 3 THEN substring(datetime, 11, 6)
            ELSE datetime END, 'Z', '+00:00') AS datetime
          FROM mv)""",
        f"""SELECT event_id, datetime, regexp_full_match(datetime, '{_ISO}')
        AND try_cast(datetime AS TIMESTAMPTZ) IS NOT NULL AS is_iso FROM spelled""",
    ),
    "reading_instants": _with(
        _MV,
        """SELECT event_id,
        CAST(epoch(CAST(replace(datetime, 'Z', '+00:00') AS TIMESTAMPTZ)) AS BIGINT) AS seconds,
        CAST(epoch(CAST(ingested_at AS TIMESTAMPTZ)) AS BIGINT) AS landed_seconds FROM mv""",
    ),
    "latest_batch": _with(
        _MV,
        """SELECT event_id, measure_id, datetime, ingested_at FROM mv
        WHERE ingested_at = (SELECT max(ingested_at) FROM mv)""",
    ),
    "route_datasets": _with(
        _MIXED,
        """SELECT id, dataset, ingested_at, 'stations' AS route FROM mixed
        WHERE dataset = 'station_search' UNION ALL
        SELECT id, dataset, ingested_at, 'readings' FROM mixed
        WHERE starts_with(dataset, 'readings_latest__')""",
    ),
    "overwrite_landing": _with(
        _MIXED,
        """SELECT id, dataset, ingested_at FROM mixed
        WHERE NOT (dataset ILIKE 'readings_latest%' OR dataset = 'station_search') UNION ALL
        SELECT (SELECT max(id) FROM mixed) + 1, 'station_search', '2024-01-31T00:00:00+00:00'""",
    ),
    "append_landing": _with(
        _MIXED,
        """SELECT id, dataset, '2023-12-31T00:00:00+00:00' AS ingested_at FROM mixed
        WHERE id % 2 = 0 UNION ALL
        SELECT id, dataset, coalesce(CASE WHEN id % 3 <> 0 THEN ingested_at END,
          '2024-01-01T12:00:00+00:00') FROM mixed WHERE id % 2 = 1""",
    ),
    "batch_row_counts": _with(
        _MV,
        """SELECT ingested_at,
        'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id AS dataset,
        count(*) AS payloads FROM mv GROUP BY 1, 2""",
    ),
    "search_stations": """
        SELECT c_custkey, c_name, c_nationkey FROM customer WHERE contains(c_name, '00001')
        ORDER BY c_custkey LIMIT 5""",
    "latest_n_readings": _with(
        _MV,
        """SELECT * FROM (
          SELECT event_id, measure_id, datetime, value, CAST(row_number() OVER (
            PARTITION BY measure_id ORDER BY datetime DESC, event_id) AS INTEGER) AS rank FROM mv
        ) WHERE rank <= 10""",
    ),
    "observed_properties": _with(_OFFERS, "SELECT station_id, parameter FROM offered"),
    "resolve_measures": _with(
        _OFFERS,
        """SELECT 'S' || s.s_suppkey AS station_id, CAST(w.nth AS INTEGER) AS nth, w.parameter,
        coalesce(string_agg(m.measure_id, ',' ORDER BY m.measure_id), '') AS measure_ids
        FROM supplier s CROSS JOIN wanted w
        LEFT JOIN measured m ON m.s_suppkey = s.s_suppkey AND m.parameter = w.parameter
        GROUP BY ALL""",
    ),
    "missing_parameters": _with(
        _OFFERS
        + """, asked AS (
          SELECT unnest([0, 1, 2, 3]) AS nth,
                 unnest(['Rate-Click', 'rate_purchase', 'rate click', 'Rate-None']) AS typed,
                 unnest(['rate click', 'rate purchase', 'rate click', 'rate none']) AS parameter),
        lacking AS (
          SELECT 'S' || s_suppkey AS station_id, string_agg(typed, ',' ORDER BY nth) AS missing
          FROM supplier s CROSS JOIN asked a
          WHERE NOT EXISTS (SELECT 1 FROM offered o
            WHERE o.s_suppkey = s.s_suppkey AND o.parameter = a.parameter)
          GROUP BY 1)""",
        """SELECT station_id, missing, string_agg(parameter, ',' ORDER BY parameter) AS available
        FROM lacking JOIN offered USING (station_id) GROUP BY ALL""",
    ),
    "station_errors": _with(
        _OFFERS
        + """, lists AS (
          SELECT s_suppkey, string_agg(parameter, ', ' ORDER BY parameter) AS available
          FROM offered GROUP BY 1)""",
        """SELECT 'S' || s_suppkey AS station_id, 'parameter not offered' AS reason,
          'missing: rate_purchase; available: ' || available AS detail
        FROM supplier JOIN lists USING (s_suppkey) WHERE s_suppkey % 6 = 5
        UNION ALL
        SELECT 'S' || s_suppkey, 'no measure for parameter', 'rate click'
        FROM supplier WHERE s_suppkey % 10 = 9""",
    ),
    "fetch_all_units": _with(
        _MV + "," + _OFFERS,
        """SELECT CAST(rank - 1 AS BIGINT) AS pos, station_id, parameter,
          split_part(measure_id, '-', -1) AS unit, measure_id, datetime, value,
          CAST(NULL AS VARCHAR) AS quality, 'Complete' AS completeness,
          '2024-01-31T00:00:00+00:00' AS ingested_at
        FROM (
          SELECT mv.station_id, m.parameter, mv.measure_id, datetime, value, row_number() OVER (
            PARTITION BY mv.measure_id ORDER BY datetime DESC, event_id) AS rank
          FROM mv JOIN measured m USING (measure_id) JOIN wanted w ON w.parameter = m.parameter
        ) WHERE rank <= 5""",
    ),
    "upsert_last_wins": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM (SELECT *, row_number() OVER (
          PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1""",
    "upsert_merge": """
        WITH ranked AS (
          SELECT *, o_orderdate >= TIMESTAMP '1998-04-01' AS late, row_number() OVER (
            PARTITION BY o_custkey, o_orderdate >= TIMESTAMP '1998-04-01'
            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders),
        late AS (SELECT * FROM ranked WHERE rn = 1 AND late),
        early AS (SELECT * FROM ranked WHERE rn = 1 AND NOT late)
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM early e WHERE NOT EXISTS (SELECT 1 FROM late l WHERE l.o_custkey = e.o_custkey)
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END FROM late""",
    "dim_stable_keys": """
        WITH last_order AS (
          SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
            SELECT *, row_number() OVER (
              PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
          WHERE rn = 1),
        first_load AS (
          SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01'),
        known AS (
          SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS customer_key FROM first_load),
        fresh AS (
          SELECT o_custkey, (SELECT count(*) FROM first_load)
            + row_number() OVER (ORDER BY o_custkey) AS customer_key
          FROM last_order WHERE o_custkey NOT IN (SELECT o_custkey FROM first_load))
        SELECT customer_key, o_custkey, o_orderdate, o_orderkey, o_totalprice FROM last_order
        JOIN (SELECT * FROM known UNION ALL SELECT * FROM fresh) USING (o_custkey)""",
    "insert_if_absent": _with(
        _MV,
        """SELECT event_id, station_id, parameter, unit, measure_id, datetime, value, ingested_at
        FROM (
          SELECT *, row_number() OVER (
            PARTITION BY measure_id, datetime, ingested_at ORDER BY event_id) AS rn
          FROM mv WHERE event_id % 97 <> 0
        ) n WHERE rn = 1 AND NOT EXISTS (
          SELECT 1 FROM mv o WHERE o.event_id % 10 = 0 AND o.measure_id = n.measure_id
            AND o.datetime = n.datetime AND o.ingested_at = n.ingested_at)""",
    ),
    "silver_measure": _with(_SILVER, f"SELECT {_SILVER_COLUMNS} FROM silver"),
    "silver_latest_batch": _with(
        _SILVER,
        f"""SELECT {_SILVER_COLUMNS} FROM silver
        WHERE ingested_at = (SELECT max(ingested_at) FROM mv)""",
    ),
    "gold_fact_keys": _with(
        _SILVER,
        f"""SELECT row_number() OVER (ORDER BY measure_id, datetime, ingested_at)
        AS measurement_key, {_FACT_COLUMNS} FROM silver s JOIN dimension d USING (station_id)""",
    ).replace("s.station_id", "station_id"),
    "gold_fact_rerun": _with(
        _SILVER, f"SELECT {_FACT_COLUMNS} FROM silver s JOIN dimension d USING (station_id)"
    ).replace("s.station_id", "station_id"),
    "orphan_measures": _with(
        _MV,
        """SELECT event_id, station_id, parameter, unit, measure_id, datetime, value, ingested_at
        FROM mv WHERE station_id NOT IN (SELECT 'S' || s_suppkey FROM supplier)""",
    ),
    "fk_check": """
        SELECT o_orderstatus, count(*) AS violations FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)
        GROUP BY 1""",
    "required_fields": _with(
        _SPOTTY,
        """SELECT count(*) AS rows,
        count(*) FILTER (unit = '' OR station_id IS NULL OR datetime = '') AS measure_violations,
        count(*) FILTER (station_id IS NULL) AS station_violations,
        count(*) FILTER (unit = '') AS unit_violations FROM spotty""",
    ),
    "duplicate_groups": _with(
        _MV,
        """SELECT measure_id, datetime, ingested_at, count(*) AS copies FROM mv
        GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    ),
    "row_count_gates": _with(
        _MIXED
        + """, counts AS (
          SELECT count(*) FILTER (dataset = 'station_search') AS s,
                 count(*) FILTER (dataset ILIKE 'readings_latest%') AS r, count(*) AS n
          FROM mixed), gates AS (
          SELECT 1 AS seq, 'station document present' AS "check", greatest(1 - s, 0) AS violations
          FROM counts UNION ALL
          SELECT 2, 'readings payloads for the request', greatest(3 - r, 0) FROM counts UNION ALL
          SELECT 3, 'payloads in total', greatest(4 - n, 0) FROM counts)""",
        """SELECT seq, 'landing' AS layer, "check", violations, violations = 0 AS ok FROM gates""",
    ),
    "iso_sample": _with(
        _SPOTTY,
        """SELECT event_id, datetime, datetime <> '' AS is_iso FROM spotty
        ORDER BY event_id DESC LIMIT 20""",
    ),
    "document_issues": _with(
        _MV
        + """, defects AS (
          SELECT unnest([1, 2, 3, 5, 7, 8, 10]) AS rest,
            unnest(['payload is not a document with items', 'not a number, taken as NULL',
              'field is not a scalar', 'item is not an object',
              'payload is not a document with items',
              'dataset name has fewer than three parts', 'payload is not JSON']) AS issue,
            unnest([NULL, 'value', 'quality', NULL, NULL, 'readings_latest__short', NULL]) AS detail,
            unnest([NULL, 0, 0, 0, NULL, NULL, NULL]) AS pos),
        shapes AS (
          SELECT unnest([1, 4, 2, 8]) AS rest,
            unnest(['first status is not an object', 'first status is not an object',
              'field is not a scalar', 'field is not a scalar']) AS issue)""",
        """SELECT event_id AS landing_id, CASE rest WHEN 8 THEN 'readings_latest__short'
          WHEN 10 THEN 'rainfall'
          ELSE 'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id
          END AS dataset, CAST(pos AS BIGINT) AS pos, issue, detail, ingested_at
        FROM mv JOIN defects ON event_id % 40 = rest
        UNION ALL
        SELECT s_suppkey, 'station_search', 0, issue, 'status', '2024-01-31T00:00:00+00:00'
        FROM supplier JOIN shapes ON s_suppkey % 10 = rest WHERE s_suppkey % 7 <> 0""",
    ),
    "land_run": _with(
        _MV
        + ","
        + _OFFERS
        + """, found AS (
          SELECT s_suppkey, row_number() OVER (ORDER BY 'S' || s_suppkey) - 1 AS place
          FROM supplier WHERE contains(s_name, 'Supplier#00000000')
          ORDER BY 'S' || s_suppkey LIMIT 5),
        per_measure AS (
          SELECT place, nth, measured.parameter, measure_id, (SELECT least(count(*), 3) FROM mv
            WHERE mv.measure_id = measured.measure_id) AS items
          FROM found JOIN measured USING (s_suppkey)
          JOIN wanted ON wanted.parameter = measured.parameter)""",
        """SELECT CAST(1 AS BIGINT) AS id, 'station_search' AS dataset,
          (SELECT count(*) FROM found) AS items, '2024-01-31T00:00:00+00:00' AS ingested_at
        UNION ALL
        SELECT 1 + row_number() OVER (ORDER BY place, nth, measure_id),
          'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id, items,
          '2024-01-31T00:00:00+00:00'
        FROM per_measure""",
    ),
    "pipeline_summary": _with(
        _RUN,
        """SELECT batch AS ingested_at, 'ok' AS status,
          coalesce(max(m), 0) AS measure_inserts,
          CAST(coalesce(sum(n) FILTER (kind = 'items'), 0) AS BIGINT) AS station_upserts,
          CAST(coalesce(sum(n) FILTER (kind = 'stations'), 0) AS BIGINT) AS silver_station_upserts,
          CAST(coalesce(sum(n) FILTER (kind = 'stations'), 0) AS BIGINT) AS dim_station_upserts,
          CAST(coalesce(sum(n) FILTER (kind = 'silver'), 0) AS BIGINT) AS silver_measure_inserts,
          CAST(coalesce(sum(n) FILTER (kind = 'silver'), 0) AS BIGINT) AS fact_measurement_inserts
        FROM (SELECT DISTINCT ingested_at AS batch FROM mv
              UNION SELECT '2024-01-31T00:00:00+00:00') b
        LEFT JOIN (SELECT ingested_at, count(*) AS m FROM items GROUP BY 1) i ON i.ingested_at = batch
        LEFT JOIN (SELECT '2024-01-31T00:00:00+00:00' AS at, 'items' AS kind, count(*) AS n FROM station_items
          UNION ALL SELECT '2024-01-31T00:00:00+00:00', 'stations', count(*) FROM stations
          UNION ALL SELECT ingested_at, 'silver', count(*) FROM run_silver GROUP BY 1) c ON c.at = batch
        GROUP BY batch""",
    ),
    "pipeline_facts": _with(
        _RUN,
        """SELECT row_number() OVER (ORDER BY measure_id, moment) AS measurement_key, station_key,
          station_id, lower(parameter) AS parameter, unit, measure_id, moment AS datetime, value,
          quality, completeness, ingested_at
        FROM run_silver JOIN dimension USING (station_id)""",
    ),
}

# The rules of a report: place, layer, name.
_RULES = """
rules AS (
  SELECT unnest([27, 1, 2, 3, 28, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20,
                 21, 22, 23, 24, 25, 26]) AS seq,
  unnest(['extract', 'landing', 'landing', 'landing', 'parse',
    'bronze', 'bronze', 'bronze', 'bronze', 'bronze', 'bronze', 'bronze', 'bronze',
    'silver', 'silver', 'silver', 'silver', 'silver', 'silver', 'silver', 'silver', 'silver',
    'gold', 'gold', 'gold', 'gold', 'gold', 'gold']) AS layer,
  unnest(['stations serve the request', 'station document present',
    'readings payloads for the request', 'payloads in total', 'payloads are readable documents',
    'station table exists', 'measure table exists', 'station table has rows',
    'measure table has rows', 'station fields present', 'measure fields present',
    'timestamps are ISO', 'reading keys are unique',
    'station table exists', 'measure table exists', 'station table has rows',
    'measure table has rows', 'station fields present', 'measure fields present',
    'timestamps are ISO', 'reading keys are unique', 'every reading has a station',
    'station dimension exists', 'measurement facts exist', 'station dimension has rows',
    'measurement facts have rows', 'facts have a station key',
    'station keys are in the dimension']) AS "check")"""

_BLANK = " OR ".join(
    f"{c} IS NULL OR {c} = ''"
    for c in ("station_id", "parameter", "unit", "measure_id", "datetime", "ingested_at")
)
_BAD_ISO = (
    f"NOT coalesce(regexp_full_match(replace(datetime, 'Z', '+00:00'), '{_ISO}')"
    " AND try_cast(replace(datetime, 'Z', '+00:00') AS TIMESTAMPTZ) IS NOT NULL, FALSE)"
)


def _copies(name: str) -> str:
    keys = "measure_id, datetime, ingested_at"
    return f"SELECT count(*) FROM (SELECT 1 FROM {name} GROUP BY {keys} HAVING count(*) > 1)"


def _count(name: str, condition: str = "TRUE") -> str:
    return f"SELECT count(*) FROM {name} WHERE {condition}"


def _lacking(name: str, wanted: int = 1, condition: str = "TRUE") -> str:
    return f"SELECT greatest({wanted} - count(*), 0) FROM {name} WHERE {condition}"


def _report(parts: str, requested: int, missing: int = 0) -> str:
    """The report over tables named as the layers'; `missing` tables of each pair do not exist.

    `parts` defines landed (dataset), issues (issue), errors, and the tables of the layers.
    """
    counts = {
        27: _count("errors"),
        1: _lacking("landed", 1, "dataset = 'station_search'"),
        2: _lacking("landed", requested, "dataset ILIKE 'readings_latest%'"),
        3: _lacking("landed", requested + 1),
        28: _count("issues", "issue <> 'not a number, taken as NULL'"),
        6: _lacking("b_station"),
        7: _lacking("b_measure"),
        8: _count(
            "b_station",
            "station_id IS NULL OR station_id = '' OR label IS NULL OR label = ''"
            " OR ingested_at IS NULL OR ingested_at = ''",
        ),
        9: _count("b_measure", _BLANK),
        10: _count("b_measure", _BAD_ISO),
        11: _copies("b_measure"),
        14: _lacking("s_station"),
        15: _lacking("s_measure"),
        16: _count(
            "s_station",
            "station_id IS NULL OR station_id = '' OR ingested_at IS NULL OR ingested_at = ''",
        ),
        17: _count("s_measure", _BLANK),
        18: _count("s_measure", _BAD_ISO),
        19: _copies("s_measure"),
        20: "SELECT count(*) FROM s_measure m WHERE NOT EXISTS"
        " (SELECT 1 FROM s_station s WHERE s.station_id = m.station_id)",
        23: _lacking("g_station"),
        24: _lacking("g_measure"),
        25: _count("g_measure", "station_key IS NULL"),
        26: "SELECT count(*) FROM g_measure m WHERE station_key IS NOT NULL AND NOT EXISTS"
        " (SELECT 1 FROM g_station s WHERE s.station_key = m.station_key)",
    }
    cases = " ".join(f"WHEN {seq} THEN ({sql})" for seq, sql in counts.items())
    return _with(
        parts + "," + _RULES + f", counted AS (SELECT *, CASE seq {cases} ELSE {missing} END AS violations FROM rules)",
        """SELECT seq, layer, "check", violations, violations = 0 AS ok FROM counted""",
    )


# What a run over all batches leaves, whose stations are known from batch `since` on.
def _after_run(since: str) -> str:
    return (
        _ITEMS
        + ","
        + _STATIONS
        + f""",
landed AS (
  SELECT 'station_search' AS dataset FROM supplier UNION ALL
  SELECT 'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id FROM mv
), issues AS (
  SELECT 'dataset name has fewer than three parts' AS issue FROM landed
  WHERE starts_with(dataset, 'readings_latest__') AND len(string_split(dataset, '__')) < 3
), errors AS (SELECT 1 WHERE FALSE),
b_station AS (SELECT * FROM stations), s_station AS (SELECT * FROM stations),
g_station AS (SELECT * FROM dimension),
b_measure AS (SELECT * REPLACE (precise AS datetime) FROM items),
s_measure AS (
  SELECT * FROM (
    SELECT * REPLACE (replace(precise, 'Z', '+00:00') AS datetime, lower(parameter) AS parameter),
      row_number() OVER (PARTITION BY measure_id, replace(precise, 'Z', '+00:00'), ingested_at
                         ORDER BY event_id, pos) AS rn
    FROM items WHERE station_id IN (SELECT station_id FROM stations) AND ingested_at >= {since}
  ) WHERE rn = 1
), g_measure AS (
  SELECT * FROM s_measure LEFT JOIN dimension USING (station_id)
)"""
    )


# Stations that arrive with one batch and once more with another.
_HISTORY = (
    _MV
    + """,
nths AS (
  SELECT row_number() OVER (ORDER BY ingested_at) - 1 AS nth, ingested_at
  FROM (SELECT DISTINCT ingested_at FROM mv)
), arrivals AS (
  SELECT 'S' || s_suppkey AS station_id, step || ' ' || s_name AS label, ingested_at, s_suppkey * 10 + step AS id
  FROM supplier, (SELECT unnest([1, 7]) AS step), nths
  WHERE nth = ((s_suppkey - 1) * step) % (SELECT count(*) FROM nths)
), known AS (
  SELECT station_id, min(ingested_at) AS since, arg_max(label, (ingested_at, id)) AS label,
         max(ingested_at) AS ingested_at
  FROM arrivals GROUP BY station_id
), keyed AS (
  SELECT *, row_number() OVER (ORDER BY since, station_id) AS station_key FROM known
)"""
)
_HISTORY_SQL = {
    "stations": _with(_HISTORY, "SELECT station_key, station_id, label, ingested_at FROM keyed"),
    "facts": _with(
        _HISTORY,
        """SELECT row_number() OVER (ORDER BY mv.ingested_at, measure_id, moment) AS measurement_key,
          station_key, mv.station_id, lower(parameter) AS parameter, unit, measure_id,
          moment AS datetime, value, CASE WHEN event_id % 2 = 0 THEN 'Good' END AS quality,
          CASE WHEN event_id % 3 = 0 THEN 'Complete' END AS completeness, mv.ingested_at
        FROM (SELECT *, replace(precise, 'Z', '+00:00') AS moment FROM mv) mv
        JOIN keyed ON keyed.station_id = mv.station_id AND since <= mv.ingested_at""",
    ),
}

# Queries over all batches, and over all customers.
SQL |= {
    "fk_check_all": """
        SELECT o_orderstatus, count(*) AS violations FROM orders
        WHERE CASE WHEN o_orderkey % 50 = 7 THEN -o_custkey ELSE o_custkey END
          NOT IN (SELECT c_custkey FROM customer)
        GROUP BY 1""",
    "check_report": _report(_after_run("'2024-01-31T00:00:00+00:00'"), 3),
    "check_report_all": _report(_after_run("''"), 3),
    "check_report_planted": _report(
        _SPOTTY
        + ","
        + _MIXED_ROWS
        + ","
        + _OFFERS
        + """,
landed AS (SELECT dataset FROM mixed),
issues AS (
  SELECT CASE event_id % 3 WHEN 0 THEN 'not a number, taken as NULL'
         ELSE 'payload is not JSON' END AS issue FROM mv WHERE event_id % 3 < 2
),
errors AS (
  SELECT 1 FROM supplier WHERE s_suppkey % 6 = 5 UNION ALL
  SELECT 1 FROM supplier WHERE s_suppkey % 10 = 9
),
b_station AS (
  SELECT s_suppkey AS station_key, 'S' || s_suppkey AS station_id,
         CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS label,
         '2024-01-31T00:00:00+00:00' AS ingested_at FROM supplier
),
s_station AS (
  SELECT station_id, CASE WHEN station_key % 9 <> 0 THEN ingested_at END AS ingested_at FROM b_station
),
g_station AS (SELECT * FROM b_station),
b_measure AS (
  SELECT * REPLACE (CASE WHEN event_id % 23 = 0 THEN '2024-02-30' ELSE datetime END AS datetime),
         CASE WHEN event_id % 11 <> 0 THEN event_id % 150 END AS station_key FROM spotty
),
s_measure AS (SELECT * FROM b_measure), g_measure AS (SELECT * FROM b_measure)""",
        1_000_000_000,
    ),
    "check_report_bare": _report(
        _MV
        + """,
landed AS (SELECT 'rainfall' AS dataset FROM mv),
issues AS (SELECT '' AS issue WHERE FALSE), errors AS (SELECT 1 WHERE FALSE),
b_station AS (SELECT NULL AS station_id, NULL AS label, NULL AS ingested_at, 1 AS station_key WHERE FALSE),
s_station AS (SELECT * FROM b_station), g_station AS (SELECT * FROM b_station),
b_measure AS (SELECT *, 1 AS station_key FROM mv WHERE FALSE),
s_measure AS (SELECT * FROM b_measure), g_measure AS (SELECT * FROM b_measure)""",
        3,
        missing=1,
    ),
    "land_bulk": _with(
        _ITEMS
        + """, stamps AS (
          SELECT unnest(['2024-02-01T00:00:00+00:00', '2024-02-02T00:00:00+00:00']) AS stamp,
                 unnest([0, 1]) AS nth)""",
        """SELECT stamp AS ingested_at,
          'readings_latest__' || replace(parameter, ' ', '_') || '__' || measure_id AS dataset,
          count(DISTINCT event_id) AS payloads,
          count(*) + count(DISTINCT event_id) FILTER (event_id % 4 = 0) AS items,
          1 + nth * (SELECT count(*) FROM mv) AS first_id, TRUE AS dense
        FROM items CROSS JOIN stamps GROUP BY stamp, nth, parameter, measure_id""",
    ),
    "drop_datasets": _with(
        _MIXED,
        """SELECT ingested_at, CASE WHEN dataset ILIKE 'readings_latest%' THEN 'readings'
          ELSE 'other' END AS kind, count(*) AS payloads
        FROM mixed WHERE dataset <> 'station_search' AND dataset NOT ILIKE 'rainfall%mgl'
        GROUP BY 1, 2""",
    ),
    "land_files": """
        SELECT row_number() OVER (ORDER BY dataset) AS id, dataset, payload,
          '2024-01-31T00:00:00+00:00' AS ingested_at
        FROM (SELECT 'rainfall ' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS dataset,
          '{"items":[' || string_agg(s_suppkey, ',' ORDER BY s_suppkey) || ']}' || chr(10) AS payload
          FROM supplier GROUP BY 1)""",
    "migrate_landing": _with(
        _MIXED,
        """SELECT id, dataset, CASE WHEN id % 2 = 1 AND id % 3 <> 0 THEN ingested_at
          ELSE '2023-12-31T00:00:00+00:00' END AS ingested_at FROM mixed
        UNION ALL SELECT max(id) + 1, 'after', '2024-01-31T00:00:00+00:00' FROM mixed""",
    ),
    "batch_without_readings": _with(
        _MV,
        """SELECT ingested_at, count(*) AS measure_inserts,
          count(*) FILTER (known) AS silver_measure_inserts,
          count(*) FILTER (known) AS fact_measurement_inserts,
          CASE WHEN ingested_at = min(ingested_at) OVER ()
            THEN (SELECT count(*) FROM supplier) ELSE 0 END AS dim_station_upserts
        FROM (SELECT *, station_id IN (SELECT 'S' || s_suppkey FROM supplier) AS known FROM mv)
        GROUP BY 1
        UNION ALL SELECT max(ingested_at)[1:10] || 'T12:00:00+00:00', 0, 0, 0,
          (SELECT count(*) FROM supplier) FROM mv""",
    ),
    "run_gated": _with(
        _MV,
        """SELECT ingested_at, count(*) AS measure_inserts,
          count(*) FILTER (known) AS silver_measure_inserts,
          count(*) FILTER (known) AS fact_measurement_inserts
        FROM (SELECT *, station_id IN (SELECT 'S' || s_suppkey FROM supplier) AS known FROM mv)
        GROUP BY 1""",
    ),
    "history_facts": _HISTORY_SQL["facts"],
    "history_stations": _HISTORY_SQL["stations"],
    "bronze_append": _with(
        _ITEMS,
        """SELECT event_id AS landing_id, CAST(pos AS BIGINT) AS pos, station_id, parameter, unit,
          measure_id, datetime, value, quality, completeness, ingested_at
        FROM items CROSS JOIN (SELECT unnest([1, 2]))
        WHERE ingested_at = (SELECT max(ingested_at) FROM mv)""",
    ),
}
