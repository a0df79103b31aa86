"""DuckDB SQL for the registered queries, over the same whole tables."""

from fleetlake.plans.adapter import EARLIER, TRAIN
from fleetlake.schema import FEATURES, GROUPS, NAME_OF, TIERS, group_columns
from fleetlake.sources.metrics import BROKERS, LAG, MEMBERS, OFFSET, UNDER_REPLICATED


def _listed(names):
    return ", ".join(f"'{name}'" for name in names)


# Samples.
_COLS = ", ".join(f"CAST((event_id * {i + 1}) % 97 AS DOUBLE) / 97.0 AS col_{i}" for i in range(2, len(FEATURES)))
T = f"""t AS (
  SELECT event_id, event_type, ts AS send_ts, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS send_text,
    'machine-' || user_id AS machine, strftime(ts, '%Y-%m-%d') AS tick,
    CASE WHEN event_type IN ({_listed(TRAIN)}) THEN 'train' ELSE 'test' END AS split,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
    value AS col_0, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS col_1, {_COLS}
  FROM events)"""

_FIRST = "row_number() OVER (PARTITION BY machine, tick, split ORDER BY event_id)"

# First sample of each key, and the earlier load.
FIRST = f"firsts AS (SELECT * FROM t QUALIFY {_FIRST} = 1)"
EARLY = f"early AS (SELECT * FROM t WHERE event_type IN ({_listed(EARLIER)}) QUALIFY {_FIRST} = 1)"
CUT = "(SELECT max(ts) - INTERVAL 7 DAY FROM events)"
_HELD = "EXISTS (SELECT 1 FROM early e WHERE e.machine = t.machine AND e.tick = t.tick AND e.split = t.split)"
_STORED = "machine, tick, split, send_ts, col_0"

# The earlier load's samples win over all others.
MERGED = f"""WITH {T}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY machine, tick, split
    ORDER BY CASE WHEN event_type IN ({_listed(EARLIER)}) THEN 0 ELSE 1 END, event_id) AS nth FROM t)
SELECT {_STORED} FROM ranked WHERE nth = 1"""
# The same with every kind of event a batch of its own.
BY_KIND = f"""WITH {T}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY machine, tick, split ORDER BY CASE WHEN event_type IN ({_listed(EARLIER)}) THEN 0 ELSE 1 END,
    CASE WHEN event_type IN ({_listed(EARLIER)}) THEN 0 ELSE list_position(['click', 'purchase', 'signup'], event_type) END, event_id) AS nth FROM t)
SELECT {_STORED} FROM ranked WHERE nth = 1"""
DEDUPED = f"WITH {T}, {FIRST} SELECT {_STORED} FROM firsts"
_KEYS = f"WITH {T}, {FIRST} SELECT machine, tick, split FROM firsts"

# Damaged messages, by kind of event, and documents.
_ALL = f"""SELECT 'sample' AS kind, event_id AS src_id, machine, tick, split, {{label}} AS label, col_0 FROM t
UNION ALL SELECT 'damaged', event_id, {{machine}}, {{tick}}, NULL, {{damaged}}, {{value}} FROM t {{where}}"""
STRICT = (
    f"WITH {T} "
    + _ALL.format(
        label="CAST(label AS DOUBLE)",
        machine="CASE WHEN event_type <> 'click' THEN machine END",
        tick="CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN '123' END",
        damaged="CASE WHEN event_type = 'view' THEN 1.0::DOUBLE END",
        value="CASE WHEN event_type = 'purchase' THEN 0.25::DOUBLE WHEN event_type = 'signup' THEN 'NaN'::DOUBLE END",
        where="",
    )
    + " UNION ALL SELECT 'document', doc_id, NULL, NULL, NULL, NULL, NULL FROM documents"
)
LENIENT = f"WITH {T} " + _ALL.format(
    label="CAST(label AS INTEGER)",
    machine="machine",
    tick="CASE WHEN event_type NOT IN ('view', 'signup') THEN '123' END",
    damaged="CASE WHEN event_type IN ('view', 'signup') THEN 1 ELSE 0 END",
    value="CASE WHEN event_type = 'signup' THEN 'NaN'::DOUBLE END",
    where="WHERE event_type NOT IN ('click', 'purchase')",
)
QUARANTINE = f"""WITH {T}
SELECT 'damaged' AS kind, event_id AS src_id, CASE WHEN event_type = 'click' THEN 'machine,timestamp,usage'
  WHEN event_type IN ('view', 'purchase', 'signup') THEN 'timestamp,usage' ELSE 'usage' END AS reason FROM t
UNION ALL SELECT 'document', doc_id, 'machine,timestamp,usage' FROM documents"""

# Metric samples.
_TOPIC, _PART, _GROUP = "event_type", "CAST(user_id % 3 AS INTEGER)", "'g' || (user_id % 2)"
_METRICS = [
    (LAG, _TOPIC, _PART, _GROUP, "event_id % 500"),
    (OFFSET, _TOPIC, _PART, "NULL", "event_id % 5000"),
    (UNDER_REPLICATED, _TOPIC, _PART, "NULL", "CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END"),
    (BROKERS, "NULL", "NULL", "NULL", "3"),
    (MEMBERS, "NULL", "NULL", _GROUP, "user_id % 5"),
]
M = (
    "m AS ("
    + " UNION ALL ".join(
        f"SELECT ts, event_id, '{metric}' AS metric, CAST({topic} AS VARCHAR) AS topic, "
        f"CAST({part} AS INTEGER) AS part, CAST({group} AS VARCHAR) AS consumergroup, "
        f"CAST({value} AS DOUBLE) AS value FROM events"
        for metric, topic, part, group, value in _METRICS
    )
    + ")"
)
NEWEST = """newest AS (SELECT * FROM m WHERE ts > (SELECT max(ts) - INTERVAL 6 HOUR FROM events) QUALIFY row_number() OVER (
  PARTITION BY metric, topic, part, consumergroup ORDER BY ts DESC, event_id DESC) = 1)"""
RATE = f"""{M}, steps AS (
  SELECT topic, part, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, ts, value,
    lag(value) OVER (PARTITION BY topic, part, time_bucket(INTERVAL 6 HOUR, ts) ORDER BY ts, event_id) AS before
  FROM m WHERE metric = '{OFFSET}'),
rates AS (
  SELECT topic, part, window_start,
    sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END)
      / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS rate
  FROM steps GROUP BY ALL HAVING max(ts) > min(ts))"""


# Every step of a grid, and what was newest at each.
STEPS = f"""{M}, steps AS (
  SELECT unnest(generate_series((SELECT min(ts) FROM events), (SELECT max(ts) FROM events), INTERVAL 2 HOUR)) AS step)"""
NEWEST_STEPS = f"""{STEPS}, newest AS (
  SELECT step, m.* FROM steps JOIN m ON m.ts <= step AND m.ts > step - INTERVAL 6 HOUR QUALIFY row_number() OVER (
    PARTITION BY step, metric, topic, part, consumergroup ORDER BY ts DESC, event_id DESC) = 1)"""
RATE_STEPS = f"""{STEPS}, inside AS (
  SELECT step, topic, part, ts, value, lag(value) OVER (PARTITION BY step, topic, part ORDER BY ts, event_id) AS before
  FROM steps JOIN m ON m.ts <= step AND m.ts > step - INTERVAL 5 HOUR WHERE metric = '{OFFSET}')
SELECT topic, part, step, round(sum(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END)
    / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 9) AS rate
FROM inside GROUP BY ALL HAVING max(ts) > min(ts)"""


def _sums(labels, metric):
    return f"SELECT {labels}, sum(value) AS total FROM newest WHERE metric = '{metric}' GROUP BY {labels}"


def _information(source, bins):
    """Mutual information per feature of rows ``(feature, x, label)``."""
    return f"""source AS ({source}),
span AS (SELECT feature, min(x) AS low, (max(x) - min(x)) / {bins} AS width FROM source GROUP BY feature),
cells AS (SELECT feature, label, CASE WHEN width <= 0 THEN 0
    ELSE least(greatest(CAST(floor((x - low) / width) AS INTEGER), 0), {bins - 1}) END AS bin
  FROM source JOIN span USING (feature)),
joint AS (SELECT feature, bin, label, count(*) AS n FROM cells GROUP BY ALL),
shares AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS whole,
    sum(n) OVER (PARTITION BY feature, bin) AS in_bin, sum(n) OVER (PARTITION BY feature, label) AS of_label
  FROM joint),
information AS (SELECT feature,
    sum(n * ln(CAST(n * whole AS DOUBLE) / (CAST(in_bin AS DOUBLE) * of_label))) / max(whole) AS mi
  FROM shares GROUP BY feature)"""


def _catalog():
    """(column, group, influence, tier) of all metrics as VALUES."""
    rows = []
    for column, name in NAME_OF.items():
        group, influence = next(((g, i) for g, (i, names) in GROUPS.items() if name in names), (None, None))
        tier = next((t for t, (_, names) in TIERS.items() if name in names), None)
        texts = [f"'{v}'" if v else "NULL::VARCHAR" for v in (column, group, influence)]
        rows.append(f"({', '.join(texts)}, {tier or 'NULL::INTEGER'})")
    return f"(VALUES {', '.join(rows)}) AS c(col, feature_group, influence, tier)"


# One row per sample and metric.
_NAMES, _VALUES = f"UNNEST([{_listed(FEATURES)}])", f"UNNEST([{', '.join(FEATURES)}])"
_LABELLED = f"SELECT label, {_NAMES} AS feature, {_VALUES} AS x FROM t"
_TRAIN_STORED = f"WITH {T} SELECT {_STORED} FROM t WHERE split = 'train'"

def _neighbours(source, k=3):
    """Mutual information by the ``k`` nearest rows of a label, of rows ``(feature, x, label)``."""
    return f"""source AS ({source}),
cells AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY feature, label ORDER BY x) AS i FROM (
  SELECT feature, label, x, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature, label) AS of_label FROM source GROUP BY feature, label, x)
  WHERE of_label > 1),
offs AS (SELECT unnest(range(-{k}, {k + 1})) AS off),
around AS MATERIALIZED (SELECT c.feature, c.label, c.x, c.n, o.x AS ox, abs(o.x - c.x) AS d,
    coalesce(sum(o.n) OVER (PARTITION BY c.feature, c.label, c.x ORDER BY abs(o.x - c.x), o.x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + c.n - 1 AS seen
  FROM (SELECT *, i + off AS j FROM cells, offs WHERE off <> 0) c JOIN cells o ON o.feature = c.feature AND o.label = c.label AND o.i = c.j),
radii AS (SELECT c.feature, c.label, c.x, c.n, c.of_label, coalesce(max(a.d) FILTER (a.seen < {k}), 0) AS r
  FROM cells c LEFT JOIN around a ON a.feature = c.feature AND a.label = c.label AND a.x = c.x GROUP BY ALL),
spans AS MATERIALIZED (SELECT r.feature, r.label, r.x, r.n, r.of_label, r.r,
    CASE WHEN r.r = 0 THEN r.x ELSE coalesce(max(a.ox) FILTER (a.d = r.r AND a.ox < a.x), r.x - r.r) END AS low,
    CASE WHEN r.r = 0 THEN r.x ELSE coalesce(min(a.ox) FILTER (a.d = r.r AND a.ox > a.x), r.x + r.r) END AS high
  FROM radii r LEFT JOIN around a ON a.feature = r.feature AND a.label = r.label AND a.x = r.x
  GROUP BY r.feature, r.label, r.x, r.n, r.of_label, r.r),
below AS MATERIALIZED (SELECT feature, x AS v, sum(sum(n)) OVER (PARTITION BY feature ORDER BY x) AS upto, sum(n) AS here FROM cells GROUP BY feature, x),
lows AS (SELECT s.*, coalesce(b.upto, 0) AS to_low FROM spans s ASOF LEFT JOIN below b ON s.feature = b.feature AND s.low >= b.v),
both_ends AS (SELECT s.*, b.upto AS to_high FROM lows s ASOF LEFT JOIN below b ON s.feature = b.feature AND s.high > b.v),
within AS (SELECT s.*, CASE WHEN r = 0 THEN b.here ELSE to_high - to_low END AS m FROM both_ends s JOIN below b ON s.feature = b.feature AND s.x = b.v),
psi AS MATERIALIZED (SELECT i, -0.57721566490153286::DOUBLE + coalesce(sum(1.0::DOUBLE / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
  FROM (SELECT unnest(range(1, (SELECT count(*) + 2 FROM source))) AS i)),
totals AS (SELECT feature, sum(n) AS whole FROM cells GROUP BY feature),
information AS (SELECT feature, greatest(0.0::DOUBLE, max(pn.p) + sum(n * (pk.p - pl.p - pm.p)) / max(whole)) AS mi
  FROM within JOIN totals USING (feature) JOIN psi pn ON pn.i = whole JOIN psi pm ON pm.i = m
  JOIN psi pl ON pl.i = of_label JOIN psi pk ON pk.i = least({k}, of_label - 1) GROUP BY feature)"""


def _component(source, k=10):
    """Absolute loadings in the first principal component of rows ``(id, feature, x)``: the covariance matrix,
    squared and normalised 20 times, leaves that component in each column."""
    steps = ["""c AS (SELECT id, feature, x - avg(x) OVER (PARTITION BY feature) AS x FROM source)""",
        "m0 AS MATERIALIZED (SELECT a.feature AS i, b.feature AS j, sum(a.x * b.x) AS v FROM c a JOIN c b USING (id) GROUP BY ALL)"]
    for n in range(20):
        steps.append(f"p{n} AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM m{n} a JOIN m{n} b ON a.j = b.i GROUP BY ALL)")
        steps.append(f"m{n + 1} AS MATERIALIZED (SELECT i, j, v / max(abs(v)) OVER () AS v FROM p{n})")
    return f"""WITH {source}, {', '.join(steps)},
led AS (SELECT i AS feature, v FROM m20 WHERE j = (SELECT i FROM m20 WHERE i = j ORDER BY v DESC, i LIMIT 1)),
loadings AS (SELECT feature, abs(v) / sqrt(sum(v * v) OVER ()) AS importance FROM led)
SELECT feature, round(importance, 6) AS importance FROM loadings ORDER BY loadings.importance DESC, feature LIMIT {k}"""


ORACLES = {
    "pca_loadings": _component(
        "source AS (SELECT vec_id AS id, 'd' || (generate_subscripts(embedding, 1) - 1) AS feature, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"
    ),
    "job_feature_rank_component": _component(
        f"{T}, named(col, feature) AS (VALUES {', '.join(f'({c!r}, {n!r})' for c, n in NAME_OF.items())}), "
        f"source AS (SELECT id, named.feature, coalesce(x, 0) AS x FROM (SELECT event_id AS id, {_NAMES} AS col, {_VALUES} AS x FROM t) JOIN named USING (col))"
    ),
    "scan_topic_batch": f"WITH {T} SELECT 'telemetry' AS topic, event_id AS \"offset\", machine || '-' || split AS msg_key FROM t",
    "stream_topic_scan": f"WITH {T} SELECT 'telemetry' AS topic, event_id AS \"offset\", machine || '-' || split AS msg_key FROM t",
    "stream_resume": f"WITH {T} SELECT machine, tick, split, event_id FROM t",
    "scan_csv_train": f"WITH {T} SELECT machine, tick, 0 AS label, col_0 FROM t WHERE split = 'train'",
    "scan_csv_test": f"WITH {T} SELECT machine, tick, label, col_0 FROM t WHERE split = 'test'",
    "scan_csv_by_name": f"WITH {T} SELECT machine, tick, label, col_0, col_37 FROM t WHERE split = 'test'",
    "scan_table_query": f"WITH {T} SELECT machine, tick, split, col_0 FROM t WHERE split = 'train' AND col_0 >= 10",
    "scan_table_ranges": f"WITH {T} SELECT {_STORED} FROM t",
    "scan_table": f"WITH {T} SELECT {_STORED} FROM t",
    "scan_table_pushdown": f"{_TRAIN_STORED} AND send_ts >= {CUT}",
    "scan_metric_samples": f"WITH {M} SELECT ts, metric, topic, part, consumergroup, value FROM m",
    "sink_append": f"WITH {T} SELECT {_STORED} FROM t",
    "merge_insert_if_absent": MERGED,
    "merge_bucketed": MERGED,
    "merge_compacted": BY_KIND,
    "stream_merge_runs": MERGED,
    "merge_into_empty": DEDUPED,
    "merge_twice": DEDUPED,
    "sink_insert_strict_conflicts": f"""WITH {T}, {EARLY}, counted AS (
  SELECT machine, tick, split, count(*) AS n FROM t GROUP BY ALL)
SELECT machine, tick, split, n, e.machine IS NOT NULL AS in_target
FROM counted LEFT JOIN (SELECT machine, tick, split FROM early) e USING (machine, tick, split)
WHERE n > 1 OR e.machine IS NOT NULL""",
    "ensure_table_idempotent": f"WITH {T}, {EARLY} SELECT count(*) AS n FROM early",
    "sink_topic_envelope": f"WITH {T} SELECT 'telemetry' AS topic, event_id AS \"offset\", machine || '-' || split AS msg_key, send_text FROM t",
    "sink_topic_sent_once": f"""WITH {T}, parted AS (
  SELECT *, event_type IN ({_listed(EARLIER)}) AS old FROM t
), span AS (SELECT coalesce(max(event_id) + 1, 0) AS width FROM parted WHERE old)
SELECT 'telemetry' AS topic, event_id + CASE WHEN old THEN 0 ELSE width END AS "offset", machine || '-' || split AS msg_key, send_text FROM parted, span""",
    "export_published": f"WITH {T} SELECT {_STORED}, label FROM t WHERE split = 'train'",
    "export_published_csv": f"WITH {T} SELECT {_STORED}, label FROM t WHERE split = 'train'",
    "export_csv_roundtrip": f"WITH {T} SELECT {_STORED}, label FROM t WHERE split = 'train'",
    "export_parquet_roundtrip": f"WITH {T} SELECT {_STORED}, label FROM t WHERE split = 'train'",
    "preview_topn": f"WITH {T} SELECT machine, tick, split, event_id FROM t ORDER BY machine, tick, split, event_id LIMIT 10",
    "decode_strict": STRICT,
    "decode_lenient": LENIENT,
    "parse_timestamp": "SELECT event_id, 0 AS place, ts FROM events UNION ALL SELECT event_id, 1, try_cast(event_type AS TIMESTAMP) FROM events",
    "select_prefix": f"WITH {T} SELECT event_id, {', '.join(FEATURES)} FROM t",
    "conform_columns": f"WITH {T} SELECT event_id, send_ts, machine, tick, split, label, col_0, NULL::DOUBLE AS col_1, col_2 FROM t",
    "sniff_number": """WITH texts AS (
  SELECT event_id, 'k' AS field, json_extract_string(props, '$.k') AS text FROM events
  UNION ALL SELECT event_id, 'value', printf('%.2f', value) FROM events
  UNION ALL SELECT event_id, 'type', event_type FROM events)
SELECT event_id, field,
  CASE WHEN regexp_matches(text, '[.eE]') THEN CASE WHEN try_cast(text AS DOUBLE) IS NULL THEN 'string' ELSE 'float' END
    WHEN try_cast(text AS BIGINT) IS NULL THEN 'string' ELSE 'int' END AS kind,
  try_cast(text AS DOUBLE) AS num FROM texts""",
    "parse_fields": f"WITH {T} SELECT event_id, machine, tick, split, label, col_0, col_37 FROM t",
    "tag_split": f"WITH {T} SELECT event_id, 'train' AS split, 0.0::DOUBLE AS label FROM t",
    "stamp_send_time": "SELECT event_id, '2024-02-01T12:00:00.500000' AS send_text FROM events",
    "encode_decode_roundtrip": f"WITH {T} SELECT event_id, send_text, col_0, col_1, col_37 FROM t",
    "rename_features": f"WITH {T} SELECT event_id, {', '.join(f'{c} AS {n}' for c, n in NAME_OF.items())} FROM t",
    "feature_group_select": f"WITH {T} SELECT event_id, {', '.join(group_columns('disk_io'))} FROM t",
    "feature_catalog_stats": f"""WITH {T}, x AS (SELECT {_NAMES} AS col, {_VALUES} AS x FROM t)
SELECT feature_group, influence, tier, count(x) AS n, round(sum(x) / count(x), 6) AS mean
FROM x JOIN {_catalog()} USING (col) GROUP BY ALL""",
    "fill_missing": f"WITH {T} SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE col_0 END AS col_0 FROM t",
    "filter_recent": f"SELECT event_id FROM events WHERE ts >= {CUT}",
    "filter_split": f"WITH {T} SELECT event_id, split FROM t WHERE split = 'train'",
    "quarantine_rows": QUARANTINE,
    "empty_input": "SELECT count(*) AS n FROM events WHERE ts >= (SELECT max(ts) + INTERVAL 1 DAY FROM events)",
    "metric_label_match": f"WITH {M} SELECT event_id, topic, part, consumergroup, value FROM m WHERE metric = '{LAG}' AND consumergroup = 'g1' AND topic IN ('click', 'view')",
    "conflict_anti_join": f"WITH {T}, {EARLY} SELECT machine, tick, split, event_id FROM t WHERE NOT {_HELD}",
    "conflict_semi_join": f"WITH {T}, {EARLY} SELECT machine, tick, split, event_id FROM t WHERE {_HELD}",
    "dedup_first_wins": f"WITH {T}, {FIRST} SELECT machine, tick, split, event_id, col_0 FROM firsts",
    "stage_counts": f"""WITH {T}, recent AS (SELECT * FROM t WHERE send_ts >= {CUT}),
train AS (SELECT * FROM recent WHERE split = 'train')
SELECT 'loaded' AS stage, count(*) AS n FROM t UNION ALL SELECT 'recent', count(*) FROM recent
UNION ALL SELECT 'train', count(*) FROM train
UNION ALL SELECT 'distinct_keys', count(*) FROM (SELECT DISTINCT machine, tick, split FROM train)""",
    "load_rate_by_day": f"WITH {T} SELECT tick, count(*) AS n, round(count(*) / 86400.0::DOUBLE, 9) AS rows_per_s FROM t GROUP BY tick",
    "stream_merge": MERGED,
    "stream_merge_chunked": _KEYS,
    "stream_dedup_watermark": f"WITH {T} SELECT DISTINCT machine, tick, split FROM t",
    "stream_batch_counts": f"""SELECT 0::BIGINT AS batch, count(*) AS n FROM events WHERE event_type IN ({_listed(EARLIER)})
UNION ALL SELECT 1, count(*) FROM events WHERE event_type NOT IN ({_listed(EARLIER)})""",
    "stream_quarantine": QUARANTINE,
    "latest_by_series": f"WITH {M}, {NEWEST} SELECT metric, topic, part, consumergroup, ts, value FROM newest",
    "latest_gauges": f"WITH {M}, {NEWEST} SELECT metric, consumergroup, ts, value FROM newest WHERE metric IN ('{BROKERS}', '{MEMBERS}')",
    "lag_by_group": f"WITH {M}, {NEWEST} {_sums('consumergroup', LAG)}",
    "lag_by_group_topic": f"WITH {M}, {NEWEST} {_sums('consumergroup, topic', LAG)}",
    "under_replicated_by_topic": f"WITH {M}, {NEWEST} {_sums('topic', UNDER_REPLICATED)}",
    "counter_rate": f"WITH {RATE} SELECT topic, part, window_start, round(rate, 9) AS rate FROM rates",
    "latest_by_series_steps": f"""WITH {NEWEST_STEPS} SELECT metric, topic, part, consumergroup, step, ts, value FROM newest
WHERE metric IN ('{UNDER_REPLICATED}', '{MEMBERS}')""",
    "lag_by_group_steps": f"WITH {NEWEST_STEPS} {_sums('consumergroup, step', LAG)}",
    "alert_steps": f"""WITH {NEWEST_STEPS}, lag AS ({_sums('consumergroup, step', LAG)}), replicas AS ({_sums('topic, step', UNDER_REPLICATED)})
SELECT 'lag' AS rule, consumergroup AS name, step, total FROM lag WHERE total >= 3000
UNION ALL SELECT 'high lag', consumergroup, step, total FROM lag WHERE total >= 4000
UNION ALL SELECT 'under_replicated', topic, step, total FROM replicas WHERE total > 0""",
    "counter_rate_steps": f"WITH {RATE_STEPS}",
    "topic_rate": f"WITH {RATE} SELECT topic, window_start, round(sum(rate), 9) AS rate FROM rates GROUP BY ALL",
    "alert_rows": f"""WITH {M}, {NEWEST}, lag AS ({_sums('consumergroup', LAG)}), replicas AS ({_sums('topic', UNDER_REPLICATED)})
SELECT 'lag' AS rule, consumergroup AS name, total FROM lag WHERE total >= 500
UNION ALL SELECT 'high lag', consumergroup, total FROM lag WHERE total >= 1500
UNION ALL SELECT 'under_replicated', topic, total FROM replicas WHERE total > 0""",
    "mutual_information": "WITH "
    + _information(
        "SELECT 'd' || (generate_subscripts(embedding, 1) - 1) AS feature, CAST(unnest(embedding) AS DOUBLE) AS x, label FROM embeddings", 4
    )
    + " SELECT feature, round(mi, 9) AS mi FROM information",
    "neighbour_information": "WITH "
    + _neighbours("SELECT 'd' || (generate_subscripts(embedding, 1) - 1) AS feature, CAST(unnest(embedding) AS DOUBLE) AS x, label FROM embeddings")
    + " SELECT feature, round(mi, 9) AS mi FROM information",
    "topk_features": f"""WITH {T}, means AS (SELECT machine, avg(col_0) AS mean FROM t GROUP BY machine)
SELECT machine, round(mean, 6) AS mean FROM means ORDER BY means.mean DESC, machine LIMIT 10""",
    "file_order": f"""WITH {T} SELECT machine, tick, event_id FROM t
QUALIFY row_number() OVER (PARTITION BY machine, tick ORDER BY event_type, event_id) = 1""",
    "union_splits": f"WITH {T} SELECT machine, tick, split, CASE WHEN split = 'train' THEN 0.0 ELSE label END::DOUBLE AS label, col_0 FROM t",
    "job_backfill_append": f"""WITH {T}, recent AS (SELECT * FROM t WHERE send_ts >= {CUT})
SELECT {_STORED} FROM recent QUALIFY {_FIRST} = 1""",
    "job_backfill_merge": f"""WITH {T}, {EARLY}, both_sides AS (
  SELECT 0 AS side, {_STORED}, event_id FROM early UNION ALL SELECT 1, {_STORED}, event_id FROM t WHERE send_ts >= {CUT})
SELECT {_STORED} FROM both_sides
QUALIFY row_number() OVER (PARTITION BY machine, tick, split ORDER BY side, event_id) = 1""",
    "job_stream_ingest": DEDUPED,
    "job_consume_merge": f"WITH {T}, {FIRST} SELECT machine, tick, split, send_ts, label FROM firsts",
    "job_export_train": f"{_TRAIN_STORED} AND send_ts >= {CUT}",
    "job_export_train_csv": f"{_TRAIN_STORED} AND send_ts >= {CUT}",
    "job_csv_to_topic": f"""WITH {T} SELECT machine, tick, split, 0.0::DOUBLE AS label, col_0 FROM t WHERE split = 'train'
QUALIFY row_number() OVER (PARTITION BY machine, tick ORDER BY CASE WHEN event_type IN ({_listed(EARLIER)}) THEN 0 ELSE 1 END, event_id) = 1""",
    "job_csv_conflicts": f"""WITH {T} SELECT machine, tick, split, count(*) AS n, true AS in_target FROM t WHERE split = 'train' GROUP BY ALL""",
    "job_csv_quarantine": f"WITH {T} SELECT DISTINCT machine, tick, 'bad-' || event_id AS text FROM t WHERE event_type = 'error'",
    "machine_of_any_folder": f"WITH {T} SELECT 'db ' || substr(machine, 9) AS machine, tick, label, col_0 FROM t WHERE split = 'test'",
    "scan_csv_headers": f"""WITH {T} SELECT machine, tick, CASE WHEN split = 'test' THEN label END AS label, CASE WHEN split = 'test' THEN col_0 END AS col_0,
  CASE WHEN split = 'train' THEN col_1 END AS col_1, CASE WHEN split = 'train' THEN 'string' END AS kind, CASE WHEN split = 'train' THEN event_type END AS text FROM t""",
    "job_load_rate": f"WITH {T} SELECT {_STORED} FROM t",
    "stream_recent": f"""WITH {T}, recent AS (SELECT * FROM t WHERE send_ts >= {CUT})
SELECT {_STORED} FROM recent QUALIFY {_FIRST} = 1""",
    "job_backfill_quarantine": f"SELECT kind, src_id, reason || ',send_timestamp' AS reason FROM ({QUARANTINE})",
    "job_csv_to_table": f"""WITH {T}, {FIRST} SELECT machine, tick, split, TIMESTAMP '2024-02-01 00:00:00' AS send_ts, col_0
FROM firsts WHERE split = 'train'""",
    "job_feature_rank": f"WITH {T}, "
    + _information(_LABELLED, 10)
    + f", named(col, feature_name) AS (VALUES {', '.join(f'({c!r}, {n!r})' for c, n in NAME_OF.items())})"
    + """ SELECT feature_name AS feature, round(mi, 9) AS mi FROM information JOIN named ON feature = col
ORDER BY information.mi DESC, feature_name LIMIT 10""",
    "job_feature_rank_neighbours": f"WITH {T}, "
    + _neighbours(_LABELLED)
    + f", named(col, feature_name) AS (VALUES {', '.join(f'({c!r}, {n!r})' for c, n in NAME_OF.items())})"
    + """ SELECT feature_name AS feature, round(mi, 9) AS mi FROM information JOIN named ON feature = col
ORDER BY information.mi DESC, feature_name LIMIT 10""",
}
