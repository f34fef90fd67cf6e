"""The registered queries in plain SQL, for comparison in another engine.

Written from the definitions, not from the Spark plans: joins make all pairs,
windows come straight from the samples, nothing is split into blocks.
"""

from __future__ import annotations

from vigil.fixed_values import (
    CPU_MEM_ALERTS,
    DEFAULT_DATE,
    FAMILY_METRICS,
    MISSING_THRESHOLD,
    NET_DISK_ALERTS,
    THRESHOLDS,
    TOPICS,
)
from vigil.workload.telemetry import FIRST_SECOND, LATER_THRESHOLDS, ODD_SERVERS

TELEMETRY = f"""
cents AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events),
hundredths AS (
  SELECT event_id, event_type, user_id, props, c,
    {FIRST_SECOND} + event_id // 2 AS ts_sec,
    'srv-' || CAST(user_id % 5 AS VARCHAR) AS server_id,
    (c * 37) % 4000 + 6000 AS cpu_pct,
    (c * 91 + event_id * 13) % 4000 + 6000 AS mem_pct,
    (c * 53 + event_id * 7) % 560000 AS net_in,
    (c * 41 + event_id * 11) % 560000 AS net_out,
    (c * 29 + event_id * 17) % 280000 AS disk_io
  FROM cents),
telemetry AS (
  SELECT event_id, event_type, ts_sec, server_id,
    strftime(make_timestamp(ts_sec * 1000000), '%Y-%m-%d %H:%M:%S') AS ts,
    CAST(cpu_pct / 100.0 AS FLOAT) AS cpu_pct,
    CAST(mem_pct / 100.0 AS FLOAT) AS mem_pct,
    CAST(net_in / 100.0 AS FLOAT) AS net_in,
    CAST(net_out / 100.0 AS FLOAT) AS net_out,
    CAST(disk_io / 100.0 AS FLOAT) AS disk_io
  FROM hundredths)"""


def _side(family: str, table: str = "telemetry", whole: bool = False) -> str:
    """All samples of a family; ``whole``: of all events."""
    where = " WHERE event_type <> 'error'" if family in ("mem", "disk") and not whole else ""
    return f"SELECT event_id, server_id, ts_sec, ts, {', '.join(FAMILY_METRICS[family])} FROM {table}{where}"


def _first(
    family: str, table: str = "telemetry", key: str = "ts_sec", order: str = "event_id", whole: bool = False
) -> str:
    return (
        f"SELECT * FROM ({_side(family, table, whole)}) s "
        f"QUALIFY row_number() OVER (PARTITION BY server_id, {key} ORDER BY {order}) = 1"
    )


def _peak(family: str, tenths: bool) -> str:
    """The order of samples without a position: by time, then the largest."""
    return ("9 - event_id % 3, " if tenths else "") + f"{FAMILY_METRICS[family][0]} DESC"


def _joined(left: str, right: str, unique: bool = True, table: str = "telemetry") -> str:
    pick = _first if unique else _side
    metrics = ", ".join(FAMILY_METRICS[left] + FAMILY_METRICS[right])
    return f"""
joined AS (
  SELECT l.server_id AS server_id, l.ts_sec AS ts_sec, {metrics}
  FROM ({pick(left, table)}) l JOIN ({pick(right, table)}) r
    ON l.server_id = r.server_id AND l.ts_sec = r.ts_sec)"""


def _assigned(size: int = 30, slide: int = 10, offset: int = 0, clamp: bool = True) -> str:
    """Joined samples by window; steps run over all starts a window could have."""
    steps = (size + slide - 1) // slide + 1
    last = f"(ts_sec - (ts_sec - {offset}) % {slide})"
    first = f"(SELECT min(ts_sec) // {slide} * {slide} FROM joined)"
    bound = f"({first} - {offset}) // {slide} * {slide} + {offset}"
    clamped = f" AND window_start >= {bound}" if clamp else ""
    return f"""
assigned AS (
  SELECT *, window_start + {size} AS window_end
  FROM (SELECT j.*, {last} - {slide} * CAST(step AS BIGINT) AS window_start
        FROM joined j, range({steps}) AS steps(step)) w
  WHERE window_start <= ts_sec AND ts_sec < window_start + {size}{clamped})"""


def _mean(metric: str) -> str:
    return f"CAST(round(CAST(avg(CAST({metric} AS DOUBLE)) AS DECIMAL(18, 10)), 2) AS DOUBLE)"


def _stats(left: str, right: str, left_name: str, right_name: str) -> str:
    return f"""
stats AS (
  SELECT server_id, window_start, window_end,
    {_mean(left)} AS avg_{left_name}, {_mean(right)} AS avg_{right_name},
    max({left}) AS max_{left_name}, max({right}) AS max_{right_name}
  FROM assigned GROUP BY server_id, window_start, window_end)"""


def _strict_case(left: str, right: str, left_limit: str, right_limit: str) -> str:
    both, left_only, right_only = CPU_MEM_ALERTS
    return f"""CASE
    WHEN {left} > {left_limit} AND {right} > {right_limit} THEN '{both}'
    WHEN {left} > {left_limit} AND {right} <= {right_limit} THEN '{left_only}'
    WHEN {right} > {right_limit} AND {left} <= {left_limit} THEN '{right_only}'
    ELSE '' END"""


def _loose_case(left: str, right: str, left_limit: str, right_limit: str) -> str:
    both, left_only, right_only = NET_DISK_ALERTS
    return f"""CASE
    WHEN {left} > {left_limit} AND {right} > {right_limit} THEN '{both}'
    WHEN {left} > {left_limit} THEN '{left_only}'
    WHEN {right} > {right_limit} THEN '{right_only}'
    ELSE '' END"""


def _limit(name: str) -> str:
    return f"CAST({THRESHOLDS[name]} AS DOUBLE)"


CPU_MEM_CASE = _strict_case("avg_cpu", "avg_mem", _limit("cpu_threshold"), _limit("mem_threshold"))
NET_DISK_CASE = _loose_case(
    "CAST(max_net_in AS DOUBLE)",
    "CAST(max_disk_io AS DOUBLE)",
    _limit("net_in_threshold"),
    _limit("disk_io_threshold"),
)


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join([TELEMETRY, *parts]) + "\n" + select


def _cpu_mem(select: str, table: str = "telemetry", extra: tuple[str, ...] = ()) -> str:
    return _with(
        *extra,
        _joined("cpu", "mem", table=table),
        _assigned(),
        _stats("cpu_pct", "mem_pct", "cpu", "mem"),
        f"alerts AS (SELECT *, {CPU_MEM_CASE} AS alert FROM stats)",
        select=select,
    )


def _net_disk(select: str, unique: bool = True) -> str:
    return _with(
        _joined("net", "disk", unique),
        _assigned(),
        _stats("net_in", "disk_io", "net_in", "disk_io"),
        f"alerts AS (SELECT *, {NET_DISK_CASE} AS alert FROM stats)",
        select=select,
    )


def _window_counts(**window) -> str:
    return _with(
        _joined("cpu", "mem"),
        _assigned(**window),
        select="SELECT server_id, window_start, window_end, count(*) AS samples FROM assigned "
        "GROUP BY server_id, window_start, window_end",
    )


def _sent(conditions: dict[str, str], source: str) -> str:
    """One row per sent record, as decoded with all metrics in one schema."""
    every = [m for metrics in FAMILY_METRICS.values() for m in metrics]
    selects = []
    for family, metrics in FAMILY_METRICS.items():
        columns = ", ".join(
            f"CAST({m} AS FLOAT) AS {m}" if m in metrics else f"CAST(NULL AS FLOAT) AS {m}" for m in every
        )
        selects.append(
            f"SELECT '{TOPICS[family]}' AS topic, ts, server_id, {columns} FROM {source} WHERE {conditions[family]}"
        )
    return "\nUNION ALL\n".join(selects)


def _dataset() -> str:
    day = DEFAULT_DATE
    numbers = ", ".join(f"{m} / 100.0 AS {m}" for metrics in FAMILY_METRICS.values() for m in metrics)
    return f"""
dataset AS (
  SELECT event_id, server_id, {numbers},
    CASE WHEN event_id % 3 = 0
      THEN '{day} ' || strftime(make_timestamp(ts_sec * 1000000), '%H:%M:%S')
      ELSE strftime(make_timestamp(ts_sec * 1000000), '%Y-%m-%d %H:%M:%S') END AS ts
  FROM hundredths)"""


def _fanout_bad_rows() -> str:
    broken = """
broken AS (
  SELECT event_id, server_id, ts,
    CASE WHEN event_id % 23 = 0 THEN 5.0 ELSE cpu_pct END AS cpu_pct, mem_pct,
    CASE WHEN event_id % 19 = 0 THEN 1000.0 ELSE net_in END AS net_in, net_out,
    CASE WHEN event_id % 7 = 0 THEN 10.0 ELSE disk_io END AS disk_io
  FROM dataset WHERE event_id % 31 <> 0)"""
    cpu = "event_id % 13 <> 0"
    mem = f"{cpu} AND event_id % 17 <> 0"
    net = f"{mem} AND event_id % 11 <> 0 AND event_id % 37 <> 0"
    disk = f"{net} AND event_id % 29 <> 0"
    sent = _sent({"cpu": cpu, "mem": mem, "net": net, "disk": disk}, "broken")
    return _with(_dataset(), broken, select=sent)


def _snapshot(family: str) -> str:
    metrics = ", ".join(FAMILY_METRICS[family])
    return _with(select=f"SELECT ts, server_id, {metrics} FROM ({_first(family, key='ts', whole=True)}) f")


def _copies() -> str:
    sums = ", ".join(
        f"sum(CAST({m} AS DOUBLE)) AS {m}_sum, count({m}) AS {m}_count, max({m}) AS {m}_max"
        for m in FAMILY_METRICS["net"] + FAMILY_METRICS["disk"]
    )
    return _with(
        _joined("net", "disk", unique=False),
        select=f"SELECT server_id, ts_sec, count(*) AS pairs, {sums} FROM joined GROUP BY server_id, ts_sec",
    )


def _threshold_table() -> str:
    columns = ", ".join(
        f"max_by(CAST(c AS DOUBLE), event_id) FILTER (WHERE event_type = '{e}') AS {e}_threshold"
        for e in ("click", "error", "purchase", "signup", "view")
    )
    return _with(
        select=f"SELECT {columns}, CAST({MISSING_THRESHOLD} AS DOUBLE) AS absent_threshold "
        "FROM hundredths WHERE event_id % 10 <> 0"
    )


THREE_DAYS = (
    "three_days AS (SELECT * REPLACE (ts_sec + 86400 * (event_id % 3) AS ts_sec) FROM telemetry)",
)

EPOCH_REPORT = "SELECT * FROM alerts"


def _summary(report: str) -> str:
    return (
        f"SELECT '{report}' AS report, count(*) AS total_rows, "
        "count(*) FILTER (WHERE alert <> '') AS alert_rows FROM alerts"
    )


def _pairs(left: str, right: str, left_name: str, right_name: str, source: str) -> str:
    limits = _limit(left_name), _limit(right_name)
    l, r = "CAST(left_value AS DOUBLE)", "CAST(right_value AS DOUBLE)"
    return _with(
        f"pairs AS (SELECT event_id, {left} AS left_value, {right} AS right_value FROM {source})",
        select=f"""SELECT event_id, left_value, right_value,
  {_strict_case(l, r, *limits)} AS needs_both, {_loose_case(l, r, *limits)} AS "either"
FROM pairs""",
    )


def _without_position(tenths: bool) -> str:
    """The CPU and memory report on samples that have no ingest position."""
    sides = [_first(f, order=_peak(f, tenths)) for f in ("cpu", "mem")]
    joined = f"""
joined AS (
  SELECT l.server_id AS server_id, l.ts_sec AS ts_sec, cpu_pct, mem_pct
  FROM ({sides[0]}) l JOIN ({sides[1]}) r ON l.server_id = r.server_id AND l.ts_sec = r.ts_sec)"""
    return _with(
        joined,
        _assigned(),
        _stats("cpu_pct", "mem_pct", "cpu", "mem"),
        f"alerts AS (SELECT *, {CPU_MEM_CASE} AS alert FROM stats)",
        select=EPOCH_REPORT,
    )


def _odd_text() -> str:
    names = ", ".join("'" + n + "'" for n in ODD_SERVERS)
    return _with(
        f"odd AS (SELECT * REPLACE ((ARRAY[{names}])[event_id % {len(ODD_SERVERS)} + 1] AS server_id) FROM telemetry)",
        select=f"SELECT ts, server_id, cpu_pct FROM ({_first('cpu', 'odd', 'ts')}) f",
    )


BROKEN = (
    "broken AS (SELECT * FROM telemetry WHERE event_id % 7 <> 0 AND event_id % 11 <> 0)",
)


def _collapsed(shift: int) -> str:
    """Time-of-day labels on a clock `shift` seconds ahead of UTC."""
    clock = [f"strftime(make_timestamp(({c} + {shift}) * 1000000), '%H:%M:%S') AS {c}" for c in ("window_start", "window_end")]
    return _cpu_mem(
        f"""SELECT * REPLACE ({', '.join(clock)})
FROM alerts QUALIFY row_number() OVER (PARTITION BY server_id, window_start % 86400 ORDER BY window_start) = 1""",
        "three_days",
        THREE_DAYS,
    )


def _versions() -> str:
    """Thresholds by the end of each window."""
    first = "(SELECT max(event_id) // 2 // 2 FROM events)"
    later = f"window_end >= {FIRST_SECOND} + {first}"
    limits = [f"CASE WHEN {later} THEN CAST({LATER_THRESHOLDS[n]} AS DOUBLE) ELSE {_limit(n)} END" for n in ("cpu_threshold", "mem_threshold")]
    judged = _strict_case("avg_cpu", "avg_mem", "cpu_limit", "mem_limit")
    return _cpu_mem(
        f"""SELECT * EXCLUDE (cpu_limit, mem_limit) REPLACE ({judged} AS alert)
FROM (SELECT *, {limits[0]} AS cpu_limit, {limits[1]} AS mem_limit FROM alerts) a"""
    )


LARGE = _with(
    """
odd AS (
  SELECT server_id, ts_sec, CAST(CASE WHEN event_id % 97 = 0 THEN 'nan' WHEN event_id % 89 = 0 THEN 'inf'
    WHEN event_id % 83 = 0 THEN '-inf' WHEN event_id % 4 = 0 THEN '2e10' WHEN event_id % 4 = 1 THEN '9e10'
    WHEN event_id % 4 = 2 THEN '-3e38' ELSE CAST(cpu_pct AS VARCHAR) END AS FLOAT) AS value
  FROM telemetry),
largest AS (SELECT server_id, ts_sec, max(value) AS value FROM odd GROUP BY server_id, ts_sec)""",
    select="""SELECT server_id, ts_sec,
  CASE WHEN isnan(value) THEN 'NaN' WHEN value = 'inf' THEN 'Infinity' WHEN value = '-inf' THEN '-Infinity' END AS odd,
  CASE WHEN isfinite(value) THEN CAST(value AS DOUBLE) END AS number FROM largest""",
)


def _exact_side(family: str, metric: str) -> str:
    steps = f"sum(CAST(CAST({metric} AS DOUBLE) * 1073741824 AS HUGEINT))"
    return (
        f"SELECT server_id, ts_sec, count(*) AS n, {steps} AS steps, max({metric}) AS most "
        f"FROM ({_side(family, 'few')}) s GROUP BY server_id, ts_sec"
    )


def _exact_mean(side: str, other: str) -> str:
    total = f"CAST(sum({side}_steps * {other}_n) AS DOUBLE) / 1073741824"
    return f"CAST(round(CAST({total} / sum(l_n * r_n) AS DECIMAL(18, 10)), 2) AS DOUBLE)"


EXACT = _with(
    f"""
few AS (SELECT * REPLACE ('srv-' || CAST(event_id % 2 AS VARCHAR) AS server_id, {FIRST_SECOND} + event_id // 2 % 20 * 3 AS ts_sec) FROM telemetry),
joined AS (
  SELECT l.server_id AS server_id, l.ts_sec AS ts_sec, CAST(l.n AS HUGEINT) AS l_n, CAST(r.n AS HUGEINT) AS r_n,
    l.steps AS l_steps, r.steps AS r_steps, l.most AS l_most, r.most AS r_most
  FROM ({_exact_side('net', 'net_in')}) l JOIN ({_exact_side('disk', 'disk_io')}) r ON l.server_id = r.server_id AND l.ts_sec = r.ts_sec)""",
    _assigned(),
    f"""
stats AS (
  SELECT server_id, window_start, window_end, {_exact_mean('l', 'r')} AS avg_net_in, {_exact_mean('r', 'l')} AS avg_disk_io,
    max(l_most) AS max_net_in, max(r_most) AS max_disk_io
  FROM assigned GROUP BY server_id, window_start, window_end)""",
    f"alerts AS (SELECT *, {NET_DISK_CASE} AS alert FROM stats)",
    select=EPOCH_REPORT,
)


QUARANTINE = _with(
    select="""SELECT CASE WHEN event_id % 17 > 4 OR event_id % 17 = 3 THEN ts WHEN event_id % 17 = 4 THEN 'at ' || ts END AS ts,
  CASE WHEN event_id % 17 > 3 THEN server_id END AS server_id,
  CASE WHEN event_id % 17 NOT IN (0, 1, 2, 5) THEN cpu_pct END AS cpu_pct,
  CASE WHEN event_id % 17 < 3 THEN 'undecodable' WHEN event_id % 17 = 3 THEN 'no server'
    WHEN event_id % 17 = 4 THEN 'bad timestamp' ELSE 'none' END AS problem
FROM telemetry"""
)


ORACLE: dict[str, str] = {
    "fanout_topics": _with(_dataset(), select=_sent(dict.fromkeys(TOPICS, "true"), "dataset")),
    "fanout_bad_rows": _fanout_bad_rows(),
    "parse_numbers": """
SELECT event_id, CASE event_id % 6
    WHEN 0 THEN c WHEN 1 THEN -10 * c WHEN 2 THEN 10 * c
    WHEN 5 THEN CAST('0.' || CAST(CAST(c AS BIGINT) AS VARCHAR) AS DOUBLE) END AS number
FROM (SELECT event_id, round(value * 100) AS c FROM events) e""",
    "ts_default_date": _with(_dataset(), select="SELECT event_id, ts FROM dataset"),
    "decode_topic_json": _with(
        select="""SELECT t.event_id AS event_id, t.ts AS ts, server_id, cpu_pct,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
FROM telemetry t JOIN events e ON t.event_id = e.event_id"""
    ),
    "decode_malformed": _with(
        select="""SELECT event_id,
  CASE WHEN event_id % 17 > 3 THEN server_id END AS server_id,
  CASE WHEN event_id % 17 > 4 OR event_id % 17 = 3 THEN ts_sec END AS ts_sec,
  CASE WHEN event_id % 17 NOT IN (0, 1, 2, 5) THEN cpu_pct END AS cpu_pct,
  CASE WHEN event_id % 17 < 3 THEN 'undecodable' WHEN event_id % 17 = 3 THEN 'no server'
    WHEN event_id % 17 = 4 THEN 'bad timestamp' END AS problem
FROM telemetry"""
    ),
    "round_metrics": "SELECT event_id, CAST(round(CAST(CAST(value / 7 AS FLOAT) AS DECIMAL(18, 8)), 2) AS FLOAT) AS metric FROM events",
    "threshold_table": _threshold_table(),
    "raw_snapshot_cpu": _snapshot("cpu"),
    "raw_snapshot_mem": _snapshot("mem"),
    "raw_snapshot_net": _snapshot("net"),
    "raw_snapshot_disk": _snapshot("disk"),
    "truncate_seconds": "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS ts_sec FROM events",
    "parse_strict_vs_lenient": _with(
        select="""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ts_sec END AS strict,
  CASE WHEN event_id % 7 < 4 THEN ts_sec WHEN event_id % 7 = 4 THEN ts_sec // 86400 * 86400 END AS lenient
FROM telemetry"""
    ),
    "dedupe_second": _with(select=f"SELECT server_id, ts_sec, cpu_pct FROM ({_first('cpu')}) f"),
    "dedupe_without_order": _with(
        select="""SELECT server_id, ts_sec, net_in, net_out FROM telemetry
QUALIFY row_number() OVER (PARTITION BY server_id, ts_sec ORDER BY net_in DESC, net_out DESC) = 1"""
    ),
    "join_cpu_mem": _with(_joined("cpu", "mem"), select="SELECT * FROM joined"),
    "join_net_disk": _with(_joined("net", "disk"), select="SELECT * FROM joined"),
    "join_dup_fanout": _copies(),
    "window_origin": _with(
        _joined("cpu", "mem"),
        select="SELECT min(ts_sec) AS ts_sec, min(ts_sec) // 10 * 10 AS first_start FROM joined",
    ),
    "window_assign": _with(_joined("cpu", "mem"), _assigned(clamp=False), select="SELECT * FROM assigned"),
    "window_unclamped": _window_counts(clamp=False),
    "window_clamp": _window_counts(),
    "window_offset": _window_counts(offset=3),
    "window_uneven": _window_counts(size=25, slide=10, offset=4),
    "window_gap": _window_counts(size=10, slide=30),
    "cpu_mem_windows": _cpu_mem("SELECT * FROM stats"),
    "net_disk_windows": _net_disk("SELECT * FROM stats"),
    "cpu_mem_alerts": _cpu_mem(EPOCH_REPORT),
    "net_disk_alerts": _net_disk(EPOCH_REPORT),
    "net_disk_alerts_dup": _net_disk(EPOCH_REPORT, unique=False),
    "cpu_mem_from_records": _cpu_mem(EPOCH_REPORT),
    "net_disk_from_records": _net_disk(EPOCH_REPORT),
    "net_disk_from_snapshots": _net_disk(EPOCH_REPORT),
    "alert_null_semantics": _pairs(
        "CASE WHEN event_id % 3 <> 0 THEN CAST(cpu_pct AS DOUBLE) END",
        "CASE WHEN event_id % 5 <> 0 THEN CAST(cpu_pct AS DOUBLE) / 2 + 45 END",
        "cpu_threshold",
        "mem_threshold",
        "telemetry",
    ),
    "alert_boundary": _pairs(
        f"CASE WHEN event_id % 4 = 0 THEN CAST({THRESHOLDS['net_in_threshold']} AS FLOAT) ELSE net_in END",
        f"CASE WHEN event_id % 3 = 0 THEN CAST({THRESHOLDS['disk_io_threshold']} AS FLOAT) ELSE net_out END",
        "net_in_threshold",
        "disk_io_threshold",
        "telemetry",
    ),
    "alert_rows": _cpu_mem("SELECT * FROM alerts WHERE alert <> ''"),
    "alert_summary": f"SELECT * FROM ({_cpu_mem(_summary('cpu_mem'))}) a UNION ALL SELECT * FROM ({_net_disk(_summary('net_disk'))}) b",
    "alerts_from_table": _cpu_mem(
        "SELECT * REPLACE (CASE WHEN avg_cpu > (SELECT 70 + max(event_id) % 20 FROM events)"
        f" AND avg_mem <= {MISSING_THRESHOLD} THEN '{CPU_MEM_ALERTS[1]}' ELSE '' END AS alert) FROM alerts"
    ),
    "report_sorted": _net_disk(EPOCH_REPORT),
    "multi_day_windows": _cpu_mem(EPOCH_REPORT, "three_days", THREE_DAYS),
    "tod_collapse": _collapsed(0),
    "tod_zone": _collapsed(19800),
    "csv_round_trip": _cpu_mem("SELECT * REPLACE (nullif(alert, '') AS alert) FROM alerts"),
    "stream_cpu_mem_alerts": _cpu_mem(EPOCH_REPORT),
    "stream_repeats": _without_position(tenths=True),
    "dedupe_subsecond": _with(
        select=f"SELECT server_id, ts_sec, cpu_pct FROM ({_first('cpu', order=_peak('cpu', True))}) f"
    ),
    "join_null_keys": _cpu_mem(EPOCH_REPORT, "broken", BROKEN),
    "csv_odd_text": _odd_text(),
    "report_ordered": _cpu_mem(EPOCH_REPORT, "three_days", THREE_DAYS),
    "report_day_range": _cpu_mem(EPOCH_REPORT, "three_days", THREE_DAYS),
    "report_refresh": _cpu_mem(EPOCH_REPORT, "three_days", THREE_DAYS),
    "snapshot_incremental": _with(
        select="""SELECT ts, server_id, net_in, net_out FROM telemetry
QUALIFY row_number() OVER (PARTITION BY server_id, ts ORDER BY net_in DESC, net_out DESC) = 1"""
    ),
    "exact_average": EXACT,
    "dedupe_large": LARGE,
    "stream_dedupe_large": LARGE,
    "stream_clamped": _cpu_mem(EPOCH_REPORT),
    "stream_late": _cpu_mem(EPOCH_REPORT),
    "stream_thresholds": _versions(),
    "stream_fanout": _with(_dataset(), select=_sent(dict.fromkeys(TOPICS, "true"), "dataset")),
    "stream_quarantine": QUARANTINE,
    "pipeline_files": _without_position(tenths=False).replace(" WHERE event_type <> 'error'", ""),
}
