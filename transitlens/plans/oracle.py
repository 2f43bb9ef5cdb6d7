"""Reference SQL (DuckDB dialect) for every registered query.

The views ``events`` etc. are provided by the caller.  Each statement
recomputes the answer from the raw table with the same report adapter, by
the most direct formulation (self-joins, unpartitioned windows), which is fine
at test scale and independent of the Spark plans it checks.
"""

from __future__ import annotations

from ..schema import SLIDE_10MIN_MS, SLIDE_MS, TRAILING_6H_MS, TRAILING_MS
from ..sources.replay import JITTER_MS, LEAST_BATCHES, PAIR_STEP, ROWS_PER_FILE, SHUFFLED_PAIRS
from ..sources.text import ARRIVAL_PLACES
from .registry import COARSE_VEHICLES, DAMAGE_ABOVE_VALUE, LATE_KEY_LATENESS_MS, REPLAY_LATENESS_MS, TEXT_LATENESS_MS

REPORTS = """reports AS (
  SELECT event_id AS seq,
         CAST(user_id AS VARCHAR) AS id,
         CAST((CAST(json_extract_string(props, '$.k') AS BIGINT) % 25) * 15 AS DOUBLE) AS bearing,
         CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS isinactive,
         CAST(user_id % 6 AS INTEGER) AS ltype,
         CAST(CAST(round(value * 100) AS BIGINT) - 3000 AS DOUBLE) AS delay,
         epoch_us(ts) // 1000 AS lastupdate,
         CAST(event_id % 97 AS VARCHAR) AS laststopid,
         value AS src_value
  FROM events),
active AS (SELECT * FROM reports WHERE isinactive = 'false')"""

# few vehicles and one delay (see registry._coarse)
COARSE_REPORTS = REPORTS.replace(
    "CAST(user_id AS VARCHAR) AS id", f"'v' || CAST(user_id % {COARSE_VEHICLES} AS VARCHAR) AS id"
).replace(
    "CAST(CAST(round(value * 100) AS BIGINT) - 3000 AS DOUBLE) AS delay",
    "CAST(sign(CAST(round(value * 100) AS BIGINT) - 3000) AS DOUBLE) AS delay",
)

# arrival batches of the replay (see sources.replay)
ARRIVED = f"""bounds AS (SELECT min(lastupdate) AS lo, max(lastupdate) AS hi, greatest({LEAST_BATCHES}, count(*) // {ROWS_PER_FILE}) AS n FROM reports),
arrived AS (
  SELECT r.*, ((r.lastupdate - lo + CAST('0x' || substr(md5(CAST(r.seq AS VARCHAR)), 1, 8) AS BIGINT) % {JITTER_MS}) * n) // (hi - lo + {JITTER_MS}) AS b
  FROM reports r, bounds)"""

# documents of the landing text files: hours for times, numbers by place
TEXT_REPORTS = REPORTS.replace("epoch_us(ts) // 1000 AS lastupdate", "epoch_us(ts) // 3600000000 * 3600000 AS lastupdate").replace(
    "SELECT event_id AS seq",
    f"""SELECT row_number() OVER (ORDER BY event_id // 2 // {SHUFFLED_PAIRS}, event_id // 2 % {SHUFFLED_PAIRS} * {PAIR_STEP} % {SHUFFLED_PAIRS}, event_id DESC) - 1 AS seq""",
)

LINES = """lines AS (
  SELECT seq, src_value,
         '{"attributes":{"id":"' || id || '","bearing":' || CAST(CAST(bearing AS BIGINT) AS VARCHAR)
         || ',"isinactive":"' || isinactive || '","ltype":' || CAST(ltype AS VARCHAR)
         || ',"delay":' || CAST(CAST(delay AS BIGINT) AS VARCHAR)
         || ',"lastupdate":' || CAST(lastupdate AS VARCHAR)
         || ',"laststopid":"' || laststopid || '"}}' AS value
  FROM reports)"""

COLS = "seq, id, bearing, isinactive, ltype, delay, lastupdate, laststopid"


def _w(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((REPORTS,) + ctes) + "\n" + body


def _num(x: str) -> str:
    """Integral doubles printed without a fraction, like number_text()."""
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


LATEST = """latest AS (
  SELECT id, delay, lastupdate FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY lastupdate DESC, seq ASC) AS rn FROM active)
  WHERE rn = 1)"""


def _sliding(size_ms: int, slide_ms: int, with_avg: bool) -> str:
    per = size_ms // slide_ms
    vals = "sum(delay) AS delay_sum, count(delay) AS n, sum(delay) / count(delay) AS avg_delay" if with_avg else "count(*) AS n"
    return _w(
        f"""SELECT w AS window_start_ms, w + {size_ms} AS window_end_ms, {vals}
FROM (SELECT a.*, (lastupdate // {slide_ms}) * {slide_ms} - k * {slide_ms} AS w
      FROM active a, range(0, {per}) t(k))
GROUP BY w"""
    )


def _vehicle_windows(size_ms: int, slide_ms: int) -> str:
    """Each window with the newest report of each vehicle in it."""
    per = size_ms // slide_ms
    return _w(
        f"""SELECT w AS window_start_ms, w + {size_ms} AS window_end_ms, sum(delay) AS delay_sum, count(delay) AS n, sum(delay) / count(delay) AS avg_delay
FROM (
  SELECT *, row_number() OVER (PARTITION BY w, id ORDER BY lastupdate DESC, seq ASC) AS rn
  FROM (SELECT a.*, (lastupdate // {slide_ms}) * {slide_ms} - k * {slide_ms} AS w FROM active a, range(0, {per}) t(k)))
WHERE rn = 1 GROUP BY w"""
    )


# the list after every active report, by a join with the states that stand there
TOP_AFTER_EACH = (
    "firsts AS (SELECT id, lastupdate, min(seq) AS seq, arg_min(delay, seq) AS delay FROM active GROUP BY id, lastupdate)",
    """standing AS (SELECT *, lead(lastupdate) OVER w AS next_t, lead(seq) OVER w AS next_s FROM firsts
  WINDOW w AS (PARTITION BY id ORDER BY lastupdate))""",
    """toplists AS (
  SELECT r.seq, r.lastupdate AS rt, s.id, s.delay, s.lastupdate,
         CAST(row_number() OVER (PARTITION BY r.seq ORDER BY s.delay DESC, s.id ASC) AS INTEGER) AS rank
  FROM active r JOIN standing s
    ON s.delay > 0 AND s.lastupdate <= r.lastupdate AND r.lastupdate <= coalesce(s.next_t, 9223372036854775807)
   AND (s.lastupdate < r.lastupdate OR s.seq <= r.seq)
   AND (s.next_t IS NULL OR r.lastupdate < s.next_t OR r.seq < s.next_s))""",
)
TOP_FLAGS = """topflags AS (
  SELECT seq, key IS DISTINCT FROM lag(key) OVER (ORDER BY lastupdate, seq) AS changed FROM (
    SELECT a.seq, a.lastupdate, string_agg(t.id || '|' || CAST(t.delay AS VARCHAR), ',' ORDER BY t.rank) AS key
    FROM active a LEFT JOIN toplists t ON t.seq = a.seq AND t.rank <= 5 GROUP BY a.seq, a.lastupdate))"""


def _top5(filter_first: bool) -> str:
    if filter_first:
        src = """ff AS (SELECT id, delay, lastupdate FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY lastupdate DESC, seq ASC) AS rn
  FROM active WHERE delay > 0) WHERE rn = 1)"""
        return _w(
            """SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY delay DESC, id ASC) AS INTEGER) AS rank, id, delay, lastupdate FROM ff)
WHERE rank <= 5""",
            src,
        )
    return _w(
        """SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY delay DESC, id ASC) AS INTEGER) AS rank, id, delay, lastupdate
  FROM latest WHERE delay > 0) WHERE rank <= 5""",
        LATEST,
    )


TICK_MS = 3600 * 1000


def _recent_top(window_ms: int) -> str:
    """CTE ``top``: every delayed report's list by a range self-join."""
    return f"""d AS (SELECT seq, id, delay, lastupdate FROM active WHERE delay > 0),
pairs AS (
  SELECT r.seq AS rseq, r.lastupdate AS rt, q.seq AS qseq, q.id, q.delay, q.lastupdate
  FROM d r JOIN d q
    ON q.lastupdate >= r.lastupdate - {window_ms}
   AND (q.lastupdate < r.lastupdate OR (q.lastupdate = r.lastupdate AND q.seq <= r.seq))),
dedup AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rseq, id ORDER BY lastupdate DESC, qseq DESC) AS k
                 FROM pairs) WHERE k = 1),
top AS (
  SELECT * FROM (
    SELECT rseq AS seq, rt, CAST(row_number() OVER (PARTITION BY rseq ORDER BY lastupdate DESC, qseq DESC) AS INTEGER) AS rank,
           id, delay, lastupdate FROM dedup)
  WHERE rank <= 5)"""


def _recent_changes(window_ms: int, iso: bool = False) -> str:
    flags = """lists AS (
  SELECT seq, rt, count(*) AS n, string_agg(id || '|' || CAST(delay AS VARCHAR), ',' ORDER BY rank) AS key
  FROM top GROUP BY seq, rt),
flags AS (
  SELECT seq, NOT (coalesce(lag(n) OVER w, 0) = 5 AND n = 5 AND lag(key) OVER w = key) AS changed
  FROM lists WINDOW w AS (ORDER BY rt, seq))"""
    if iso:
        cols = f"t.seq, t.rank, t.id, t.delay, {_iso('t.lastupdate')} AS lastupdate_iso"
    else:
        cols = "t.seq, t.rank, t.id, t.delay, t.lastupdate"
    return _w(f"SELECT {cols} FROM top t JOIN flags f ON t.seq = f.seq WHERE f.changed", _recent_top(window_ms), flags)


def _iso(ms: str) -> str:
    return (
        f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN {ms} % 1000 <> 0 THEN '.' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0') || '000' ELSE '' END"
    )


def _recent_final(window_ms: int) -> str:
    return _w(
        f"""SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY lastupdate DESC, seq DESC) AS INTEGER) AS rank, id, delay, lastupdate FROM (
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY lastupdate DESC, seq DESC) AS k
      FROM active WHERE delay > 0
        AND lastupdate >= (SELECT max(lastupdate) FROM active WHERE delay > 0) - {window_ms})
    WHERE k = 1))
WHERE rank <= 5"""
    )


FRAME = """frame AS (
  SELECT seq, lastupdate, count(*) OVER w AS n, lastupdate - min(lastupdate) OVER w AS span_ms
  FROM active WINDOW w AS (ORDER BY lastupdate, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""

VEHICLE_FRAME = """frame AS (
  SELECT id, seq, lastupdate, count(*) OVER w AS n, lastupdate - min(lastupdate) OVER w AS span_ms
  FROM active WINDOW w AS (PARTITION BY id ORDER BY lastupdate, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))"""

BUFFER = """buf AS (
  SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY lastupdate DESC, seq DESC) AS INTEGER) AS rank, seq, lastupdate FROM active)
  WHERE rank <= 10)"""


def _duration(us: str) -> str:
    d = f"({us}) // 86400000000"
    rest = f"(({us}) - {d} * 86400000000)"
    secs = f"({rest} // 1000000)"
    frac = f"({rest} - {secs} * 1000000)"
    clock = f"printf('%d:%02d:%02d', {secs} // 3600, ({secs} % 3600) // 60, {secs} % 60)"
    return (
        f"CASE WHEN {d} = 0 THEN '' WHEN {d} = 1 THEN '1 day, ' ELSE printf('%d days, ', {d}) END || {clock} || "
        f"CASE WHEN {frac} <> 0 THEN printf('.%06d', {frac}) ELSE '' END"
    )


def _rounded_us(span: str, n: str) -> str:
    q = f"(({span}) * 1000) // (({n}) - 1)"
    r2 = f"((({span}) * 1000) - {q} * (({n}) - 1)) * 2"
    return f"(CASE WHEN {r2} > ({n}) - 1 THEN {q} + 1 WHEN {r2} = ({n}) - 1 AND {q} % 2 = 1 THEN {q} + 1 ELSE {q} END)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_reports"] = _w("SELECT seq, value FROM lines", LINES)
    q["tokenize_lines"] = _w("SELECT seq, CAST(0 AS INTEGER) AS pos, value AS token FROM lines", LINES)
    q["parse_reports"] = _w(f"SELECT {COLS} FROM reports")
    q["corrupt_reports"] = _w(
        f"SELECT seq, substring(value, 1, length(value) // 2) AS value FROM lines WHERE src_value > {DAMAGE_ABOVE_VALUE}",
        LINES,
    )
    q["reports_as_json"] = _w(
        """SELECT seq, '{"seq":' || seq || ',"id":"' || id || '","bearing":' || CAST(bearing AS VARCHAR)
  || ',"isinactive":"' || isinactive || '","ltype":' || ltype || ',"delay":' || CAST(delay AS VARCHAR)
  || ',"lastupdate":' || lastupdate || ',"laststopid":"' || laststopid || '"}' AS json FROM reports"""
    )
    q["active_reports"] = _w(f"SELECT {COLS} FROM active")
    q["train_reports"] = _w(f"SELECT {COLS} FROM active WHERE ltype = 5")
    q["delayed_reports"] = _w(f"SELECT {COLS} FROM active WHERE delay > 0")
    north = "((bearing >= 315 AND bearing <= 360) OR (bearing >= 0 AND bearing <= 45))"
    q["north_bearing"] = _w(f"SELECT id, bearing FROM active WHERE {north}")
    q["north_json_lines"] = _w(
        f"""SELECT '["' || id || '", ' || {_num('bearing')} || ']' AS line FROM active WHERE {north}"""
    )
    train = """train AS (
  SELECT id, laststopid AS last_stop, lastupdate AS last_update FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY lastupdate DESC, seq ASC) AS rn
    FROM active WHERE ltype = 5) WHERE rn = 1)"""
    q["train_last_stop"] = _w("SELECT id, last_stop, last_update FROM train", train)
    q["train_last_stop_csv"] = _w(
        """SELECT 0 AS ord, 'id,laststop,lastupdate' AS line
UNION ALL SELECT 1 AS ord, '''' || id || ''',''' || last_stop || ''',''' || CAST(last_update AS VARCHAR) || '''' FROM train""",
        train,
    )
    q["latest_delay_per_vehicle"] = _w("SELECT id, delay, lastupdate FROM latest", LATEST)
    q["top5_delayed"] = _top5(False)
    q["top5_delayed_filter_first"] = _top5(True)
    q["top5_delayed_json"] = _w(
        f"""SELECT '[' || coalesce(string_agg('["' || id || '", ' || {_num('delay')} || ', ' || CAST(lastupdate AS VARCHAR) || ']', ', ' ORDER BY rank), '') || ']' AS line
FROM (SELECT CAST(row_number() OVER (ORDER BY delay DESC, id ASC) AS INTEGER) AS rank, id, delay, lastupdate FROM latest WHERE delay > 0)
WHERE rank <= 5""",
        LATEST,
    )
    q["top5_delayed_timeline"] = _w(
        f"""SELECT tick_ms, rank, id, delay FROM (
  SELECT t.tick_ms, s.id, s.delay,
         CAST(row_number() OVER (PARTITION BY t.tick_ms ORDER BY s.delay DESC, s.id ASC) AS INTEGER) AS rank
  FROM ticks t JOIN states s ON s.lastupdate <= t.tick_ms AND (s.nxt IS NULL OR t.tick_ms < s.nxt)
  WHERE s.delay > 0)
WHERE rank <= 5""",
        """states AS (SELECT id, delay, lastupdate,
  lead(lastupdate) OVER (PARTITION BY id ORDER BY lastupdate ASC, seq DESC) AS nxt FROM active)""",
        f"""ticks AS (SELECT unnest(generate_series(
  (min(lastupdate) + {TICK_MS - 1}) // {TICK_MS} * {TICK_MS}, max(lastupdate) // {TICK_MS} * {TICK_MS}, {TICK_MS})) AS tick_ms
  FROM active)""",
    )
    per_report = """SELECT seq, rank, id, delay, lastupdate FROM toplists WHERE rank <= 5"""
    q["top5_delayed_per_report"] = _w(per_report, *TOP_AFTER_EACH)
    q["top5_delayed_changes"] = _w(per_report + " AND seq IN (SELECT seq FROM topflags WHERE changed)", *TOP_AFTER_EACH, TOP_FLAGS)
    q["train_last_stop_changes"] = _w(
        f"""SELECT seq, id, last_stop, last_update FROM (
  SELECT seq, id, laststopid AS last_stop, lastupdate AS last_update,
         max(lastupdate) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS known
  FROM (SELECT * REPLACE (
          (lastupdate + CAST('0x' || substr(md5(CAST(seq AS VARCHAR)), 1, 8) AS BIGINT) % {JITTER_MS}) * {ARRIVAL_PLACES} + seq % {ARRIVAL_PLACES} AS seq)
        FROM active)
  WHERE ltype = 5) WHERE known IS NULL OR last_update > known"""
    )
    q["avg_delay_vehicles"] = _vehicle_windows(TRAILING_MS, SLIDE_MS)
    q["avg_delay_vehicles_6h"] = _vehicle_windows(TRAILING_6H_MS, SLIDE_10MIN_MS)
    q["avg_delay_stored_panes"] = _sliding(TRAILING_6H_MS, SLIDE_10MIN_MS, True)
    q["avg_delay_total"] = _w("SELECT sum(delay) AS delay_sum, count(delay) AS n, sum(delay) / count(delay) AS avg_delay FROM active")
    q["avg_delay_sliding"] = _sliding(TRAILING_MS, SLIDE_MS, True)
    q["avg_delay_sliding_6h"] = _sliding(TRAILING_6H_MS, SLIDE_10MIN_MS, True)
    q["window_report_count"] = _sliding(TRAILING_MS, SLIDE_MS, False)
    q["window_report_count_6h"] = _sliding(TRAILING_6H_MS, SLIDE_10MIN_MS, False)
    q["recent5_final"] = _recent_final(TRAILING_MS)
    q["recent5_final_6h"] = _recent_final(TRAILING_6H_MS)
    q["recent5_timeline"] = _w("SELECT seq, rank, id, delay, lastupdate FROM top", _recent_top(TRAILING_MS))
    q["recent5_timeline_6h"] = _w("SELECT seq, rank, id, delay, lastupdate FROM top", _recent_top(TRAILING_6H_MS))
    q["recent5_changes"] = _recent_changes(TRAILING_MS)
    q["recent5_changes_6h"] = _recent_changes(TRAILING_6H_MS)
    q["recent5_iso"] = _recent_changes(TRAILING_MS, iso=True)
    q["recent5_iso_6h"] = _recent_changes(TRAILING_6H_MS, iso=True)
    q["last10_buffer"] = _w("SELECT rank, seq, lastupdate FROM buf", BUFFER)
    q["last10_gap_final"] = _w(
        """SELECT * FROM (SELECT count(*) AS n, max(lastupdate) - min(lastupdate) AS span_ms,
  (max(lastupdate) - min(lastupdate)) / (count(*) - 1) AS gap_ms FROM buf) WHERE n > 1""",
        BUFFER,
    )
    q["last10_deltas"] = _w(
        """SELECT pos, delta_ms FROM (
  SELECT CAST(row_number() OVER (ORDER BY lastupdate, seq) - 1 AS INTEGER) AS pos,
         lastupdate - lag(lastupdate) OVER (ORDER BY lastupdate, seq) AS delta_ms FROM buf) WHERE pos >= 1""",
        BUFFER,
    )
    q["last10_gap_timeline"] = _w(
        "SELECT seq, lastupdate, n, span_ms, span_ms / (n - 1) AS gap_ms FROM frame WHERE n > 1", FRAME
    )
    q["last10_gap_per_vehicle"] = _w(
        "SELECT id, seq, lastupdate, n, span_ms, span_ms / (n - 1) AS gap_ms FROM frame WHERE n > 1", VEHICLE_FRAME
    )
    q["last10_gap_text"] = _w(
        f"SELECT seq, {_duration(_rounded_us('span_ms', 'n'))} AS gap_text FROM frame WHERE n > 1", FRAME
    )
    coarse = lambda sql: sql.replace(REPORTS, COARSE_REPORTS)
    q["recent5_coarse_timeline"] = coarse(q["recent5_timeline_6h"])
    q["recent5_coarse_changes"] = coarse(q["recent5_changes_6h"])
    # text files hold the same documents; tokens are cut by SQL itself
    q["text_scan_reports"] = q["text_stream_scan_reports"] = _w(f"SELECT {COLS.removeprefix('seq, ')} FROM reports")
    placed = lambda sql: sql.replace(REPORTS, TEXT_REPORTS)
    q["text_arrival_order"] = placed(_w("SELECT seq, id, lastupdate, laststopid FROM reports"))
    for twin, batch in [("train_last_stop", "train_last_stop"), ("top5_delayed", "top5_delayed"), ("recent5_changes", "recent5_changes_6h")]:
        q[f"text_{twin}"] = q[f"text_stream_{twin}"] = placed(q[batch])
    q["text_stream_recent5_changes"] = (
        q["text_recent5_changes"].replace("SELECT t.seq, t.rank", "SELECT t.rank")
        + f" AND t.rt < (SELECT max(lastupdate) - {TEXT_LATENESS_MS} FROM reports)"
    )
    q["text_tokens"] = r"""SELECT token, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(coalesce(text, ''), '\s+')) AS token FROM documents) WHERE token <> '' GROUP BY token"""
    # streaming twins that do not depend on the order of arrival
    for twin, batch in [
        ("stream_scan_reports", "parse_reports"),
        ("stream_north_bearing", "north_bearing"),
        ("stream_train_last_stop", "train_last_stop"),
        ("stream_top5_delayed", "top5_delayed"),
        ("stream_recent5", "recent5_final"),
        ("stream_last10_buffer", "last10_buffer"),
        ("stream_train_last_stop_changes", "train_last_stop_changes"),
    ]:
        q[twin] = q[batch]
    # answers per report come once the newest time minus the lateness has passed them
    settled = f"(SELECT max(lastupdate) - {REPLAY_LATENESS_MS} FROM reports)"
    for twin, batch, column in [
        ("stream_recent5_changes", "recent5_changes", "t.seq"),
        ("stream_recent5_coarse_changes", "recent5_coarse_changes", "t.seq"),
        ("stream_last10_gap_text", "last10_gap_text", "seq"),
        ("stream_top5_delayed_changes", "top5_delayed_changes", "seq"),
    ]:
        word = " AND " if " WHERE " in q[batch].rsplit("\n", 1)[-1] else " WHERE "
        q[twin] = q[batch] + f"{word}{column} IN (SELECT seq FROM reports WHERE lastupdate < {settled})"
    # windows whose end the final watermark has passed
    q["stream_avg_delay_sliding"] = (
        "SELECT * FROM (" + _sliding(TRAILING_MS, SLIDE_MS, True) + ") s "
        f"WHERE window_end_ms <= (SELECT max(epoch_us(ts) // 1000) FROM events WHERE event_type <> 'error') - {REPLAY_LATENESS_MS}"
    )
    q["stream_avg_delay_ptime"] = _w(
        f"SELECT CAST(count(*) * {TRAILING_MS // SLIDE_MS} AS BIGINT) AS reports_in_windows, "
        f"CAST({TRAILING_MS // 1000} AS BIGINT) AS shortest_s, CAST({TRAILING_MS // 1000} AS BIGINT) AS longest_s FROM active"
    )
    q["stream_late_rows"] = _w(
        f"""SELECT seq, id, lastupdate FROM arrived a
WHERE lastupdate < (SELECT max(lastupdate) FROM arrived e WHERE e.b < a.b) - {LATE_KEY_LATENESS_MS}""",
        ARRIVED,
    )
    # in the order of arrival (batch, then event time): a report is answered
    # when it is among the ten newest that have arrived so far
    q["stream_last10_listed"] = q["stream_last10_per_vehicle"] = _w(
        """SELECT id, seq, lastupdate, n, span_ms, span_ms / (n - 1) AS gap_ms FROM (
  SELECT r.id, r.seq, r.lastupdate, count(*) AS n, max(p.lastupdate) - min(p.lastupdate) AS span_ms,
         bool_or(p.seq = r.seq) AS stays
  FROM seen r JOIN (
    SELECT * FROM (
      SELECT r.seq AS rseq, q.seq, q.lastupdate,
             row_number() OVER (PARTITION BY r.seq ORDER BY q.lastupdate DESC, q.seq DESC) AS k
      FROM seen r JOIN seen q ON q.id = r.id
       AND (q.b < r.b OR (q.b = r.b AND (q.lastupdate < r.lastupdate OR (q.lastupdate = r.lastupdate AND q.seq <= r.seq)))))
    WHERE k <= 10) p ON p.rseq = r.seq
  GROUP BY r.id, r.seq, r.lastupdate)
WHERE stays AND n > 1""",
        ARRIVED,
        "seen AS (SELECT * FROM arrived WHERE isinactive = 'false')",
    )
    return q
