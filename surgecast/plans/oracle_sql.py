"""Independent DuckDB SQL for each named query (same tables, same columns).

Written from the stated semantics, not from the Spark plans: sliding windows
by enumerating the 4 window offsets, the 'latest technology' by
``arg_max``, truncating casts by ``trunc`` (DuckDB's cast rounds), JSON
decoding with explicit type checks (Spark's parser yields null for a
wrong-typed field and keeps the rest of the row).
"""

from __future__ import annotations

from surgecast.functions import fixed_values as FV


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(i) for i in items) + "]"


GEO_FIELDS = ['"clientId"', '"cellId"', "latitude", "longitude", '"signalDbm"', "congestion", "technology", '"timestamp"']

PER_EVENT = """
pe0 AS (
  SELECT event_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         1 + user_id % 50 AS cn,
         event_id % 40 AS m
  FROM events
),
pe AS (
  SELECT event_id, m,
    CASE WHEN m = 7 THEN NULL WHEN m = 17 THEN '' ELSE 'CLIENT_' || lpad(CAST(cn AS VARCHAR), 4, '0') END AS "clientId",
    'CELL_' || lpad(CAST(1 + (cn * 7 + (event_id // 300) * 3) % 20 AS VARCHAR), 3, '0') AS "cellId",
    CAST(40.0 AS DOUBLE) AS latitude,
    CAST(-3.0 AS DOUBLE) AS longitude,
    CASE WHEN m = 7 THEN NULL ELSE CAST(-70 - k % 30 AS INTEGER) END AS "signalDbm",
    CAST(CASE WHEN m = 27 THEN 101 + k
              WHEN event_id >= 300 AND 1 + (cn * 7 + (event_id // 300) * 3) % 20 = 3 THEN 75 + k % 20
              WHEN event_id >= 300 AND 1 + (cn * 7 + (event_id // 300) * 3) % 20 = 7 THEN 70 + k % 25
              ELSE 20 + k % 50 END AS INTEGER) AS congestion,
    CASE WHEN k % 5 < 3 THEN '5G' ELSE '4G' END AS technology,
    CAST(1704067200000 + event_id * 200 AS BIGINT) AS "timestamp"
  FROM pe0
),
geo AS (
  SELECT "clientId", "cellId", latitude, longitude, "signalDbm", congestion, technology, "timestamp" FROM pe
  UNION ALL
  SELECT "clientId", "cellId", latitude, longitude, "signalDbm", congestion, technology, "timestamp" FROM pe WHERE m = 37
)"""

VALID = """"clientId" IS NOT NULL AND "clientId" <> '' AND "signalDbm" IS NOT NULL
  AND coalesce(congestion, -1) BETWEEN 0 AND 100 AND "cellId" IS NOT NULL AND "timestamp" IS NOT NULL"""

CLEAN = f"""
clean AS (SELECT * FROM geo WHERE {VALID})"""

DEDUP = """
dedup AS (
  SELECT "clientId", "cellId", "timestamp",
         any_value(congestion) AS congestion, any_value("signalDbm") AS "signalDbm",
         any_value(technology) AS technology
  FROM clean GROUP BY "clientId", "cellId", "timestamp"
)"""


def _window_agg(name: str, size_ms: int, slide_ms: int, src: str = "dedup") -> str:
    n = size_ms // slide_ms
    return f"""
{name} AS (
  SELECT ws AS "windowStart", ws + {size_ms} AS "windowEnd", "clientId", "cellId",
         CAST(trunc(avg(congestion)) AS INTEGER) AS "avgCongestion",
         CAST(trunc(avg("signalDbm")) AS INTEGER) AS "avgSignalDbm",
         arg_max(technology, "timestamp") AS technology,
         count(*) AS "eventCount"
  FROM (SELECT *, ("timestamp" // {slide_ms} - o) * {slide_ms} AS ws
        FROM (SELECT *, unnest(range({n})) AS o FROM {src}) e) x
  GROUP BY ws, "clientId", "cellId"
)"""


WINDOWS = _window_agg("agg", 120_000, 30_000)
TUMBLING = _window_agg("agg_t", 120_000, 120_000)

_SEG = FV.CONSENT_SEGMENT_CYCLE
_NP, _NS, _NB = (FV.CELLS_PER_SEGMENT[s] for s in ("PREMIUM", "STANDARD", "BASIC"))

CONSENTS = f"""
consents AS (
  SELECT 'CLIENT_' || lpad(CAST(i AS VARCHAR), 4, '0') AS "clientId",
         i % 10 <> 0 AS "hasConsent",
         seg AS segment,
         array_to_string(list_slice(list_transform(range(1, {FV.CELL_COUNT + 1}),
                           lambda x: 'CELL_' || lpad(CAST(x AS VARCHAR), 3, '0')),
                         (i * 3) % ({FV.CELL_COUNT} - n) + 1, (i * 3) % ({FV.CELL_COUNT} - n) + n), ',') AS "targetCells",
         CAST(i % 4 AS INTEGER) AS "campaignsSent"
  FROM (SELECT i, seg, CASE seg WHEN 'PREMIUM' THEN {_NP} WHEN 'STANDARD' THEN {_NS} ELSE {_NB} END AS n
        FROM (SELECT i, ({_list(_SEG)})[i % {len(_SEG)} + 1] AS seg FROM range(1, {FV.CONSENT_CLIENTS + 1}) t(i)) s0) s1
)"""

CELLS = f"""
cells AS (
  SELECT 'CELL_' || lpad(CAST(i + 1 AS VARCHAR), 3, '0') AS "cellId",
         i % 5 <> 0 AS "campaignActive",
         CAST(60 + (i % 3) * 10 AS INTEGER) AS "congestionThreshold",
         ({_list([c for c, _ in FV.CELL_LOCATIONS])})[i % {len(FV.CELL_LOCATIONS)} + 1] AS city,
         ({_list([z for _, z in FV.CELL_LOCATIONS])})[i % {len(FV.CELL_LOCATIONS)} + 1] AS zone
  FROM range(0, {FV.CELL_COUNT}) t(i)
)"""

AGG_COLS = 'a."windowStart", a."windowEnd", a."clientId", a."cellId", a."avgCongestion", a."avgSignalDbm", a.technology, a."eventCount"'
CONSENT_COLS = 'c."hasConsent", c.segment, c."targetCells", c."campaignsSent"'
CELL_COLS = 'l."campaignActive", l."congestionThreshold", l.city, l.zone'

WITH_CONSENT = f"""
wc AS (SELECT {AGG_COLS}, {CONSENT_COLS} FROM agg a JOIN consents c ON a."clientId" = c."clientId" WHERE c."hasConsent")"""

WITH_CELLS = f"""
wl AS (SELECT w.*, {CELL_COLS} FROM wc w JOIN cells l ON w."cellId" = l."cellId" WHERE l."campaignActive")"""


def _candidates(extra: str = "") -> str:
    return f"""
cand AS (SELECT * FROM wl WHERE "avgCongestion" >= "congestionThreshold" {extra})"""


def _policy(cong: str = '"avgCongestion"', sent: str = "coalesce(\"campaignsSent\", 0)") -> str:
    parts = " ".join(
        f"WHEN {_q(seg)} THEN {cong} > {mc} AND {sent} < {ms}" for seg, (mc, ms) in FV.SEGMENT_POLICY.items()
    )
    return f"coalesce(CASE segment {parts} ELSE false END, false)"


def _cap(sent: str = "coalesce(\"campaignsSent\", 0)") -> str:
    parts = " ".join(f"WHEN {_q(seg)} THEN {sent} >= {ms}" for seg, (_, ms) in FV.SEGMENT_POLICY.items())
    return f"coalesce(CASE segment {parts} ELSE false END, false)"


def _decisions(src: str = "cand", floor: int | None = None) -> str:
    sent = 'coalesce("campaignsSent", 0)'
    policy = _policy()
    floor_hit = "false" if floor is None else f'coalesce("avgSignalDbm" < {floor}, false)'
    known = "segment IN (" + ", ".join(_q(s) for s in FV.SEGMENT_POLICY) + ")"
    floor_reason = ""
    if floor is not None:
        floor_reason = f"""WHEN pol AND fl THEN printf({_q('Señal %d dBm por debajo del mínimo %d dBm')}, "avgSignalDbm", {floor})"""
    return f"""
dec0 AS (SELECT *, {policy} AS pol, {floor_hit} AS fl, {sent} AS snt FROM {src}),
dec AS (
  SELECT * EXCLUDE (pol, fl, snt),
    CASE WHEN pol AND NOT fl THEN 'SEND' ELSE 'SKIP' END AS "aiDecision",
    CASE WHEN pol AND NOT fl THEN printf({_q(FV.SEND_REASON_FMT)}, segment, "avgCongestion", snt)
         {floor_reason}
         WHEN snt >= {FV.REASON_CAMPAIGN_LIMIT} THEN printf({_q(FV.SKIP_LIMIT_REASON_FMT)}, snt)
         ELSE printf({_q(FV.SKIP_BELOW_REASON_FMT)}, "avgCongestion", segment) END AS "aiReasoning",
    CASE WHEN pol AND NOT fl THEN (CASE WHEN technology = '5G' THEN {_q(FV.SMS_5G)} ELSE {_q(FV.SMS_OTHER)} END)
         ELSE '' END AS "smsText",
    CASE WHEN pol AND NOT fl THEN NULL
         WHEN pol AND fl THEN 'SIGNAL_FLOOR'
         WHEN NOT coalesce({known}, false) THEN 'UNKNOWN_SEGMENT'
         WHEN {_cap()} THEN 'CAMPAIGN_LIMIT'
         ELSE 'BELOW_THRESHOLD' END AS "skipCode"
  FROM dec0
)"""


ALERT_COLS = '"clientId", "cellId", city, "avgCongestion" AS congestion, technology, segment, "aiDecision", "aiReasoning", "smsText"'


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


CHAIN = [PER_EVENT, CLEAN, DEDUP, WINDOWS, CONSENTS, CELLS, WITH_CONSENT, WITH_CELLS]


def _chain(extra_cand: str = "", floor: int | None = None) -> str:
    return _with(*CHAIN, _candidates(extra_cand), _decisions(floor=floor))


# ---------------------------------------------------------------- wire format
WIRE = """
wire AS (
  SELECT coalesce("clientId", 'null_key') AS key,
         CAST(json_object('clientId', "clientId", 'cellId', "cellId", 'latitude', latitude, 'longitude', longitude,
                     'signalDbm', "signalDbm", 'congestion', congestion, 'technology', technology,
                     'timestamp', "timestamp") AS VARCHAR) AS value,
         m, event_id, "timestamp" AS ts
  FROM pe
),
msgs AS (
  SELECT key, value FROM wire
  UNION ALL SELECT key, value FROM wire WHERE m = 37
  UNION ALL SELECT key,
    CASE WHEN m = 39 THEN substring(value, 1, length(value) // 2)
         WHEN m = 19 THEN regexp_replace(value, '"congestion":[^,]*', '"congestion":"abc"')
         WHEN m = 29 THEN regexp_replace(value, '"congestion":[^,]*', '"congestion":55.5')
         WHEN m = 3 THEN regexp_replace(value, '"timestamp":[0-9]+', '"timestamp":' || CASE (event_id // 40) % 3
           WHEN 0 THEN '9223372036854775807' WHEN 1 THEN '-9223372036854775808' ELSE ts || '000000' END)
         ELSE '' END
    FROM wire WHERE m IN (3, 9, 19, 29, 39)
),
decoded AS (
  SELECT key, value,
    CASE WHEN json_valid(value) AND json_type(value, '$.clientId') <> 'NULL' THEN json_extract_string(value, '$.clientId') END AS "clientId",
    CASE WHEN json_valid(value) AND json_type(value, '$.cellId') <> 'NULL' THEN json_extract_string(value, '$.cellId') END AS "cellId",
    CASE WHEN json_valid(value) AND json_type(value, '$.latitude') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.latitude') AS DOUBLE) END AS latitude,
    CASE WHEN json_valid(value) AND json_type(value, '$.longitude') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.longitude') AS DOUBLE) END AS longitude,
    CASE WHEN json_valid(value) AND json_type(value, '$.signalDbm') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.signalDbm') AS INTEGER) END AS "signalDbm",
    CASE WHEN json_valid(value) AND json_type(value, '$.congestion') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.congestion') AS INTEGER) END AS congestion,
    CASE WHEN json_valid(value) AND json_type(value, '$.technology') <> 'NULL' THEN json_extract_string(value, '$.technology') END AS technology,
    CASE WHEN json_valid(value) AND json_type(value, '$.timestamp') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.timestamp') AS BIGINT) END AS "timestamp",
    json_valid(value) AS parsed
  FROM msgs
)"""

# one more message per m = 13, 6000 years later
FUTURE_WIRE = WIRE.replace("\n),\ndecoded AS", """
  UNION ALL SELECT key, regexp_replace(value, '"timestamp":[0-9]+', '"timestamp":' || (ts + 189341712000000)) FROM wire WHERE m = 13
),
decoded AS""")

REASON = """
CASE WHEN value IS NULL OR trim(value) = '' THEN 'empty_message'
     WHEN NOT parsed THEN 'malformed_json'
     WHEN "clientId" IS NULL THEN 'null_client'
     WHEN "clientId" = '' THEN 'blank_client'
     WHEN "signalDbm" IS NULL THEN 'null_signal'
     WHEN congestion IS NULL THEN 'null_congestion'
     WHEN NOT (congestion BETWEEN 0 AND 100) THEN 'congestion_out_of_range'
     WHEN "cellId" IS NULL OR "timestamp" IS NULL THEN 'missing_required_field'
     WHEN "timestamp" NOT BETWEEN -62135596800000 AND 253402300799999 THEN 'bad_timestamp'
END"""

SQL: dict[str, str] = {}

SQL["geo_events"] = _with(PER_EVENT) + f" SELECT {', '.join(GEO_FIELDS)} FROM geo"

SQL["encode_events"] = _with(PER_EVENT) + """
SELECT coalesce("clientId", 'null_key') AS key,
       CAST(json_object('clientId', "clientId", 'cellId', "cellId", 'latitude', latitude, 'longitude', longitude,
                   'signalDbm', "signalDbm", 'congestion', congestion, 'technology', technology,
                   'timestamp', "timestamp") AS VARCHAR) AS value
FROM geo"""

SQL["decode_events"] = _with(PER_EVENT, WIRE) + f"""
SELECT key, {', '.join(GEO_FIELDS)}, CASE WHEN "timestamp" BETWEEN -62135596800000 AND 253402300799999 THEN "timestamp" END AS "eventTimeMs" FROM decoded"""

SQL["clean_events"] = _with(PER_EVENT, CLEAN) + f" SELECT {', '.join(GEO_FIELDS)} FROM clean"

SQL["reject_reasons"] = _with(PER_EVENT, WIRE) + f"""
SELECT key, value, rejectReason AS "rejectReason" FROM (SELECT key, value, {REASON} AS rejectReason FROM decoded) r
WHERE rejectReason IS NOT NULL"""

SQL["reject_summary"] = _with(PER_EVENT, WIRE) + f"""
SELECT coalesce({REASON}, 'valid') AS "rejectReason", count(*) AS rows FROM decoded GROUP BY 1"""

SQL["cleaning_metric"] = _with(PER_EVENT, WIRE) + f"""
SELECT count(*) AS "rowsIn", count(*) FILTER (WHERE ({REASON}) IS NULL) AS "rowsKept",
       count(*) FILTER (WHERE ({REASON}) IS NOT NULL) AS "rowsDropped" FROM decoded"""

SQL["congestion_band"] = _with(PER_EVENT) + f"""
SELECT CASE WHEN NOT coalesce({VALID}, false) THEN 'dirty'
            WHEN congestion >= {FV.BAND_HIGH_MIN} THEN 'high'
            WHEN congestion >= {FV.BAND_MEDIUM_MIN} THEN 'medium' ELSE 'low' END AS "congestionBand",
       count(*) AS events
FROM geo GROUP BY 1"""

GUARDED_REASON = REASON.replace("\nEND", """
     WHEN "timestamp" > 4102444800000 THEN 'future_timestamp'
END""")
_GUARDED = _with(PER_EVENT, FUTURE_WIRE) + f"""
SELECT key, value, rejectReason AS "rejectReason" FROM (SELECT key, value, {GUARDED_REASON} AS rejectReason FROM decoded) r
WHERE rejectReason IS NOT NULL"""
SQL["guarded_rejects"] = _GUARDED
SQL["intake_rejects"] = f"""SELECT value, "rejectReason" FROM ({_GUARDED})"""

SQL["dedup_conflicts"] = _with(PER_EVENT) + f"""
SELECT "clientId", "cellId", "timestamp" AS "eventTimeMs", "signalDbm", congestion, technology FROM (
  SELECT * FROM geo
  UNION ALL
  SELECT "clientId", "cellId", latitude, longitude, "signalDbm" - 1, 100 - congestion,
         CASE technology WHEN '5G' THEN '4G' ELSE '5G' END, "timestamp" FROM pe WHERE m = 23
) x WHERE {VALID}
QUALIFY row_number() OVER (PARTITION BY "clientId", "cellId", "timestamp" ORDER BY latitude, longitude, "signalDbm", congestion, technology) = 1"""

SQL["dedup_events"] = _with(PER_EVENT, CLEAN, DEDUP) + """
SELECT "clientId", "cellId", "timestamp" AS "eventTimeMs", "signalDbm", congestion, technology FROM dedup"""

SQL["window_agg"] = _with(PER_EVENT, CLEAN, DEDUP, WINDOWS) + " SELECT * FROM agg"

SQL["window_tumbling"] = _with(PER_EVENT, CLEAN, DEDUP, TUMBLING) + " SELECT * FROM agg_t"

SQL["with_consent"] = _with(PER_EVENT, CLEAN, DEDUP, WINDOWS, CONSENTS, WITH_CONSENT) + " SELECT * FROM wc"

SQL["with_cells"] = _with(PER_EVENT, CLEAN, DEDUP, WINDOWS, CONSENTS, CELLS, WITH_CONSENT, WITH_CELLS) + " SELECT * FROM wl"

_CAND_COLS = 'SELECT * FROM cand'
SQL["candidates"] = _with(*CHAIN, _candidates()) + " " + _CAND_COLS
SQL["candidates_min3"] = _with(*CHAIN, _candidates('AND "eventCount" >= 3')) + " " + _CAND_COLS
SQL["target_cell_candidates"] = (
    _with(*CHAIN, _candidates("""AND list_contains(string_split("targetCells", ','), "cellId")""")) + " " + _CAND_COLS
)

SQL["decisions"] = _chain() + " SELECT * FROM dec"
SQL["alerts"] = _chain() + f" SELECT {ALERT_COLS} FROM dec"
SQL["sent_alerts"] = _chain() + f""" SELECT {ALERT_COLS} FROM dec WHERE "aiDecision" = 'SEND'"""
SQL["signal_floor_decisions"] = _chain(floor=FV.SIGNAL_FLOOR_DBM) + " SELECT * FROM dec"

SQL["external_decisions"] = _chain() + """,
rep0 AS (
  SELECT *, ("windowStart" // 30000 + CAST(substring("clientId", 8, 4) AS BIGINT)) % 8 AS sel,
         CASE WHEN technology = '4G' THEN 'SKIP' ELSE 'SEND' END AS rdec
  FROM dec
),
rep AS (
  SELECT *, sel IN (0, 1, 5, 6) OR (sel = 7 AND rdec = 'SKIP') AS usable FROM rep0
)
SELECT "windowStart", "windowEnd", "clientId", "cellId", segment, "avgCongestion", technology,
       CASE WHEN usable THEN 'external' ELSE 'rules' END AS "decisionSource",
       CASE WHEN usable THEN rdec ELSE "aiDecision" END AS "aiDecision",
       CASE WHEN usable THEN printf('Servicio: %s en %s', "clientId", "cellId") ELSE "aiReasoning" END AS "aiReasoning",
       CASE WHEN usable THEN (CASE WHEN rdec = 'SEND' THEN 'Activa 5G ``` prioritario' ELSE '' END) ELSE "smsText" END AS "smsText"
FROM rep"""

SQL["clients_per_cell"] = _with(PER_EVENT, CLEAN, DEDUP, WINDOWS) + """
SELECT "windowStart", "windowEnd", "cellId", count(*) AS "approxClients", count(*) AS clients, CAST(sum("eventCount") AS BIGINT) AS "eventCount", true AS "withinError"
FROM agg GROUP BY ALL"""

SQL["clients_per_hour"] = _with(PER_EVENT, CLEAN, DEDUP) + """
SELECT "timestamp" // 3600000 AS hour, "cellId", count(DISTINCT "clientId") AS "approxClients", count(*) AS "eventCount"
FROM dedup GROUP BY ALL"""

# kind 6 came too late
SQL["reply_alerts"] = SQL["external_decisions"].replace("sel IN (0, 1, 5, 6)", "sel IN (0, 1, 5)").replace(
    'SELECT "windowStart", "windowEnd", "clientId", "cellId", segment, "avgCongestion", technology,',
    'SELECT "clientId", "cellId", city, "avgCongestion" AS congestion, technology, segment,',
)

SQL["sms_length"] = _chain() + f"""
SELECT "windowStart", "clientId", "cellId", "aiDecision", CAST(length("smsText") AS INTEGER) AS "smsLength",
       length("smsText") <= {FV.SMS_MAX_CHARS} AS "smsFits" FROM dec"""

SQL["alert_lines"] = _chain() + """
SELECT "clientId", "cellId",
       printf('%s | %-8s | %s (%s) | %d%%', "aiDecision", segment, "cellId", city, "avgCongestion") AS headline,
       substring("aiReasoning", 1, 80) AS "reasonLine",
       CASE WHEN "aiDecision" = 'SEND' THEN substring("smsText", 1, 80) END AS "smsLine"
FROM dec"""

SQL["alert_summary"] = _chain() + """
SELECT segment, "aiDecision", count(*) AS alerts FROM dec GROUP BY 1, 2"""

SQL["batch_tally"] = _chain() + """
SELECT count(*) AS candidates, count(*) FILTER (WHERE "aiDecision" = 'SEND') AS sent,
       count(*) FILTER (WHERE "aiDecision" = 'SKIP') AS skipped FROM dec"""

SQL["stream_alerts"] = SQL["alerts"]
SQL["results_roundtrip"] = SQL["sent_alerts"]
SQL["stream_tally"] = SQL["batch_tally"]
SQL["live_summary"] = SQL["alert_summary"]
SQL["stream_reply_alerts"] = f"""SELECT * EXCLUDE ("decisionSource") FROM ({SQL["reply_alerts"]})"""
