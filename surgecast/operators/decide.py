"""SEND/SKIP decisions as column expressions (no driver round trip).

Rules (offline decision policy): PREMIUM sends above 60 % with fewer than 5
campaigns this month, STANDARD above 70 % with fewer than 3, BASIC above
80 % with fewer than 2; anything else, including an unknown or missing
segment, is SKIP. Congestion is the truncated window average. A missing
campaign count counts as 0.

The SKIP reason keeps the reference's wording, whose limit test (>= 3) is
the same for every segment; ``skipCode`` states the actual cause.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast import schemas
from surgecast.config import CampaignConfig
from surgecast.functions import fixed_values as FV
from surgecast.functions.columns import epoch_millis
from surgecast.operators.windows import duration_ms

# our own reason text for the optional signal floor (not a reference value)
SIGNAL_FLOOR_REASON_FMT = "Señal %d dBm por debajo del mínimo %d dBm"

SKIP_BELOW_THRESHOLD = "BELOW_THRESHOLD"
SKIP_CAMPAIGN_LIMIT = "CAMPAIGN_LIMIT"
SKIP_UNKNOWN_SEGMENT = "UNKNOWN_SEGMENT"
SKIP_SIGNAL_FLOOR = "SIGNAL_FLOOR"


def _sent() -> Column:
    return F.coalesce(F.col("campaignsSent"), F.lit(0))


def policy_send(segment: Column, congestion: Column, sent: Column) -> Column:
    """Boolean: does the segment policy send? (never null)"""
    chain = None
    for seg, (min_cong, max_sent) in FV.SEGMENT_POLICY.items():
        cond = (congestion > F.lit(min_cong)) & (sent < F.lit(max_sent))
        chain = F.when(segment == F.lit(seg), cond) if chain is None else chain.when(segment == F.lit(seg), cond)
    return F.coalesce(chain.otherwise(F.lit(False)), F.lit(False))


def _known_segment(segment: Column) -> Column:
    return F.coalesce(segment.isin(*FV.SEGMENT_POLICY.keys()), F.lit(False))


def _segment_cap_reached(segment: Column, sent: Column) -> Column:
    chain = None
    for seg, (_, max_sent) in FV.SEGMENT_POLICY.items():
        cond = sent >= F.lit(max_sent)
        chain = F.when(segment == F.lit(seg), cond) if chain is None else chain.when(segment == F.lit(seg), cond)
    return F.coalesce(chain.otherwise(F.lit(False)), F.lit(False))


def decision_columns(cfg: CampaignConfig | None = None) -> dict[str, Column]:
    """aiDecision, aiReasoning, smsText, skipCode for a candidate row."""
    cfg = cfg or CampaignConfig()
    seg, cong, tech, sent = F.col("segment"), F.col("avgCongestion"), F.col("technology"), _sent()
    by_policy = policy_send(seg, cong, sent)
    floor_hit = F.lit(False)
    if cfg.signal_floor_dbm is not None:
        floor_hit = F.coalesce(F.col("avgSignalDbm") < F.lit(cfg.signal_floor_dbm), F.lit(False))
    send = by_policy & ~floor_hit

    decision = F.when(send, F.lit(FV.DECISION_SEND)).otherwise(F.lit(FV.DECISION_SKIP))
    sms = F.when(send, F.when(tech == F.lit("5G"), F.lit(FV.SMS_5G)).otherwise(F.lit(FV.SMS_OTHER))).otherwise(F.lit(""))
    reason = F.when(send, F.format_string(FV.SEND_REASON_FMT, seg, cong, sent))
    if cfg.signal_floor_dbm is not None:
        reason = reason.when(
            by_policy & floor_hit,
            F.format_string(SIGNAL_FLOOR_REASON_FMT, F.col("avgSignalDbm"), F.lit(cfg.signal_floor_dbm)),
        )
    reason = reason.when(sent >= F.lit(FV.REASON_CAMPAIGN_LIMIT), F.format_string(FV.SKIP_LIMIT_REASON_FMT, sent)).otherwise(
        F.format_string(FV.SKIP_BELOW_REASON_FMT, cong, seg)
    )
    skip_code = (
        F.when(send, F.lit(None).cast("string"))
        .when(by_policy & floor_hit, F.lit(SKIP_SIGNAL_FLOOR))
        .when(~_known_segment(seg), F.lit(SKIP_UNKNOWN_SEGMENT))
        .when(_segment_cap_reached(seg, sent), F.lit(SKIP_CAMPAIGN_LIMIT))
        .otherwise(F.lit(SKIP_BELOW_THRESHOLD))
    )
    return {"aiDecision": decision, "aiReasoning": reason, "smsText": sms, "skipCode": skip_code}


def decide(candidates: DataFrame, cfg: CampaignConfig | None = None) -> DataFrame:
    return candidates.withColumns(decision_columns(cfg))


# ---------------------------------------------------------------- external replies
_API_BODY = "struct<content: array<struct<type: string, text: string>>>"
# an opening fence (with a language name) or a closing one, at the ends only
_OPENING = r"^\s*`{3}[A-Za-z0-9_-]*\s"
_CLOSING = r"\s`{3}\s*$"


def reply_text(body: Column) -> Column:
    """Text of a decision service reply: the first block of type ``text`` when
    the body is an API document (null if it has none), else the body itself."""
    blocks = F.from_json(body, _API_BODY)["content"]
    first = F.get(F.filter(blocks, lambda b: b["type"] == F.lit("text")), F.lit(0))["text"]
    return F.when(blocks.isNotNull(), first).otherwise(body)


def parse_reply(text: Column) -> Column:
    """Reply text -> struct(decision, reasoning, smsText); a fence around the
    whole text is taken off, text inside is left as it is. Invalid replies
    give a struct whose decision is null."""
    inner = F.regexp_replace(F.regexp_replace(text, _OPENING, ""), _CLOSING, "")
    return F.from_json(inner, schemas.DECISION_REPLY)


def apply_replies(df: DataFrame, body_col: str = "reply", cfg: CampaignConfig | None = None) -> DataFrame:
    """Decisions from a reply column (null when no reply arrived), falling
    back to the policy rules when a reply is missing or unusable: no valid
    decision, an SMS that does not fit one message, or SEND below the signal
    floor. The reply is parsed once into a column and referenced from there."""
    cfg = cfg or CampaignConfig()
    rules = decision_columns(cfg)
    parsed = df.withColumn("_reply", parse_reply(reply_text(F.col(body_col))))
    r = F.col("_reply")
    valid = r["decision"].isin(FV.DECISION_SEND, FV.DECISION_SKIP)
    fits = F.char_length(F.coalesce(r["smsText"], F.lit(""))) <= F.lit(FV.SMS_MAX_CHARS)
    usable = F.coalesce(valid, F.lit(False)) & fits
    if cfg.signal_floor_dbm is not None:
        below = F.coalesce(F.col("avgSignalDbm") < F.lit(cfg.signal_floor_dbm), F.lit(False))
        usable = usable & ~((r["decision"] == F.lit(FV.DECISION_SEND)) & below)
    return parsed.withColumns(
        {
            "decisionSource": F.when(usable, F.lit("external")).otherwise(F.lit("rules")),
            "aiDecision": F.when(usable, r["decision"]).otherwise(rules["aiDecision"]),
            "aiReasoning": F.when(usable, F.coalesce(r["reasoning"], F.lit(""))).otherwise(rules["aiReasoning"]),
            "smsText": F.when(usable, F.coalesce(r["smsText"], F.lit(""))).otherwise(rules["smsText"]),
            "skipCode": F.when(~usable, rules["skipCode"]),
        }
    ).drop("_reply")


def with_external_decisions(
    candidates: DataFrame,
    replies: DataFrame,
    keys: list[str],
    body_col: str = "reply",
    cfg: CampaignConfig | None = None,
) -> DataFrame:
    """Join a table of service replies (never collected) to the candidates,
    then ``apply_replies``. Of several replies for one key the smallest text
    counts."""
    one = replies.groupBy(*keys).agg(F.min(body_col).alias(body_col))
    joined = candidates.join(one, on=keys, how="left")
    return apply_replies(joined, body_col, cfg).drop(body_col)


REPLY_KEYS = ["windowStart", "clientId", "cellId"]


def decide_with_replies(candidates: DataFrame, replies: DataFrame, cfg: CampaignConfig | None = None) -> DataFrame:
    """Decisions from a reply table (``schemas.REPLY``); the rules decide
    where no usable reply came in time. In time is up to ``reply_lateness``
    after the window's end, whenever the lookup happens: a replay decides as
    the first attempt did. ``candidates`` have ``window`` or ``windowStart``."""
    cfg = cfg or CampaignConfig()
    flat = "windowStart" in candidates.columns
    keyed = candidates if flat else candidates.withColumn("windowStart", epoch_millis(F.col("window.start")))
    allowed = duration_ms(cfg.window_duration) + duration_ms(cfg.reply_lateness)
    timely = replies.where(F.col("repliedAt") <= F.col("windowStart") + F.lit(allowed)).select(*REPLY_KEYS, "reply")
    decided = with_external_decisions(keyed, timely, REPLY_KEYS, cfg=cfg)
    first = [c for c in candidates.columns]
    return decided.select(*first, *[c for c in decided.columns if c not in first and (flat or c != "windowStart")])


def sms_quality(decisions: DataFrame) -> DataFrame:
    """Length of each SMS and whether it fits one message."""
    n = F.char_length(F.coalesce(F.col("smsText"), F.lit("")))
    return decisions.withColumns({"smsLength": n, "smsFits": n <= F.lit(FV.SMS_MAX_CHARS)})
