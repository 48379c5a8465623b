"""Fixed values that must equal the reference's for identical results.

Kept together, as plain text, in their natural order.
"""

# --- fixed values: decision policy (segment -> congestion must exceed, campaigns must stay under)
SEGMENT_POLICY = {
    "PREMIUM": (60, 5),
    "STANDARD": (70, 3),
    "BASIC": (80, 2),
}

# --- fixed values: SKIP reason uses this limit for every segment
REASON_CAMPAIGN_LIMIT = 3

# --- fixed values: SMS texts and reasons
SMS_5G = "Tu red está saturada. Activa la priorización 5G. Responde SÍ (gratis 24h)."
SMS_OTHER = "Zona congestionada. Activa 5G prioritario y navega sin cortes. Responde SÍ (gratis 24h)."
SEND_REASON_FMT = "Segmento %s, congestión %d%%, %d campañas."
SKIP_LIMIT_REASON_FMT = "Límite de campañas alcanzado (%d/mes)"
SKIP_BELOW_REASON_FMT = "Congestión %d%% no supera umbral para %s"

DECISION_SEND = "SEND"
DECISION_SKIP = "SKIP"

# --- fixed values: SMS limits stated in the decision prompt
SMS_MAX_CHARS = 160
SIGNAL_FLOOR_DBM = -95

# --- fixed values: congestion bands used on the producer console
BAND_HIGH_MIN = 75
BAND_MEDIUM_MIN = 50

# --- fixed values: reference tables
CONSENT_SEGMENT_CYCLE = ["PREMIUM", "PREMIUM", "STANDARD", "STANDARD", "STANDARD", "BASIC"]
CELLS_PER_SEGMENT = {"PREMIUM": 8, "STANDARD": 5, "BASIC": 3}
CONSENT_CLIENTS = 50
CELL_COUNT = 20
CELL_LOCATIONS = [
    ("Madrid", "Centro"),
    ("Madrid", "Bernabéu"),
    ("Madrid", "Retiro"),
    ("Barcelona", "Eixample"),
    ("Barcelona", "Gràcia"),
    ("Valencia", "Centro"),
    ("Sevilla", "Centro"),
    ("Bilbao", "Centro"),
    ("Málaga", "Costa"),
    ("Alicante", "Centro"),
    ("Madrid", "Sur"),
    ("Madrid", "Este"),
    ("Barcelona", "Poblenou"),
    ("Valencia", "Norte"),
    ("Sevilla", "Norte"),
    ("Zaragoza", "Centro"),
    ("Murcia", "Centro"),
    ("Palma", "Centro"),
    ("Las Palmas", "Centro"),
    ("Tenerife", "Sur"),
]

# --- fixed values: message key used when a producer event has no client id
NULL_KEY = "null_key"
