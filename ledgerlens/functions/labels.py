"""Fixed output labels.

Fixed values: these strings must equal the reference's so that grouped
results and reports carry the same labels. UTF-8, NFC.
"""

# time of day
SLOT_MORNING = "Mañana"
SLOT_AFTERNOON = "Tarde"
SLOT_EVENING = "Noche"
SLOT_NIGHT = "Madrugada"
# report order of the slots: Madrugada, Mañana, Tarde, Noche
SLOT_ORDER = (SLOT_NIGHT, SLOT_MORNING, SLOT_AFTERNOON, SLOT_EVENING)

# amount bands, low to high
AMOUNT_LOW = "Bajo"
AMOUNT_MEDIUM = "Medio"
AMOUNT_HIGH = "Alto"
AMOUNT_VERY_HIGH = "Muy Alto"

# gap to the previous transaction of the same customer
VELOCITY_VERY_FAST = "Muy Rápida"
VELOCITY_FAST = "Rápida"
VELOCITY_NORMAL = "Normal"
VELOCITY_SLOW = "Lenta"
VELOCITY_FIRST = "Primera Transacción"

# statuses
STATUS_APPROVED = "APPROVED"
STATUS_DECLINED = "DECLINED"
STATUS_PENDING = "PENDING"
STATUS_FRAUD = "FRAUD"

# alert priorities
PRIORITY_CRITICAL = "CRÍTICA"
PRIORITY_HIGH = "ALTA"
PRIORITY_MEDIUM = "MEDIA"
PRIORITY_LOW = "BAJA"

# alert reasons, joined with " | "
REASON_STATUS = "Estado FRAUD"
REASON_HIGH_DECLINED = "Monto alto rechazado"
REASON_NIGHT = "Transacción nocturna sospechosa"
REASON_VELOCITY = "Velocidad sospechosa"
REASON_SCORE_FORMAT = "Risk score alto (%d)"
REASON_SEPARATOR = " | "

# weekend split
PERIOD_WEEKEND = "Fin de Semana"
PERIOD_WEEKDAY = "Entre Semana"
