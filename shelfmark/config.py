"""Fixed values and default parameters.

Everything here is small, literal and broadcast-free: values become Spark
literals or tiny in-plan inline tables.
"""

from __future__ import annotations

# --- Fixed values (must equal the modelled pricing engine for equal results) ---

# Domain elasticity per category of the test-data adapter (p_type plays the
# role of a product category).  MEDIUM has no counterpart and gets our own -2.4.
CATEGORY_ELASTICITY = {
    "PROMO": -0.5,
    "STANDARD": -2.0,
    "SMALL": -1.5,
    "LARGE": -1.2,
    "ECONOMY": -1.0,
    "MEDIUM": -2.4,
}
DEFAULT_ELASTICITY = -1.0

# Public holidays used by the is_holiday flag (ISO dates).
HOLIDAYS = (
    "2023-01-26", "2023-03-08", "2023-03-22", "2023-03-30",
    "2023-04-07", "2023-04-14", "2023-04-22", "2023-05-05",
    "2023-06-29", "2023-08-15", "2023-08-30", "2023-09-07",
    "2023-09-28", "2023-10-02", "2023-10-24", "2023-11-01",
    "2023-11-12", "2023-11-27", "2023-12-25",
    "2024-01-26", "2024-03-25", "2024-03-29", "2024-04-11",
    "2024-04-14", "2024-04-17", "2024-04-21", "2024-06-17",
    "2024-07-17", "2024-08-15", "2024-08-26", "2024-09-16",
    "2024-10-02", "2024-10-12", "2024-10-31", "2024-11-01",
    "2024-11-15", "2024-12-25",
)

# Markdown scenario discounts (fractions).
SIMULATION_DISCOUNTS = (0.0, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50)

# Optimiser bounds and soft clearance target.
OPT_DISCOUNT_MIN = 0.0
OPT_DISCOUNT_MAX = 0.50
OPT_MIN_CLEARANCE = 0.60
HOLDING_COST_RATE = 0.05
STOCK_PRESSURE_FACTOR = 3
PROJECTION_DAYS = 30
RECENT_DAYS = 90
DEFAULT_DAILY_DEMAND = 10.0

# Elasticity regression.
MIN_OBSERVATIONS = 30
R2_THRESHOLD = 0.20

# Forecast.
FORECAST_MONTHS = 3
SEASONAL_PERIOD = 12
SMA_WINDOW = 3
Z_95 = 1.96

# Promotion types of the derived promotions.
PROMO_TYPES = ("Clearance", "Festival", "Flash Sale", "Seasonal")

CURRENCY_SYMBOL = "₹"

DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# What-if slider discount range (percent): 0..50 step 5.
WHATIF_DISCOUNT_RANGE = (0, 50, 5)
