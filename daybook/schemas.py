"""Column layouts of the relations the jobs read and write."""

# Landed records are kept word for word, so every field is text.
RAW_COLUMNS = ("ts", "project_id", "props", "nums")
RAW = "ts string, project_id string, props string, nums string"
BRONZE = f"{RAW}, date date, batch string"

TRANSACTIONS = "date date, project_id bigint, currency_symbol string, amount double"

# Files taken up from a folder; ``done`` comes after their batch is landed and valued.
ARRIVALS = "file string, size bigint, label string, done boolean"

# CSV lines that do not fit their header.
QUARANTINE = "line string, cells int, file string, block bigint, batch string"

QUOTES = "symbol string, date date, price double"
RESPONSES = "symbol string, date date, status_code int, body string"

PROJECT_METRICS = "project_id bigint, num_transactions bigint, raw_volume double, date date"
PROJECT_METRICS_REQUIRED = ("date", "project_id", "num_transactions", "raw_volume")

METRICS = (
    "project_id bigint, currency_symbol string, num_transactions bigint, raw_volume double, "
    "price double, price_source string, usd_volume double, date date"
)
METRICS_KEY = ("date", "currency_symbol", "project_id")
METRICS_REQUIRED = ("date", "project_id", "num_transactions", "usd_volume")
