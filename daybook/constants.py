"""Fixed values the results depend on."""

# --- fixed values: names, lists and formats that input and output must agree on ---

SYMBOL_KEY = "currencySymbol"
AMOUNT_KEY = "currencyValueDecimal"
DEFAULT_SYMBOL = ""
DEFAULT_AMOUNT = "0"

STABLECOINS = ("USDC", "USDC.E")
PEG_PRICE = 1.0
BASE_UNITS_PER_TOKEN = {"MATIC": 1e18}

COIN_IDS = {"MATIC": "matic-network", "SFL": "sunflower-land"}
HISTORY_URL = "https://api.coingecko.com/api/v3/coins/{coin_id}/history"
HISTORY_PARAMS = "date={date}&localization=false"
HISTORY_DATE_FORMAT = "dd-MM-yyyy"

QUOTE_KEY = "prices/{symbol}/{date}.json"
QUOTE_DATE_FORMAT = "yyyy-MM-dd"
SUCCESS_STATUS = 200

# --- end of fixed values ---

PEG = "peg"
EXACT = "exact"
LAST_KNOWN = "last_known"
UNPRICED = "unpriced"
