"""Column names and schemas shared by every operator."""

from pyspark.sql import types as T

KEY = ["symbol", "dt"]
PRICES = ["open", "high", "low", "close"]
BAR = [*KEY, *PRICES, "volume"]
ADJUSTED = ["adj_open", "adj_high", "adj_low", "adj_close"]

BAR_FILE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("dt", T.DateType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICES],
        T.StructField("volume", T.DoubleType()),
    ]
)
# With the text of a line that does not fit, as the reader gives it.
MALFORMED = T.StructField("malformed", T.StringType())
BAR_LINE = T.StructType([*BAR_FILE.fields, MALFORMED])
BARS = T.StructType([*BAR_FILE.fields[:-1], T.StructField("volume", T.LongType())])
# Ingest position of a bar: its file's day and name, block and row.
SEQ = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
    ]
)
BARS_MOD = T.StructType([*BARS.fields, *[T.StructField(c, T.DoubleType()) for c in ADJUSTED]])

# A line of either file of reviewed replacements; lines of one pair carry the same `pair`.
PAIR_FILE = T.StructType([T.StructField("pair", T.StringType()), *BARS.fields, MALFORMED])

RENAMES = T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType())])
MULTIPLIERS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("dt", T.DateType()),
        T.StructField("multiplier", T.DoubleType()),
    ]
)
INDEX_FEED = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("date_text", T.StringType()),
        T.StructField("scrip", T.StringType()),
        T.StructField("change_text", T.StringType()),
    ]
)
SCRIP_MAP = T.StructType([T.StructField("scrip", T.StringType()), T.StructField("symbol", T.StringType())])
MANUAL_FIX = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("dt", T.DateType()),
        T.StructField("correct_symbol", T.StringType()),
    ]
)
INDEX_CURRENT = T.StructType(
    [T.StructField("index_name", T.StringType()), T.StructField("symbol", T.StringType())]
)
SNAPSHOTS = T.StructType(
    [
        T.StructField("index_name", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)
RANGES = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("start_dt", T.DateType()),
        T.StructField("end_dt", T.DateType()),
    ]
)

# Table-source labels of the symbol ranges.
RAW_SOURCE = "Dump"
MOD_SOURCE = "ModDump"

# Index names that were changed by the exchange.
INDEX_RENAMES = {
    "Nifty Free Float Smallcap 100": "NIFTY Smallcap 100",
    "Nifty Free Float Midcap 100": "NIFTY Midcap 100",
}

# Short code per index, used as symbol suffix in exports.
INDEX_CODES = {
    "NIFTY LargeMidcap 250": "NLMC250",
    "NIFTY Midcap 100": "NMC100",
    "NIFTY Smallcap 100": "NSC100",
    "Nifty 100": "N100",
    "Nifty 200": "N200",
    "Nifty 50": "N50",
    "Nifty 500": "N500",
    "Nifty Alpha 50": "NALPHA50",
    "Nifty Auto": "NAUTO",
    "Nifty Bank": "NBANK",
    "Nifty Commodities": "NCOMM",
    "Nifty Dividend Opportunities 50": "NDIVO50",
    "Nifty Energy": "NENERGY",
    "Nifty FMCG": "NFMCG",
    "Nifty Financial Services": "NFINS",
    "Nifty Growth Sectors 15": "NGROWTH15",
    "Nifty High Beta 50": "NHBETA50",
    "Nifty IT": "NIT",
    "Nifty India Consumption": "NINDCONS",
    "Nifty Infrastructure": "NINFRA",
    "Nifty Low Volatility 50": "NLVOL50",
    "Nifty MNC": "NMNC",
    "Nifty Media": "NMEDIA",
    "Nifty Metal": "NMETAL",
    "Nifty Midcap 50": "NMC50",
    "Nifty Midcap Liquid 15": "NMCLIQ15",
    "Nifty Next 50": "NNXT50",
    "Nifty PSE": "NPSE",
    "Nifty PSU Bank": "NPSUBANK",
    "Nifty Pharma": "NPHARMA",
    "Nifty Realty": "NREALTY",
    "Nifty Services Sector": "NSERV",
    "Nifty100 Liquid 15": "N100LIQ15",
    "Nifty50 Value 20": "N50VAL20",
}

# Indices flagged when the caller names none.
DEFAULT_INDICES = [
    "NIFTY LargeMidcap 250",
    "NIFTY Midcap 100",
    "NIFTY Smallcap 100",
    "Nifty 100",
    "Nifty 200",
    "Nifty 50",
    "Nifty 500",
    "Nifty Alpha 50",
    "Nifty High Beta 50",
    "Nifty Low Volatility 50",
    "Nifty Midcap 50",
    "Nifty Midcap Liquid 15",
    "Nifty Next 50",
    "Nifty100 Liquid 15",
]
