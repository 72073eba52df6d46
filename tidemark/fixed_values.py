"""Word lists, patterns and phrases that results must carry verbatim."""

# Raw column names of the exchange files.
PRICE_COLUMNS = (
    "SYMBOL", "SERIES", "DATE1", "PREV_CLOSE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "LAST_PRICE",
    "CLOSE_PRICE", "AVG_PRICE", "TTL_TRD_QNTY", "TURNOVER_LACS", "NO_OF_TRADES", "DELIV_QTY", "DELIV_PER",
)
INDEX_COLUMNS = (
    "Index Name", "Index Date", "Open Index Value", "High Index Value", "Low Index Value",
    "Closing Index Value", "Points Change", "Change(%)", "Volume", "Turnover (Rs. Cr.)", "P/E", "P/B",
    "Div Yield",
)
MASTER_COLUMNS = ("SYMBOL", "NAME OF COMPANY", "SERIES", "DATE OF LISTING", "ISIN NUMBER", "FACE VALUE")
INDUSTRY_COLUMNS = ("Symbol", "Industry")

# Equity series kept for analysis, preferred first.
EQUITY_SERIES = ("EQ", "BE", "BZ", "SM", "ST")

# Instruments that cannot be manipulated like a single stock.
ETF_SUFFIX = "BEES"
ETF_WORD = "ETF"

UNKNOWN_KEY = "unknown"
UNKNOWN_NAME = "Not in NSE equity master (ETF / SME / other)"
UNCLASSIFIED = "Unclassified"

# Corporate-action text.
SPLIT_PATTERN = r"(?i)From\s+R[es]\.?\s*([\d.]+).*?To\s+R[es]\.?\s*([\d.]+)"
SPLIT_WORD = "split"
BONUS_WORD = "bonus"
BONUS_PATTERN = r"(?i)Bonus\s+(\d+)\s*:\s*(\d+)"

# Filing classes in order of precedence: category contains / starts with / equals.
FILING_CLASSES = (
    ("EXCHANGE_QUERY", ("spurt in volume", "price movement"), ("clarification",), ()),
    ("RESULTS", ("financial result",), ("integrated filing", "analysts/institutional"),
     ("Outcome of Board Meeting", "Investor Presentation")),
    ("ORDER_WIN", ("orders/contracts",), (), ()),
    ("CORPORATE_DEAL", ("takeover",), (),
     ("Acquisition", "Amalgamation / Merger", "Scheme of Arrangement", "Buyback", "Preferential Issue",
      "Qualified Institutional Placement", "Fund raising", "Disinvestment", "Open Offer")),
    ("REGULATORY_LEGAL", (), ("action(s)", "pendency of litigation", "granting/withdrawal"),
     ("Credit Rating", "Corporate Insolvency Resolution Process")),
    ("ROUTINE", ("newspaper",), ("certificate under sebi",),
     ("Trading Window", "Structural Digital Database", "ESOP/ESOS/ESPS", "Shareholders meeting", "Record Date",
      "Extension  of Financial Year", "Loss of Share Certificates", "Duplicate Share Certificate",
      "Change in Registrar and Share Transfer Agent", "Book Closure")),
)
FILING_OTHER = "OTHER"
RESULTS_SUMMARY_PATTERN = r"(?i)\bQ[1-4]\s?FY\s?\d{2}"
EXCHANGE_QUERY = "EXCHANGE_QUERY"
ROUTINE = "ROUTINE"
MATERIAL_NEWS = ("CORPORATE_DEAL", "ORDER_WIN", "OTHER", "REGULATORY_LEGAL", "RESULTS")

# Index families in order of precedence.
INDEX_FAMILIES = (
    ("Broad Market",
     r"^Nifty (50|Next 50|100|200|500|Midcap \d+|Smallcap \d+|Microcap 250|Total Market|LargeMidcap 250"
     r"|MidSmallcap 400)$"),
    ("Sectoral",
     r"(?i)bank|financial|IT$|pharma|auto|fmcg|metal|realty|energy|media|oil|healthcare|consumer durables"
     r"|chemicals|services sector"),
    ("Volatility", r"(?i)vix"),
    ("Fixed Income", r"(?i)g-sec|sdl|bond|gilt|t-bill|aaa|composite|gs "),
)
INDEX_OTHER = "Strategy / Thematic"

# Fund attributes.
ASSET_CLASSES = (("Equity", "Equity"), ("Debt", "Debt"), ("Hybrid", "Hybrid"), ("Solution", "Solution Oriented"))

# Transaction types that take units out.
OUTFLOW_TYPES = ("SELL", "REDEEM", "SWP")
TXN_TYPES = ("BUY", "SELL", "SIP", "LUMPSUM", "REDEEM", "SWP")
STOCK = "STOCK"
MUTUAL_FUND = "MUTUAL_FUND"

# Rule flag, points column and published name, in the order they are listed.
RULES = (
    ("r_volume_spike", "pts_volume", "VOLUME_SPIKE"),
    ("r_price_shock", "pts_price_shock", "PRICE_SHOCK"),
    ("r_pump", "pts_pump", "PUMP_PATTERN"),
    ("r_dump_after_pump", "pts_dump", "DUMP_AFTER_PUMP"),
    ("r_delivery_anomaly", "pts_delivery", "DELIVERY_ANOMALY"),
    ("r_circuit_streak", "pts_circuit", "CIRCUIT_STREAK"),
    ("r_gap_move", "pts_gap", "GAP_MOVE"),
)
BANDS = ("HIGH", "MEDIUM", "LOW")
NOT_ALERTED = "NOT_ALERTED"

# Reason phrases: %s are numbers already formatted.
REASON_VOLUME = "Volume %sx its 20-day average"
REASON_VOLUME_Z = "Volume %sx its 20-day average (%s sd above its own normal)"
REASON_SHOCK = "Moved %s%% while its sector moved %s%%"
REASON_SHOCK_Z = "Moved %s%% while its sector moved %s%% (%sx its usual daily swing)"
REASON_PUMP = "Up %s%% in 5 days on %sx volume with delivery only %s%% (usual %s%%)"
REASON_DUMP = "Fell %s%% (3-day %s%%) after a recent pump pattern"
REASON_DELIVERY = "Delivery %s%% vs usual %s%% on %sx volume"
REASON_CIRCUIT = "%s consecutive closes at a price-band limit"
REASON_GAP = "Opened %s%% from previous close and held the gap"
REASON_ILLIQUID = "Thinly traded (avg turnover Rs %s cr/day)"

# Triage of an alert.
EXPLAINED = "EXPLAINED"
UNEXPLAINED = "UNEXPLAINED"
UNCLEAR = "UNCLEAR"
VERDICTS = (EXPLAINED, UNEXPLAINED, UNCLEAR)
TRIAGE_NEWS = "Possible explanation: %s filing(s)"
TRIAGE_QUERY = "No company news; NSE has asked the company to explain the move"
TRIAGE_NONE = "No company news in the last 3 days: worth a look"
TRIAGE_LINE_CHARS = 140
TRIAGE_FILINGS = 8
TRIAGE_SUMMARY_CHARS = 400

# Daily digest.
DIGEST_WATCHLIST = 10
DIGEST_REPEAT_DAYS = 5
DIGEST_TITLE = "📊 NSE surveillance: %s"
DIGEST_COUNTS = "%s flagged · %s HIGH · %s MEDIUM"
DIGEST_HIGH = "🚨 HIGH (%s)"
DIGEST_NO_HIGH = "🚨 No HIGH alerts today"
DIGEST_WATCH = "👀 Watchlist: top %s new MEDIUM names"
DIGEST_ICONS = {"EXPLAINED": "✅", "UNCLEAR": "❔", "UNEXPLAINED": "🔎"}
DIGEST_ICON_OTHER = "•"
DIGEST_QUALITY = "🩺 Data quality: %s"
DIGEST_CLOSING = "Signals for analysis, not accusations."

# Safety check of one stock: titles and details.
CHECK_LISTED = "On NSE's surveillance list"
CHECK_NOT_LISTED = "Not on any NSE surveillance list"
CHECK_CALM = "No unusual trading in the last 10 trading days"
CHECK_FLAGGED = "Flagged %s time%s in the last 10 trading days (%s risk)"
CHECK_TRIAGE = "Is the move explained by company news?"
CHECK_NEWS = "The company filed news around the move"
CHECK_NO_NEWS = "No company news behind the move"
CHECK_QUERIED = "NSE asked the company to explain a move"
CHECK_NOT_QUERIED = "No NSE queries this month"
CHECK_THIN = "Thinly traded: about ₹%s cr a day"
CHECK_LIQUID = "Liquid enough: about ₹%s cr traded a day"
CHECK_DELIVERY = "Mostly short-term trading on the last day"
CHECK_RISE = "Up %s%% in 20 trading days"
CHECK_FALL = "Down %s%% in 20 trading days"
DETAIL_LISTED = ("%s (as of %s). NSE puts stocks here after unusual price or volume behaviour, and restricts how they "
                 "can be traded.")
DETAIL_NOT_LISTED = "Checked against NSE's short-term, long-term and graded lists."
DETAIL_CALM = "Our 7 rules did not flag it at medium or high risk."
DETAIL_FLAGGED = "Strongest on %s: %s."
DETAIL_NEWS = "Filings: %s. Read them before assuming the move is real."
DETAIL_NO_NEWS = ("Nothing was filed in the 3 days before. Big moves without news are the classic pump pattern.")
DETAIL_QUERIED_ONCE = "%s on %s."
DETAIL_QUERIED_MORE = "%s on %s, and %s more time(s) this month."
DETAIL_NOT_QUERIED = "NSE has not asked the company about unusual price or volume."
DETAIL_THIN = ("Small amounts of money can move the price, and selling can be hard when everyone wants out.")
DETAIL_LIQUID = "Hard to move with small amounts of money."
DETAIL_DELIVERY = ("Only %s%% of traded shares were delivered, against a usual %s%%. Buyers were not holding on.")
DETAIL_RISE = "Fast run-ups are where late buyers get hurt most."
DETAIL_FALL = "Check why before assuming it is cheap."

# Daily steps in running order.
STEPS = ("calendar", "extract", "silver", "dbt", "surveillance", "quality", "alerts")

# Tidying of a company name before an exact name match.
NAME_SUFFIX_PATTERN = r"\s+(LIMITED|LTD\.?)$"
TICKER_SUFFIX_PATTERN = r"\.NS$"
