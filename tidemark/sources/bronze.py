"""Readers of the raw files: `<root>/<source>/dt=YYYY-MM-DD/<file>`, all parsed on the executors."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.classify import corporate_action
from tidemark.functions.cleaning import blank_to_null, code, day, number, numbers, require_columns, whole
from tidemark.operators.ordering import forward_fill
from tidemark.operators.windows import first_per

Days = Sequence[dt.date] | None

HISTORY_SCHEMA = ("meta struct<scheme_code:string,scheme_name:string,fund_house:string,scheme_category:string>, "
                  "data array<struct<date:string,nav:string>>")
ACTION_SCHEMA = "symbol string, series string, exDate string, subject string"
FILING_SCHEMA = "seq_id string, symbol string, sort_date string, `desc` string, attchmntText string, attchmntFile string"
MEMBER = "array<struct<symbol:string,asmSurvIndicator:string,survDesc:string>>"
ASM_SCHEMA = f"shortterm struct<data:{MEMBER}>, longterm struct<data:{MEMBER}>"
GSM_SCHEMA = "symbol string, gsmStage string, survDesc string"
HOLIDAY_SCHEMA = "CM array<struct<tradingDate:string,description:string>>"


def landed(spark: SparkSession, root: str, source: str, reader, days: Days = None) -> DataFrame | None:
    """Files of the chosen `dt=` folders through partition pruning; None where the source never landed."""
    try:
        df = reader(spark.read.option("basePath", f"{root}/{source}"), f"{root}/{source}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if "dt" not in df.columns:      # the source landed, but no file of this kind
        return None
    df = df.withColumn("dt", F.col("dt").cast("date"))
    return df if days is None else df.filter(F.col("dt").isin(*days))


def _csv(reader, path: str) -> DataFrame:
    return (reader.option("header", True).option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True).option("recursiveFileLookup", False).csv(path))


DOCUMENTS = "*.{json,txt}"      # the second as Spark's own text writer names them


def _json(schema: str, glob: str = DOCUMENTS):
    return lambda reader, path: reader.schema(schema).option("multiLine", True).option("pathGlobFilter", glob).json(path)


# ---------- prices and indices ----------

def typed_prices(raw: DataFrame) -> DataFrame:
    """All-text exchange rows to typed columns; anything unreadable becomes null."""
    doubles = {"prev_close": "PREV_CLOSE", "open": "OPEN_PRICE", "high": "HIGH_PRICE", "low": "LOW_PRICE",
               "last": "LAST_PRICE", "close": "CLOSE_PRICE", "vwap": "AVG_PRICE", "turnover_lacs": "TURNOVER_LACS",
               "deliv_pct": "DELIV_PER"}
    wholes = {"volume": "TTL_TRD_QNTY", "num_trades": "NO_OF_TRADES", "deliv_qty": "DELIV_QTY"}
    named = raw.select(day("DATE1").alias("trade_date"), code("SYMBOL").alias("symbol"), code("SERIES").alias("series"),
                       *doubles.values(), *wholes.values())
    return numbers(named, doubles, wholes).select(
        "trade_date", "symbol", "series", "prev_close", "open", "high", "low", "last", "close", "vwap", "volume",
        "turnover_lacs", "num_trades", "deliv_qty", "deliv_pct")


def prices(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    raw = landed(spark, root, "nse_bhavcopy", _csv, days)
    return None if raw is None else typed_prices(require_columns(raw, fixed.PRICE_COLUMNS, "nse_bhavcopy"))


def typed_indices(raw: DataFrame) -> DataFrame:
    return raw.select(
        day("Index Date", "dd-MM-yyyy").alias("trade_date"), F.trim(F.col("`Index Name`")).alias("index_name"),
        number("Open Index Value").alias("open"), number("High Index Value").alias("high"),
        number("Low Index Value").alias("low"), number("Closing Index Value").alias("close"),
        number("Points Change").alias("points_change"), number("Change(%)").alias("pct_change"),
        whole("Volume").alias("volume"), number("Turnover (Rs. Cr.)").alias("turnover_cr"), number("P/E").alias("pe"),
        number("P/B").alias("pb"), number("Div Yield").alias("div_yield"),
    ).filter(F.col("trade_date").isNotNull() & F.col("close").isNotNull())


def indices(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    raw = landed(spark, root, "nse_indices", _csv, days)
    return None if raw is None else typed_indices(require_columns(raw, fixed.INDEX_COLUMNS, "nse_indices"))


def long_prices(wide: DataFrame, sep: str = "|") -> DataFrame:
    """Fallback prices with one `TICKER|Field` column each to one row per (date, ticker), snake-case fields."""
    names = [c for c in wide.columns if sep in c]
    fields = sorted({c.split(sep)[1] for c in names})
    tickers = sorted({c.split(sep)[0] for c in names})
    per_ticker = [F.struct(F.lit(t).alias("ticker"), *[
        (F.col(f"`{t}{sep}{f}`") if f"{t}{sep}{f}" in names else F.lit(None)).cast("double")
        .alias(f.strip().lower().replace(" ", "_")) for f in fields]) for t in tickers]
    return wide.select(F.col("Date").alias("date"), F.explode(F.array(*per_ticker)).alias("_row")).select(
        "date", "_row.*")


# ---------- funds ----------

def nav_lines(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    """NAV files line by line. Place in the file is (block start, row id), so a file may span many tasks."""
    raw = landed(spark, root, "amfi_navall", lambda reader, path: reader.text(path), days)
    if raw is None:
        return None
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"),
                      F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))


def parse_nav_lines(lines: DataFrame) -> DataFrame:
    """(file, chunk, line_no, line) to NAV rows.

    Category and fund-house headings stand on lines of their own and hold for the rows below them; the NAV
    and its date are the last two fields of a row, whatever lies between.
    """
    line = F.trim("line")
    kept = lines.withColumn("line", line).filter((F.col("line") != "") & ~F.col("line").startswith("Scheme Code"))
    heading = ~F.col("line").contains(";")
    is_category = heading & F.col("line").contains("Schemes") & F.col("line").contains("(")
    category = F.trim(F.regexp_replace(F.regexp_extract("line", r"\((.*)$", 1), r"\)+$", ""))
    marked = kept.withColumns({
        "category": F.when(is_category, category),
        "amc": F.when(heading & ~is_category, F.col("line")),
    })
    filled = forward_fill(marked, ["file"], "chunk", ["line_no"], ["category", "amc"])
    f = F.split("line", ";")

    def field(i: int):
        return F.element_at(f, i)

    rows = filled.filter((F.size(f) >= 6) & F.trim(field(1)).rlike(r"^\d+$"))
    return rows.select(
        F.trim(field(1)).try_cast("long").alias("scheme_code"), blank_to_null(field(2)).alias("isin_growth"),
        blank_to_null(field(3)).alias("isin_reinvest"), F.trim(field(4)).alias("scheme_name"),
        F.trim(field(-2)).try_cast("double").alias("nav"), day(field(-1)).alias("nav_date"), "amc", "category",
    ).filter(F.col("nav_date").isNotNull() & F.col("scheme_code").isNotNull())


def fund_nav(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    lines = nav_lines(spark, root, days)
    return None if lines is None else parse_nav_lines(lines)


def newest_folder(spark: SparkSession, root: str, source: str) -> dt.date | None:
    """The newest day for which a source has a folder, from the names of its files."""
    found = landed(spark, root, source, lambda reader, path: reader.format("binaryFile").load(path))
    return None if found is None else found.agg(F.max("dt").alias("dt")).first().dt


def history_documents(spark: SparkSession, root: str) -> DataFrame | None:
    """(file, meta, data, broken) of every document in the newest folder; ``broken`` holds a text that is no document."""
    newest = newest_folder(spark, root, "mfapi_history")
    if newest is None:
        return None
    reader = spark.read.schema(f"{HISTORY_SCHEMA}, broken string").option("multiLine", True).option(
        "columnNameOfCorruptRecord", "broken").option("pathGlobFilter", DOCUMENTS)
    return reader.json(f"{root}/mfapi_history/dt={newest}").withColumn("file", F.col("_metadata.file_name"))


def history_rows(documents: DataFrame) -> DataFrame:
    """NAV rows of the documents that can be read."""
    rows = documents.where("broken is null").select("meta", F.explode("data").alias("d"))
    return rows.select(
        F.col("meta.scheme_code").try_cast("long").alias("scheme_code"), day(F.col("d.date"), "dd-MM-yyyy").alias("nav_date"),
        F.col("d.nav").try_cast("double").alias("nav"), F.col("meta.scheme_name").alias("scheme_name"),
        F.col("meta.fund_house").alias("amc"), F.col("meta.scheme_category").alias("category"),
    ).filter(F.col("nav_date").isNotNull() & (F.col("nav") > 0))


def fund_history(spark: SparkSession, root: str) -> DataFrame | None:
    documents = history_documents(spark, root)
    return None if documents is None else history_rows(documents)


def watched(df: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Only the schemes on the watch list (scheme_code, label)."""
    return df.join(watchlist.select("scheme_code").distinct(), "scheme_code", "left_semi")


# ---------- reference data ----------

def stock_master(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    """The chosen snapshots of the equity list, with the newest industry map."""
    raw = landed(spark, root, "nse_equity_list", _csv, days)
    if raw is None:
        return None
    raw = require_columns(raw, fixed.MASTER_COLUMNS, "nse_equity_list")
    listed = raw.select(
        F.col("dt").alias("snapshot_date"), code("SYMBOL").alias("symbol"),
        F.trim(F.col("`NAME OF COMPANY`")).alias("company_name"), code("SERIES").alias("series"),
        day("DATE OF LISTING").alias("listing_date"), F.trim(F.col("`ISIN NUMBER`")).alias("isin"),
        number("FACE VALUE").alias("face_value"))
    newest = newest_folder(spark, root, "nse_nifty500")
    if newest is None:
        return listed.withColumns({"industry": F.lit(None).cast("string"), "in_nifty500": F.lit(False)})
    industries = _csv(spark.read, f"{root}/nse_nifty500/dt={newest}")
    mapped = require_columns(industries, fixed.INDUSTRY_COLUMNS, "nse_nifty500").groupBy(
        code("Symbol").alias("symbol")).agg(F.min(F.trim("Industry")).alias("industry"))
    return listed.join(mapped.withColumn("in_nifty500", F.lit(True)), "symbol", "left").withColumn(
        "in_nifty500", F.coalesce("in_nifty500", F.lit(False))).select(*listed.columns, "industry", "in_nifty500")


def corporate_actions(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    raw = landed(spark, root, "nse_corp_actions", _json(ACTION_SCHEMA), days)
    if raw is None:
        return None
    return raw.withColumn("_action", corporate_action(F.col("subject"))).select(
        code("symbol").alias("symbol"), "series", day("exDate").alias("ex_date"), "_action.action_type",
        "_action.factor", F.trim("subject").alias("subject"), F.col("dt").alias("_landed"),
    ).filter(F.col("ex_date").isNotNull() & F.col("action_type").isNotNull())


def announcements(spark: SparkSession, root: str, days: Days = None) -> DataFrame | None:
    raw = landed(spark, root, "nse_announcements", _json(FILING_SCHEMA), days)
    if raw is None:
        return None

    def said(c: str):
        return F.trim(F.coalesce(F.col(f"`{c}`"), F.lit("")))

    return raw.select(
        "seq_id", code("symbol").alias("symbol"),
        F.try_to_timestamp("sort_date", F.lit("yyyy-MM-dd HH:mm:ss")).alias("announced_at"),
        said("desc").alias("category"), said("attchmntText").alias("summary"),
        F.col("attchmntFile").alias("attachment_url"), F.col("dt").alias("_landed"),
    ).filter(F.col("announced_at").isNotNull() & (F.col("seq_id") != "") & (F.col("symbol") != ""))


def flatten_lists(asm: DataFrame | None, graded: DataFrame | None) -> DataFrame | None:
    """Nested short-term and long-term lists and the graded list to one long table; both carry `dt`."""
    parts = []
    if graded is not None:
        parts.append(graded.select("dt", code("symbol").alias("symbol"), F.lit("GSM").alias("list_type"),
                                   F.col("gsmStage").alias("stage"), F.col("survDesc").alias("description")))
    if asm is not None:
        for branch, kind in (("shortterm", "STASM"), ("longterm", "LTASM")):
            members = asm.select("dt", F.explode(f"{branch}.data").alias("m"))
            parts.append(members.select("dt", code(F.col("m.symbol")).alias("symbol"), F.lit(kind).alias("list_type"),
                                        F.col("m.asmSurvIndicator").alias("stage"),
                                        F.col("m.survDesc").alias("description")))
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).filter(F.col("symbol").isNotNull()).withColumnRenamed(
        "dt", "snapshot_date")


def surveillance_lists(spark: SparkSession, root: str) -> DataFrame | None:
    return flatten_lists(landed(spark, root, "nse_surveillance_lists", _json(ASM_SCHEMA, "asm.json")),
                         landed(spark, root, "nse_surveillance_lists", _json(GSM_SCHEMA, "gsm.json")))


def holidays(spark: SparkSession, root: str) -> DataFrame | None:
    """Every holiday of every snapshot; the newest description of a date wins."""
    raw = landed(spark, root, "nse_holidays", _json(HOLIDAY_SCHEMA))
    if raw is None:
        return None
    listed = raw.select("dt", F.explode("CM").alias("h")).select(
        "dt", day(F.col("h.tradingDate")).alias("holiday"), F.coalesce("h.description", F.lit("")).alias("description"))
    return listed.filter(F.col("holiday").isNotNull()).groupBy("holiday").agg(
        F.max_by("description", "dt").alias("description"))


def portfolio(spark: SparkSession, path: str) -> DataFrame:
    schema = ("owner string, date date, type string, symbol string, quantity double, price double, amount double, "
              "asset_class string")
    return spark.read.schema(schema).option("header", True).csv(path)


def watchlist(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("scheme_code long, label string").option("header", True).csv(path)


def present_days(spark: SparkSession, root: str, source: str = "nse_bhavcopy") -> DataFrame:
    """Days for which the source has files."""
    found = landed(spark, root, source, lambda reader, path: reader.format("binaryFile").load(path))
    if found is None:
        return spark.createDataFrame([], "trade_date date")
    return found.select(F.col("dt").alias("trade_date")).distinct()


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the same one on every run: of the newest folder where ``_landed`` tells it, then the smallest
    in the order of all other columns.
    """
    newest = [F.col(c).desc_nulls_last() for c in df.columns if c == "_landed" and c not in keys]
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in [*keys, "_landed"]]
    return first_per(df, keys, *newest, *others) if newest or others else df.distinct()
