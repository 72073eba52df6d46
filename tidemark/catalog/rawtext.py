"""Table rows written out as the raw text and nested files the readers expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import domain
from tidemark.sources import store


def price_rows(spark, folder: str) -> DataFrame:
    """Every trade as one untidy exchange row; some carry the defects the reject rules look for."""
    line, flag = F.col("l_linenumber"), F.col("l_returnflag")
    rows = domain.table(spark, folder, "lineitem").join(
        domain.sellers(spark, folder), F.col("l_suppkey") == F.col("s_suppkey")).withColumn("tick", domain.tick())

    def text(c):
        return F.concat(F.lit(" "), c.cast("string"), F.lit(" "))

    return rows.select(
        text(F.lower("symbol")).alias("SYMBOL"), F.lit("eq ").alias("SERIES"),
        F.when((line == 7) & (flag == "R"), "soon").otherwise(F.date_format("l_shipdate", "dd-MMM-yyyy")).alias("DATE1"),
        F.lit("-").alias("PREV_CLOSE"), text(F.col("tick") - 50).alias("OPEN_PRICE"),
        F.when((line == 3) & (flag == "N"), "").otherwise(text(F.col("tick") + 100)).alias("HIGH_PRICE"),
        F.when((line == 4) & (flag == "N"), text(F.col("tick") + 200)).otherwise(text(F.col("tick") - 100))
        .alias("LOW_PRICE"), text(F.col("tick")).alias("LAST_PRICE"),
        F.when((line == 6) & (flag == "A"), "-").when((line == 5) & (flag == "A"), "0").otherwise(text(F.col("tick")))
        .alias("CLOSE_PRICE"), F.when((line == 2) & (flag == "R"), "n/a").otherwise("-").alias("AVG_PRICE"),
        text(F.col("l_quantity").cast("long")).alias("TTL_TRD_QNTY"),
        text(domain.cents("l_extendedprice")).alias("TURNOVER_LACS"),
        line.cast("string").alias("NO_OF_TRADES"),
        F.when(flag == "R", "-").otherwise(text(F.col("l_quantity").cast("long"))).alias("DELIV_QTY"),
        F.lit("").alias("DELIV_PER"))


AGAIN = dt.date(1998, 1, 1)     # the folder that is ingested twice
OPEN_FOLDERS = 64               # of years, into which a task writes side by side


def _by_year(day):
    """The folder in which a row lands: one for each year, rows without a day in another."""
    return F.coalesce(F.trunc(day, "year"), F.lit(dt.date(1970, 1, 1)))


def write_price_files(rows: DataFrame, raw: str) -> None:
    landed = _by_year(F.try_to_date(F.trim("DATE1"), "dd-MMM-yyyy"))
    with store.unsorted_partitions(rows.sparkSession, OPEN_FOLDERS):
        (rows.withColumn("dt", landed).write.partitionBy("dt").option("header", True)
         .csv(f"{raw}/nse_bhavcopy"))


def write_index_files(index_rows: DataFrame, raw: str) -> None:
    names = {"open": "Open Index Value", "high": "High Index Value", "low": "Low Index Value",
             "close": "Closing Index Value", "points_change": "Points Change", "pct_change": "Change(%)",
             "volume": "Volume", "turnover_cr": "Turnover (Rs. Cr.)", "pe": "P/E", "pb": "P/B", "div_yield": "Div Yield"}
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(n) for c, n in names.items()]
    (index_rows.select(F.col("index_name").alias("Index Name"), F.date_format("trade_date", "dd-MM-yyyy").alias("Index Date"),
                       *shown, _by_year(F.col("trade_date")).alias("dt"))
     .write.partitionBy("dt").option("header", True).csv(f"{raw}/nse_indices"))


def nav_lines(spark, folder: str) -> DataFrame:
    """Daily NAVs as yearly text files: headings per scheme, then its rows, in chunks of a few weeks."""
    nav = domain.fund_nav_daily(spark, folder).withColumn("file", F.year("nav_date").cast("string"))
    day, c = F.dayofyear("nav_date"), F.col("scheme_code")
    number = F.round(F.col("nav") * 10_000).cast("long").cast("string")
    row = F.concat_ws(
        ";", c.cast("string"), "isin_growth", F.lit("-"), "scheme_name",
        F.when(c % 7 == 0, F.lit("Plan;Option")), F.when(day % 50 == 0, "N.A.").otherwise(number),
        F.when(day % 61 == 0, "unknown").otherwise(F.date_format("nav_date", "dd-MMM-yyyy")))
    rows = nav.select("file", (c * 100 + F.floor(day / 37)).alias("chunk"), (c * 1000 + 10 + day).alias("line_no"),
                      row.alias("line"))
    heads = nav.select("file", "scheme_code", "category", "amc").distinct()
    lines = F.array(F.lit("Scheme Code;ISIN;ISIN;Scheme Name;Net Asset Value;Date"), F.lit("  "),
                    F.concat(F.lit("Open Ended Schemes("), "category", F.lit(")")), F.col("amc"))
    headings = heads.select("file", (c * 100).alias("chunk"), "scheme_code",
                            F.posexplode(lines).alias("_place", "line")).select(
        "file", "chunk", (c * 1000 + F.col("_place")).alias("line_no"), "line")
    return rows.unionByName(headings)


def nested_lists(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """List rows as nested short/long-term documents and graded rows."""
    member = F.struct(F.concat(F.lit(" "), F.lower("symbol")).alias("symbol"), F.col("stage").alias("asmSurvIndicator"),
                      F.col("description").alias("survDesc"))
    nobody = F.array().cast("array<struct<symbol:string,asmSurvIndicator:string,survDesc:string>>")

    def members(kind: str):
        return F.struct(F.when(F.col("list_type") == kind, F.array(member)).otherwise(nobody).alias("data"))

    dated = lists.withColumn("dt", F.col("snapshot_date"))
    asm = dated.select("dt", members("STASM").alias("shortterm"), members("LTASM").alias("longterm"))
    graded = dated.filter(F.col("list_type") == "GSM").select(
        "dt", "symbol", F.col("stage").alias("gsmStage"), F.col("description").alias("survDesc"))
    return asm, graded


# ---------- nested and text files ----------

DOCUMENT_ROWS = 5_000       # of one JSON array, at most about


def _write_documents(documents: DataFrame, path: str) -> None:
    """(dt, document): each as a file of its own in its folder."""
    documents.write.mode("append").partitionBy("dt").option("maxRecordsPerFile", 1).text(path)


def _write_arrays(rows: DataFrame, path: str) -> None:
    """Rows with `dt` as JSON arrays of some thousand objects; nulls are left out of the objects."""
    named = [c for c in rows.columns if c != "dt"]
    texts = rows.select("dt", F.to_json(F.struct(*[F.col(f"`{c}`") for c in named])).alias("_text"))
    folders = texts.groupBy(F.col("dt").alias("_dt")).agg(F.ceil(F.count("*") / DOCUMENT_ROWS).alias("_parts"))
    dealt = texts.join(F.broadcast(folders), F.col("dt").eqNullSafe(F.col("_dt"))).select(      # one row per folder
        "dt", "_text", F.pmod(F.xxhash64("_text"), F.col("_parts")).alias("_part"))
    arrays = dealt.groupBy("dt", "_part").agg(
        F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("_text")), ",\n"), F.lit("]")).alias("document"))
    _write_documents(arrays.select("dt", "document"), path)


def quarters() -> list[dt.date]:
    """Every day on which a quarter's files land."""
    return [dt.date(year, month, 1) for year in range(1990, 2004) for month in (1, 4, 7, 10)]


def _landing(day, quarters_later: int = 1):
    return F.to_date(F.add_months(F.trunc(day, "quarter"), 3 * quarters_later))


def write_filings(filings: DataFrame, raw: str) -> None:
    """Filings land the quarter after; late ones of a quarter also in the folder after that. A fifth landed before as a
    draft with another date; some objects have no id, no symbol or no date.
    """
    key = F.col("seq_id").cast("long")
    day = F.to_date("announced_at")

    def objects(rows, landed, **changes):
        shown = {"seq_id": F.col("seq_id"), "symbol": F.concat(F.lit(" "), F.lower("symbol")),
                 "sort_date": F.date_format("announced_at", "yyyy-MM-dd HH:mm:ss"), "desc": F.concat(F.lit(" "), F.col("category")),
                 "attchmntText": F.col("summary"), "attchmntFile": F.col("attachment_url")} | changes
        return rows.select(landed.alias("dt"), *[c.alias(n) for n, c in shown.items()])

    late = F.month(F.date_add(day, 14)) != F.month(day)
    earlier = F.date_format(F.col("announced_at") - F.expr("interval 100 days"), "yyyy-MM-dd HH:mm:ss")
    files = [objects(filings, _landing(day)), objects(filings.where(late), _landing(day, 2)),
             objects(filings.where(key % 5 == 0), _landing(day, 0), sort_date=earlier, attchmntText=F.lit("draft"), desc=F.lit(None).cast("string")),
             objects(filings.where(key % 11 == 0), _landing(day), seq_id=F.lit(None).cast("string")),
             objects(filings.where(key % 13 == 0), _landing(day, 2), sort_date=F.lit("unknown")),
             objects(filings.where(key % 17 == 0), _landing(day, 2), symbol=F.lit(" "))]
    rows = files[0]
    for more in files[1:]:
        rows = rows.unionByName(more)
    _write_arrays(rows, f"{raw}/nse_announcements")


def write_actions(subjects: DataFrame, raw: str) -> None:
    """Every subject lands the quarter before its ex-date, bonuses again with a corrected ratio in the quarter itself."""
    def landing(quarters_later, subject):
        return F.struct(_landing(F.col("ex_date"), quarters_later).alias("dt"), subject.alias("subject"))

    bonus = F.col("subject").startswith("Bonus")
    first = F.when(bonus, F.lit("Bonus 9:1")).otherwise(F.concat(F.lit(" "), F.col("subject")))
    landings = F.array_compact(F.array(landing(-1, first), F.when(bonus, landing(0, F.col("subject")))))
    # both landings from one pass over the subjects, whose join a union would repeat
    rows = subjects.select("symbol", "ex_date", F.explode(landings).alias("landed")).select(
        "landed.dt", F.concat(F.lower("symbol"), F.lit(" ")).alias("symbol"), F.lit("EQ").alias("series"),
        F.date_format("ex_date", "dd-MMM-yyyy").alias("exDate"), "landed.subject")
    _write_arrays(rows, f"{raw}/nse_corp_actions")


def write_nav_files(lines: DataFrame, raw: str) -> None:
    """One text file a year, its lines in order."""
    placed = lines.select(F.to_date(F.concat("file", F.lit("-12-31"))).alias("dt"), "line_no", "line")
    (placed.repartition("dt").sortWithinPartitions("dt", "line_no").select("dt", "line")
     .write.partitionBy("dt").text(f"{raw}/amfi_navall"))


HISTORY_DAYS = (dt.date(2001, 1, 31), dt.date(2002, 1, 31))


def write_history(nav: DataFrame, raw: str) -> None:
    """One document per scheme in two snapshots, the older one with other values; some documents are cut short, some
    rows have no date or no value.
    """
    for taken, factor in zip(HISTORY_DAYS, (2, 1)):
        day = F.dayofyear("nav_date")
        row = F.struct(F.when(day % 59 == 0, "someday").otherwise(F.date_format("nav_date", "dd-MM-yyyy")).alias("date"),
                       F.when(day % 53 == 0, "N.A.").when(day % 47 == 0, "0").otherwise(
                           (F.col("nav") * factor).cast("string")).alias("nav"))
        document = F.to_json(F.struct(
            F.struct(F.col("scheme_code").cast("string").alias("scheme_code"), "scheme_name", F.col("amc").alias("fund_house"),
                     F.col("category").alias("scheme_category")).alias("meta"), F.col("data")), {"pretty": "true"})
        whole = nav.groupBy("scheme_code", "scheme_name", "amc", "category").agg(F.collect_list(row).alias("data")).select(
            F.lit(taken).alias("dt"), F.when(F.col("scheme_code") % 10 == 3, F.substring(document, 1, 150)).otherwise(document).alias("document"))
        _write_documents(whole, f"{raw}/mfapi_history")


def write_master(master: DataFrame, industries: DataFrame, raw: str) -> None:
    """Snapshots of the equity list, and the industry map (symbol, industry) with an older one that says otherwise."""
    shown = {"SYMBOL": F.lower("symbol"), "NAME OF COMPANY": F.col("company_name"), " SERIES": F.col("series"),
             " DATE OF LISTING": F.date_format("listing_date", "dd-MMM-yyyy"), " ISIN NUMBER": F.concat(F.lit(" "), F.col("isin")),
             " FACE VALUE": F.col("face_value").cast("string")}
    (master.select(F.col("snapshot_date").alias("dt"), *[c.alias(n) for n, c in shown.items()])
     .write.partitionBy("dt").option("header", True).csv(f"{raw}/nse_equity_list"))
    old = industries.select(F.lit(dt.date(1996, 1, 1)).alias("dt"), F.col("symbol").alias("Symbol"), F.lit("Old").alias("Industry"))
    new = industries.select(F.lit(dt.date(1998, 1, 1)).alias("dt"), F.lower("symbol"), F.concat(F.lit(" "), F.col("industry")))
    old.union(new).write.partitionBy("dt").option("header", True).csv(f"{raw}/nse_nifty500")


def write_holidays(holidays: DataFrame, raw: str) -> None:
    """Holidays of each year as one document, in an older snapshot with other words."""
    entry = F.struct(F.date_format("holiday", "dd-MMM-yyyy").alias("tradingDate"), "description")
    older = holidays.withColumns({"dt": F.lit(dt.date(1990, 1, 1)), "description": F.lit("to be told")})
    newer = holidays.withColumn("dt", _landing(F.col("holiday"), 0))
    documents = older.unionByName(newer).groupBy("dt", F.year("holiday").alias("year")).agg(
        F.to_json(F.struct(F.collect_list(entry).alias("CM"))).alias("document"))
    _write_documents(documents.select("dt", "document"), f"{raw}/nse_holidays")
