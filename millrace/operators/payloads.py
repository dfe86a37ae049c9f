"""Payloads landed as JSON text, as tables: pages of events and markets, nested memberships, typed markets and candles.

Text is parsed once to a VARIANT and read by path with tolerant types: a field of another kind is null, and rows that are no rows at
all leave by a side output with the reason, so that every input row is either in a table or counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import clean_text, parse_ts

PASSES = ("events_open", "events_closed", "markets_open", "markets_closed")


def text_at(v: Column, *names: str) -> Column:
    """The first of the fields that holds text, trimmed; numbers and booleans as text, nested values and blanks are none."""
    return F.coalesce(*(F.nullif(F.trim(F.try_variant_get(v, f"$.{n}", "string")), F.lit("")) for n in names))


def number_at(v: Column, *names: str) -> Column:
    number = F.coalesce(*(text_at(v, n).try_cast("double") for n in names))
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def flag_at(v: Column, *names: str) -> Column:
    return F.coalesce(*(text_at(v, n).try_cast("boolean") for n in names))


def time_at(v: Column, *names: str) -> Column:
    """A time in any form of parse_ts, or epoch seconds or milliseconds, as a zone-less UTC time."""

    def one(n: str) -> Column:
        epoch = text_at(v, n).try_cast("decimal(20,0)")
        seconds = F.when(F.abs(epoch) >= 10**11, F.floor(epoch / 1000)).otherwise(epoch).cast("long")
        micros = F.coalesce(F.when(F.abs(epoch) < 10**14, seconds * 1_000_000), F.unix_micros(parse_ts(text_at(v, n))))
        return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))

    return F.coalesce(*(one(n) for n in names))


def array_at(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "array<variant>")


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def json_text(v: Column) -> Column:
    """A nested value as compact JSON; text that already is JSON as it stands."""
    text = F.try_variant_get(v, "$", "string")
    return F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string")).when(F.schema_of_variant(v) == "STRING", text).otherwise(F.to_json(v))


def page_rows(pages: DataFrame, crawl: str = "crawl_id", name: str = "pass_name", number: str = "page_number", payload: str = "payload_json") -> DataFrame:
    """Each row of each page, with crawl, endpoint (events, markets), page, position, row (a variant) and issue: null, or why there is no row:
    pass, json, object, array (of the page), row, id (of the row). A page with issues gives one row, a page without rows none."""
    v = F.try_parse_json(payload)
    endpoint = F.when(F.col(name).isin(*PASSES), F.substring_index(name, "_", 1))
    p = pages.select(F.col(crawl).alias("crawl"), endpoint.alias("endpoint"), F.col(number).alias("page"), F.coalesce(F.col(name), F.lit("")).alias("pass"), v.alias("_v"))
    held = lambda kind: F.when(F.col("endpoint") == "events", F.try_variant_get("_v", "$.events", kind)).when(F.col("endpoint") == "markets", F.try_variant_get("_v", "$.markets", kind))
    issue = F.when(F.col("endpoint").isNull(), "pass").when(F.col("_v").isNull(), "json").when(~is_object(F.col("_v")), "object").when(held("variant").isNotNull() & held("array<variant>").isNull(), "array")
    p = p.withColumn("_issue", issue).withColumn("_rows", held("array<variant>")).where("_issue IS NOT NULL OR size(_rows) > 0")
    rows = p.select("crawl", "endpoint", "pass", "page", "_issue", F.posexplode_outer("_rows").alias("position", "row"))
    return rows.select("crawl", "endpoint", "pass", "page", "position", "row", F.coalesce("_issue", F.when(~is_object(F.col("row")), F.lit("row")), F.when(text_at(F.col("row"), "id").isNull(), F.lit("id"))).alias("issue"))


def _event(v: Column) -> dict[str, Column]:
    return {
        "event_id": text_at(v, "id"), "slug": text_at(v, "slug"), "title": clean_text(text_at(v, "title")), "volume": number_at(v, "volume"), "is_active": flag_at(v, "active"), "is_closed": flag_at(v, "closed"),
        "created_at": time_at(v, "createdAt", "creationDate"), "start_at": time_at(v, "startDate"), "end_at": time_at(v, "endDate"),
    }


def _market(v: Column) -> dict[str, Column]:
    return {
        "market_id": text_at(v, "id"), "condition_id": text_at(v, "conditionId", "condition_id"), "slug": text_at(v, "slug"), "title": clean_text(text_at(v, "question", "title")), "volume": number_at(v, "volumeNum", "volume"),
        "is_active": flag_at(v, "active"), "is_closed": flag_at(v, "closed"), "created_at": time_at(v, "createdAt"), "end_at": time_at(v, "endDate", "endDateIso"),
    }


def _merged(rows: DataFrame, key: str) -> DataFrame:
    """One row a crawl and id: of each field the first value that is not null, rows of its own endpoint before nested ones, then in order of pages.
    versions: how many different values condition_id has, where there is one."""
    order = F.struct("nested", "pass", "page", "position", "inner")
    fields = [c for c in rows.columns if c not in ("crawl", key, "nested", "pass", "page", "position", "inner")]
    return rows.groupBy("crawl", key).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in fields), F.count("*").alias("mentions"), *([F.count_distinct("condition_id").alias("versions")] if "condition_id" in fields else []))


def normalize_pages(pages: DataFrame, **names: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(events, markets, edges, issues) of crawled pages. edges: crawl, event_id, market_id, evidence (the endpoints that show it, sorted);
    issues: crawl, pass, issue, rows, those of page_rows and nested (a nested list or row that is none, or has no id). Repeated pages change mentions only."""
    rows = page_rows(pages, **names)
    good = rows.where("issue IS NULL")
    at = ["crawl", "endpoint", "pass", "page", "position"]
    inner = F.when(F.col("endpoint") == "events", F.try_variant_get("row", "$.markets", "variant")).otherwise(F.try_variant_get("row", "$.events", "variant"))
    listed = good.select(*at, "row", inner.alias("_n")).withColumn("_n", F.when(~F.is_variant_null("_n"), F.col("_n")))
    listed = listed.withColumn("_list", F.try_variant_get("_n", "$", "array<variant>"))
    nested = listed.where("_list IS NOT NULL").select(*at, text_at(F.col("row"), "id").alias("_outer"), F.posexplode("_list").alias("inner", "v")).withColumn("_id", F.when(is_object(F.col("v")), text_at(F.col("v"), "id")))
    found, lost = nested.where("_id IS NOT NULL"), nested.where("_id IS NULL").select("crawl", "pass").unionAll(listed.where("_n IS NOT NULL AND _list IS NULL").select("crawl", "pass"))

    def table(endpoint: str, fields) -> DataFrame:
        own = good.where(F.col("endpoint") == endpoint).select("crawl", F.lit(0).alias("nested"), "pass", "page", "position", F.lit(0).alias("inner"), *(c.alias(n) for n, c in fields(F.col("row")).items()))
        other = found.where(F.col("endpoint") != endpoint).select("crawl", F.lit(1).alias("nested"), "pass", "page", "position", "inner", *(c.alias(n) for n, c in fields(F.col("v")).items()))
        return own.unionByName(other)

    ends = lambda mine, other: F.when(F.col("endpoint") == "events", F.col(mine)).otherwise(F.col(other))
    edges = found.groupBy("crawl", ends("_outer", "_id").alias("event_id"), ends("_id", "_outer").alias("market_id")).agg(F.array_join(F.array_sort(F.collect_set(F.concat("endpoint", F.lit("_endpoint")))), ",").alias("evidence"))
    issues = rows.where("issue IS NOT NULL").select("crawl", "pass", "issue").unionAll(lost.select("crawl", "pass", F.lit("nested").alias("issue")))
    return _merged(table("events", _event), "event_id"), _merged(table("markets", _market), "market_id"), edges, issues.groupBy("crawl", "pass", "issue").agg(F.count("*").alias("rows"))


def explode_event_payload(events: DataFrame, payload: str = "payload_json") -> DataFrame:
    """The markets of each event's payload, a row for each membership: the columns of events, event_id, market_id, member_event_id, source_ordinal,
    is_enclosing_event and market (the market's variant). A market that does not list its enclosing event is a member of it last; an event
    listed twice counts at its first place. Events and markets without an id give no rows; bad_payloads() counts them."""
    others = [c for c in events.columns if c != payload]
    v = events.select(*others, F.try_parse_json(payload).alias("_v")).withColumn("event_id", text_at(F.col("_v"), "id")).where("event_id IS NOT NULL")
    m = v.select(*others, "event_id", F.explode(array_at(F.col("_v"), "markets")).alias("market")).withColumn("market_id", F.when(is_object(F.col("market")), text_at(F.col("market"), "id"))).where("market_id IS NOT NULL")
    related = F.transform(F.coalesce(array_at(F.col("market"), "events"), F.array().cast("array<variant>")), lambda e, i: F.struct(F.when(is_object(e), text_at(e, "id")).alias("id"), i.alias("ordinal")))
    known = m.withColumn("_known", F.filter(related, lambda e: e["id"].isNotNull()))
    first = F.filter("_known", lambda e: ~F.exists("_known", lambda o: (o["id"] == e["id"]) & (o["ordinal"] < e["ordinal"])))
    known = known.withColumn("_known", first)
    own = F.struct(F.col("event_id").alias("id"), F.size("_known").alias("ordinal"))
    members = F.when(F.exists("_known", lambda e: e["id"] == F.col("event_id")), F.col("_known")).otherwise(F.concat("_known", F.array(own)))
    rows = known.select(*others, "event_id", "market_id", "market", F.explode(members).alias("_m"))
    return rows.select(*others, "event_id", "market_id", F.col("_m.id").alias("member_event_id"), F.col("_m.ordinal").cast("long").alias("source_ordinal"), (F.col("_m.id") == F.col("event_id")).alias("is_enclosing_event"), "market")


def bad_payloads(events: DataFrame, payload: str = "payload_json") -> DataFrame:
    """One row: payloads, and those of them that are no JSON object, have no id, or a markets field that is no list."""
    v = events.select(F.try_parse_json(payload).alias("_v"))
    markets = F.try_variant_get("_v", "$.markets", "variant")
    listed = F.coalesce(F.schema_of_variant(markets).startswith("ARRAY"), F.lit(True))
    return v.agg(F.count("*").alias("payloads"), F.count_if(~is_object(F.col("_v"))).alias("not_object"), F.count_if(is_object(F.col("_v")) & text_at(F.col("_v"), "id").isNull()).alias("no_id"), F.count_if(~listed).alias("markets_not_list"))


def normalize_markets(df: DataFrame, payload: str = "payload_json") -> DataFrame:
    """df with typed fields of each market's payload: camel or snake names, outcomes and token ids as JSON, the resolution, and the preferred event: the
    enclosing one, else the first. Rows that hold no object, or no id, have null fields."""
    others = [c for c in df.columns if c != payload]
    v = df.select(*others, F.try_parse_json(payload).alias("_v"))
    events = array_at(F.col("_v"), "events")
    event = F.coalesce(F.get(F.filter(events, lambda e: F.coalesce(flag_at(e, "is_enclosing_event"), F.lit(False))), F.lit(0)), F.get(F.filter(events, is_object), F.lit(0)))
    v = v.withColumn("_e", event)
    m, e = F.col("_v"), F.col("_e")
    at = lambda n: json_text(F.try_variant_get("_v", f"$.{n}", "variant"))
    fields = {
        "market_id": text_at(m, "id"), "question": text_at(m, "question"), "condition_id": text_at(m, "conditionId", "condition_id"), "outcomes": at("outcomes"), "clob_token_ids": at("clobTokenIds"), "volume": number_at(m, "volumeNum", "volume"),
        "active": flag_at(m, "active"), "closed": flag_at(m, "closed"), "line": number_at(m, "line"), "sports_market_type": text_at(m, "sportsMarketType", "sports_market_type"), "group_item_title": text_at(m, "groupItemTitle", "group_item_title"),
        "created_at": time_at(m, "createdAt"), "end_date": time_at(m, "endDate", "endDateIso"), "game_start_time": time_at(m, "gameStartTime", "game_start_time"), "is_resolved": F.coalesce(flag_at(m, "isResolved", "resolved"), F.lit(False)),
        "winning_outcome": text_at(m, "winningOutcome", "winning_outcome"), "winning_clob_token_id": text_at(m, "winningClobTokenId", "winning_clob_token_id"), "event_id": text_at(e, "id"), "event_slug": text_at(e, "slug"), "event_title": text_at(m, "eventTitle", "event_title"),
    }
    return v.select(*(c for c in others if c not in fields), *(c.alias(n) for n, c in fields.items()))


def half_up(c: Column) -> Column:
    """A number in text as a whole one, halves away from zero; null if it is none."""
    return F.round(c.try_cast("decimal(38,12)"), 0).cast("long")


def normalize_candles(df: DataFrame, ticker: str = "market_ticker", payload: str = "candles_json") -> DataFrame:
    """(ticker, hour_start_utc, open, high, low, close and avg price, volume) of arrays of hourly candles. A candle is named by its end, the
    row by its start; one without an end has no row. volume_fp counts before volume where it is a number."""
    v = df.select(ticker, F.explode(F.try_variant_get(F.try_parse_json(payload), "$", "array<variant>")).alias("_c"))
    end = text_at(F.col("_c"), "end_period_ts").try_cast("long")
    price = lambda n: F.try_variant_get("_c", f"$.price.{n}", "string").try_cast("double")
    prices = {f"{n}_price": price(f"{'mean' if n == 'avg' else n}_dollars") for n in ("open", "high", "low", "close", "avg")}
    start = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(end - 3600).cast("decimal(18,6)"))
    volume = F.coalesce(half_up(text_at(F.col("_c"), "volume_fp")), half_up(text_at(F.col("_c"), "volume")))
    return v.where(end.isNotNull()).select(ticker, start.alias("hour_start_utc"), *(c.alias(n) for n, c in prices.items()), volume.alias("volume"))


def admitted_markets(payloads: DataFrame, registry: DataFrame, market: str, observed: str, payload: str = "payload_json") -> DataFrame:
    """The last payload of each market of the registry, typed: the current market table. Of payloads of one time the greatest text counts."""
    admitted = registry.select(market).distinct()
    last = payloads.join(admitted, market, "left_semi").groupBy(market).agg(F.max_by(payload, F.struct(observed, payload)).alias(payload), F.max(observed).alias(observed))
    return normalize_markets(last.withColumnRenamed(market, "_admitted"), payload).where("market_id IS NOT NULL").drop("_admitted")
