"""Matches: pairing of records that no key joins, strict plans with reasons for what they leave out, and clocks of play.

A pair of teams within a time tolerance matches only if it is the one candidate of both sides; everything else leaves by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_seconds, issue_list, name_key


def mutual_match(a: DataFrame, b: DataFrame, a_id: str, b_id: str, a_pair: tuple[str, str], b_pair: tuple[str, str], a_ts: str, b_ts: str, tolerance_s: int) -> DataFrame:
    """(a_id, b_id, reason) for every row of a: the one b whose unordered pair is equal and whose time is at most tolerance_s away, if a is
    also its only one; else b_id is null and reason says why: incomplete (a null in pair or time), none, many, or taken (its b has others).

    Ids are unique in their tables. Times are dealt to buckets of the tolerance, so pairs that recur often still meet their time only.
    """
    key = lambda p: {"_p": F.least(*p), "_q": F.greatest(*p)}
    width = max(tolerance_s, 1)
    whole = lambda p, t: F.col(p[0]).isNotNull() & F.col(p[1]).isNotNull() & F.col(t).isNotNull()
    x = a.select(F.col(a_id).alias("_a"), whole(a_pair, a_ts).alias("_whole"), epoch_seconds(F.col(a_ts)).alias("_at"), *(c.alias(n) for n, c in key(a_pair).items()))
    y = b.where(whole(b_pair, b_ts)).select(F.col(b_id).alias("_b"), epoch_seconds(F.col(b_ts)).alias("_bt"), *(c.alias(n) for n, c in key(b_pair).items()))
    near = F.explode(F.sequence(F.floor(F.col("_at") / width) - 1, F.floor(F.col("_at") / width) + 1))
    found = x.where("_whole").withColumn("_k", near).join(y.withColumn("_k", F.floor(F.col("_bt") / width)), ["_p", "_q", "_k"]).where(F.abs(F.col("_at") - F.col("_bt")) <= tolerance_s)
    of_a = found.groupBy("_a").agg(F.count("*").alias("_n"), F.min("_b").alias("_b"))
    of_b = found.groupBy("_b").agg(F.count("*").alias("_m"))
    out = x.join(of_a, "_a", "left").join(of_b, "_b", "left")
    reason = F.when(~F.col("_whole"), "incomplete").when(F.col("_n").isNull(), "none").when(F.col("_n") > 1, "many").when(F.col("_m") > 1, "taken")
    return out.select(F.col("_a").alias(a_id), F.when(reason.isNull(), F.col("_b")).alias(b_id), reason.alias("reason"))


def _tokens(markets: DataFrame) -> DataFrame:
    """markets with o, t (arrays of text from JSON) and their issue."""
    read = lambda c: F.from_json(c, "array<string>")
    m = markets.withColumns({"_o": read("outcomes"), "_t": read("clob_token_ids")})
    two = (F.size("_o") == 2) & (F.size("_t") == 2) & (F.get("_t", F.lit(0)) != F.get("_t", F.lit(1)))
    literal = F.array_sort(F.transform("_o", F.lower)) == F.array(F.lit("no"), F.lit("yes"))
    return m.withColumn("_tokens_issue", F.when(~F.coalesce(two, F.lit(False)), "tokens").when((F.col("sports_market_type") == "moneyline") & ~F.coalesce(literal, F.lit(False)), "outcomes"))


def match_plan(markets: DataFrame, moneylines: int = 3, tolerance_s: int = 60, advance: str = "soccer_team_to_advance") -> tuple[DataFrame, DataFrame]:
    """(plans, exclusions). plans: market_id, token_id, event_id (of the event whose clock counts), stage (group, knockout), started_at, finished_at, a row
    a token. exclusions: market_id, event_id, reasons.

    markets: market_id, event_id, sports_market_type, group_item_title, outcomes, clob_token_ids (JSON), event_start_time, event_finished_time,
    event_ended, closed. An event has so many moneyline markets, of which those that don't begin with "draw" name its two teams. A
    closed advance market takes the clock of the one event of its two teams that starts within tolerance_s; that event's own markets are
    then no plan. Reasons: moneylines, timing, teams, duplicate_event, tokens, outcomes, shared_token, and those of mutual_match after event_.
    """
    known = _tokens(markets.where("closed AND sports_market_type IS NOT NULL").withColumn("_key", name_key(F.col("group_item_title"))))
    money, ahead = known.where("sports_market_type = 'moneyline'"), known.where(F.col("sports_market_type") == advance)
    team = F.when(~F.coalesce(F.col("_key").startswith("draw"), F.lit(False)), F.col("_key"))
    events = money.groupBy("event_id").agg(F.count("*").alias("_n"), F.count(team).alias("_named"), F.min(team).alias("_home"), F.max(team).alias("_away"), F.min("event_start_time").alias("_start"), F.max("event_finished_time").alias("_finish"), F.min(F.coalesce("event_ended", F.lit(False))).alias("_ended"))
    same = Window.partitionBy("_home", "_away", "_start")
    events = events.withColumn("_copies", F.count("*").over(same)).withColumn(
        "_event_issues",
        issue_list(("moneylines", F.col("_n") != moneylines), ("timing", ~F.coalesce(F.col("_ended") & (F.col("_start") < F.col("_finish")), F.lit(False))), ("teams", ~F.coalesce((F.col("_named") == 2) & (F.col("_home") != F.col("_away")), F.lit(False))), ("duplicate_event", F.col("_copies") > 1)),
    )
    teams = ahead.select("market_id", "_tokens_issue", F.col("event_id").alias("_own"), "_t", "event_start_time", name_key(F.get("_o", F.lit(0))).alias("_x"), name_key(F.get("_o", F.lit(1))).alias("_y"))
    matched = mutual_match(teams, events.where("_event_issues IS NULL"), "market_id", "event_id", ("_x", "_y"), ("_home", "_away"), "event_start_time", "_start", tolerance_s)
    knockout = teams.join(matched, "market_id").join(events.select("event_id", "_start", "_finish"), "event_id", "left").withColumn("_issues", issue_list(("tokens", F.col("_tokens_issue").isNotNull()), *((f"event_{r}", F.coalesce(F.col("reason") == r, F.lit(False))) for r in ("incomplete", "none", "many", "taken"))))
    clocks = matched.where("event_id IS NOT NULL").select("event_id")
    group = money.join(clocks, "event_id", "left_anti").join(events, "event_id").withColumn("_issues", F.nullif(F.concat_ws(",", "_event_issues", "_tokens_issue"), F.lit("")))
    columns = ["market_id", "event_id", "_t", "_start", "_finish", "_issues"]
    every = group.select(*columns, F.lit("group").alias("stage")).unionByName(knockout.select(*columns, F.lit("knockout").alias("stage")))
    tokens = every.where("_issues IS NULL").select("market_id", "event_id", "stage", F.explode("_t").alias("token_id"), F.col("_start").alias("started_at"), F.col("_finish").alias("finished_at"))
    tokens = tokens.withColumn("_claims", F.count("*").over(Window.partitionBy("token_id")))
    shared = tokens.where("_claims > 1").select("market_id", "event_id", F.lit("shared_token").alias("reasons")).distinct()
    plans = tokens.join(shared.select("market_id"), "market_id", "left_anti").drop("_claims")
    return plans, every.where("_issues IS NOT NULL").select("market_id", "event_id", F.col("_issues").alias("reasons")).unionByName(shared)


def working_set(plans: DataFrame, markets: DataFrame, fixtures: DataFrame, tolerance_s: int = 86_400) -> tuple[DataFrame, DataFrame]:
    """(rows, exclusions): each planned market with its fixture and what its tokens stand for.

    fixtures: fixture_id, home_team, away_team, kickoff_at. An event's teams are those its markets name; it takes the one fixture of both teams within the
    tolerance. rows: market_id, event_id, stage, fixture_id, home_team, away_team, proposition (home_win, away_win, draw; home_advances in a knockout), yes_token_id, no_token_id,
    started_at, finished_at; in a knockout yes is the home team. exclusions: event_id, reason, those of mutual_match.
    """
    m = _tokens(markets).select("market_id", "sports_market_type", name_key(F.col("group_item_title")).alias("_key"), F.array(*(name_key(F.get("_o", F.lit(i))) for i in (0, 1))).alias("_o"), "_t")
    each = plans.groupBy("market_id", "event_id", "stage").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at")).join(m, "market_id")
    draw = F.coalesce(F.col("_key").startswith("draw"), F.lit(False))
    names = F.when(F.col("stage") == "knockout", F.col("_o")).when(~draw, F.array("_key")).otherwise(F.array().cast("array<string>"))
    events = each.withColumn("_name", F.explode(names)).groupBy("event_id").agg(F.min("_name").alias("_home"), F.max("_name").alias("_away"), F.min("started_at").alias("_start"))
    f = fixtures.select("fixture_id", "home_team", "away_team", "kickoff_at", name_key(F.col("home_team")).alias("_h"), name_key(F.col("away_team")).alias("_w"))
    matched = mutual_match(events, f, "event_id", "fixture_id", ("_home", "_away"), ("_h", "_w"), "_start", "kickoff_at", tolerance_s)
    rows = each.join(matched.where("fixture_id IS NOT NULL").drop("reason"), "event_id").join(f, "fixture_id")
    first_yes = F.when(F.col("stage") == "knockout", F.get("_o", F.lit(0)) == F.col("_h")).otherwise(F.get("_o", F.lit(0)) == "yes")
    side = F.when(F.col("stage") == "knockout", "home_advances").when(F.col("_key") == F.col("_h"), "home_win").when(F.col("_key") == F.col("_w"), "away_win").otherwise("draw")
    token = lambda yes: F.when(first_yes == F.lit(yes), F.get("_t", F.lit(0))).otherwise(F.get("_t", F.lit(1)))
    out = rows.select("market_id", "event_id", "stage", "fixture_id", "home_team", "away_team", side.alias("proposition"), token(True).alias("yes_token_id"), token(False).alias("no_token_id"), "started_at", "finished_at")
    return out, matched.where("reason IS NOT NULL").select("event_id", "reason")


def event_from_title(title: Column) -> Column:
    """A struct of home and away from "Home vs. Away"; null sides where a title has no such form."""
    part = lambda i: F.nullif(F.trim(F.regexp_extract(title, r"^(.+?)\s+(?:vs?\.?|v)\s+(.+?)\s*(?:[-:(].*)?$", i)), F.lit(""))
    return F.struct(part(1).alias("home"), part(2).alias("away"))


def match_registry(events: DataFrame, markets: DataFrame, as_of: Column, usual_s: int = 7200) -> tuple[DataFrame, DataFrame]:
    """(registry, exclusions) of match events. registry: event_id, market_id, result_role (home_win, draw, away_win), home_team, away_team, yes_token_id,
    no_token_id, window_start_at, window_end_at, kickoff_source (event_start, market_game_start), timing_status (finished, inferred). exclusions: event_id, reason.

    events: event_id, event_title, event_start_at, finished_at, is_closed. markets: market_id, event_id, group_item_title, outcomes, clob_token_ids, sports_market_type,
    game_start_time. A finish that is missing is inferred usual_s after kickoff, once as_of is past it. Reasons: title, kickoff, finish, roles, tokens.
    """
    m = _tokens(markets.where("sports_market_type = 'moneyline'")).withColumn("_key", name_key(F.col("group_item_title")))
    e = events.withColumn("_t", event_from_title(F.col("event_title"))).select("event_id", "event_start_at", "finished_at", "is_closed", F.col("_t.home").alias("home_team"), F.col("_t.away").alias("away_team"))
    e = e.withColumns({"_h": name_key(F.col("home_team")), "_w": name_key(F.col("away_team"))})
    joined = e.join(m, "event_id", "left")
    role = F.when(F.col("_key") == F.col("_h"), "home_win").when(F.col("_key") == F.col("_w"), "away_win").when(F.col("_key").startswith("draw"), "draw")
    w = Window.partitionBy("event_id")
    joined = joined.withColumn("result_role", role).withColumns({"_roles": F.size(F.collect_set("result_role").over(w)), "_markets": F.count("market_id").over(w), "_unsound": F.count("_tokens_issue").over(w), "_game": F.min("game_start_time").over(w)})
    kickoff = F.coalesce("event_start_at", "_game")
    inferred = kickoff + F.make_dt_interval(secs=F.lit(usual_s))
    finish = F.when(F.col("finished_at") > kickoff, F.col("finished_at")).when(F.coalesce("is_closed", F.lit(False)) & (inferred <= as_of), inferred)
    joined = joined.withColumns({"window_start_at": kickoff, "window_end_at": finish})
    reason = F.when(F.col("home_team").isNull(), "title").when(F.col("window_start_at").isNull(), "kickoff").when(F.col("window_end_at").isNull(), "finish").when((F.col("_roles") != 3) | (F.col("_markets") != 3), "roles").when(F.col("_unsound") > 0, "tokens")
    joined = joined.withColumn("reason", reason)
    yes = F.lower(F.get("_o", F.lit(0))) == "yes"
    token = lambda first: F.when(yes == F.lit(first), F.get("_t", F.lit(0))).otherwise(F.get("_t", F.lit(1)))
    good = joined.where("reason IS NULL").select(
        "event_id", "market_id", "result_role", "home_team", "away_team", token(True).alias("yes_token_id"), token(False).alias("no_token_id"), "window_start_at", "window_end_at",
        F.when(F.col("event_start_at").isNotNull(), "event_start").otherwise("market_game_start").alias("kickoff_source"), F.when(F.col("finished_at") > F.col("window_start_at"), "finished").otherwise("inferred").alias("timing_status"),
    )
    return good, joined.where("reason IS NOT NULL").select("event_id", "reason").distinct()


def minute_bands(periods: DataFrame, events: DataFrame) -> DataFrame:
    """The minutes of each period as [band_start, band_end), with minute, stoppage and label (45+2): one after the other, without a gap or an overlap.

    periods: match_id, period, first_minute, last_minute, started_at, ended_at (zone-less). events: match_id, period, match_minute, stoppage_minute. A period has
    as many minutes of stoppage as its events at its last minute show, or as its length exceeds its minutes by, rounded up
    beyond a millisecond. Its last band ends with it. A period too short for its bands has one row, with issue and no band.
    """
    shown = events.where("stoppage_minute IS NOT NULL").groupBy("match_id", "period", F.col("match_minute").alias("last_minute")).agg(F.max("stoppage_minute").alias("_shown"))
    micros = lambda c: epoch_seconds(F.col(c)) * 1_000_000 + (F.date_part(F.lit("SECONDS"), F.col(c)) * 1_000_000 % 1_000_000).cast("long")
    p = periods.join(shown, ["match_id", "period", "last_minute"], "left").withColumns({"_span": micros("ended_at") - micros("started_at"), "_nominal": (F.col("last_minute") - F.col("first_minute") + 1).cast("long")})
    excess = F.greatest(F.col("_span") - F.col("_nominal") * 60_000_000 - 1000, F.lit(0))
    p = p.withColumn("_n", F.col("_nominal") + F.greatest(F.coalesce("_shown", F.lit(0)), F.ceil(excess / 60_000_000)).cast("int"))
    short = F.coalesce((F.col("_n") - 1) * 60_000_000 >= F.col("_span"), F.lit(True))
    rows = p.withColumn("_short", short).withColumn("_i", F.explode(F.when(F.col("_short"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_n").cast("int") - 1))))
    good, over = ~F.col("_short"), F.col("_i") >= F.col("_nominal")
    minute = F.when(over, F.col("last_minute")).otherwise(F.col("first_minute") + F.col("_i"))
    stoppage = F.when(over, F.col("_i") - F.col("_nominal") + 1).cast("int")
    start = F.col("started_at") + F.make_dt_interval(mins=F.col("_i").cast("int"))
    end = F.when(F.col("_i") == F.col("_n") - 1, F.col("ended_at")).otherwise(F.col("started_at") + F.make_dt_interval(mins=F.col("_i").cast("int") + 1))
    label = F.concat_ws("+", minute.cast("string"), stoppage.cast("string"))
    named = {"minute": minute, "stoppage": stoppage, "label": label, "band_start": start, "band_end": end}
    return rows.select("match_id", "period", *(F.when(good, c).alias(n) for n, c in named.items()), F.when(F.col("_short"), F.lit("too_short")).alias("issue"))
