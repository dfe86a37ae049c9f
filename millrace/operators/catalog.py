"""Catalog rules: working sets, stage and role classification, payload merges, plans, publication and leaf audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import compact_key, name_key, safe_ratio
from millrace.operators.scans import SEGMENT_ROWS, Scan, last_seen, scan
from millrace.operators.windows import merge_intervals


def token_working_set(tokens: DataFrame, markets: DataFrame, market: str, place: str, outcomes: str) -> DataFrame:
    """Tokens with their market's columns and the label at their place (from 0) in its JSON list; null beyond it."""
    return tokens.join(markets, market).withColumn("outcome_label", F.get(F.from_json(outcomes, "array<string>"), F.col(place))).drop(outcomes)


def classify_stage(suffix: Column, ladder: list[tuple[str, str, int, str]]) -> list[Column]:
    """stage, stage_rank and direction of the ladder's step (suffix, stage, rank, direction) of that suffix; else null."""
    kinds = {"stage": 1, "stage_rank": 2, "direction": 3}

    def pick(at: int) -> Column:
        out = F.when(suffix == ladder[0][0], F.lit(ladder[0][at]))
        for step in ladder[1:]:
            out = out.when(suffix == step[0], F.lit(step[at]))
        return out

    return [pick(at).alias(name) for name, at in kinds.items()]


def group_label(series: Column, pattern: str) -> Column:
    """What follows the pattern of a group's series, in upper case; null where it doesn't begin so or nothing follows."""
    return F.nullif(F.upper(F.regexp_extract(series, f"(?i)^{pattern}(.+)$", 1)), F.lit(""))


def market_role(label: Column, home: Column, away: Column, draw: str = "draw|tie") -> Column:
    """home, away, draw or other, by match keys of the names; null labels are other."""
    key = name_key(label)
    return F.when(key == name_key(home), "home").when(key == name_key(away), "away").when(key.rlike(f"(^| )({draw})( |$)"), "draw").otherwise("other")


#: Forms of questions (fixed values).
DRAW_QUESTION = r"(?i)^will\s+(.+?)\s+vs\.?\s+(.+?)\s+end\s+in\s+a\s+draw\??$"
BEAT_QUESTION = r"(?i)^will\s+(.+?)\s+beat\s+(.+?)\??$"


def market_role_of(kind: Column, label: Column, question: Column, home: Column, away: Column) -> Column:
    """home_win, draw, away_win or null. A market of the type moneyline goes by its label (draw, or a team by its match key); without one that fits, and for other types, the question decides:
    whether home and away, in any order, end in a draw, or one beats the other."""
    h, a = compact_key(home), compact_key(away)
    said = compact_key(label)
    asked = F.trim(F.coalesce(question, F.lit("")))
    part = lambda pattern, i: compact_key(F.regexp_extract(asked, pattern, i))
    both = lambda pattern: asked.rlike(pattern) & (((part(pattern, 1) == h) & (part(pattern, 2) == a)) | ((part(pattern, 1) == a) & (part(pattern, 2) == h)))
    by_label = F.when(F.lower(F.trim(label)) == "draw", "draw").when(said == h, "home_win").when(said == a, "away_win")
    structured = (F.lower(F.trim(kind)) == "moneyline") & (F.trim(label) != "")
    by_question = F.when(both(DRAW_QUESTION), "draw").when(both(BEAT_QUESTION), F.when(part(BEAT_QUESTION, 1) == h, "home_win").otherwise("away_win"))
    return F.coalesce(F.when(structured, by_label), by_question)


def missing_metadata(markets: DataFrame, tokens: DataFrame, unresolved: DataFrame, market: str, now: Column) -> DataFrame:
    """(market, missing): markets that lack something, and what, sorted: tokens (none in tokens), slug, event_slug (unless its retry is still to come) and end_date; null and empty texts are missing.

    unresolved: market, field_name, next_retry_at."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    waiting = unresolved.where((F.col("field_name") == "event_slug") & (F.col("next_retry_at") > now)).select(market, F.lit(True).alias("_waits")).distinct()
    m = markets.join(tokens.select(market, F.lit(True).alias("_held")).distinct(), market, "left").join(waiting, market, "left")
    lacks = {"end_date": blank("end_date"), "event_slug": blank("event_slug") & F.col("_waits").isNull(), "slug": blank("slug"), "tokens": F.col("_held").isNull()}
    return m.select(market, F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in lacks.items()))).alias("_m")).where(F.size("_m") > 0).select(market, F.array_join("_m", ",").alias("missing"))


def mark_unresolved(ledger: DataFrame, batch: DataFrame, key: list[str], now: Column, retry_hours: int = 168) -> DataFrame:
    """ledger (key, reason, attempts, last_checked_at, next_retry_at) with the fields of batch (key, reason) that could not be resolved now: one attempt more, the next one after retry_hours (an
    hour at least). A key that comes more than once in the batch is one attempt, of its greatest reason."""
    new = batch.groupBy(*key).agg(F.max("reason").alias("_reason"), F.lit(True).alias("_new"))
    met = ledger.join(new, key, "full")
    fresh = F.col("_new").isNotNull()
    later = now + F.make_dt_interval(hours=F.lit(max(1, retry_hours)))
    return met.select(
        *key, F.when(fresh, F.col("_reason")).otherwise(F.col("reason")).alias("reason"), (F.coalesce("attempts", F.lit(0)) + fresh.cast("int")).cast("long").alias("attempts"),
        F.when(fresh, now).otherwise(F.col("last_checked_at")).alias("last_checked_at"), F.when(fresh, later).otherwise(F.col("next_retry_at")).alias("next_retry_at"),
    )


def multiset_digest(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, n_rows, digest) of the rows of each group, or of all rows, whatever their order: the SHA-256 of sums of pieces of each row's SHA-256. Sums are combined before they are shuffled, so a
    group of any size leaves a few numbers. Columns are read as text, parted by a unit separator; nulls differ from empty texts."""
    row = F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns)), 256)
    pieces = [F.conv(F.substring("_h", 15 * i + 1, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    hashed = df.select(*by, row.alias("_h"))
    sums = hashed.groupBy(*by).agg(F.count("*").alias("n_rows"), *(F.sum(p).cast("decimal(38,0)").alias(f"_{i}") for i, p in enumerate(pieces)))
    return sums.select(*by, "n_rows", F.sha2(F.concat_ws("|", F.col("n_rows").cast("string"), *(F.coalesce(f"_{i}", F.lit(0)).cast("string") for i in range(4))), 256).alias("digest"))


def portrait_targets(working: DataFrame, match: str, role: str, teams: list[str], grouped: Column, roles: list[str], final_roles: list[str]) -> DataFrame:
    """(match, n_markets, issue) of each match: absent (no row maps to exactly one fixture and one event), identity (rows that name other teams), roles (a match of a group without exactly one market of
    each of roles, another one without exactly one, of final_roles); null if the match can be exported. Rows with other counts of mappings don't count."""
    sound = (F.col("fixture_mapping_count") == 1) & (F.col("primary_mapping_count") == 1)
    kept = F.when(sound, F.struct(*teams))
    of = lambda names: F.count_if(sound & F.col(role).isin(names))
    g = working.groupBy(match).agg(F.count_if(sound).alias("n_markets"), F.min(kept).alias("_a"), F.max(kept).alias("_b"), F.bool_or(sound & grouped).alias("_grouped"), of(final_roles).alias("_final"), *(of([r]).alias(f"_r{i}") for i, r in enumerate(roles)))
    each = F.lit(True)
    for i in range(len(roles)):
        each = each & (F.col(f"_r{i}") == 1)
    whole = F.when(F.col("_grouped"), each & (F.col("n_markets") == len(roles))).otherwise((F.col("n_markets") == 1) & (F.col("_final") == 1))
    return g.select(match, "n_markets", F.when(F.col("n_markets") == 0, "absent").when(~F.col("_a").eqNullSafe(F.col("_b")), "identity").when(~whole, "roles").alias("issue"))


def proposition(role: Column, home: Column, away: Column) -> list[Column]:
    """What yes and no of a market stand for, by its role."""
    team = F.when(role == "home", home).when(role == "away", away)
    yes = F.when(role == "draw", F.lit("draw")).otherwise(F.concat(team, F.lit(" wins")))
    no = F.when(role == "draw", F.lit("either team wins")).otherwise(F.concat(team, F.lit(" does not win")))
    return [yes.alias("yes_represents"), no.alias("no_represents"), team.alias("team_name")]


def exclude_suffixes(df: DataFrame, series: str, suffix: str, excluded: dict[str, list[str]]) -> DataFrame:
    """Rows but those whose suffix is excluded in their series; null series and suffixes stay."""
    out = F.lit(False)
    for name, suffixes in excluded.items():
        out = out | ((F.col(series) == name) & F.col(suffix).isin(suffixes))
    return df.where(~F.coalesce(out, F.lit(False)))


def scope_candidates(sources: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """One row per keys, of the first source that has it, and how many sources do (sources: best first, equal columns)."""
    parts = [df.select(*keys).distinct().withColumn("_rank", F.lit(i)) for i, df in enumerate(sources.values())]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    names = F.array(*map(F.lit, sources))
    best = every.groupBy(*keys).agg(F.min("_rank").alias("_rank"), F.count("*").alias("n_sources"))
    return best.withColumn("scope_source", F.get(names, F.col("_rank"))).drop("_rank")


def planning_context(tokens: DataFrame, key: str, layers: dict[str, DataFrame]) -> DataFrame:
    """One row: the tokens and, per layer, how many and what share of them it holds (null without tokens)."""
    known = tokens.select(key).distinct()
    for name, df in layers.items():
        known = known.join(df.select(key).distinct().withColumn(name, F.lit(1)), key, "left")
    counts = known.agg(F.count("*").alias("n_tokens"), *(F.count(name).alias(f"{name}_tokens") for name in layers))
    return counts.select("*", *(safe_ratio(F.col(f"{name}_tokens"), F.col("n_tokens")).alias(f"{name}_ratio") for name in layers))


def merge_members(df: DataFrame, key: list[str], lo: str, hi: str, gap: int = 0, rows: int = SEGMENT_ROWS) -> DataFrame:
    """Each [lo, hi] with the number of its merged interval in its key, from 1: intervals merge that overlap or lie at most gap apart."""
    reach = scan(df, key, [lo, hi], {"_before": Scan("max", F.col(hi), own=False)}, rows)
    # of equal intervals the one that begins a group comes first in the second scan too
    marked = reach.withColumn("_joins", F.when(F.col(lo) <= F.col("_before") + gap, 1).otherwise(0)).drop("_before")
    return scan(marked, key, [lo, hi, "_joins"], {"merged": Scan("sum", 1 - F.col("_joins"))}, rows).drop("_joins")


def target_gaps(target: DataFrame, done: DataFrame, key: list[str], lo: str, hi: str) -> DataFrame:
    """(gap_lo, gap_hi): what of a key's target [target_lo, target_hi] no done interval covers, edges included."""
    merged = merge_intervals(done, key, lo, hi)
    inside = target.join(merged, key, "left").where("lo IS NULL OR (hi > target_lo AND lo < target_hi)").select(*key, "target_lo", "target_hi", "lo", "hi")
    bare = target.join(inside.select(*key).distinct(), key, "left_anti").select(*key, F.col("target_lo").alias("gap_lo"), F.col("target_hi").alias("gap_hi"))
    ahead = scan(inside, key, ["lo"], {"_before": last_seen(F.col("hi"), own=False)})
    heads = ahead.select(*key, F.coalesce("_before", "target_lo").alias("gap_lo"), F.coalesce(F.least("lo", "target_hi"), F.col("target_hi")).alias("gap_hi"))
    tails = inside.groupBy(*key, "target_hi").agg(F.max("hi").alias("gap_lo")).select(*key, "gap_lo", F.col("target_hi").alias("gap_hi"))
    return heads.unionByName(tails).unionByName(bare).where("gap_hi > gap_lo")


def merge_payloads(df: DataFrame, event: str, item: str, later: list[Column], members: str) -> DataFrame:
    """Per event the union of its payloads' items, by id; of an id's versions the last in the order of later stays."""
    last = df.groupBy(event, item).agg(F.max_by(members, F.struct(*later)).alias("_kept"))
    return last.groupBy(event).agg(F.count("*").alias("n_items"), F.array_sort(F.collect_list(F.struct(item, F.col("_kept").alias(members)))).alias("items"))


def inventory_hash(df: DataFrame, event: str, member: str) -> DataFrame:
    """Per event, the number and the SHA-256 of its distinct members, sorted and comma-joined: equal scans have equal hashes."""
    held = F.array_sort(F.collect_set(F.col(member).cast("string")))
    return df.groupBy(event).agg(held.alias("_m")).select(event, F.size("_m").alias("n_members"), F.sha2(F.array_join("_m", ","), 256).alias("members_sha256"))


def futures_windows(markets: DataFrame, created: str, ended: str, lo: Column, hi: Column) -> DataFrame:
    """[window_lo, window_hi): the target span clipped to a market's life; a null bound is open, empty windows go."""
    return markets.withColumn("window_lo", F.greatest(F.col(created), lo)).withColumn("window_hi", F.least(F.col(ended), hi)).where("window_lo < window_hi")


def reusable(plans: DataFrame, published: DataFrame, key: list[str], at: list[str]) -> DataFrame:
    """Plans with reusable: whether the last published window of their key (in the order of at) equals the planned one."""
    last = published.groupBy(*key).agg(F.max_by(F.struct("window_lo", "window_hi"), F.struct(*at)).alias("_last"))
    same = F.col("_last").eqNullSafe(F.struct("window_lo", "window_hi"))
    return plans.join(last, key, "left").withColumn("reusable", F.col("_last").isNotNull() & same).drop("_last")


def refresh_registry(members: DataFrame, eligible: DataFrame, event: str, market: str, at: list[str]) -> DataFrame:
    """Each market in the event of its last membership, if that event is eligible (eligible: unique events)."""
    last = members.groupBy(market).agg(F.max_by(event, F.struct(*at, event)).alias(event))
    return last.join(eligible.select(event), event, "left_semi")


def check_inventory(found: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """One row per name: rows found, rows expected, and whether they agree."""
    rows = [df.agg(F.count("*").alias("found")).select(F.lit(name).alias("name"), "found", F.lit(want).cast("long").alias("expected"), (F.col("found") == want).alias("ok")) for name, (df, want) in found.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def publish_scan(fills: DataFrame, chunks: DataFrame, chunk: str, expected: str) -> DataFrame:
    """Fills of the chunks that hold as many as expected; chunks whose counts differ publish nothing."""
    counts = fills.groupBy(chunk).agg(F.count("*").alias("_n"))
    whole = chunks.join(counts, chunk, "left").where(F.coalesce("_n", F.lit(0)) == F.col(expected)).select(chunk)
    return fills.join(whole, chunk, "left_semi")


def leaf_audit(events: DataFrame, leaf: list[str], log: list[str], in_scope: Column) -> DataFrame:
    """Per leaf: events, those in scope, and repeated logs. Logs are counted before leaves, so no leaf is held in one task."""
    logs = events.groupBy(*leaf, *log).agg(F.count("*").alias("_n"), F.count_if(in_scope).alias("_in"))
    return logs.groupBy(*leaf).agg(F.sum("_n").alias("n_events"), F.sum("_in").alias("n_in_scope"), F.sum(F.col("_n") - 1).alias("n_repeated_logs"))
