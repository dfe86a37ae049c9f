"""Order books replayed from a stream of their events.

Events wait in state until the watermark of receipt times has passed them, so they are applied in order of receipt however they
arrive; a timer wakes them. Only the current book and what still waits are kept: state does not grow with the stream's length.
A key of state is a bucket of tokens, not a token: a call into Python and its state cost far more than a token's few events.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Columns of events. received and source are epoch milliseconds; bids and asks are JSON arrays of [price, size] of a whole book.
EVENT = "token string, event_type string, received long, source long, sequence long, bids string, asks string, price string, size string, side string"
#: What is emitted: kind snapshot, trade or issue. bids fall and asks rise in price, both as JSON.
OUT = "kind string, token string, window_id string, received long, source long, sequence long, bids string, asks string, levels int, price string, size string, digest string, issue string"
_NAMES = [c.split()[0] for c in EVENT.split(", ")]
#: Buckets of tokens. State is kept by them: a stream must go on with the number it began with.
BUCKETS = 1024
#: Rows that a bucket hands on at once.
OUT_ROWS = 10_000


def _number(text: str | None) -> Decimal | None:
    try:
        value = Decimal(text) if text is not None else None
    except InvalidOperation:
        return None
    return value if value is not None and value.is_finite() else None


def _levels(text: str | None) -> dict[Decimal, Decimal] | None:
    """A whole side; None if it isn't one: each price once, within 0 and 1, sizes not below 0."""
    try:
        pairs = [(_number(str(p)), _number(str(s))) for p, s in json.loads(text or "[]")]
    except (ValueError, TypeError):
        return None
    good = all(p is not None and s is not None and 0 <= p <= 1 and s >= 0 for p, s in pairs) and len({p for p, _ in pairs}) == len(pairs)
    return {p: s for p, s in pairs if s > 0} if good else None


@lru_cache(maxsize=65_536)
def _plain(d: Decimal) -> str:
    return format(d.normalize(), "f")


def _text(side: dict[Decimal, Decimal], falling: bool) -> str:
    return json.dumps([[_plain(p), _plain(side[p])] for p in sorted(side, reverse=falling)], separators=(",", ":"))


class Book:
    """One token's book, and the rules of its events."""

    def __init__(self, bids: str | None, asks: str | None):
        self.sides = {"BUY": _levels(bids) or {}, "SELL": _levels(asks) or {}}

    def texts(self) -> tuple[str, str]:
        return _text(self.sides["BUY"], True), _text(self.sides["SELL"], False)

    def apply(self, event: dict) -> str | None:
        """Applies an event; the reason why not, if it cannot be: then the book is as before."""
        if event["received"] is None or event["source"] is None or event["received"] < event["source"]:
            return "times"
        if event["event_type"] == "book":
            bids, asks = _levels(event["bids"]), _levels(event["asks"])
            if bids is None or asks is None:
                return "levels"
            self.sides = {"BUY": bids, "SELL": asks}
        elif event["event_type"] == "price_change":
            price, size = _number(event["price"]), _number(event["size"])
            if event["side"] not in self.sides or price is None or size is None or not 0 <= price <= 1 or size < 0:
                return "price_change"
            side = self.sides[event["side"]]
            if size:
                side[price] = size
            else:
                side.pop(price, None)
        return None

    def crossed(self) -> bool:
        return bool(self.sides["BUY"] and self.sides["SELL"]) and max(self.sides["BUY"]) > min(self.sides["SELL"])


def replay(token: str, book: Book, events: list[dict], windows: list[tuple[str, int, int]]) -> Iterator[tuple]:
    """Rows of OUT for events in order. A changed book gives a snapshot in every window [lo, hi) that holds its receipt, a trade a trade; events
    that cannot be applied and books that cross give an issue wherever they lie, and a crossed book no snapshot."""
    for e in events:
        at = (e["received"], e["source"], e["sequence"])
        issue = book.apply(e)
        changed = issue is None and e["event_type"] in ("book", "price_change")
        if changed and book.crossed():
            issue, changed = "crossed", False
        if issue:
            yield ("issue", token, None, *at, None, None, None, e["price"], e["size"], None, issue)
        for name, lo, hi in windows:
            if issue or not lo <= e["received"] < hi:
                continue
            if changed:
                bids, asks = book.texts()
                digest = hashlib.sha256(f"{token}|{e['source']}|{bids}|{asks}".encode()).hexdigest()
                yield ("snapshot", token, name, *at, bids, asks, len(book.sides["BUY"]) + len(book.sides["SELL"]), None, None, digest, None)
            elif e["event_type"] == "last_trade_price":
                yield ("trade", token, name, *at, None, None, None, e["price"], e["size"], None, None)


def _order(event: dict) -> tuple:
    return tuple(-1 if event[c] is None else event[c] for c in ("received", "source", "sequence"))


class ReplayProcessor(StatefulProcessor):
    """windows: JSON of each token's windows travels with its events, in column windows. States are JSON: known, the book and the windows
    of each token; pending, a text for each frame of events that wait, with the windows of their tokens."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "tokens string")
        self.pending = handle.getListState("pending", "events string")

    def _tokens(self) -> dict[str, list]:
        """token: bids, asks, windows."""
        return {token: rest for token, *rest in json.loads(self.known.get()[0])} if self.known.exists() else {}

    def _keep(self, tokens: dict[str, list]) -> None:
        self.known.update((json.dumps([[token, *rest] for token, rest in tokens.items()]),))  # not an object: a token may be null

    def handleInitialState(self, key, initialState, timerValues) -> None:
        tokens = self._tokens()
        for frame in [initialState] if isinstance(initialState, pd.DataFrame) else initialState:
            tokens |= {row.token: [row.bids, row.asks, None] for row in frame.itertuples(index=False)}
        self._keep(tokens)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            if not len(frame):
                continue
            columns = [[None if v is None or v != v else int(v) if c in ("received", "source", "sequence") else v for v in frame[c].tolist()] for c in _NAMES]
            windows = dict(zip(reversed(columns[0]), reversed(frame["windows"].tolist()), strict=True))
            self.pending.appendValue((json.dumps([list(windows.items()), list(zip(*columns, strict=True))]),))
            at = min((v for v in columns[_NAMES.index("received")] if v is not None), default=0)
            first = at if first is None else min(first, at)
        if first is not None:
            self.handle.registerTimer(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed, found, due, later, at = timerValues.getCurrentWatermarkInMs(), {}, defaultdict(list), [], _NAMES.index("received")
        for (text,) in self.pending.get() if self.pending.exists() else ():
            windows, rows = json.loads(text)
            found = dict(windows) | found
            for row in rows:
                if row[at] is None or row[at] < passed:
                    due[row[0]].append(row)
                else:
                    later.append(row)
        if later:
            self.handle.registerTimer(min(row[at] for row in later))
        if not due:
            return
        if later:
            self.pending.put([(json.dumps([list({row[0]: found[row[0]] for row in later}.items()), later]),)])
        else:
            self.pending.clear()
        tokens, out = self._tokens(), []
        for token, waited in due.items():
            events = [dict(zip(_NAMES, row, strict=True)) for row in waited]
            bids, asks, windows = tokens.get(token, (None, None, None))
            windows = found[token] or "[]" if windows is None else windows
            book = Book(bids, asks)
            for row in replay(token, book, sorted(events, key=_order), [(name, int(lo), int(hi)) for name, lo, hi in json.loads(windows)]):
                out.append(row)
                if len(out) >= OUT_ROWS:
                    yield _frame(out)
                    out = []
            tokens[token] = [*book.texts(), windows]
        self._keep(tokens)
        if out:
            yield _frame(out)

    def close(self) -> None:
        pass


def _frame(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")]).astype({c: "Int64" for c in ("received", "source", "sequence", "levels")})


def token_windows(windows: DataFrame) -> DataFrame:
    """(token, windows): each token's windows (token, window_id, lo, hi in epoch milliseconds) as JSON. A token has a handful."""
    each = F.array_sort(F.collect_list(F.struct("lo", "hi", "window_id")))
    return windows.groupBy("token").agg(F.to_json(F.transform(each, lambda w: F.array(w["window_id"], w["lo"].cast("string"), w["hi"].cast("string")))).alias("windows"))


def stream_books(events: DataFrame, seeds: DataFrame, windows: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """A stream of rows of OUT from a stream of events (columns of EVENT). delay: how much later than a later one an event may arrive.

    seeds: token, bids, asks: the books before the first event; tokens without one start empty. windows: token, window_id, lo, hi. Events of tokens
    without a window keep their book up to date and emit issues only. Events later than the watermark, and events without a receipt time, which
    no order holds, are dropped by it; everything else comes out once the watermark has passed it. State must be in RocksDB (use_rocksdb).
    """
    known = token_windows(windows)
    timed = events.where("received IS NOT NULL").withColumn("_at", F.timestamp_millis("received")).withWatermark("_at", delay)
    bucket = F.pmod(F.xxhash64("token"), F.lit(BUCKETS)).cast("int").alias("bucket")
    dealt = timed.join(F.broadcast(known) if known.count() <= 1_000_000 else known, "token", "left").select("*", bucket)
    return dealt.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=ReplayProcessor(), outputStructType=OUT, outputMode="Append", timeMode="EventTime", initialState=seeds.select("token", "bids", "asks", bucket).groupBy("bucket")
    )


def use_rocksdb(spark) -> None:
    """Keeps the state of this session's streams in RocksDB, as timers and several states a key need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
