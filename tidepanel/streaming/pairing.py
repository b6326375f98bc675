"""Keyed state of a stream of two feeds: a day is passed on once both feeds have items for it.

The state of a day holds the items of the pages that came, as JSON, until the other feed's first items come; then all go on
together, and later pages of that day go on at once. Pages without items say that a day was seen, and wait for nothing. A day whose second feed has not come ``wait`` after its last page is passed on
as unpaired, with its items, and its state is given up; so state holds days that wait, not days that were loaded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidepanel.sources.landed import fault, page_schema

LANES = 64  # faulty pages have no day; they are dealt over this many keys
EVENT = "day date, kind string, file string, items string, reason string"
EVENT_COLUMNS = ["day", "kind", "file", "items", "reason"]
STATE = "stock array<string>, index array<string>, paired boolean"
OUT = f"{EVENT}, status string"
SEEN, PAIRED, UNPAIRED, FAULTY = "seen", "paired", "unpaired", "faulty"


def page_events(pages: DataFrame, kind: str) -> DataFrame:
    """An event per sound page and day, with the day's items, and one per faulty page, with its text.

    Days are those of the items and the date (yyyyMMdd) in the file's name, so a page without items counts for its day.
    """
    named = F.to_date(F.try_to_timestamp(F.regexp_extract("file", "([0-9]{8})", 1), F.lit("yyyyMMdd")))
    dated = F.transform("data", lambda i: F.to_date(F.try_to_timestamp(i["Date"])))
    judged = pages.withColumn("reason", fault(kind)).withColumn(
        "day", F.explode_outer(F.when(F.col("reason").isNull(), F.array_compact(F.array_distinct(F.concat(dated, F.array(named))))))
    )
    own = F.to_json(F.filter("data", lambda i: F.to_date(F.try_to_timestamp(i["Date"])) == F.col("day")))
    return judged.select("day", F.lit(kind).alias("kind"), "file", F.when(F.col("reason").isNull(), own).otherwise(F.col("value")).alias("items"), "reason")


def paired_days(events: DataFrame, wait: timedelta) -> DataFrame:
    """Events with a status: every sound page is ``seen`` at once, and its items come ``paired`` or ``unpaired``."""
    patience = int(wait.total_seconds() * 1000)

    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        day = key[0]
        if state.hasTimedOut:
            stock, index, paired = state.get
            state.remove()
            yield _rows(day, {} if paired else {"stock": stock, "index": index}, UNPAIRED)
            return
        seen = pd.concat(list(batches), ignore_index=True)[EVENT_COLUMNS]
        if day is None or pd.isna(day):
            yield seen.assign(status=seen.reason.map(lambda r: SEEN if r is None else FAULTY))
            return
        held = dict(zip(("stock", "index", "paired"), state.get)) if state.exists else {"stock": [], "index": [], "paired": False}
        filled = seen[seen["items"] != "[]"]
        feeds = {k: [*held[k], *filled.loc[filled.kind == k, "items"]] for k in ("stock", "index")}
        paired = bool(held["paired"]) or all(feeds.values())
        yield seen.assign(items=None, status=SEEN)
        if paired:
            yield _rows(day, feeds, PAIRED)
            feeds = {"stock": [], "index": []}
        state.update((feeds["stock"], feeds["index"], paired))
        state.setTimeoutDuration(patience)

    lane = F.when(F.col("day").isNull(), F.pmod(F.xxhash64("file", "items"), F.lit(LANES))).otherwise(F.lit(0)).cast("int")
    return events.withColumn("lane", lane).groupBy("day", "lane").applyInPandasWithState(
        step, OUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def _rows(day: object, feeds: dict[str, list[str]], status: str) -> pd.DataFrame:
    rows = [(day, kind, None, items, None, status) for kind, pages in feeds.items() for items in pages]
    return pd.DataFrame(rows, columns=["day", "kind", "file", "items", "reason", "status"])


def pages_of(rows: DataFrame, kind: str) -> DataFrame:
    """Items of one feed as pages again."""
    items = page_schema(kind)["data"].dataType
    return rows.where(F.col("kind") == kind).select("day", F.from_json("items", items).alias("data"))
