"""Filling containers of fixed capacity with items: Karmarkar-Karp multiway differencing.

Items go to groups at random (a hash of their id), each group worth a fixed number of containers, so
a group is bounded whatever the data and groups are packed side by side. In a group every item
starts as a partial partition of k windows holding it alone; the two partitions with the largest
differences merge again and again, the largest windows of one onto the smallest of the other, which
gives k near-equal windows. k starts at the least possible count. A window above the capacity
exchanges single items with windows that have room; where no exchange helps, it is filled again with
the emptiest windows; k rises while that leaves one above the capacity. Only an item longer than the
capacity is split: full pieces take a container each.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_CONTAINERS = 192
GROUP_ITEMS = 8192


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each item. Partial partitions keep only their non-empty windows, largest first."""
    n = len(sizes)
    if k <= 1:
        return np.zeros(n, np.int64)
    left, right = [-1] * n, [-1] * n  # a window is an item or the union of two windows
    order = np.argsort(-sizes, kind="stable")
    heap = [(-int(sizes[i]), c, np.array([sizes[i]], np.int64), np.array([i], np.int64)) for c, i in enumerate(order.tolist())]
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, sa, wa = heapq.heappop(heap)
        _, _, sb, wb = heapq.heappop(heap)
        over = max(0, len(sa) + len(sb) - k)
        if over:  # the smallest windows of both meet, largest with smallest
            at = len(sb) - over
            ms = sa[len(sa) - over :] + sb[at:][::-1]
            mw = np.arange(len(left), len(left) + over)
            left += wa[len(wa) - over :].tolist()
            right += wb[at:][::-1].tolist()
            s, w = np.concatenate([sa[: len(sa) - over], sb[:at], ms]), np.concatenate([wa[: len(wa) - over], wb[:at], mw])
        else:
            s, w = np.concatenate([sa, sb]), np.concatenate([wa, wb])
        o = np.argsort(-s, kind="stable")
        s, w = s[o], w[o]
        spread = int(s[0]) - (int(s[-1]) if len(s) == k else 0)
        heapq.heappush(heap, (-spread, serial, s, w))
        serial += 1
    window = np.zeros(len(left), np.int64)
    roots = heap[0][3]
    window[roots] = np.arange(len(roots))
    for x in range(len(left) - 1, n - 1, -1):  # a union was made after its parts
        window[left[x]] = window[right[x]] = window[x]
    return window[:n]


def best_fit(x: list[int], capacity: int, k: int) -> list[int] | None:
    """Best-fit decreasing into at most k windows, or None; x in descending order."""
    free: list[tuple[int, int]] = []
    at, used = [], 0
    for size in x:
        i = bisect_left(free, (size, -1))
        if i == len(free):
            if used == k:
                return None
            room, w, used = capacity, used, used + 1
        else:
            room, w = free.pop(i)
        insort(free, (room - size, w))
        at.append(w)
    return at


def exchange(x: np.ndarray, window: np.ndarray, k: int, capacity: int) -> np.ndarray:
    """Relieves over-full windows item by item: an item changes places with a smaller one, or with the room itself, of a
    window that can take the difference. The least sufficient difference is taken, else the greatest one; windows that no
    exchange relieves stay as they are."""
    load = np.bincount(window, weights=x, minlength=k).astype(np.int64)
    size, at = np.concatenate([x, np.zeros(k, np.int64)]), np.concatenate([window, np.arange(k)])
    over = np.flatnonzero(load > capacity)
    for w in over[np.argsort(-load[over], kind="stable")].tolist():
        while (excess := load[w] - capacity) > 0:
            room = capacity - load[at]
            mine, theirs = np.flatnonzero((at == w) & (size > 0)), np.flatnonzero(room > 0)
            gain = size[mine][:, None] - size[theirs][None, :]
            gain = np.where((gain > 0) & (gain <= room[theirs][None, :]), gain, 0)
            if not gain.any():
                break
            enough = gain >= excess
            p = int(np.where(enough, gain, np.iinfo(np.int64).max).argmin() if enough.any() else gain.argmax())
            i, j = mine[p // len(theirs)], theirs[p % len(theirs)]
            load[w], load[at[j]] = load[w] - gain.flat[p], load[at[j]] + gain.flat[p]
            at[i], at[j] = at[j], w
    return at[: len(x)]


def repair(x: np.ndarray, window: np.ndarray, k: int, capacity: int) -> np.ndarray | None:
    """Brings windows that the differencing left above the capacity under it, or None.

    The over-full windows and as many of the emptiest ones are filled again together, largest item
    first into the least sufficient space; while that fails, twice as many windows take part.
    """
    load = np.bincount(window, weights=x, minlength=k)
    over = int((load > capacity).sum())
    if not over:
        return window
    order = np.concatenate([np.flatnonzero(load > capacity), (o := np.argsort(load, kind="stable"))[load[o] <= capacity]])
    m = 2 * over
    while True:
        m = min(m, k)
        some = order[:m]
        at = np.flatnonzero(np.isin(window, some))
        at = at[np.argsort(-x[at], kind="stable")]
        if load[some].sum() <= m * capacity and (got := best_fit(x[at].tolist(), capacity, m)) is not None:
            window = window.copy()
            window[at] = some[got]
            return window
        if m == k:
            return None
        m *= 2


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The container of each item (none longer than the capacity), counted from 0, and whether it left its differencing window."""
    out, moved = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
    some = np.flatnonzero(sizes > 0)
    if not len(some):
        return out, moved
    x = sizes[some]
    k, step, best = max(-(-int(x.sum()) // capacity), int((2 * x > capacity).sum()), 1), 1, None
    failed = k - 1

    def attempt(k: int) -> tuple[np.ndarray, np.ndarray] | None:
        window = differencing(x, k)
        got = repair(x, exchange(x, window, k, capacity), k, capacity)
        return None if got is None else (got, got != window)

    while (best := attempt(k)) is None:  # rise until the windows fit, in growing steps
        failed, k, step = k, min(k + step, len(x)), step * 2
    while k - failed > 1:  # then close in on the least count seen to fit
        mid = (k + failed) // 2
        got = attempt(mid)
        if got is None:
            failed = mid
        else:
            k, best = mid, got
    out[some], moved[some] = best
    return out, moved


def pack_items(items: DataFrame, key: str, size: str, limits: DataFrame, limit_id: str, capacity: str, at_once: int = 500) -> DataFrame:
    """limit_id, container_id, key, piece_no, start_token, n_tokens, moved: the assignment for every capacity.

    Items of size 0 take no space and join a container of their group. Null sizes give no row.
    Limits with a null or non-positive capacity are left out; every limit gives a row per item, so
    limits are taken in blocks of ``at_once``, as many as there are. Repeated keys are packed as
    separate items. ``moved`` tells the items that are not in the window the differencing gave them.
    """
    kinds = dict(limits.dtypes)
    it = items.where(F.col(size).isNotNull()).select(F.col(key).alias("_key"), F.col(size).cast("long").alias("_size"))
    total = it.agg(F.sum("_size").alias("t"), F.count("*").alias("n")).first()
    t, n = total.t or 0, total.n
    none = F.struct(F.lit(None).cast(kinds[limit_id]).alias("limit"), F.lit(None).cast("long").alias("cap"), F.lit(None).cast("long").alias("groups"))
    blocks, block = [], []
    for r in limits.where(F.col(capacity) > 0).select(limit_id, capacity).toLocalIterator():
        groups = max(1, round(t / (GROUP_CONTAINERS * int(r[1]))), round(n / GROUP_ITEMS))
        one = F.struct(F.lit(r[0]).cast(kinds[limit_id]).alias("limit"), F.lit(int(r[1])).cast("long").alias("cap"), F.lit(groups).cast("long").alias("groups"))
        block.append(one)
        if len(block) == at_once:
            blocks, block = [*blocks, block], []
    parts = [it.select("_key", "_size", F.inline(F.array(*b))) for b in ([*blocks, block] if block else blocks)]
    each = reduce(DataFrame.unionByName, parts) if parts else it.select("_key", "_size", F.inline(F.array(none))).where("false")
    full = F.floor(F.greatest(F.col("_size") - 1, F.lit(0)) / F.col("cap"))  # whole pieces before the last
    each = each.withColumn("_full", F.when(F.col("_size") > F.col("cap"), full).otherwise(0).cast("int"))
    whole = each.where("_full > 0").withColumn("_no", F.explode(F.sequence(F.lit(0), F.col("_full") - 1)))
    name = F.concat(F.lit("full-"), F.col("_key").cast("string"), F.lit("-"), F.col("_no").cast("string"))
    whole = whole.select(
        F.col("limit").alias(limit_id), name.alias("container_id"), F.col("_key").alias(key), F.col("_no").alias("piece_no"),
        (F.col("_no") * F.col("cap")).alias("start_token"), F.col("cap").alias("n_tokens"), F.lit(False).alias("moved"),
    )
    rest = each.select(
        "limit", "cap", "_key", F.col("_full").alias("_no"), (F.col("_full") * F.col("cap")).alias("_start"),
        (F.col("_size") - F.col("_full") * F.col("cap")).alias("_left"), F.pmod(F.xxhash64("limit", "_key"), F.col("groups")).alias("grp"),
    )
    key_kind = dict(items.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_key", "_no"], kind="stable")
        at, moved = pack(pdf["_left"].to_numpy(np.int64), int(pdf["cap"].iloc[0]))
        names = [f"g{g}-{c}" for g, c in zip(pdf["grp"], at.tolist())]
        out = {limit_id: pdf["limit"], "container_id": names, key: pdf["_key"], "piece_no": pdf["_no"], "start_token": pdf["_start"], "n_tokens": pdf["_left"]}
        return pd.DataFrame(out | {"moved": moved})

    schema = f"`{limit_id}` {kinds[limit_id]}, container_id string, `{key}` {key_kind}, piece_no int, start_token long, n_tokens long, moved boolean"
    return whole.unionByName(rest.groupBy("limit", "grp").applyInPandas(run, schema))
